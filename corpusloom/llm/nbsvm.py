"""Quality classifier: Naive Bayes support vectors.

Features are indicators of hashed n-grams: words (1 and 2) and word shapes (1 to 3; a shape keeps case, digits,
punctuation and whether the word repeats the one before). Each indicator is scaled by the class log-count ratio of its
n-gram, rows have unit length, and a linear hinge-loss model is fitted by dual coordinate descent. The weights are
interpolated with their mean, the margin is made a probability by a logistic curve fitted on rows set aside.

The fit sees at most ``max_rows`` labelled rows, those with the smallest hash of their id. That sample and the weights
(``2 ** BITS`` floats) are bounded whatever the input; scoring reads every whole text in one pass without a shuffle.

Defined cases: a null or empty text has no n-grams and gets the score of the intercept; labels that are null, that
have no document or that contradict each other are left out; without labels every score is 0.5, with one class alone
it is that class's smoothed share; repeated rows get equal scores; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bpe import Memo
from corpusloom.llm.common import map_batches, text_bytes

BITS = 18


@dataclass(frozen=True)
class Fit:
    """Parameters of the fit; ``max_rows`` bounds the sample of labelled rows."""

    max_rows: int = 6000
    smooth: float = 1.0
    cost: float = 1.0
    interpolate: float = 0.25
    epochs: int = 20
    aside: float = 0.25


SHAPES = ((re.compile(rb"[A-Z]"), b"X"), (re.compile(rb"[a-z]"), b"x"), (re.compile(rb"[0-9]"), b"d"), (re.compile(rb"[\x80-\xff]+"), b"u"), (re.compile(rb"(.)\1+", re.S), rb"\1+"))


def shape(word: bytes) -> bytes:
    for pattern, by in SHAPES:
        word = pattern.sub(by, word)
    return word[:24]


class Features:
    """Indices of the n-grams that a text has."""

    def __init__(self):
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        self.memo = Memo(100_000)
        self.make = lambda words: [(digest(w.lower()), digest(shape(w), 7)) for w in words]

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.split()
        if not words:
            return np.zeros(0, dtype=np.int32)
        get = self.memo.fill(set(words), self.make).__getitem__
        both = np.array(list(map(get, words)), dtype=np.uint64)
        w, s = both[:, 0], both[:, 1].copy()
        s[1:][w[1:] == w[:-1]] += np.uint64(0x51ED270B)
        a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
        pair = s[:-1] * a + s[1:] * b
        grams = [w * a, (w[:-1] * b + w[1:]) * a, (s ^ b) * a, pair * a, (pair[:-1] * b + s[2:]) * b]
        return np.unique((np.concatenate(grams) >> np.uint64(64 - BITS)).astype(np.int32))


def descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: float, epochs: int) -> np.ndarray:
    """Weights (the last is the intercept) of a hinge-loss model by dual coordinate descent."""
    w, alpha = np.zeros((1 << BITS) + 1), np.zeros(len(rows))
    square = np.array([float(v @ v) + 1 for v in values])
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(rows)):
            r, v = rows[i], values[i]
            slope = y[i] * (v @ w[r] + w[-1]) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), cost)
            if change := (new - alpha[i]) * y[i]:
                w[r] += change * v
                w[-1] += change
                most = max(most, abs(change))
                alpha[i] = new
        if most < 1e-4:
            break
    return w


def ratios(rows: list[np.ndarray], y: np.ndarray, smooth: float) -> np.ndarray:
    """Class log-count ratio of each n-gram."""
    counts = [np.bincount(np.concatenate([r for r, k in zip(rows, y, strict=True) if k == sign] or [np.zeros(0, dtype=np.int32)]), minlength=1 << BITS) + smooth for sign in (1, -1)]
    return np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())


def scaled(row: np.ndarray, r: np.ndarray) -> np.ndarray:
    v = r[row]
    return v / (np.sqrt(v @ v) or 1)


def logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, with smoothed targets, by Newton's method."""
    up, down = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        d, h = p - target, p * (1 - p) + 1e-9
        grad = np.array([d @ margins + 1e-3 * a, d.sum()])
        hess = np.array([[h @ margins**2 + 1e-3, h @ margins], [h @ margins, h.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return max(float(a), 1e-3), float(b)


def train(rows: list[np.ndarray], labels: list[int], fit: Fit) -> dict:
    """The model: ``r`` (ratios), ``w`` (weights with the intercept), ``a`` and ``b`` of the curve."""
    y = np.where(np.array(labels, dtype=int) == 1, 1, -1)
    zero = {"r": np.zeros(1 << BITS, dtype=np.float32), "w": np.zeros((1 << BITS) + 1, dtype=np.float32), "a": 1.0, "b": 0.0}
    if len(set(y.tolist())) < 2:
        share = ((y > 0).sum() + 1) / (len(y) + 2)
        return zero | {"b": float(np.log(share / (1 - share)))}

    def model(some: np.ndarray):
        mine, ys = [rows[i] for i in some], y[some]
        r = ratios(mine, ys, fit.smooth)
        w = descend(mine, [scaled(x, r) for x in mine], ys, fit.cost, fit.epochs)
        mean = np.abs(w[:-1]).sum() / max(1, len(np.unique(np.concatenate(mine))))  # over the n-grams that occur
        w[:-1] = (1 - fit.interpolate) * mean + fit.interpolate * w[:-1]
        return r, w

    margin = lambda x, r, w: float(scaled(x, r) @ w[x] + w[-1])
    aside = np.arange(len(rows)) < round(fit.aside * len(rows))
    a, b = 1.0, 0.0
    if len(set(y[~aside].tolist())) == 2 and len(set(y[aside].tolist())) == 2:
        r, w = model(np.flatnonzero(~aside))
        a, b = logistic(np.array([margin(rows[i], r, w) for i in np.flatnonzero(aside)]), y[aside])
    r, w = model(np.arange(len(rows)))
    return {"r": r.astype(np.float32), "w": w.astype(np.float32), "a": a, "b": b}


def fitted(df: DataFrame, labels: DataFrame, label_column: str = "quality", fit: Fit | None = None, id_column: str = "doc_id", text_column: str = "text") -> dict:
    """Fit on at most ``fit.max_rows`` labelled rows of ``df``; ``labels``: the id and a 0/1 column."""
    fit = fit or Fit()
    key = F.col(id_column)
    sample = labels.where(key.isNotNull() & F.col(label_column).isin(0, 1)).groupBy(key.alias("id")).agg(F.min(label_column).cast("int").alias("y"), F.max(label_column).cast("int").alias("z"))
    sample = sample.where("y = z").select("id", "y", F.xxhash64("id").alias("place")).orderBy("place", "id").limit(fit.max_rows)
    rows = df.select(key.alias("id"), F.col(text_column).alias("text")).join(F.broadcast(sample), "id").select("place", "id", "y", "text")

    def extract():
        features = Features()

        def batch(rows: pa.RecordBatch):
            grams = [features(t).tobytes() for t in text_bytes(rows.column(3))]
            yield pa.RecordBatch.from_arrays([*rows.columns[:3], pa.array(grams, pa.binary())], names=["place", "id", "y", "grams"])

        return batch

    def learn(batches):
        found = sorted((r["place"], r["id"], r["grams"], r["y"]) for b in batches for r in b.to_pylist())
        model = train([np.frombuffer(f[2], dtype=np.int32) for f in found], [f[3] for f in found], fit)
        yield pa.RecordBatch.from_pylist([{"r": model["r"].tobytes(), "w": model["w"].tobytes(), "curve": json.dumps([model["a"], model["b"]])}])

    grams = map_batches(rows, extract, f"place bigint, id {df.schema[id_column].dataType.simpleString()}, y int, grams binary")
    row = grams.repartition(1).mapInArrow(learn, "r binary, w binary, curve string").first()
    if row is None:
        return train([], [], fit)
    a, b = json.loads(row["curve"])
    return {"r": np.frombuffer(row["r"], dtype=np.float32), "w": np.frombuffer(row["w"], dtype=np.float32), "a": a, "b": b}


def scorer(model: dict):
    """``text bytes -> score``."""
    features, r = Features(), model["r"]
    weight, square, end = r * model["w"][:-1], r * r, float(model["w"][-1])

    def score(text: bytes) -> float:
        x = features(text)
        margin = float(weight[x].sum(dtype=np.float64)) / (float(np.sqrt(square[x].sum(dtype=np.float64))) or 1) + end
        return float(1 / (1 + np.exp(-np.clip(model["a"] * margin + model["b"], -30, 30))))

    return score


def scores(df: DataFrame, model: dict, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` of each row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def one():
        score = scorer(shared.value)

        def batch(rows: pa.RecordBatch):
            s = np.array([score(t) for t in text_bytes(rows.column(1))])
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[id_column, "score", "predicted"])

        return batch

    return map_batches(df.select(id_column, text_column), one, f"`{id_column}` {df.schema[id_column].dataType.simpleString()}, score double, predicted int")


def accepted(df: DataFrame, model: dict, least: float = 0.5, text_column: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, whose score is at least ``least``."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_column)

    def one():
        score = scorer(shared.value)

        def batch(rows: pa.RecordBatch):
            yield rows.filter(pa.array([score(t) >= least for t in text_bytes(rows.column(at))], pa.bool_()))

        return batch

    return map_batches(df, one, df.schema)


def held_out(key, fold: int = 1, folds: int = 3):
    """Column: the row belongs to the fold that is kept from the fit (false for a null id)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))
