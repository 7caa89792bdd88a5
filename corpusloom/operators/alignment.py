"""Monotonic alignment of two cue tracks of a video."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Group sizes, allowed mismatch and band in seconds, and the weights of the score.
MOST_LEFT, MOST_RIGHT = 3, 5
SLACK, BAND = 3.0, 40.0
SKIP, MERGE, TIME = 0.30, 0.04, 0.3

SCHEMA = "video string, step int, kind string, left_ids string, right_ids string, score double, left_text string, right_text string"


def group_texts(cues: DataFrame, key: str, most: int) -> DataFrame:
    """Every distinct text that up to ``most`` consecutive cues of a track make."""
    lines = cues.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda c: c["text"]).alias("t"))
    spans = lines.select(F.explode(F.sequence(F.lit(1), F.size("t"))).alias("i"), "t").select("t", "i", F.explode(F.sequence(F.lit(1), F.least(F.lit(most), F.size("t") - F.col("i") + 1))).alias("n"))
    return spans.select(F.array_join(F.slice("t", F.col("i"), F.col("n")), " ").alias("text")).distinct()


#: Ways into a cell, in the order that settles equal scores: groups (left cues, right cues), then a cue that is left out.
GROUPS = [(a, b) for a in range(MOST_LEFT, 0, -1) for b in range(MOST_RIGHT, 0, -1)]
WAYS = [*GROUPS, (1, 0), (0, 1)]


def group_gains(left: np.ndarray, right: np.ndarray, a: int, b: int, i: int, cols: np.ndarray) -> np.ndarray:
    """Time share less merge cost of joining ``a`` left cues from ``i`` on with ``b`` right cues from each of ``cols``; -inf where they lie apart."""
    start, end = right[cols, 0], right[cols + b - 1, 1]
    shared = np.minimum(left[i + a - 1, 1], end) - np.maximum(left[i, 0], start)
    whole = np.maximum(left[i + a - 1, 1], end) - np.minimum(left[i, 0], start)
    return np.where(shared + SLACK < 0, -np.inf, TIME * np.maximum(shared, 0.0) / np.maximum(whole, 1e-6) - MERGE * (a + b - 2))


def best_path(left: list[tuple], right: list[tuple], likeness) -> list[tuple]:
    """Steps (left cue, right cue, left cues, right cues, likeness) of the best monotonic path; cues are (start, end, text).

    Rows of a score table are filled one after another, each from the rows before it: all columns of a way at once,
    the best way by ``argmax``, and left-out right cues by a running maximum along the row. Only columns whose cue
    starts within ``BAND`` of the row's cue pass their score on.
    """
    n, m = len(left), len(right)
    times = [np.array([c[:2] for c in cues], dtype=float).reshape(-1, 2) for cues in (left, right)]
    moments = np.r_[times[0][:, 0], times[0][-1:, 1] if n else 0.0]
    first = np.maximum(np.searchsorted(times[1][:, 0], moments - BAND) - MOST_RIGHT, 0)
    last = np.minimum(np.searchsorted(times[1][:, 0], moments + BAND, side="right"), m)
    first[0], last[n] = 0, m
    joined = [[[" ".join(c[2] for c in cues[i : i + k]) for k in range(most + 1)] for i in range(len(cues))] for cues, most in ((left, MOST_LEFT), (right, MOST_RIGHT))]

    passing = np.full((n + 1, m + 1), -np.inf)  # scores that later cells may build on
    way, alike = np.full((n + 1, m + 1), -1, dtype=np.int8), np.full((n + 1, m + 1), np.nan)
    reach = -np.inf
    for i in range(n + 1):
        offers, likes = np.full((len(GROUPS) + 1, m + 1), -np.inf), np.full((len(GROUPS), m + 1), np.nan)
        for k, (a, b) in enumerate(GROUPS):
            if i < a or m < b:
                continue
            gain = passing[i - a, : m - b + 1].copy()
            cols = np.flatnonzero(np.isfinite(gain))
            gain[cols] += group_gains(*times, a, b, i - a, cols)
            cols = cols[np.isfinite(gain[cols])]
            likes[k, cols + b] = [likeness(joined[0][i - a][a], joined[1][j][b]) for j in cols.tolist()]
            offers[k, cols + b] = gain[cols] + likes[k, cols + b]
        if i:
            offers[-1] = passing[i - 1] - SKIP
        chosen = offers.argmax(axis=0)
        row = offers[chosen, np.arange(m + 1)]
        if i == 0:
            row[0] = 0.0
        # A run of left-out right cues costs SKIP for each: the best start of a run, within the columns that pass on.
        steps = SKIP * np.arange(m + 1)
        run = np.full(m + 1, -np.inf)
        run[first[i] : last[i] + 1] = np.maximum.accumulate((row + steps)[first[i] : last[i] + 1])
        before = np.r_[-np.inf, run[:-1]] - steps
        over = before > row + 1e-12
        row = np.where(over, before, row)
        way[i] = np.where(over, len(WAYS) - 1, np.where(np.isfinite(row), chosen, -1))
        grouped = np.flatnonzero(~over & (chosen < len(GROUPS)))
        alike[i, grouped] = likes[chosen[grouped], grouped]
        passing[i, first[i] : last[i] + 1] = row[first[i] : last[i] + 1]
        reach = row[m]
    if not np.isfinite(reach):
        raise ValueError("the band is too narrow for these tracks")
    path, i, j = [], n, m
    while i or j:
        a, b = WAYS[way[i, j]]
        i, j, like = i - a, j - b, alike[i, j]
        path.append((i, j, a, b, None if np.isnan(like) else float(like)))
    return path[::-1]


def align(left: DataFrame, right: DataFrame, likeness) -> DataFrame:
    """Aligned groups of each ``video``; tracks have ``video``, ``start``, ``end``, ``text``. A video is one group: its tracks are bounded by its length."""

    def one(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        x, y = (list(d.sort_values(["start", "end"], kind="stable")[["start", "end", "text"]].itertuples(index=False, name=None)) for d in (a, b))
        rows = []
        for k, (i, j, n, m, like) in enumerate(best_path(x, y, likeness)):
            ids = lambda at, count: "+".join(str(at + 1 + q) for q in range(count))
            kind = f"{n}:{m}" if n and m else "left_only" if n else "right_only"
            rows.append((key[0], k, kind, ids(i, n), ids(j, m), None if like is None else round(like, 3), " ".join(c[2] for c in x[i : i + n]), " ".join(c[2] for c in y[j : j + m])))
        return pd.DataFrame(rows, columns=["video", "step", "kind", "left_ids", "right_ids", "score", "left_text", "right_text"])

    return left.groupBy("video").cogroup(right.groupBy("video")).applyInPandas(one, SCHEMA)
