"""Functions that no built-in expresses, as pandas UDFs over Arrow batches.

Return types are objects, not text: workers import this module, and they cannot parse type names.
"""

from __future__ import annotations

import difflib
import re
import unicodedata
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN = re.compile(r"[\w']+")


@F.pandas_udf(T.StringType())
def composed_form(text: pd.Series) -> pd.Series:
    """Canonical composition; null is empty."""
    return text.map(lambda t: unicodedata.normalize("NFC", t or ""))


@F.pandas_udf(T.StringType())
def compatible_form(text: pd.Series) -> pd.Series:
    """Compatibility composition; null is empty."""
    return text.map(lambda t: unicodedata.normalize("NFKC", t or ""))


@F.pandas_udf(T.StringType())
def base_letters(text: pd.Series) -> pd.Series:
    """Text without combining marks; null is empty."""
    return text.map(lambda t: "".join(c for c in unicodedata.normalize("NFD", t or "") if not unicodedata.combining(c)))


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff and Obershelp's likeness of two texts, popular characters of long texts left out; null if one is null."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="object")


def chrf_counts(hypothesis: str, reference: str, order: int = 6) -> list[tuple[int, int, int]]:
    """Per n-gram length: n-grams of the hypothesis, of the reference, and common ones; white space does not count."""
    h, r = "".join(hypothesis.split()), "".join(reference.split())
    out = []
    for n in range(1, order + 1):
        a, b = Counter(h[i : i + n] for i in range(len(h) - n + 1)), Counter(r[i : i + n] for i in range(len(r) - n + 1))
        out.append((a.total(), b.total(), (a & b).total()))
    return out


def chrf_score(counts: list[tuple[int, int, int]], beta: float = 2.0) -> float:
    """Character F-score in percent: precision and recall are means over the orders that both sides have."""
    both = [(h, r, m) for h, r, m in counts if h and r]
    if not both:
        return 0.0
    precision, recall = sum(m / h for h, _, m in both) / len(both), sum(m / r for _, r, m in both) / len(both)
    if not precision + recall:
        return 0.0
    return 100 * (1 + beta**2) * precision * recall / (beta**2 * precision + recall)


@F.pandas_udf(T.DoubleType())
def chrf(hypothesis: pd.Series, reference: pd.Series) -> pd.Series:
    """Sentence score; null counts as empty."""
    return pd.Series([chrf_score(chrf_counts(h or "", r or "")) for h, r in zip(hypothesis, reference, strict=True)])


@F.pandas_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
def chrf_statistics(hypothesis: pd.Series, reference: pd.Series) -> pd.Series:
    """Counts to be summed over a corpus before scoring."""
    return pd.Series([[list(c) for c in chrf_counts(h or "", r or "")] for h, r in zip(hypothesis, reference, strict=True)])


@F.pandas_udf(T.StructType([T.StructField("chrf", T.DoubleType()), T.StructField("span", T.IntegerType()), T.StructField("novelty", T.DoubleType())]))
def divergence(literal: pd.Series, human: pd.Series) -> pd.DataFrame:
    """How far a line departs from a literal one: score, longest new run of words, share of new words."""
    rows = []
    for a, b in zip(literal, human, strict=True):
        x, y = TOKEN.findall((a or "").lower()), TOKEN.findall((b or "").lower())
        new = [j2 - j1 for tag, _, _, j1, j2 in difflib.SequenceMatcher(a=x, b=y, autojunk=False).get_opcodes() if tag in ("replace", "insert")]
        rows.append((chrf_score(chrf_counts(a or "", b or "")), max(new, default=0), sum(new) / max(1, len(y))))
    return pd.DataFrame(rows, columns=["chrf", "span", "novelty"]).astype({"span": "int32"})


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
URL = r"(?:https?://|www\.)[^\s<>\"')]+[^\s<>\"').,;:!?]"
PHONE = r"(?<![\w.])\(?\+?\d[\d() -]{6,17}\d\)?(?![\w])"


@F.pandas_udf(T.ArrayType(T.StringType()))
def entity_candidates(text: pd.Series) -> pd.Series:
    """E-mail addresses, then URLs, then phone numbers: each new value that meets no earlier match; outer brackets go.

    A text that is nothing but the entity has no candidate.
    """
    patterns = [re.compile(p) for p in (EMAIL, URL, PHONE)]

    def of(t):
        found, out = [], []
        for m in (m for p in patterns for m in p.finditer(t or "")):
            fresh = all(m[0] != v and (m.end() <= a or m.start() >= b) for v, a, b in found)
            found.append((m[0], *m.span()))
            if fresh and m[0] != t:
                out.append(m[0][1:-1] if m[0][0] == "(" and m[0][-1] == ")" else m[0])
        return out

    return text.map(of)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])))
def resampled_path(points: pd.Series, count: pd.Series) -> pd.Series:
    """A path as ``count`` points at equal distances along it."""
    import numpy as np

    def of(path, n):
        xy = np.array([(p["x"], p["y"]) for p in path], dtype=float)
        if not len(xy) or n < 1:
            return []
        along = np.r_[0, np.cumsum(np.hypot(*np.diff(xy, axis=0).T))] if len(xy) > 1 else np.zeros(1)
        at = np.linspace(0, along[-1], int(n))
        return [{"x": float(x), "y": float(y)} for x, y in zip(np.interp(at, along, xy[:, 0]), np.interp(at, along, xy[:, 1]), strict=True)]

    return pd.Series([of(p if p is not None else [], n) for p, n in zip(points, count, strict=True)])
