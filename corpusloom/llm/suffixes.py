"""Substring dedup by bytes: a suffix array built by bucket-pointer refinement decides which strings repeat.

Of every text's UTF-8 bytes, each byte is removed that a ``length``-byte string covers which also starts anywhere
else. Cells of candidate text (see ``repeats``) are sorted: suffixes start in buckets by their first ``GRAM`` bytes; a
suffix's bucket pointer is where its bucket begins in the array. Buckets are refined one range of the array after
another. A bucket whose suffixes agree in ``d`` bytes is sorted by the pointers of the positions ``d`` further on; new
pointers replace the old ones at once, so later buckets, and the sub-buckets themselves, reuse every refinement that
went before: a sub-bucket agrees in ``d`` bytes and in as many as the bucket it points to. Refinement of a bucket ends
with one suffix or ``length`` bytes. Strings that repeat are then neighbours in the array, and neighbours of different
buckets are compared byte by byte.

Defined cases: a null text counts as empty; repeated rows are occurrences of each other, so both lose the strings;
rows whose id is null are treated alike; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from corpusloom.llm.repeats import View, merged, reported, spans_of

#: Bytes of the first buckets, and suffixes of the buckets that are refined together.
GRAM, RANGE = 8, 1 << 16


def grams_of(text: np.ndarray, room: np.ndarray, q: int) -> np.ndarray:
    """The next ``q`` bytes of each position as a number; zeros stand behind the end of a part."""
    padded = np.zeros(len(text) + q, dtype=np.uint64)
    padded[: len(text)] = text
    out = np.zeros(len(text), dtype=np.uint64)
    for i in range(q):
        out = (out << np.uint64(8)) | padded[i : i + len(text)]
    ends = np.flatnonzero(room < q)
    over = ((q - room[ends]) * 8).astype(np.uint64)
    out[ends] = out[ends] >> over << over
    return out


def suffix_array(grams: np.ndarray, room: np.ndarray, length: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix positions in order, and the bucket pointer of each position, refined to ``length`` bytes."""
    n = len(grams)
    short = room < q
    order = np.argsort(grams)
    ranked, ends = grams[order], short[order]
    edge = np.r_[True, ranked[1:] != ranked[:-1]]
    if (~edge[1:] & (ends[1:] != ends[:-1])).any():  # texts with zero bytes: ends of parts come first
        order = np.lexsort((~short, grams))
        ranked, ends = grams[order], short[order]
        edge = np.r_[True, ranked[1:] != ranked[:-1]]
    edge[1:] |= ends[1:] | ends[:-1]
    heads = np.flatnonzero(edge)
    sizes = np.diff(np.r_[heads, n])
    pointer = np.empty(n, dtype=np.int64)
    pointer[order] = np.repeat(heads, sizes)
    depth = np.zeros(n, dtype=np.int64)
    depth[heads] = q
    if q >= length:
        return order, pointer
    wide = 2 * n + 1
    many, count = heads[sizes > 1], sizes[sizes > 1]
    cuts = np.flatnonzero(np.diff(np.cumsum(count) // RANGE)) + 1
    for some, size in zip(np.split(many, cuts), np.split(count, cuts), strict=True):
        at = np.repeat(some - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        live = order[at]
        while len(live):
            bucket = pointer[live]
            known = depth[bucket]
            ended = room[live] <= known
            target = np.where(ended, -1 - live, pointer[np.where(ended, live, live + known)])
            by = np.argsort(bucket * wide + target + n)
            live, bucket, target, known = live[by], bucket[by], target[by], known[by]
            top = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            sub = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (target[1:] != target[:-1])])
            place = bucket + np.arange(len(live)) - np.repeat(top, np.diff(np.r_[top, len(live)]))
            sizes = np.diff(np.r_[sub, len(live)])
            reach = known[sub] + np.where(target[sub] >= 0, depth[np.maximum(target[sub], 0)], 0)
            order[place] = live
            pointer[live] = np.repeat(place[sub], sizes)
            depth[place[sub]] = reach
            live = live[np.repeat((sizes > 1) & (reach < length), sizes)]
    return order, pointer


def solve(parts: list[bytes], weights: list[int], length: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each part the classes of its windows, and the number of windows in each class; a part stands for as many as its weight."""
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    text = np.frombuffer(b"".join(parts), dtype=np.uint8)
    room = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(text))
    q = min(GRAM, length)
    grams = grams_of(text, room, q)
    order, pointer = suffix_array(grams, room, length, q)
    windows = order[room[order] >= length]
    alike = np.zeros(max(0, len(windows) - 1), dtype=bool)
    left, right = windows[:-1], windows[1:]
    open_ = np.flatnonzero(pointer[left] != pointer[right])
    alike[pointer[left] == pointer[right]] = True
    for offset in [*range(0, length - q, q), length - q]:
        open_ = open_[grams[left[open_] + offset] == grams[right[open_] + offset]]
    alike[open_] = True
    found = np.full(len(text), -1, dtype=np.int64)
    number = np.cumsum(np.r_[True, ~alike])[: len(windows)] - 1
    found[windows] = number
    n = np.bincount(number, weights=np.repeat(np.array(weights, dtype=np.float64), sizes)[windows])
    starts = np.cumsum(sizes) - sizes
    return [found[s : s + max(0, k - length + 1)] for s, k in zip(starts, sizes, strict=True)], n


def byte_symbols():
    table = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return lambda text: (text, table[np.frombuffer(text, dtype=np.uint8)], None, None)


def byte_view(length: int) -> View:
    return View(length, min(64, length), byte_symbols, solve)


def kept_bytes(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for a, b in runs:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def dedup_substrings(df: DataFrame, length: int = 400, with_text: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``; ``with_text`` adds ``kept`` (binary: a removed run may end within a character)."""

    def make():
        def row(text: bytes, runs: list[tuple[int, int]]):
            kept = kept_bytes(text, runs)
            return (len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept)

        return lambda texts, found: [row(t, merged(f)) for t, f in zip(texts, found, strict=True)]

    columns = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_text
    return reported(df, byte_view(length), spans_of, make, columns, id_column, text_column)
