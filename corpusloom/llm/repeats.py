"""Windows of a text that occur again anywhere: the search that substring dedup by bytes and by words share.

A window is ``length`` consecutive symbols (bytes or words) of one document. Each window has an anchor: the leftmost
of the smallest hashes of its ``gram``-symbol strings. That depends on nothing outside the window, so equal windows
have equal anchors and windows are only compared with those of the same anchor string:

1. Every document is cut into contexts: a run of windows with one anchor. A row has the hashes of its anchor string
   and of its whole context, never text.
2. Anchors are counted. An anchor string that occurs once ends the search for its windows. Of equal contexts (same
   anchor hash and context hash, 128 bits together) one is cut from its document and stands for all of them.
3. Contexts meet by anchor in cells of bounded size, where a solver puts windows of equal symbols into one class.
4. The contexts of an anchor with more text than a cell holds are searched like documents: by blocks of windows whose
   anchor lies at nearly the same offset. Equal windows have it at the same offset, and all windows of a block share a
   stretch of text, much longer than the anchor, which is the key of the block. Blocks whose stretch occurs once end
   there. Blocks get smaller (``FINER``) until each key fits a cell; with one offset the stretch is the window itself.
5. What was found in a context holds for all its occurrences.

Steps 1 and 2 and the removal read each document once each; the texts are shuffled for the two joins by document.
Joins by anchor and by context keep hot keys where they are (``common.joined``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import bounded_batches, dropped, joined, map_batches, text_bytes, written

#: Symbols scanned at a time, and bytes of a cell.
PIECE, CELL = 1 << 20, 1 << 20
#: By how much blocks of windows get smaller if a key has more text than a cell.
FINER = 8
BASE = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class View:
    """How a text becomes symbols. ``symbols(text)`` gives their 64-bit values and, for each, where it starts and ends in ``data``."""

    length: int
    gram: int
    make: Callable[[], Callable[[bytes], tuple[bytes, np.ndarray, np.ndarray | None, np.ndarray | None]]]
    #: Classes of the windows of each part, and how many windows each class has; parts have weights.
    solve: Callable[[list[bytes], list[int], int], tuple[list[np.ndarray], np.ndarray]]
    #: Bytes of a symbol, roughly, and whether what is found comes with its text.
    scale: int = 1
    with_data: bool = False

    def cut(self, data: bytes, starts, ends, a: int, b: int) -> bytes:
        """Bytes of the symbols a..b-1."""
        return data[a:b] if starts is None else data[starts[a] : ends[b - 1]]


class Powers:
    """Powers of ``BASE`` and of its inverse modulo 2**64."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                x = np.full(max(n, 1 << 14), base, dtype=np.uint64)
                x[0] = 1
                setattr(self, name, np.cumprod(x, dtype=np.uint64))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def hashed(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches of ``values``: equal for equal stretches, wherever they lie."""
    up, down = POWERS.upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:-1], dtype=np.uint64, out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def contexts(values: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last window, the anchor and its hash of each context of a sequence of symbols."""
    if len(values) < length:
        return (*(np.zeros(0, dtype=np.int64),) * 3, np.zeros(0, dtype=np.uint64))
    parts = []
    for a in range(0, len(values) - length + 1, PIECE):
        *places, h = _piece(values[a : a + PIECE + length - 1], length, gram)
        parts.append([*[x + a for x in places], h])
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _piece(values: np.ndarray, length: int, gram: int):
    n = len(values)
    first = np.arange(n - gram + 1)
    whole = hashed(values, first, first + gram)
    h = (whole & ~np.uint64((1 << 21) - 1)) | first.astype(np.uint64)  # equal hashes: the leftmost counts as the smallest
    wide = length - gram + 1
    blocks = np.full(-(-len(h) // wide) * wide, np.uint64(0xFFFFFFFFFFFFFFFF))
    blocks[: len(h)] = h
    blocks = blocks.reshape(-1, wide)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    least = np.minimum(back[:windows], ahead[wide - 1 : wide - 1 + windows])
    at = (least & np.uint64((1 << 21) - 1)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return first, np.r_[first[1:] - 1, windows - 1], at[first], whole[at[first]]


def blocks_of(lo: np.ndarray, hi: np.ndarray, at: np.ndarray, width: int, length: int) -> tuple[np.ndarray, ...]:
    """The contexts' windows in blocks of ``width`` offsets of the anchor: first and last window, the stretch that all windows of the block share (symbols a..b-1), and the block's number."""
    first = (at - hi) // width
    n = (at - lo) // width - first + 1
    of = np.repeat(np.arange(len(lo)), n)
    block = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    last = at[of] - block * width
    least = last - width + 1
    return np.maximum(lo[of], least), np.minimum(hi[of], last), last, least + length, block


def scan(df: DataFrame, view: View, width: int | None = None) -> DataFrame:
    """A row for each context: ``key`` and ``ctx`` (hashes of anchor and context), the document, ``pos`` (first window * length + windows - 1).

    With ``width``, a row for each block of windows of a context: ``key`` is the hash of what its windows share. ``df`` then has a ``weight``, which the rows keep.
    """

    def one():
        import xxhash

        digest, symbols = xxhash.xxh3_64_intdigest, view.make()
        length, gram = view.length, view.gram

        def in_data(a, b, starts, ends):
            return (a if starts is None else starts[a]).tolist(), (b if starts is None else ends[b - 1]).tolist()

        def batch(rows: pa.RecordBatch):
            keys, whole, where, docs = [], [], [], []
            for k, text in enumerate(text_bytes(rows.column(2))):
                data, values, starts, ends = symbols(text)
                lo, hi, at, anchor = contexts(values, length, gram)
                if not len(lo):
                    continue
                if width:
                    lo, hi, a, b, block = blocks_of(lo, hi, at, width, length)
                    shared = zip(*in_data(a, b, starts, ends), block.tolist(), strict=True)
                    anchor = np.array([digest(data[a:b], seed=k) for a, b, k in shared], dtype=np.uint64)
                keys.append(anchor)
                whole += [digest(data[a:b]) for a, b in zip(*in_data(lo, hi + length, starts, ends), strict=True)]
                where.append(lo * length + (hi - lo))
                docs.append(np.full(len(lo), k))
            if keys:
                docs = pa.array(np.concatenate(docs))
                as_long = lambda x: pa.array(np.array(x, dtype=np.uint64).view(np.int64))
                more = [rows.column(3).take(docs)] if width else []
                yield pa.RecordBatch.from_arrays([as_long(np.concatenate(keys)), as_long(whole), rows.column(0).take(docs), rows.column(1).take(docs), pa.array(np.concatenate(where)), *more], names=["key", "ctx", "did", "th", "pos", *["weight"] * len(more)])

        return batch

    return map_batches(df, one, "key bigint, ctx bigint, did bigint, th bigint, pos bigint" + ", weight int" * bool(width))


def cut_out(rows: DataFrame, view: View) -> DataFrame:
    """The symbols of each distinct context, cut from the document of one occurrence; ``weight`` 2 stands for several."""

    def one():
        symbols = view.make()

        def batch(rows: pa.RecordBatch):
            made, data_out = [], []
            for text, marks in zip(text_bytes(rows.column(0)), rows.column(1).to_pylist(), strict=True):
                data, _, starts, ends = symbols(text)
                for m in marks:
                    lo, more = divmod(m["pos"], view.length)
                    made.append((m["key"], m["tile"], m["ctx"], m["weight"]))
                    data_out.append(view.cut(data, starts, ends, lo, lo + more + view.length))
            keys, tiles, ctxs, weights = zip(*made, strict=True) if made else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(tiles, pa.int32()), pa.array(ctxs, pa.int64()), pa.array(data_out, pa.binary()), pa.array(weights, pa.int32())], names=["key", "tile", "ctx", "data", "weight"])

        return batch

    return map_batches(rows, one, "key bigint, tile int, ctx bigint, data binary, weight int")


FOUND = "large boolean, key bigint, ctx bigint, a bigint, b bigint, weight int, data binary"


def runs_of(flags: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Symbols a..b-1 that the flagged windows cover, as runs of windows."""
    edge = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
    return [(int(a), int(b) - 1 + length) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def settled(pieces: DataFrame, view: View) -> DataFrame:
    """What the repeated windows of each distinct context cover, from its start.

    The contexts of a key that has more text than a cell (``tile`` is not negative) pass as they are, as ``large`` rows.
    """
    bounded_batches(pieces.sparkSession)

    def run(batches):
        symbols = view.make()
        schema = pa.schema([("large", pa.bool_()), ("key", pa.int64()), ("ctx", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("weight", pa.int32()), ("data", pa.binary())])
        done: list[tuple] = []

        def cell(rows: list[tuple]):
            classes, count = view.solve([r[3] for r in rows], [r[4] for r in rows], view.length)
            for (key, _, ctx, part, _), found in zip(rows, classes, strict=True):
                runs = runs_of(count[found] > 1, view.length)
                if runs and view.with_data:
                    data, _, starts, ends = symbols(part)
                for a, b in runs:
                    done.append((False, key, ctx, a, b, None, view.cut(data, starts, ends, a, b) if view.with_data else None))
                if len(done) > 5000:
                    yield out()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
            done.clear()
            return made

        held: list[tuple] = []
        now, size = None, 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                key, tile, ctx, data, weight = row
                if tile >= 0:
                    done.append((True, key, ctx, None, None, weight, data))
                    if len(done) > 5000:
                        yield out()
                    continue
                if key != now:
                    if size >= CELL:
                        yield from cell(held)
                        held, size = [], 0
                    now = key
                held.append(row)
                size += len(data)
        if held:
            yield from cell(held)
        if done:
            yield out()

    return pieces.repartition("key", "tile").sortWithinPartitions("key", "tile").mapInArrow(run, FOUND)


def tiled(contexts: DataFrame, view: View) -> DataFrame:
    """``contexts`` with ``tile``: -1, or which part of the contexts of a key with more text than a cell."""
    size = F.sum((F.pmod("one.pos", F.lit(view.length)) + view.length) * view.scale)
    large = written(contexts.groupBy("key").agg(F.count("*").alias("total"), F.ceil(size / CELL).cast("int").alias("tiles")).where("tiles > 1 and total > 1"), "large")
    if not large.head(1):
        return contexts.withColumn("tile", F.lit(-1))
    split = joined(contexts, large, ["key"], "total", contexts.count(), "left")
    return split.select(*contexts.columns, F.when(F.col("tiles") > 1, F.pmod(F.xxhash64("ctx"), "tiles").cast("int")).otherwise(-1).alias("tile"))


def repeated(df: DataFrame, view: View, width: int | None = None) -> DataFrame:
    """What repeated windows cover in each occurrence of a context: ``did``, ``th``, ``lo`` (first symbol of the context) and ``r`` (symbols a..b-1 from there, and their ``data`` if the view has it).

    ``df``: ``did``, ``th``, ``text``; with ``width``, contexts to be searched by blocks of so many offsets, and the ``weight`` of each.
    """
    every = written(scan(df, view, width), "scan")
    weight = F.sum("weight") if width else F.count("*")
    anchors = written(every.groupBy("key").agg(F.count("*").alias("total"), weight.alias("all")).where("all > 1").drop("all"), "anchors")
    rows = written(joined(every, anchors, ["key"], "total", every.count()).select(every.columns), "candidates")
    dropped(every)
    dropped(anchors)
    contexts = written(rows.groupBy("key", "ctx").agg(F.count("*").alias("n"), F.least(weight, F.lit(2)).cast("int").alias("weight"), F.min(F.struct("did", "th", "pos")).alias("one")), "contexts")
    mark = F.struct("one.pos", "key", "tile", "ctx", "weight")
    cells = contexts.withColumn("tile", F.lit(-1)) if width == 1 else tiled(contexts, view)
    by_doc = cells.groupBy("one.did", "one.th").agg(F.collect_list(mark).alias("marks"))
    pieces = cut_out(df.join(by_doc.hint("shuffle_hash"), ["did", "th"]).select("text", "marks"), view)
    found = written(settled(pieces, view), "found")
    spans = found.where("not large").select("key", "ctx", F.struct("a", "b", "data").alias("r"))
    if found.where("large").head(1):
        whole = found.where("large").select(F.col("key").alias("did"), F.col("ctx").alias("th"), F.col("data").alias("text"), "weight")
        finer = repeated(whole, view, -(-(width or view.length - view.gram + 1) // FINER))
        run = F.struct((F.col("lo") + F.col("r.a")).alias("a"), (F.col("lo") + F.col("r.b")).alias("b"), F.col("r.data").alias("data"))
        spans = spans.unionByName(finer.select(F.col("did").alias("key"), F.col("th").alias("ctx"), run.alias("r")))
    marks = spans.groupBy("key", "ctx").agg(F.collect_list("r").alias("runs"))
    marks = written(marks.join(contexts.select("key", "ctx", "n"), ["key", "ctx"]), "marks")
    dropped(found)
    dropped(contexts)
    each = joined(rows, marks, ["key", "ctx"], "n", rows.count())
    return each.select("did", "th", F.floor(F.col("pos") / view.length).alias("lo"), F.explode("runs").alias("r"))


def spans_of(each: DataFrame) -> DataFrame:
    """``did``, ``th``, ``found``: what the repeated windows of each document cover (symbols a..b-1)."""
    spans = each.select("did", "th", F.struct((F.col("lo") + F.col("r.a")).alias("a"), (F.col("lo") + F.col("r.b")).alias("b")).alias("s"))
    return spans.groupBy("did", "th").agg(F.collect_list("s").alias("found"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of covered symbols, ascending."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans or []):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def keyed(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``did``, ``th`` (together they name a row's text), ``text`` and the id.

    A row whose id is null has two 64-bit hashes of its text instead, the second one salted: 128 bits that no row with
    an id can have but by chance, so results of such rows depend on their text alone.
    """
    text, own = F.coalesce(F.col(text_column), F.lit("")), F.col(id_column).cast("bigint")
    none = F.lit("no id")
    did = F.when(own.isNull(), F.xxhash64(none, text)).otherwise(own)
    return df.select(did.alias("did"), F.when(own.isNull(), F.xxhash64(text, none)).otherwise(F.xxhash64(text)).alias("th"), text.alias("text"), F.col(id_column).alias("own"))


def reported(df: DataFrame, view: View, found_in: Callable, make: Callable, columns: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row for each row of ``df``: its id and ``columns``.

    ``found_in(each)`` gathers what ``repeated`` found for each document as ``found``. ``make()`` gives the function of
    a block of texts and their ``found`` that makes the rows.
    """
    rows = keyed(df, id_column, text_column)
    found = found_in(repeated(rows.drop("own"), view))
    whole = rows.join(found.hint("shuffle_hash"), ["did", "th"], "left").select("own", "text", "found")
    schema = f"`{id_column}` {df.schema[id_column].dataType.simpleString()}, {columns}"
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names, types = zip(*((c.split()[0], kinds[c.split()[1]]) for c in columns.split(", ")), strict=True)

    def one():
        block = make()

        def batch(rows: pa.RecordBatch):
            made = block(text_bytes(rows.column(1)), rows.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([rows.column(0), *[pa.array([m[i] for m in made], t) for i, t in enumerate(types)]], names=[id_column, *names])

        return batch

    return map_batches(whole, one, schema)
