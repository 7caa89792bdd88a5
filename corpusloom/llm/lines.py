"""Line dedup: content-defined chunks of lines; runs of several lines that occurred before are removed.

A rolling hash over the hashes of ``window`` lines ends a chunk where it is a multiple of ``divisor``, so lines that
are put in or taken out move only the boundaries near them; a chunk ends after ``longest`` lines in any case. Chunks
with at least ``min_lines`` lines that have text are compared over all documents: digests first, then the bytes of
those whose digest repeats. The first occurrence (smallest id, then place) stays, all later ones go.

A passage that is cut into a text need not hold a whole chunk, and sticks out of those it holds. So what the chunks
left is searched on: the smallest runs of lines with ``min_lines`` lines of text that lie in no removed chunk, across
chunk boundaries too, are compared by 128-bit BLAKE2b digests. Together a line goes if, and only if, any run of lines
around it with at least ``min_lines`` lines that have text occurred before, as a contiguous run, in an earlier document
or earlier in its own without overlap. The first occurrence of each distinct line always stays.

Hot chunks and runs are counted with partial counts in each task, and their rows stay where they are in the joins
(``common.joined``): no task gathers the occurrences of one.

Defined cases: a null text counts as empty and stays null; lines end at ``\\n`` alone; a row whose id is null comes after all others;
rows with the same id and text are one document, so a repeated row is no reason to remove anything; other columns pass
through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import joined, map_batches, text_bytes, written

BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
#: Bytes of a chunk beyond which it is not broadcast, however often it occurs.
LIGHT = 1 << 16


def chunks(lines: list[bytes], window: int, divisor: int, longest: int) -> list[tuple[int, int]]:
    """Chunks (first line, line after the last) that cover all lines."""
    import xxhash

    h = [xxhash.xxh3_64_intdigest(x) for x in lines]
    top = pow(BASE, window, 1 << 64)
    out, start, rolling = [], 0, 0
    for i, x in enumerate(h):
        rolling = (rolling * BASE + x) & MASK
        if i >= window:
            rolling = (rolling - h[i - window] * top) & MASK
        if ((rolling ^ rolling >> 31) * BASE & MASK) >> 40 & 0xFFFF < 0x10000 // divisor or i + 1 - start >= longest:
            out.append((start, i + 1))
            start = i + 1
    if start < len(lines):
        out.append((start, len(lines)))
    return out


def smallest_runs(lines: list[bytes], least: int) -> Iterator[tuple[int, int, bytes]]:
    """First line, line after the last and digest of each run with ``least`` lines of text that has no such run within it.

    Blank lines are kept with the run: those inside are part of it, and each at an end makes a run of its own, whose
    digest continues the one of its neighbour, so that many blank lines cost no more than others.
    """
    from hashlib import blake2b

    at = [i for i, x in enumerate(lines) if x.strip()]
    for k in range(len(at) - least + 1):
        a, b = at[k], at[k + least - 1] + 1
        core = blake2b(b"\n".join(lines[a:b]), digest_size=16).digest()
        yield a, b, core
        digest = core
        for i in range(a - 1, at[k - 1] if k else -1, -1):
            digest = blake2b(lines[i] + b"\n" + digest, digest_size=16, person=b"before").digest()
            yield i, b, digest
        digest = core
        for i in range(b, at[k + least] if k + least < len(at) else len(lines)):
            digest = blake2b(lines[i] + b"\n" + digest, digest_size=16, person=b"after").digest()
            yield a, i + 1, digest


def dedup_lines(df: DataFrame, window: int = 2, divisor: int = 4, min_lines: int = 2, longest: int = 64, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All columns of ``df`` with every repeated run of lines cut from the text, and ``line_stats``: lines, chunks, chunks of which no line stays, removed lines."""
    if "line_stats" in df.columns:
        raise ValueError("column line_stats is in the input already")
    text = F.coalesce(F.col(text_column), F.lit(""))
    key = [F.coalesce(F.col(id_column).cast("bigint"), F.lit((1 << 63) - 1)).alias("did"), F.xxhash64(text).alias("th")]
    docs = df.select(*key, text.alias("text"))

    def digests():
        from hashlib import blake2b

        def batch(rows: pa.RecordBatch):
            at, chunk, whole, a, b, sums = [], [], [], [], [], []

            def made() -> pa.RecordBatch:
                pairs = np.frombuffer(b"".join(sums), dtype="<i8").reshape(-1, 2)
                where = pa.array(at, pa.int64())
                columns = [rows.column(0).take(where), rows.column(1).take(where), pa.array(chunk, pa.int32()), pa.array(whole, pa.bool_()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())]
                return pa.RecordBatch.from_arrays(columns, names=["did", "th", "chunk", "whole", "a", "b", "d1", "d2"])

            for k, data in enumerate(text_bytes(rows.column(2))):
                lines = data.split(b"\n")
                if sum(1 for x in lines if x.strip()) < min_lines:
                    continue
                parts = chunks(lines, window, divisor, longest)
                own = [no for no, (i, j) in enumerate(parts) for _ in range(i, j)]
                found = [(no, True, i, j, blake2b(b"\n".join(lines[i:j]), digest_size=16).digest()) for no, (i, j) in enumerate(parts) if sum(1 for x in lines[i:j] if x.strip()) >= min_lines]
                found += [(own[i] if own[i] == own[j - 1] else -1, False, i, j, digest) for i, j, digest in smallest_runs(lines, min_lines)]
                for row in found:
                    at.append(k)
                    for out, x in zip((chunk, whole, a, b, sums), row, strict=True):
                        out.append(x)
                if len(at) >= 1 << 16:
                    yield made()
                    for out in (at, chunk, whole, a, b, sums):
                        out.clear()
            if at:
                yield made()

        return batch

    seen = written(map_batches(docs, digests, "did bigint, th bigint, chunk int, whole boolean, a int, b int, d1 bigint, d2 bigint"), "lines")
    whole = seen.where("whole").select("did", "th", "chunk", "a", "b", "d1", "d2")
    twice = written(whole.groupBy("d1", "d2").agg(F.count("*").alias("n")).where("n > 1"), "twice")
    marks = joined(whole, twice, ["d1", "d2"], "n", whole.count()).groupBy("did", "th").agg(F.collect_set(F.struct("chunk", "a", "b")).alias("marks"))

    def bodies():
        def batch(rows: pa.RecordBatch):
            at, body = [], []
            where = {"chunk": [], "a": [], "b": []}
            for k, (data, some) in enumerate(zip(text_bytes(rows.column(2)), rows.column(3).to_pylist(), strict=True)):
                lines = data.split(b"\n")
                for m in some:
                    at.append(k)
                    body.append(b"\n".join(lines[m["a"] : m["b"]]))
                    for name, out in where.items():
                        out.append(m[name])
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([rows.column(0).take(at), rows.column(1).take(at), *[pa.array(x, pa.int32()) for x in where.values()], pa.array(body, pa.binary())], names=["did", "th", *where, "body"])

        return batch

    repeated = docs.join(marks.hint("shuffle_hash"), ["did", "th"]).select("did", "th", "text", "marks")
    found = written(map_batches(repeated, bodies, "did bigint, th bigint, chunk int, a int, b int, body binary"), "bodies")
    light = F.when(F.length("body") <= LIGHT, F.count("*")).otherwise(0)  # heavy bodies are never broadcast
    first = written(found.groupBy("body").agg(F.min(F.struct("did", "th", "chunk")).alias("first"), light.alias("n")), "firsts")
    cut = joined(found, first, ["body"], "n", found.count()).where(F.struct("did", "th", "chunk") != F.col("first"))
    cut = written(cut.select("did", "th", "chunk", "a", "b").distinct(), "cut")

    runs = seen.where("not whole").join(cut.select("did", "th", "chunk"), ["did", "th", "chunk"], "left_anti").select("did", "th", "a", "b", "d1", "d2")
    runs = written(runs, "runs")
    place = F.struct("did", "th", "a", "b")
    start = runs.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("n")).where("first <> last").select("d1", "d2", "first", "n")
    start = written(start, "starts")
    same = (F.col("did") == F.col("first.did")) & (F.col("th") == F.col("first.th"))
    later = joined(runs, start, ["d1", "d2"], "n", runs.count()).where(~same | (F.col("a") >= F.col("first.b")))
    gone = later.select("did", "th", "a", "b").union(cut.select("did", "th", "a", "b")).groupBy("did", "th").agg(F.collect_set(F.struct("a", "b")).alias("runs"))

    whole = df.select(F.struct(*df.columns).alias("row"), *key).join(gone.hint("shuffle_hash"), ["did", "th"], "left").select("row.*", F.col("runs").alias("line_stats"))
    names = list(df.columns)
    at = names.index(text_column)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", line_stats struct<lines: bigint, chunks: bigint, removed_chunks: bigint, removed_lines: bigint>"

    def clean():
        def batch(rows: pa.RecordBatch):
            texts, stats = [], []
            for data, runs in zip(rows.column(at).cast(pa.binary()).to_pylist(), rows.column(len(names)).to_pylist(), strict=True):
                lines = (data or b"").split(b"\n")
                parts = chunks(lines, window, divisor, longest)
                drop: set[int] = set()
                for x in runs or ():
                    drop.update(range(x["a"], x["b"]))
                if drop:
                    data = b"\n".join(x for i, x in enumerate(lines) if i not in drop)
                texts.append(data)
                cut = sum(drop.issuperset(range(a, b)) for a, b in parts) if drop else 0
                stats.append({"lines": len(lines), "chunks": len(parts), "removed_chunks": cut, "removed_lines": len(drop)})
            columns = list(rows.columns[:-1])
            columns[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(stats, pa.struct([(k, pa.int64()) for k in ("lines", "chunks", "removed_chunks", "removed_lines")]))], names=[*names, "line_stats"])

        return batch

    return map_batches(whole, clean, schema)
