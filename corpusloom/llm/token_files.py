"""Token-ID files: flat unsigned integers with 64-bit document offsets, memory-mapped, in ascending id order.

A shard is three files of the shared folder: ``.tok`` (little-endian ids, two bytes each if the vocabulary allows it,
else four), ``.off`` (64-bit token offsets within the shard, one more than documents) and ``.doc`` (64-bit document
ids). Shards follow one another by range of the id; their bases are prefix sums of the shards' counts, kept in a
manifest with one row for each shard. A task writes under a name of its own and renames when the file is whole, so a
task that runs again replaces its files with the same content.

Defined cases: a null text counts as empty and has the end id alone; repeated rows and repeated ids are all kept,
next to each other and ordered by a hash of their text; a row whose id is null comes first, its id is stored as the smallest 64-bit
integer and read back as null; an empty table gives no shards and no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import urllib.parse
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.bpe import blocks, codec, read_spec
from corpusloom.llm.common import bounded_batches, map_batches, shared_path, text_bytes

NO_ID = -(1 << 63)


def local(path: str) -> str:
    """Path on the shared mount of a ``file:`` address; other stores need a mount of their own."""
    parts = urllib.parse.urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"token files are memory-mapped: {path} is not on a mounted file system")
    return parts.path


def write_tokens(df: DataFrame, tokenizer: str, end_id: int | None = None, folder: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> str:
    """Encode every text with the library, append ``end_id`` to each, write the shards; returns their folder."""
    spark = df.sparkSession
    bounded_batches(spark)
    folder = folder or shared_path(spark, "tokens")
    where = local(folder)
    os.makedirs(where, exist_ok=True)
    spec = spark.sparkContext.broadcast(read_spec(tokenizer))

    def write(batches):
        from pyspark import TaskContext

        bpe = codec(spec.value, by_library=True)
        kind = f"<u{bpe.width}"
        end = b"" if end_id is None else np.array([end_id], dtype=kind).tobytes()
        name, own = f"{where}/{TaskContext.get().partitionId():08d}", uuid.uuid4().hex
        offsets, n = [np.zeros(1, dtype="<i8")], 0

        def make(chunks):
            return bpe.library_bytes(chunks, kind)

        docs = 0
        with open(f"{name}.tok.{own}", "wb") as tok, open(f"{name}.doc.{own}", "wb") as doc:
            for rows in batches:
                texts = text_bytes(rows.column(1))
                for a, b in blocks(texts):
                    chunks = [t.split() for t in texts[a:b]]
                    get = bpe.chunks.fill(set().union(*chunks), make).__getitem__
                    data = [b"".join(map(get, words)) + end for words in chunks]
                    tok.write(b"".join(data))
                    ends = n + np.cumsum([len(d) // bpe.width for d in data], dtype="<i8")
                    offsets.append(ends)
                    n = int(ends[-1])
                doc.write(rows.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                docs += rows.num_rows
        np.concatenate(offsets).astype("<i8").tofile(f"{name}.off.{own}")
        for kind_of in ("tok", "off", "doc"):
            os.replace(f"{name}.{kind_of}.{own}", f"{name}.{kind_of}")
        yield pa.RecordBatch.from_pylist([{"shard": os.path.basename(name), "docs": docs, "tokens": n, "width": bpe.width}] if docs else [], schema=pa.schema([("shard", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()), ("width", pa.int32())]))

    key = F.col(id_column).cast("bigint")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))  # rows of one id may be dealt to several shards
    ordered = df.select(key.alias("id"), F.col(text_column).alias("text"), tie.alias("tie")).repartitionByRange(shards, "id", "tie").sortWithinPartitions("id", "tie", "text").drop("tie")
    counts = sorted(tuple(r) for r in ordered.mapInArrow(write, "shard string, docs bigint, tokens bigint, width int").collect())  # a row for each shard
    bases = np.concatenate([[0], np.cumsum([c[2] for c in counts], dtype=np.int64)])
    schema = T.StructType([T.StructField(n, t) for n, t in (("shard", T.StringType()), ("docs", T.LongType()), ("tokens", T.LongType()), ("width", T.IntegerType()), ("base", T.LongType()))])
    spark.createDataFrame([(*c, int(base)) for c, base in zip(counts, bases, strict=False)], schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest")
    return folder


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents of the shards, each read through a memory map of its shard.

    Columns ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32`` (of the ids as
    little-endian unsigned 32-bit integers), and ``ids`` (array of long) ``with_ids``.
    """
    where = local(folder)
    manifest = spark.read.parquet(f"{folder}/manifest")
    shards = max(1, manifest.count())
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids

    def one():
        def batch(rows: pa.RecordBatch):
            for shard in rows.to_pylist():
                name = f"{where}/{shard['shard']}"
                off, doc = (np.memmap(f"{name}.{kind}", dtype="<i8", mode="r") for kind in ("off", "doc"))
                ids = np.memmap(f"{name}.tok", dtype=f"<u{shard['width']}", mode="r") if shard["tokens"] else np.zeros(0, dtype=f"<u{shard['width']}")
                if len(off) != len(doc) + 1 or off[-1] != len(ids):
                    raise ValueError(f"shard {name} is not whole")
                for a in range(0, len(doc), 1000):
                    spans = list(zip(off[a : a + 1000][: len(doc) - a], off[a + 1 : a + 1001], strict=True))
                    sums = [zlib.crc32(ids[s:e].astype("<u4").tobytes()) for s, e in spans]
                    columns = [pa.array([None if d == NO_ID else int(d) for d in doc[a : a + 1000]], pa.int64()), pa.array([shard["base"] + int(s) for s, _ in spans], pa.int64()), pa.array([int(e - s) for s, e in spans], pa.int64()), pa.array(sums, pa.int64())]
                    if with_ids:
                        columns.append(pa.array([ids[s:e].astype("<i8") for s, e in spans], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

        return batch

    return map_batches(manifest.repartition(shards), one, schema)
