"""Helpers that the training-data operators share: shared folders, Arrow batches, word splitting."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.shared import dropped, shared_path, shared_root, spread, written  # noqa: F401

#: White space of the word contracts, as a Java character class.
WORD_SPACE = r"[ \t-\r]+"
#: Rows and bytes of one Arrow batch between the JVM and a Python worker.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


#: Keys with more than one in so many rows count as hot; there are at most so many of them, so they may be broadcast.
HOT_KEYS = 1000


def joined(rows: DataFrame, marks: DataFrame, keys: list[str], weight: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``marks``, which has one row for each key and the number of its ``rows`` in ``weight``.

    A key that holds more than one in ``HOT_KEYS`` of all ``total`` rows is hot. There cannot be more than ``HOT_KEYS``
    of them, so they are broadcast and their rows stay where they are; only rows of other keys are shuffled. ``marks``
    and ``rows`` should be written tables, as both are read twice if a key is hot.
    """
    hot = marks.where(F.col(weight) * HOT_KEYS > total)
    if not hot.head(1):
        return rows.join(marks, keys, how)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(marks.where(F.col(weight) * HOT_KEYS <= total), keys, how)
    return rows.join(F.broadcast(hot), keys).unionByName(rest)


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session, where the user has not set bounds: long texts must not add up to gigabytes."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = int(spark.conf.get(key, str(most)).rstrip("b") or most)
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def map_batches(df: DataFrame, one: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]], schema: str) -> DataFrame:
    """``mapInArrow`` with state of its own for each task: ``one()`` makes the function that gets each batch."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = one()
        for batch in batches:
            if batch.num_rows:
                yield from f(batch)

    return df.mapInArrow(run, schema)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as the empty text."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def words_of(text):
    """Column: the words of the contracts, ``[^\\x20\\x09-\\x0D]+``; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SPACE), lambda w: w != "")


def let(value, body):
    """Column: ``body(value)`` with ``value`` computed once for a row, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spread(df) if table == "documents" else df
