"""The corpus pipeline: quality classifier, line dedup, near-dedup, source mixing, BPE.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and reread as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bpe, lines, mixing, nbsvm, near
from corpusloom.llm.common import documents, written
from corpusloom.llm.queries import tokenizer_path
from corpusloom.shipping import shipped


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled rows outside the held-out fold."""
    labels = documents(spark, sf_dir, "labels")
    labels = labels.where(~nbsvm.held_out(labels["doc_id"]))
    return nbsvm.accepted(docs, nbsvm.fitted(docs, labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of chunks of lines are cut from the texts; ``n_chars`` follows."""
    cleaned = lines.dedup_lines(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates: five-word shingles, similarity of 0.8 or more."""
    return near.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in proportion to the square root of their size, each document as often as it is drawn."""
    return mixing.mix(docs, temper=0.5, epochs=1.0, seed="mix").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(docs, tokenizer_path())


STAGES = [(name, shipped(f)) for name, f in (("quality classifier", quality), ("line dedup", line_dedup), ("near dedup", near_dedup), ("source mixing", mix_sources), ("bpe", encode))]

#: The classifier and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
