"""Queries of the training-data operators over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bpe, fingerprints, lines, mixing, nbsvm, near, phrases, rules, suffixes, token_files
from corpusloom.llm.common import documents
from corpusloom.shipping import shipped

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.write_tokens(documents(spark, sf_dir), tokenizer_path(), end_id=2)
    return token_files.read_tokens(spark, folder)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup_substrings(documents(spark, sf_dir), length=400)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    model = nbsvm.fitted(docs, labels.where(~nbsvm.held_out(labels["doc_id"])))
    return nbsvm.scores(docs, model).select("doc_id", nbsvm.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(documents(spark, sf_dir), size=3, radius=3, seed=42)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(documents(spark, sf_dir)).select("doc_id", "text", "line_stats.*")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_report(documents(spark, sf_dir), radius=3)


def op7_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.dedup_phrases(documents(spark, sf_dir), length=35)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), temper=0.5, epochs=1.0, seed="mix")
    return mixed.select("doc_id", "source", "text", F.col("mix_copy").cast("int").alias("copy"), F.col("mix_key").alias("shuffle_key"))


OP8_SQL = """
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
shares AS (SELECT source, n, pow(n::DOUBLE, 0.5) AS w FROM counts),
rates AS (SELECT source, w / (SELECT sum(w) FROM shares) * (SELECT sum(n) FROM shares) / n AS rate FROM shares),
split AS (SELECT source, greatest(1, ceil(rate / 8))::BIGINT AS parts, rate / greatest(1, ceil(rate / 8)) AS mean FROM rates),
terms AS (SELECT source, k, exp(-mean) * pow(mean, k) / gamma(k + 1) AS p FROM split, range(0, 41) t(k)),
sums AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS s FROM terms),
drawn AS (SELECT d.doc_id, d.source, d.text, 'mix:' || d.doc_id AS own, unnest(range(split.parts)) AS part FROM documents d JOIN split ON d.source IS NOT DISTINCT FROM split.source),
numbers AS (SELECT *, ('0x' || substr(md5(own || CASE WHEN part = 0 THEN '' ELSE ':part' || part END), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM drawn),
copies AS (SELECT doc_id, numbers.source, text, own, count(*) FILTER (sums.s <= u) AS n
  FROM numbers JOIN sums ON numbers.source IS NOT DISTINCT FROM sums.source GROUP BY ALL),
each AS (SELECT *, unnest(range(n)) AS k FROM copies)
SELECT doc_id, source, text, k::INT AS copy, md5(own || ':' || k) AS shuffle_key FROM each
"""


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(documents(spark, sf_dir)).drop("clean_text")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(documents(spark, sf_dir), tokenizer_path())


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [op1_token_files, op2_suffix_dedup, op3_quality_classifier, op4_simhash_near_dedup, op5_line_dedup, op6_fingerprints, op7_phrase_dedup, op8_mixing, op9_quality_rules, op10_bpe]
    return {f.__name__: shipped(f) for f in named}


def oracle_sql() -> dict[str, str]:
    return {"op8_mixing": OP8_SQL}
