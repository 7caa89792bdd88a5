"""Row checks: reasons for rejects over documents, and the candidate checks with their three outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import predicates as P
from corpusloom.functions import text as T
from corpusloom.functions import udfs


def document_reasons(df: DataFrame, min_words: int = 20, max_words: int = 400) -> DataFrame:
    """``reason``: the first of empty, short, long, symbols, duplicate that holds; null for rows that are kept.

    Texts do not move: the first row of each key is found with a partial minimum in each task, and only ids and digests
    are joined back, to keys that have several rows. A row with a reason already has a key of its own in that join, so
    the many empty or short rows of a hot key are not joined at all.
    """
    n = T.space_word_count(F.col("text"))
    early = P.cascade(("empty", F.col("text") == ""), ("short", n < min_words), ("long", n > max_words), ("symbols", F.regexp_count("text", F.lit("[#*$%&|<>]")) * 20 > F.length("text")))
    rest = [c for c in df.columns if c != "text"]
    rows = df.select(*rest, early.alias("_early"), F.sha2(T.exact_key(F.col("text")), 256).alias("_key"))
    firsts = rows.groupBy("_key").agg(F.min("doc_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").select("_key", "_first")
    own = F.when(F.col("_early").isNull(), F.col("_key")).otherwise(F.concat(F.lit("row "), F.col("doc_id").cast("string")))
    joined = rows.withColumn("_key", own).join(firsts, "_key", "left")
    return joined.select(*rest, F.coalesce("_early", F.when(F.col("doc_id") > F.col("_first"), "duplicate")).alias("reason"))


def candidate_problems(df: DataFrame, echo: str | None = None, least: float = 0.8) -> DataFrame:
    """``problems`` of candidate rows, in order. Finer checks need a sound schema; a repeat of (source, model) is always
    marked, and its first row claims the pair even if it fails itself. ``echo``: the source as the model repeated it."""
    c = F.col
    schema = P.schema_problems(c("source_lang"), c("source_text"), c("translation"), c("has_subtext"), c("category"), c("nuance_note"))
    drift = []
    if echo:
        ratio = udfs.sequence_ratio(T.echo_key(c(echo)), T.echo_key(F.coalesce("source_text", F.lit(""))))
        df = df.withColumn("_ratio", ratio)
        drift = [("echo drift", c("_ratio") < least)]
    fine = P.problems(
        ("language", P.language_mismatch(c("source_lang"), c("source_text"))),
        ("long note", P.note_too_long(c("nuance_note"))),
        ("echo", P.echoed(c("source_text"), c("translation"))),
        ("no translation", P.blank(c("translation"))),
        *drift,
        ("masked", P.masked_in_row(c("translation"))),
    )
    w = Window.partitionBy("source_text", "model").orderBy("line")
    repeat = F.when(F.row_number().over(w) > 1, F.array(F.lit("repeat"))).otherwise(F.array().cast("array<string>"))
    rows = df.withColumn("_schema", schema)
    return rows.withColumn("problems", F.concat(F.when(F.size("_schema") > 0, c("_schema")).otherwise(fine), repeat)).drop("_schema", "_ratio")


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clean rows, rejects, and the sources of rejects for the next round (distinct, sorted)."""
    bad = F.size("problems") > 0
    rejects = checked.where(bad)
    return checked.where(~bad).drop("problems"), rejects, rejects.where("source_text <> ''").select("source_text").distinct().orderBy("source_text")
