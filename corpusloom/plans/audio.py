"""Clips from speaker segments and cues: merge, cut out overlaps, split, filter, caption; and second opinions on captions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import intervals, joins


def clips(segments: DataFrame, cues: DataFrame, max_gap: float = 0.5, shortest: float = 1.0, longest: float = 12.0) -> DataFrame:
    """``film``, ``speaker``, ``start``, ``end``, ``text``, ``reason`` (null if kept) of clips; ``segments``: film, speaker, start, end."""
    merged = intervals.gap_islands(segments, ["film", "speaker"], "start", "end", max_gap).select("film", "speaker", "start", "end")
    holes = intervals.overlaps(segments, ["film"], "speaker", "start", "end").groupBy("film").agg(F.array_sort(F.collect_list(F.struct(F.col("start").alias("a"), F.col("end").alias("b")))).alias("holes"))
    alone = merged.join(holes, "film", "left").withColumn("holes", F.coalesce("holes", F.array().cast(intervals.SPAN)))
    alone = alone.select("film", "speaker", F.explode(intervals.difference(F.col("start"), F.col("end"), F.col("holes"))).alias("p"))
    parts = alone.select("film", "speaker", F.explode(intervals.equal_parts(F.col("p.a"), F.col("p.b"), longest)).alias("q")).select("film", "speaker", F.col("q.a").alias("w_start"), F.col("q.b").alias("w_end"))
    said = joins.covered_by_windows(cues, parts, ["film"], longest).groupBy("film", "speaker", "w_start", "w_end").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda c: c["text"]), " ").alias("text"))
    rows = parts.join(said, ["film", "speaker", "w_start", "w_end"], "left")
    reason = F.when(F.col("w_end") - F.col("w_start") < shortest, "short").when(F.col("text").isNull(), "no_text")
    return rows.select("film", "speaker", F.col("w_start").alias("start"), F.col("w_end").alias("end"), "text", reason.alias("reason"))


def character_error_rate(hypothesis: Column, reference: Column) -> Column:
    """Edit distance over the reference's length, both as character keys; an empty reference gives 0 or 1."""
    h, r = T.character_key(F.coalesce(hypothesis, F.lit(""))), T.character_key(F.coalesce(reference, F.lit("")))
    return F.when(r == "", F.when(h == "", 0.0).otherwise(1.0)).otherwise(F.levenshtein(h, r) / F.length(r))


def cross_checked(rows: DataFrame, agree: float = 0.10) -> DataFrame:
    """``cer`` and ``asr_agree`` of rows with a second transcript (``second``); rows by hand (``source`` = human) stay as they are."""
    cer = F.when((F.col("source") != "human") & F.col("second").isNotNull(), character_error_rate(F.col("second"), F.col("text")))
    return rows.withColumn("cer", F.bround(cer, 4)).withColumn("asr_agree", F.when(F.col("cer").isNotNull(), F.col("cer") <= agree))


def filled(rows: DataFrame, made: DataFrame, force: bool = False) -> DataFrame:
    """Captions filled in where none is there; text by hand is never replaced, other text only with ``force``."""
    both = rows.join(made.withColumnRenamed("text", "_new"), "clip", "left")
    free = F.coalesce(F.col("source"), F.lit("")) != "human"
    take = free & F.col("_new").isNotNull() & (F.lit(force) | (F.coalesce("text", F.lit("")) == ""))
    return both.withColumn("source", F.when(take, "asr").otherwise(F.col("source"))).withColumn("text", F.when(take, F.col("_new")).otherwise(F.col("text"))).drop("_new")
