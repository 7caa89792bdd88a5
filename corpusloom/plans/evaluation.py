"""Evaluation of replies: parse, compare with the reference, report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import language as G
from corpusloom.functions import lexicons as L
from corpusloom.operators import reports


def compared(rows: DataFrame) -> DataFrame:
    """Gold and predicted flags and categories of rows with a ``reply``; an unusable reply predicts nothing."""
    r = rows.withColumn("parsed", G.parse_reply(F.col("reply")))
    gold = F.coalesce("has_subtext", F.lit(False))
    return r.withColumns({"valid": F.col("parsed").isNotNull(), "gold": gold, "predicted": F.coalesce("parsed.has_subtext", F.lit(False)), "gold_category": F.when(gold, F.col("category")).otherwise("none"), "predicted_category": F.coalesce("parsed.category", F.lit("none")), "hypothesis": F.coalesce("parsed.translation", F.lit(""))})


def finished(rows: DataFrame) -> dict:
    """All reports of a run; frames except the corpus score."""
    r = compared(rows)
    return {
        "detection": reports.detection(r, F.col("gold"), F.col("predicted")),
        "categories": reports.by_class(r, "gold_category", "predicted_category", L.CATEGORIES),
        "confusion": reports.confusion(r, "gold_category", "predicted_category"),
        "crude": reports.crude_report(r.withColumnRenamed("translation", "reference")),
        "chrf": reports.chrf_corpus(r, "hypothesis", "translation"),
    }
