"""Agreement votes over candidates of one source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def agreement(df: DataFrame, source: str, flag: str, category: str, order: str, least: float) -> DataFrame:
    """Per source: the modal flag, its share, and the category if all who agree name the same one.

    A null flag is a vote; of equal counts the one seen first wins. ``eligible`` asks for the share and one category.
    """
    one = df.groupBy(source, flag).agg(F.count("*").alias("n"), F.min(order).alias("first"), F.count_distinct(F.struct(category)).alias("kinds"), F.min(category).alias("category"))
    top = one.groupBy(source).agg(F.sum("n").alias("votes"), F.max_by(F.struct(flag, "n", "kinds", "category"), F.struct("n", -F.col("first"))).alias("top"))
    share = F.col("top.n") / F.col("votes")
    ok = (share >= least) & (F.col("top.kinds") == 1)
    return top.select(source, "votes", share.alias("fraction"), ok.alias("eligible"), F.when(ok, F.col(f"top.{flag}")).alias(flag), F.when(ok, F.col("top.category")).alias("category"))


def contested(df: DataFrame, group: str, resolution: str, least: int = 3) -> DataFrame:
    """Groups with at least ``least`` rows that were not resolved by agreement."""
    return df.where(F.coalesce(F.col(resolution), F.lit("")) != "agreed").groupBy(group).agg(F.count("*").alias("n")).where(F.col("n") >= least)
