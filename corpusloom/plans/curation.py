"""Curation: last-wins load, frozen test split, near-duplicate groups, routing, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import dedup, selection, vectors_join


def loaded(rows: DataFrame, held_files: list[str]) -> DataFrame:
    """Rows without review flags, one for each key; ``line`` orders them, ``_batch_file`` names their file."""
    flagged = [F.coalesce(F.col(c).cast("boolean"), F.lit(False)) for c in ("needs_human_review", "_stage_b_needs_human_review") if c in rows.columns]
    for f in flagged:
        rows = rows.where(~f)
    return dedup.last_wins(rows, T.exact_key(F.col("source_text")), "line", F.col("_batch_file").isin(held_files))


def curated(rows: DataFrame, held_files: list[str], frozen: DataFrame | None = None, near: float = 0.93, test_share: float = 0.1, drop_near: bool = False, seed: str = "7") -> DataFrame:
    """``rows`` (with ``vector``) and their ``split``: train, test, a held-out file, or dropped.

    Rows with the key of a frozen test row go. In a group of near duplicates with a fixed row (test or held out) only
    fixed rows stay; other groups go to test by a budget for each category, unless the test split is frozen.
    """
    rows = loaded(rows, held_files).withColumn("fixed", F.when(F.col("_batch_file").isin(held_files), F.col("_batch_file")))
    if frozen is not None:
        rows = rows.join(frozen.select(T.exact_key(F.col("source_text")).alias("_k")), T.exact_key(F.col("source_text")) == F.col("_k"), "left_anti")
        rows = rows.unionByName(frozen.withColumn("fixed", F.lit("test")), allowMissingColumns=True)
    rows = rows.withColumn("id", F.xxhash64("source_lang", "source_text", "fixed"))
    pairs = vectors_join.banded_pairs(rows, "id", "vector", "source_lang", near)
    rows = rows.join(vectors_join.groups(rows, "id", pairs), "id")
    g = Window.partitionBy("root")
    rows = rows.withColumns({"has_fixed": F.max(F.col("fixed").isNotNull().cast("int")).over(g) == 1, "size": F.count("*").over(g)})
    free = rows.where("not has_fixed")
    if frozen is None:
        taken = selection.group_budget(free, "root", "category", test_share, seed).select("root", "is_test")
        rows = rows.join(taken, "root", "left")
    else:
        rows = rows.withColumn("is_test", F.lit(False))
    best = F.row_number().over(g.orderBy(F.coalesce("has_subtext", F.lit(False)).desc(), "position"))
    rows = rows.withColumn("_best", best)
    is_test = F.coalesce("is_test", F.lit(False))
    lost = F.lit(drop_near) & ~F.col("has_fixed") & ~is_test & (F.col("_best") > 1)
    split = F.when(F.col("has_fixed"), F.coalesce("fixed", F.lit("dropped: near a fixed row"))).when(is_test, "test").when(lost, "dropped: near duplicate").otherwise("train")
    return rows.withColumn("split", split).drop("_best", "is_test")


def split_report(rows: DataFrame) -> DataFrame:
    """Rows by split and category, with subtotals."""
    return rows.rollup("split", "category").agg(F.count("*").alias("n"))
