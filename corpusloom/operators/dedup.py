"""Deduplication, set operations and anti joins on keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows that a side may have to be broadcast.
SMALL = 50_000


def first_wins(df: DataFrame, key: Column, *order: Column | str) -> DataFrame:
    """The first row of each key in the given order.

    In an order of plain columns each task keeps one row of a key before the shuffle, so a key that holds many rows
    is no hot partition. Other orders need a window.
    """
    if all(isinstance(o, str) for o in order):
        firsts = df.groupBy(key.alias("_key")).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_row"))
        return firsts.select("_row.*")
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def last_wins(df: DataFrame, key: Column, line: Column | str, protected: Column) -> DataFrame:
    """The last row of each key, unless a protected row came before: the first such row stays for good.

    ``position`` is the place where the key was first seen. Each task keeps two rows of a key before the shuffle.
    """
    line = F.col(line) if isinstance(line, str) else line
    held = F.coalesce(protected, F.lit(False))
    row = F.struct(*df.columns)
    kept = df.groupBy(key.alias("_key")).agg(F.min(line).alias("position"), F.min_by(row, F.when(held, line)).alias("_held"), F.max_by(row, line).alias("_last"))
    return kept.select(F.coalesce("_held", "_last").alias("_row"), "position").select("_row.*", "position")


def flag_repeats(df: DataFrame, keys: list[str], *order: str, name: str = "repeat") -> DataFrame:
    """Marks every row of a key but the first in the order of the columns, which no two rows of a key share. Null keys are equal.

    The first of each key is found with a partial minimum and joined back: few keys, or keys with very many rows, are
    no hot partitions.
    """
    firsts = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min(F.struct(*order)).alias("_first"))
    on = reduce(lambda a, b: a & b, [df[k].eqNullSafe(firsts[f"_k{i}"]) for i, k in enumerate(keys)])
    few = firsts.limit(SMALL + 1).count() <= SMALL
    return df.join(F.broadcast(firsts) if few else firsts, on).select(*[df[c] for c in df.columns], (F.struct(*[df[o] for o in order]) != F.col("_first")).alias(name))


def without(df: DataFrame, key: Column, *others: DataFrame) -> DataFrame:
    """Rows whose key is in none of the one-column frames."""
    seen = reduce(DataFrame.union, [o.toDF("_seen") for o in others]).distinct()
    return df.withColumn("_key", key).join(seen, F.col("_key") == F.col("_seen"), "left_anti").drop("_key")


def merged(*parts: DataFrame) -> DataFrame:
    """All rows of parts whose columns may differ."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def merged_first_wins(parts: list[tuple[str, DataFrame]], key: Column, *order: Column | str) -> DataFrame:
    """Parts in order, the first row of a key stays; ``part`` names where it came from."""
    tagged = [df.withColumn("part", F.lit(name)).withColumn("_part", F.lit(i)) for i, (name, df) in enumerate(parts)]
    return first_wins(merged(*tagged), key, "_part", *order).drop("_part")


def restored(now: DataFrame, saved: DataFrame, identity: str) -> DataFrame:
    """Saved rows that are new in all but their identity; null equals null."""
    rest = [c for c in saved.columns if c != identity]
    condition = reduce(lambda a, b: a & b, [saved[c].eqNullSafe(now[c]) for c in rest])
    return saved.join(now, condition, "left_anti")


def shuffled(df: DataFrame, seed: str, key: Column) -> DataFrame:
    """Order by a digest of key and seed: the same order on every run."""
    return df.orderBy(F.md5(F.concat_ws(":", key.cast("string"), F.lit(seed))))


def upserted(now: DataFrame, news: DataFrame, keys: list[str]) -> DataFrame:
    """``now`` with the rows of ``news`` put in or replacing those of the same keys; null keys are equal."""
    values = [c for c in now.columns if c not in keys]
    on = reduce(lambda a, b: a & b, [now[k].eqNullSafe(news[k]) for k in keys])
    rows = now.withColumn("_old", F.lit(True)).join(news.withColumn("_new", F.lit(True)), on, "full_outer")
    pick = lambda c: F.when(F.col("_new"), news[c]).otherwise(now[c]).alias(c)
    return rows.select(*[pick(c) for c in [*keys, *values]])
