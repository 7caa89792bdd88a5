"""Histories and keyed state: expiry, recency, move to front, latest result, health over runs."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def expired(now: Column, created: Column, pinned: Column, sensitive: Column, minutes: int, sensitive_seconds: int) -> Column:
    """Unpinned rows older than ``minutes``; sensitive ones, pinned or not, older than ``sensitive_seconds``. Times are seconds."""
    age = now - created
    return (~pinned & (age > minutes * 60)) | (sensitive & (age > sensitive_seconds))


def recency(now: Column, created: Column, minutes: int = 5) -> Column:
    return F.when(now - created < minutes * 60, "recent").otherwise("other")


def moved_to_front(df: DataFrame, owner: list[str], identity: list[str], time: str, pinned: str) -> DataFrame:
    """One row for each owner and identity: the latest time, pinned if ever pinned before."""
    return df.groupBy(*owner, *identity).agg(F.max(time).alias(time), F.max(pinned).alias(pinned), F.count("*").alias("uses"))


def latest(df: DataFrame, keys: list[str], requested: str, *tie: str) -> DataFrame:
    """The result of the latest request of each key."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(requested, *tie)).alias("r")).select(*keys, "r.*")


def changes(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value differs from the one before."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_before", F.lag(F.struct(value)).over(w)).where(~F.struct(value).eqNullSafe(F.col("_before"))).drop("_before")


def recent_lists(df: DataFrame, owner: str, order: str, item: str, most: int) -> DataFrame:
    """The ``most`` last used distinct items of each owner, the latest first."""
    last = df.groupBy(owner, item).agg(F.max(order).alias("_last"))
    w = Window.partitionBy(owner).orderBy(F.col("_last").desc(), item)
    top = last.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)
    return top.select(owner, "place", item)


def used(pinned: list, recent: list, item, pinned_rule: str, recent_rule: str, most_pinned: int, most_recent: int) -> tuple[list, list]:
    """Both lists after a use. Rules: ``auto_front``, ``auto_back``, ``manual_front``, ``manual_back``; manual ones leave known items in place."""

    def put(items, rule):
        return [item, *items] if rule.endswith("front") else [*items, item]

    def cut(items, rule, most):
        return items[:most] if rule.endswith("front") else items[-most:] if most else []

    if item in pinned:
        if pinned_rule.startswith("auto"):
            pinned = put([x for x in pinned if x != item], pinned_rule)
    elif item in recent:
        if recent_rule.startswith("auto"):
            recent = put([x for x in recent if x != item], recent_rule)
    else:
        recent = put(recent, recent_rule)
    return cut(pinned, pinned_rule, most_pinned), cut(recent, recent_rule, most_recent)


def use_histories(df: DataFrame, owner: str, order: str, item: str, recent_rule: str = "auto_front", most: int = 10) -> DataFrame:
    """The recent list of each owner after all uses in order, under any rule: an ordered fold that holds one list at a time."""
    kind = df.schema[owner].dataType

    def fold(batches):
        now, recent, done = None, None, []
        for rows in batches:
            for key, x in zip(rows.column(0).to_pylist(), rows.column(2).to_pylist(), strict=True):
                if recent is None or key != now:
                    if recent is not None:
                        done.append((now, recent))
                    now, recent = key, []
                _, recent = used([], recent, x, "auto_front", recent_rule, 0, most)
            if done:
                yield made(done, rows.schema)
                done = []
        if recent is not None:
            yield made([(now, recent)], rows.schema)

    def made(done, schema):
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], schema.field(0).type), pa.array([d[1] for d in done], pa.list_(schema.field(2).type))], names=[owner, "recent"])

    rows = df.select(owner, order, F.col(item).cast("string").alias(item)).repartition(owner).sortWithinPartitions(owner, order, item)
    return rows.mapInArrow(fold, f"`{owner}` {kind.simpleString()}, recent array<string>")


def run_health(runs: DataFrame, model: str, order: str, tripped: str, disable_after: int = 2) -> DataFrame:
    """State of each model after its runs: bad runs in a row, and ``disabled`` once they reached the bound, for good.

    Window form of the fold: the streak counts bad runs since the last good one.
    """
    w = Window.partitionBy(model).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = runs.withColumn("_good", F.sum(F.when(F.col(tripped), 0).otherwise(1)).over(w))
    streak = F.sum(F.when(F.col(tripped), 1).otherwise(0)).over(Window.partitionBy(model, "_good").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("streak", streak)
    return rows.groupBy(model).agg(F.max_by("streak", order).alias("consecutive_bad_runs"), (F.max("streak") >= disable_after).alias("disabled"), F.max(F.when(F.col(tripped), F.col(order))).alias("last_bad_run"), F.count("*").alias("runs"))


def active(roster: DataFrame, health: DataFrame, model: str) -> DataFrame:
    """The roster with a flag and the reason of models that are disabled."""
    off = health.where("disabled").select(model, F.format_string("disabled after %d bad runs in a row", F.col("consecutive_bad_runs")).alias("reason"), F.lit(True).alias("_off"))
    return roster.join(off, model, "left").select(*roster.columns, F.col("_off").isNull().alias("active"), "reason")
