"""Ranking, quotas, samples and splits."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows that a side may have to be broadcast.
SMALL = 50_000


def place(seed: str, key: Column) -> Column:
    """Order key that any engine computes alike."""
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(seed)))


def hash_sample(df: DataFrame, n: int, seed: str, key: Column) -> DataFrame:
    """``n`` rows, each as likely as any other, the same on every run."""
    return df.orderBy(place(seed, key)).limit(n)


def group_budget(df: DataFrame, group: str, category: str, share: float, seed: str) -> DataFrame:
    """Groups taken for the test side: in each category, in hashed order, while fewer rows than the budget are taken.

    A group's category is its most frequent one (the smallest of equals). The last group may go beyond the budget.
    """
    sizes = df.groupBy(group, category).agg(F.count("*").alias("n"))
    modal = sizes.groupBy(group).agg(F.sum("n").alias("size"), F.max_by(F.col(category), F.struct("n", F.col(category))).alias(category))
    w = Window.partitionBy(category).orderBy(place(seed, F.col(group)))
    taken = F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    target = F.bround(F.sum("size").over(Window.partitionBy(category)) * F.lit(share))
    return modal.withColumn("taken_before", taken).withColumn("target", target.cast("bigint")).withColumn("is_test", F.col("taken_before") < F.col("target"))


def round_robin(df: DataFrame, group: str, preferred: Column, n: int, per_group: int, seed: str, key: Column) -> DataFrame:
    """``n`` rows in turns over the groups, at most ``per_group`` of each, preferred rows first."""
    w = Window.partitionBy(group).orderBy(preferred.desc(), place(seed, key))
    return df.withColumn("preferred", preferred).withColumn("turn", F.row_number().over(w)).where(F.col("turn") <= per_group).orderBy("turn", group).limit(n)


def keep_good_else_all(df: DataFrame, group: str, good: Column) -> DataFrame:
    """Good rows of a group, or all of them if none is good. A null group is a group.

    The groups with a good row are aggregated and joined back, by broadcast if a count shows that they are few.
    """
    rows = df.withColumn("_good", F.coalesce(good, F.lit(False)))
    having = rows.where("_good").select(F.col(group).alias("_group")).distinct()
    if having.limit(SMALL + 1).count() <= SMALL:
        having = F.broadcast(having)
    lacking = rows.where("not _good").join(having, F.col(group).eqNullSafe(F.col("_group")), "left_anti")
    return rows.where("_good").unionByName(lacking).drop("_good")


def oversampled(df: DataFrame, category: Column, factors: dict[str, int]) -> DataFrame:
    """Rows repeated by their category's factor, once without one; ``copy`` counts from 1."""
    table = F.create_map(*[F.lit(x) for pair in factors.items() for x in pair])
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.coalesce(F.try_element_at(table, category), F.lit(1))))))


def history_limit(df: DataFrame, keys: list[str], newest: str, most: int, pinned: Column) -> DataFrame:
    """Rows beyond the ``most`` newest that are not pinned: what a history with a limit removes."""
    w = Window.partitionBy(*keys).orderBy(F.col(newest).desc())
    return df.where(~pinned).withColumn("age_rank", F.row_number().over(w)).where(F.col("age_rank") > most)


def capped_greedy(ranked: DataFrame, order: list[Column], target: int, per_group: int, bucket_share: float = 0.3, per_label: int | None = None) -> DataFrame:
    """The best rows under quotas that only chosen rows use up: one of a ``key``, ``per_group`` of a ``grp``, a share of
    the target in ``bucket`` ``capped``, and ``per_label`` of a ``label``.

    Choices depend on the choices before, so the fold is sequential. What can reach it is bounded first, in parallel:
    of rows alike in key, group, bucket and label the best one suffices, since quotas only tighten; of each group,
    bucket and label the best ``per_group + target`` rows suffice, since at most ``target`` of them can lose their key.
    """
    if not {"key", "grp", "bucket", "label"} <= set(ranked.columns):
        raise ValueError("columns key, grp, bucket and label are needed")
    alike = Window.partitionBy("key", "grp", "bucket", "label").orderBy(*order)
    ranked = ranked.withColumn("_rn", F.row_number().over(alike)).where("_rn = 1").drop("_rn")
    cell = Window.partitionBy("grp", "bucket", "label").orderBy(*order)
    ranked = ranked.withColumn("_rn", F.row_number().over(cell)).where(F.col("_rn") <= per_group + target).drop("_rn")
    schema = ranked.schema
    quota = int(target * bucket_share)

    def fold(batches):
        keys, groups, labels, in_bucket, n = set(), {}, {}, 0, 0
        for rows in batches:
            chosen = []
            for i, (k, g, b, e) in enumerate(zip(rows["key"], rows["grp"].fillna("unknown"), rows["bucket"], rows["label"], strict=True)):
                if n >= target:
                    break
                if k in keys or groups.get(g, 0) >= per_group or (per_label is not None and pd.notna(e) and labels.get(e, 0) >= per_label):
                    continue
                if b == "capped":
                    if in_bucket >= quota:
                        continue
                    in_bucket += 1
                keys.add(k)
                groups[g] = groups.get(g, 0) + 1
                if pd.notna(e):
                    labels[e] = labels.get(e, 0) + 1
                n += 1
                chosen.append(i)
            yield rows.iloc[chosen]
            if n >= target:
                return

    return ranked.repartition(1).sortWithinPartitions(*order).mapInPandas(fold, schema)


def ranked_candidates(df: DataFrame, min_meaning: float) -> DataFrame:
    """Candidates that keep the meaning, with ``score``: alignment times departure, and a bonus for idioms."""
    departure = F.greatest((100.0 - F.col("chrf")) / 100.0, F.coalesce("novelty", F.lit(0.0)))
    score = F.bround(F.col("align_cos") * departure + 0.1 * F.least(F.lit(2), F.size("idioms")), 4)
    return df.where(F.coalesce("meaning", F.lit(1.0)) >= min_meaning).withColumn("score", score)


def lower_quantiles(df: DataFrame, value: str, shares: list[float]) -> DataFrame:
    """Exact lower elements at the shares of the sorted values: ``share`` and the value; no rows without values.

    Values are counted first, cut into some hundred ranges, and only the ranges that hold a wanted place are ordered;
    the driver sees one count for each range.
    """
    rows = df.where(F.col(value).isNotNull()).select(value)
    cuts = rows.agg(F.percentile_approx(value, [i / 200 for i in range(1, 200)], 10_000).alias("c")).first()["c"]
    counted = rows.groupBy(value).agg(F.count("*").alias("n"))
    counted = counted.withColumn("range", F.size(F.filter(F.lit(sorted(set(cuts or [0]))), lambda c: c <= F.col(value))))
    sizes = sorted((r["range"], r["n"]) for r in counted.groupBy("range").agg(F.sum("n").alias("n")).collect())
    total, before, wanted = sum(n for _, n in sizes), 0, []
    for at, n in sizes:
        wanted += [(s, at, int(s * (total - 1)) - before) for s in shares if before <= int(s * (total - 1)) < before + n]
        before += n
    places = F.broadcast(df.sparkSession.createDataFrame(wanted, "share double, range int, place bigint"))
    upto = F.sum("n").over(Window.partitionBy("range").orderBy(value))
    picked = counted.join(F.broadcast(places.select("range").distinct()), "range", "left_semi").withColumn("upto", upto)
    return picked.join(places, "range").where((F.col("upto") > F.col("place")) & (F.col("upto") - F.col("n") <= F.col("place"))).select("share", value)
