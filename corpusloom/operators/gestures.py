"""Gesture typing: ideal paths of words, pruning, and the best words for a path."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import udfs
from corpusloom.functions import vectors as V


def ideal_paths(words: DataFrame, keys: DataFrame, word: str = "word") -> DataFrame:
    """``word`` and ``points``: key centres of its letters; letters that have no key take the key of their base letter."""
    letters = words.select(F.col(word).alias("word"), F.posexplode(F.filter(F.split(F.lower(F.col(word)), ""), lambda c: c != "")).alias("at", "letter"))
    letters = letters.withColumn("base", udfs.base_letters("letter"))
    table = F.broadcast(keys.select("letter", "x", "y"))  # the keys of a keyboard
    own = letters.join(table, "letter", "left")
    base = table.select(F.col("letter").alias("base"), F.col("x").alias("bx"), F.col("y").alias("by"))
    found = own.join(base, "base", "left").select("word", "at", F.coalesce("x", "bx").alias("x"), F.coalesce("y", "by").alias("y")).where("x is not null")
    return found.groupBy("word").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x", "y"))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("points"))


def closest_keys(keys: DataFrame, x: Column, y: Column, n: int) -> DataFrame:
    return keys.withColumn("distance", F.sqrt(F.pow(F.col("x") - x, 2) + F.pow(F.col("y") - y, 2))).orderBy("distance", "letter").limit(n)


def pruned(words: DataFrame, starts: list[str], ends: list[str], length: float, radius: float, most: float = 8.42) -> DataFrame:
    """Words whose ends are near the gesture's ends and whose path is about as long; ``points``."""
    w = F.lower(F.col("word"))
    ends_fit = F.left(w, F.lit(1)).isin(starts) & F.right(w, F.lit(1)).isin(ends)
    return words.where(ends_fit & (F.abs(V.path_length(F.col("points")) - length) < most * radius))


def best_words(words: DataFrame, gesture: Column, count: int, n: int, shape_dev: float = 22.08, location_dev: float = 0.5109, key_width: float = 1.0) -> DataFrame:
    """The ``n`` words with the lowest inverse likelihood of shape and place, weighed by frequency; one row for each word."""
    scored = words.withColumn("path", udfs.resampled_path("points", F.lit(count))).withColumn("drawn", udfs.resampled_path(gesture, F.lit(count)))
    shape = V.path_distance(V.normalised_path(F.col("path")), V.normalised_path(F.col("drawn")), 2)
    location = V.path_distance(F.col("path"), F.col("drawn"), 1)
    likelihood = V.gaussian(shape, 0.0, shape_dev) * V.gaussian(location, 0.0, location_dev * key_width) * F.greatest(F.col("freq"), F.lit(1e-3))
    w = Window.partitionBy("word").orderBy("inverse")
    ranked = scored.withColumn("inverse", 1.0 / F.greatest(likelihood, F.lit(1e-300)))
    return ranked.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").orderBy("inverse", "word").limit(n).select("word", "inverse")


def thinned(points: DataFrame, owner: str, order: str, least: float) -> DataFrame:
    """Points that lie at least ``least`` from the last kept one: an ordered fold that holds one point at a time."""
    at = [points.columns.index(c) for c in (owner, "x", "y")]

    def fold(batches):
        now, last = None, None
        for rows in batches:
            keep = []
            for key, x, y in zip(*(rows.column(i).to_pylist() for i in at), strict=True):
                if last is None or key != now or (x - last[0]) ** 2 + (y - last[1]) ** 2 >= least**2:
                    now, last = key, (x, y)
                    keep.append(True)
                else:
                    keep.append(False)
            yield rows.filter(pa.array(keep, pa.bool_()))

    return points.repartition(owner).sortWithinPartitions(owner, order).mapInArrow(fold, points.schema)
