"""Near-duplicate pairs of unit vectors within a class, their neighbour counts and their groups."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import vectors as V
from corpusloom.shared import written

#: Vectors of a tile; two tiles are compared in one task, so many rows of one at a time.
TILE, STRIPE = 4096, 256
#: Pairs of two tiles that cost about as much as one candidate, which is shuffled and joined with both its vectors.
CANDIDATE = 100


def _tiles(df: DataFrame, key: str, vector: str, group: str) -> DataFrame:
    """Every vector in a tile of its class, and every pair of tiles of a class as one cell."""
    sizes = df.groupBy(group).agg(F.ceil(F.count("*") / TILE).cast("int").alias("_t"))
    rows = df.select(F.col(key).alias("id"), F.col(vector).alias("v"), F.col(group).alias("g")).join(sizes.withColumnRenamed(group, "_g"), F.col("g").eqNullSafe(F.col("_g"))).drop("_g")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("_t")).cast("int"))
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("_t") - 1)))
    return rows.select("g", F.least("own", "o").alias("a"), F.greatest("own", "o").alias("b"), "own", "id", "v")


def near_pairs(df: DataFrame, key: str, vector: str, group: str, least: float) -> DataFrame:
    """``i``, ``j`` (i < j) and ``cos`` of all pairs of a class with a cosine of at least ``least``.

    Classes are cut into tiles; a task multiplies two tiles as matrices, stripe by stripe, so memory is bounded by the
    tile, also where all vectors are alike, and a large class is spread over many tasks. All pairs of a class are
    compared: the join is exact at any ``least``, and the way to go for low ones. For cosines of near duplicates take
    ``banded_pairs``.
    """

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [(rows["a"].iloc[0], rows["b"].iloc[0], rows["own"].to_numpy(), rows["id"].to_numpy(), np.stack(rows["v"].to_list()).astype(float)) for rows in batches if len(rows)]
        a, b = parts[0][:2]
        own, ids, v = (np.concatenate([p[k] for p in parts]) for k in (2, 3, 4))
        (left, x), (right, y) = ((ids[own == o], v[own == o]) for o in (a, b))
        for at in range(0, len(left), STRIPE):
            cos = x[at : at + STRIPE] @ y.T
            p, q = np.nonzero(cos >= least)
            i, j = left[at + p], right[q]
            keep = i < j if a == b else i != j
            i, j, c = i[keep], j[keep], cos[p, q][keep]
            yield pd.DataFrame({"i": np.minimum(i, j), "j": np.maximum(i, j), "cos": c})

    kind = df.schema[key].dataType.simpleString()
    cells = _tiles(df.where(F.col(vector).isNotNull()), key, vector, group)
    return cells.groupBy("g", "a", "b").applyInPandas(compare, f"i {kind}, j {kind}, cos double")


def banded_pairs(df: DataFrame, key: str, vector: str, group: str, least: float, recall: float = 0.9999, bits: int = 16) -> DataFrame:
    """As ``near_pairs`` for a high ``least``, without comparing all vectors of a class where that saves work.

    Candidates share the signs of ``bits`` random hyperplanes in one of several tables; their cosine is then exact. A
    pair at ``least`` agrees in one sign with probability ``1 - acos(least) / pi``; the number of tables follows from the
    ``recall`` that such a pair must have, closer pairs have more. Only ids and table keys are paired; vectors are
    joined to the distinct candidates.

    Few bits put most pairs into some bucket, and a group of copies shares a bucket in every table. A class with more
    than one candidate for ``CANDIDATE`` of its pairs is therefore left to ``near_pairs``, which misses nothing: what is
    shuffled for a class never outgrows its pairs.
    """
    rows = df.where(F.col(vector).isNotNull()).select(F.col(key).alias("id"), F.col(vector).alias("v"), F.col(group).alias("g"))
    agree = (1 - math.acos(least) / math.pi) ** bits
    tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))
    if tables * CANDIDATE >= 2**bits:  # so many candidates come from vectors that have nothing in common
        return near_pairs(df, key, vector, group, least)

    def sign(batches):
        planes = None
        for rows in batches:
            if not len(rows):
                continue
            x = np.stack(rows["v"].to_list()).astype(float)
            if planes is None:
                planes = np.random.default_rng(7).standard_normal((x.shape[1], tables * bits))
            signs = (x @ planes > 0).reshape(len(x), tables, bits)
            keys = signs @ (1 << np.arange(bits))
            yield pd.DataFrame({"id": np.repeat(rows["id"].to_numpy(), tables), "g": np.repeat(rows["g"].to_numpy(), tables), "t": np.tile(np.arange(tables), len(x)), "k": keys.ravel()})

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    keyed = written(rows.mapInPandas(sign, f"id {kinds['id']}, g {kinds['g']}, t int, k long"), "bands")
    n = F.col("n")
    buckets = keyed.groupBy("g", "t", "k").agg(F.count("*").cast("double").alias("n"))
    classes = buckets.groupBy("g").agg(F.sum(n * (n - 1)).alias("_c"), F.sum(F.when(F.col("t") == 0, n)).alias("n"))
    dense = written(classes.where(F.col("_c") * CANDIDATE > n * (n - 1)).select(F.col("g").alias("_dense")), "dense")
    is_dense = F.col("g").eqNullSafe(F.col("_dense"))
    whole = near_pairs(rows.join(dense, is_dense, "left_semi"), "id", "v", "g", least)
    keyed = keyed.join(dense, is_dense, "left_anti")
    other = keyed.select(F.col("id").alias("j"), F.col("g").alias("h"), F.col("t").alias("u"), F.col("k").alias("l"))
    pairs = keyed.join(other, F.col("g").eqNullSafe(F.col("h")) & (F.col("t") == F.col("u")) & (F.col("k") == F.col("l")) & (F.col("id") < F.col("j"))).select(F.col("id").alias("i"), "j").distinct()
    both = pairs.join(rows.select(F.col("id").alias("i"), F.col("v").alias("a")), "i").join(rows.select(F.col("id").alias("j"), F.col("v").alias("b")), "j")
    return both.select("i", "j", V.dot(F.col("a"), F.col("b")).alias("cos")).where(F.col("cos") >= least).union(whole)


def neighbour_counts(df: DataFrame, key: str, vector: str, group: str, least: float) -> DataFrame:
    """Number of other vectors of the class with a cosine of at least ``least``; 0 for none."""
    pairs = near_pairs(df, key, vector, group, least)
    ends = pairs.select(F.explode(F.array("i", "j")).alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    return df.select(F.col(key).alias("id")).join(ends, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("neighbours"))


def groups(nodes: DataFrame, key: str, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``id`` and ``root`` (smallest id) of the component of each node.

    Each round takes the smallest label of the neighbours and then the label of that label, so long chains shorten by
    powers; rounds end when no label changes, and are written to the shared folder.
    """
    both = edges.select("i", "j").union(edges.select(F.col("j").alias("i"), F.col("i").alias("j"))).distinct()
    both = written(both, "edges")
    label = written(both.select(F.col("i").alias("id")).distinct().withColumn("root", F.col("id")), "labels")
    for _ in range(rounds):
        least = both.join(label.withColumnRenamed("id", "j"), "j").groupBy("i").agg(F.min("root").alias("m"))
        moved = label.join(least, F.col("id") == F.col("i"), "left").select("id", F.least("root", F.coalesce("m", "root")).alias("root"))
        jump = moved.select(F.col("id").alias("_id"), F.col("root").alias("_root"))
        new = written(moved.join(jump, F.col("root") == F.col("_id"), "left").select("id", F.least("root", F.coalesce("_root", "root")).alias("root")), "labels")
        changed = new.join(label.withColumnRenamed("root", "old"), "id").where("root <> old").limit(1).count()
        label = new
        if not changed:
            break
    else:
        raise RuntimeError("components did not settle")
    return nodes.select(F.col(key).alias("id")).join(label, "id", "left").select("id", F.coalesce("root", "id").alias("root"))


def group_report(rows: DataFrame, root: str, label: str) -> DataFrame:
    """Groups of several rows, the rows in them, and groups whose labels differ."""
    per = rows.groupBy(root).agg(F.count("*").alias("n"), F.count_distinct(F.struct(label)).alias("k")).where("n > 1")
    return per.agg(F.count("*").alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in_groups"), F.count_if(F.col("k") > 1).alias("mixed_groups"))


def representatives(rows: DataFrame, root: str, prefer: str, key: str) -> DataFrame:
    """One row of each group, preferring a flag, then the smallest key."""
    w = Window.partitionBy(root).orderBy(F.coalesce(prefer, F.lit(False)).desc(), key)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
