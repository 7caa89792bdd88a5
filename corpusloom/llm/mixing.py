"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source's mean repetition rate is its target share of the output over its rows. Each document draws its number of
copies from a Poisson distribution with that mean: a uniform number, hashed from the seed and the document, is looked
up in the distribution's sums. A mean over ``PART`` is the sum of equal means of at most ``PART``, each drawn with a
number of its own; such a sum is again Poisson with the whole mean. Documents are exploded by their counts and dealt
out by a hash of document and copy, which also orders each partition: a global shuffle that needs neither sampling nor
a sort over all rows.

Defined cases: a null source is a source of its own, with the weight of the key ``None``; a row whose id is null draws
by the hash of its whole row; rows with the same id draw the same count and are all repeated by it; a source with
weight 0, or that the weights do not name, has no copies; an empty table gives no rows; columns of the input keep their
names and values, and added ones must not clash (an error says so).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest mean that one number is drawn for, terms of the distribution's sums, and rows of a rate table that may be broadcast.
PART, TERMS, SMALL = 8, 40, 10_000


def uniform(text: Column) -> Column:
    """Uniform in [0, 1) from the first 52 bits of the MD5 digest of a text."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_sums(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... of a Poisson distribution."""
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("sums"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        start,
        lambda a, k: F.struct((a["p"] * mean / k).alias("p"), F.concat(a["sums"], F.array(F.element_at(a["sums"], -1) + a["p"] * mean / k)).alias("sums")),
        lambda a: a["sums"],
    )


def rates(counts: DataFrame, weights: dict[str | None, float] | None, temper: float, epochs: float) -> DataFrame:
    """``source``, its rows ``n`` and mean ``rate``. Without weights, shares follow ``n ** temper``; ``counts`` has ``source`` and ``n``."""
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(temper))
    else:
        named = {k: float(v) for k, v in weights.items() if k is not None}
        table = F.create_map(*[F.lit(x) for pair in named.items() for x in pair]) if named else F.create_map().cast("map<string,double>")
        weight = F.when(F.col("source").isNull(), F.lit(float(weights.get(None, 0.0)))).otherwise(F.coalesce(table[F.col("source")], F.lit(0.0)))
    shared = counts.select("source", "n", weight.alias("w"))
    whole = shared.agg(F.sum("n").alias("rows"), F.sum("w").alias("ws"))
    return shared.join(F.broadcast(whole)).select("source", "n", F.when(F.col("ws") > 0, F.col("w") / F.col("ws") * F.col("rows") * epochs / F.col("n")).otherwise(0.0).alias("rate"))


def mix(df: DataFrame, weights: dict[str | None, float] | None = None, temper: float = 0.5, epochs: float = 1.0, seed: str = "mix", id_column: str = "doc_id", source_column: str = "source", counts_from: DataFrame | None = None) -> DataFrame:
    """All columns of ``df`` once for each copy, with ``mix_rate``, ``mix_copy`` (0, 1, ...) and ``mix_key`` (order of the shuffle).

    The rate table has one row for each source. It is broadcast only if it has at most ``SMALL`` rows; beyond that
    it is joined by the source, where adaptive execution splits a source that holds many rows.
    """
    if clash := {"mix_rate", "mix_copy", "mix_key"} & set(df.columns):
        raise ValueError(f"columns {sorted(clash)} are in the input already")
    counts = (counts_from if counts_from is not None else df).groupBy(F.col(source_column).cast("string").alias("source")).agg(F.count("*").alias("n"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int")
    table = rates(counts, weights, temper, epochs).withColumn("parts", parts)
    table = table.select(F.col("source").alias("s"), F.col("rate").alias("mix_rate"), "parts", poisson_sums(F.col("rate") / F.col("parts")).alias("sums"))
    if counts.limit(SMALL + 1).count() <= SMALL:
        table = F.broadcast(table)
    own = F.coalesce(F.col(id_column).cast("string"), F.concat(F.lit("null:"), F.xxhash64(*df.columns).cast("string")))
    rows = df.select(F.struct(*df.columns).alias("row"), F.col(source_column).cast("string").alias("source"), F.concat(F.lit(f"{seed}:"), own).alias("own"))
    rows = rows.join(table, rows["source"].eqNullSafe(table["s"]))

    def drawn(part: Column) -> Column:
        u = uniform(F.when(part == 0, F.col("own")).otherwise(F.concat("own", F.lit(":part"), part.cast("string"))))
        return F.size(F.filter("sums", lambda s: s <= u))

    n = F.aggregate(F.sequence(F.lit(0), F.col("parts") - 1), F.lit(0), lambda a, k: a + drawn(k))
    rows = rows.select("row", "own", "mix_rate", n.alias("n")).where("n > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rows = rows.select("row", "mix_rate", "mix_copy", F.md5(F.concat_ws(":", "own", F.col("mix_copy").cast("string"))).alias("mix_key"))
    many = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(many, "mix_key").sortWithinPartitions("mix_key").select("row.*", "mix_rate", "mix_copy", "mix_key")
