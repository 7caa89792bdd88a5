"""Document fingerprints: SimHash and its search by permuted block tables, in DataFrame functions only.

A document's terms are its five-word shingles, weighted by how often they occur: each occurrence votes with the bits
of its 64-bit hash, +1 for a set bit and -1 for a clear one; a fingerprint bit is set if its sum is positive. Votes
are counted in eight-bit lanes of eight longs for 127 terms at a time (no lane reaches a sign bit), then added up in 64 counters.

The search cuts a fingerprint into ``blocks`` blocks. Fingerprints within ``radius`` bits agree in at least
``blocks - radius`` blocks, so there is one table for each choice of that many blocks, keyed by them. A pair is
counted in the first table that holds it. Equal fingerprints are one row of a table, with their number of documents.

Defined cases: a null text counts as empty; without words the fingerprint is zero; with fewer than five words all of
them are the one term; equal texts have equal fingerprints; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import let, words_of, written

SHINGLE, BITS, LANE = 5, 64, 127
#: Distinct queries that may be broadcast.
SMALL = 5000


def shingle_hashes(words: Column, size: int = SHINGLE) -> Column:
    """Array of 64-bit hashes, one for each shingle; empty without words."""

    def of(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(size)]))
        return F.when(F.size(w) >= size, many).when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.array().cast("array<bigint>"))

    return let(words, of)


def simhash(hashes: Column) -> Column:
    """Fingerprint (long) of the votes of an array of hashes."""
    shift = lambda x, n: F.call_function("shiftrightunsigned", x, n)
    lanes = F.lit(0x0101010101010101)

    def part(h: Column, k: Column) -> Column:
        votes = F.aggregate(
            F.slice(h, k * LANE + 1, F.lit(LANE)),
            F.struct(*[F.lit(0).cast("bigint").alias(f"v{i}") for i in range(8)]),
            lambda a, x: F.struct(*[(a[f"v{i}"] + shift(x, F.lit(i)).bitwiseAND(lanes)).alias(f"v{i}") for i in range(8)]),
            lambda a: F.array(*[a[f"v{i}"] for i in range(8)]),
        )
        return let(votes, lambda v: F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: shift(F.get(v, F.pmod(b, F.lit(8))), b - F.pmod(b, F.lit(8))).bitwiseAND(F.lit(LANE))))

    def of(h: Column) -> Column:
        counts = F.aggregate(
            F.sequence(F.lit(0), F.floor((F.size(h) - 1) / LANE).cast("int")),
            F.array_repeat(F.lit(0).cast("bigint"), BITS),
            lambda a, k: F.zip_with(a, part(h, k), lambda x, y: x + y),
        )
        bits = let(counts, lambda c: F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("bigint"), lambda a, b: F.when(F.get(c, b) * 2 > F.size(h), a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b))).otherwise(a)))
        return F.when(F.size(h) > 0, bits).otherwise(F.lit(0).cast("bigint"))

    return let(hashes, of)


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    return simhash(shingle_hashes(words_of(text), size))


def as_hex(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def with_next(df: DataFrame, key: str, columns: list[str], ties: str) -> DataFrame:
    """Adds ``next_<column>``: the values of the following row in ascending order of ``key``, the first after the last.

    Rows are dealt to ranges of the key. The bounds are keys of the data, so the first row of a range is known before
    the shuffle, and a copy of it closes the range before: no range needs another. Equal keys are ordered by ``ties``.
    Rows without a key have no place in the order and no next row.
    """
    spark = df.sparkSession
    n = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = df.agg(F.min(key).alias("a"), F.percentile_approx(key, [i / n for i in range(1, n)], 10 * n).alias("p")).first()
    bounds = sorted({found["a"], *(found["p"] or [])} - {None}) or [0]
    step = ceil(sqrt(len(bounds)))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    k = F.col(key)
    outer = F.size(F.filter(F.lit([g[0] for g in groups]), lambda b: b <= k))
    inner = F.size(F.filter(F.element_at(F.array(*[F.lit(g) for g in groups]), F.greatest(outer, F.lit(1))), lambda b: b <= k))
    place = (outer - 1) * step + inner - 1
    first = F.array_contains(F.element_at(F.array(*[F.lit(g) for g in groups]), F.greatest(outer, F.lit(1))), k)
    own = F.struct(F.col("_place").alias("at"), F.lit(0).alias("closing"))
    before = F.struct(F.when(F.col("_place") == 0, len(bounds) - 1).otherwise(F.col("_place") - 1).alias("at"), F.lit(1).alias("closing"))
    rows = df.withColumn("_place", F.when(k.isNull(), -1 - F.pmod(F.hash(ties), F.lit(64))).otherwise(place))
    rows = rows.withColumn("_dealt", F.explode(F.when(k.isNotNull() & first, F.array(own, before)).otherwise(F.array(own))))
    w = Window.partitionBy("_dealt.at").orderBy("_dealt.closing", key, ties)
    rows = rows.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns]).where("_dealt.closing = 0")
    return rows.select(*df.columns, *[F.when(k.isNotNull(), F.col(f"next_{c}")).alias(f"next_{c}") for c in columns])


def edited_fingerprints(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text (its last half replaced by the start of the next document).

    A row whose id is null has no next document: its edited text is its first half, its ``near_next`` is null.
    """
    rows = df.select(F.col(id_column).cast("bigint").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("t"))
    rows = with_next(rows.withColumn("f", fingerprint(F.col("t"))), "id", ["t", "f"], "t")
    n = F.length("t")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("t"), F.lit(1), n - half), F.substring(F.coalesce(F.col("next_t"), F.lit("")), F.lit(1), half))
    rows = rows.select("id", n.cast("bigint").alias("n_chars"), "f", "next_f", edited.alias("e"))
    rows = rows.select("id", "n_chars", "f", "next_f", F.sha2("e", 256).alias("edited_sha256"), fingerprint(F.col("e")).alias("g"))
    return rows.select(F.col("id").alias(id_column), "n_chars", "edited_sha256", as_hex(F.col("f")).alias("fingerprint"), as_hex(F.col("g")).alias("edited_fingerprint"), likeness(F.col("f"), F.col("g")).alias("near_edited"), likeness(F.col("f"), F.col("next_f")).alias("near_next"), F.col("f").alias("bits"))


def tables(radius: int, blocks: int) -> list[int]:
    """A mask of the key's bits for each permuted table."""
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    return [sum(masks[i] for i in chosen) for chosen in combinations(range(blocks), blocks - radius)]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def near_counts(fingerprints: DataFrame, queries: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """For each distinct ``bits`` of ``queries``: ``n_near``, documents of ``fingerprints`` within ``radius`` bits.

    The side of the queries is broadcast only if a count shows at most ``SMALL`` of them; beyond that both sides are
    shuffled by table and key, and adaptive execution splits a key that holds many rows.
    """
    masks = [signed(m) for m in tables(radius, blocks)]
    keyed = lambda df: df.select("*", F.posexplode(F.array(*[F.col("bits").bitwiseAND(F.lit(m)) for m in masks])).alias("tab", "key"))
    distinct = queries.select("bits").distinct()
    few = distinct.limit(SMALL + 1).count() <= SMALL
    everyone = keyed(fingerprints.groupBy("bits").agg(F.count("*").alias("n"))).alias("a")
    asked = keyed(distinct).hint("broadcast" if few else "merge").alias("q")
    diff = F.col("a.bits").bitwiseXOR(F.col("q.bits"))
    first = F.array_position(F.array(*[diff.bitwiseAND(F.lit(m)) for m in masks]), F.lit(0).cast("bigint")) - 1
    pairs = asked.join(everyone, (F.col("a.tab") == F.col("q.tab")) & (F.col("a.key") == F.col("q.key")) & (F.bit_count(diff) <= radius) & (first == F.col("q.tab")))
    return pairs.groupBy(F.col("q.bits").alias("bits")).agg(F.sum("a.n").alias("n_near"))


def fingerprint_report(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = 3, every: int = 20) -> DataFrame:
    """``edited_fingerprints`` with ``n_near``: other documents within the radius, for ids divisible by ``every`` (else null)."""
    rows = written(edited_fingerprints(df, id_column, text_column), "fingerprints")
    asks = F.coalesce(F.pmod(F.col(id_column), F.lit(every)) == 0, F.lit(False))
    near = near_counts(rows, rows.where(asks), radius)
    return rows.join(near, "bits", "left").withColumn("n_near", F.when(asks, F.col("n_near") - 1)).drop("bits")
