"""Joins with rules of their own: fan-out with resume, fuzzy re-keying, containment, intervals."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions import udfs
from corpusloom.shared import written

#: Rows that a lookup side may have before it is no longer broadcast.
SMALL = 50_000


def small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if a count of at most ``SMALL`` rows allows it."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def missing_pairs(seeds: DataFrame, models: DataFrame, present: DataFrame, seed: str, model: str) -> DataFrame:
    """Seed and model pairs that are not present yet. ``models`` is a short configured list and rides along as an array."""
    listed = models.select(model).distinct().agg(F.sort_array(F.collect_list(model)).alias("_models"))
    pairs = seeds.join(F.broadcast(listed)).withColumn(model, F.explode("_models")).drop("_models")
    have = present.select(T.plain_quotes(present[seed]).alias("_seed"), F.col(model).alias("_model")).distinct()
    return pairs.join(have, (T.plain_quotes(pairs[seed]) == have["_seed"]) & (pairs[model] == have["_model"]), "left_anti")


def retry_eligible(failed: DataFrame, active: DataFrame, covered: DataFrame, done: DataFrame, seed: str, model: str) -> DataFrame:
    """Failures of active models whose seed is not covered and that are neither done nor refused."""
    out = failed.join(small(active.select(model).distinct()), model, "left_semi")
    out = out.join(covered.select(seed).distinct(), seed, "left_anti")
    return out.join(done.select(seed, model).distinct(), [seed, model], "left_anti").select(failed.columns)


def first_match(left: DataFrame, right: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """Left join to the first row of each key."""
    w = Window.partitionBy(key).orderBy(*order)
    first = right.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return left.join(first, key, "left")


def with_meta(seeds: DataFrame, meta: DataFrame, key: str, line: str) -> DataFrame:
    """Seeds with the last metadata row of each; columns of the seeds win."""
    w = Window.partitionBy(key).orderBy(F.col(line).desc())
    last = meta.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    extra = [c for c in meta.columns if c not in (*seeds.columns, line)]
    return seeds.join(last.select(key, *extra), key, "left")


def rekeyed(rows: DataFrame, seeds: DataFrame, column: str, min_ratio: float = 0.95, margin: float = 0.2) -> DataFrame:
    """``column`` pointed back at its seed: exactly after the typographic fold, else at the closest seed.

    The closest seed must be ``min_ratio`` alike and beat the next one by ``margin``. A ratio that high bounds the number
    of common two-letter pieces from below, so a row and its closest seed share one of their rarest pieces
    (``alike_candidates``): only rows with such a seed go on. For them the runner-up is looked for among the seeds of a
    like length, as length bounds the ratio from above.
    """
    keys = seeds.select(F.col(column).alias("seed")).distinct().withColumn("norm", T.typographic_fold(udfs.compatible_form("seed")))
    keys = keys.groupBy("norm").agg(F.max("seed").alias("seed"))
    known = seeds.select(F.col(column).alias("_known")).distinct()
    odd = rows.select(column).where(F.coalesce(column, F.lit("")) != "").distinct().join(known, F.col(column) == F.col("_known"), "left_anti")
    odd = odd.withColumn("norm", T.typographic_fold(udfs.compatible_form(column)))
    exact = odd.join(keys, "norm").select(column, "seed")
    rest = written(odd.join(keys, "norm", "left_anti"), "odd")
    pairs = alike_candidates(rest.select("norm").distinct(), keys.select("norm"), "norm", min_ratio)
    hopeful = pairs.where(udfs.sequence_ratio("a", "b") >= min_ratio).select(F.col("a").alias("norm")).distinct()
    rest = rest.join(hopeful, "norm", "left_semi")
    # a ratio over r needs 2 * min(len) / (len + len) > r; lengths differ by a factor of (2 - r) / r at most
    reach = (2 - (min_ratio - margin)) / (min_ratio - margin)
    step = math.log(reach)
    bucket = lambda c: F.floor(F.log(F.greatest(F.length(c), F.lit(1))) / step).cast("int")
    left = rest.withColumn("_b", F.explode(F.array(*[bucket("norm") + k for k in (-1, 0, 1)]))).withColumnRenamed("norm", "_n")
    near = left.join(keys.withColumn("_b", bucket("norm")), "_b").withColumn("ratio", udfs.sequence_ratio("_n", "norm"))
    w = Window.partitionBy(column).orderBy(F.col("ratio").desc(), F.col("seed").desc())
    two = near.select(column, "ratio", "seed", F.row_number().over(w).alias("_rn")).where("_rn <= 2")
    ranked = two.groupBy(column).agg(F.min_by("seed", "_rn").alias("seed"), F.max("ratio").alias("best"), F.max(F.when(F.col("_rn") == 2, F.col("ratio"))).alias("next"))
    close = ranked.where((F.col("best") >= min_ratio) & (F.col("best") - F.coalesce("next", F.lit(0.0)) >= margin)).select(column, "seed")
    found = exact.union(close)
    return rows.join(found, column, "left").withColumn("echoed", F.when(F.col("seed").isNotNull(), F.col(column))).withColumn(column, F.coalesce("seed", column)).drop("seed")


def alike_candidates(left: DataFrame, right: DataFrame, text: str, ratio: float) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct texts that hold all pairs whose matching blocks make up ``ratio`` of both.

    With n characters on one side, such a pair shares at least ``n * (2 * ratio / (2 - ratio) - 1) - 1`` two-letter pieces
    (repeated ones numbered). In one order of all pieces, the rarest of ``right`` first, the first shared piece then lies
    among the first ``n`` less that many of each side: only those are joined. A text of one letter has no piece.
    """
    keep = 2 * ratio / (2 - ratio) - 1

    def pieces(df: DataFrame) -> DataFrame:
        n = F.length("t")
        each = df.select(F.col(text).alias("t")).where(n > 1).select("t", F.explode(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(F.col("t"), i, F.lit(2)))).alias("g"))
        counted = each.groupBy("t", "g").agg(F.count("*").cast("int").alias("n"))
        return counted.select("t", F.explode(F.transform(F.sequence(F.lit(1), F.col("n")), lambda k: F.concat("g", k.cast("string")))).alias("g"))

    b = written(pieces(right), "pieces")
    often = b.groupBy("g").agg(F.count("*").alias("n"))

    def rarest(df: DataFrame) -> DataFrame:
        listed = df.join(often, "g", "left").groupBy("t").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g"))).alias("gs"))
        needed = F.greatest(F.lit(1), F.ceil(F.length("t") * keep - 1).cast("int"))
        return listed.select("t", F.explode(F.slice("gs", 1, F.greatest(F.lit(1), F.size("gs") - needed + 1))).alias("p")).select("t", "p.g")

    return rarest(pieces(left)).toDF("a", "g").join(rarest(b).toDF("b", "g"), "g").select("a", "b").distinct()


def fluency_issues(lines: DataFrame, key: str, text: str, words: DataFrame, max_unknown: int = 1) -> DataFrame:
    """``key`` and ``issue`` of each line of Russian: ``doubled_capital``, ``unknown_words`` or null.

    ``words`` (one column, lower case) are the known words. A capital that is doubled by mistake stands before the same
    letter: the token is unknown, the token without its first letter is known. More than ``max_unknown`` unknown tokens
    are an issue too. Distinct tokens are looked up once each, in an equi join; without a word list no line has an issue.
    """
    known = words.toDF("_word").distinct()
    if not known.head(1):
        return lines.select(key, F.lit(None).cast("string").alias("issue"))
    tokens = lines.select(key, F.explode_outer(F.regexp_extract_all(F.col(text), F.lit("[А-Яа-яЁё]+"), F.lit(0))).alias("_t"))
    low, rest = F.lower("_t"), F.substring(F.col("_t"), F.lit(2), F.length("_t"))
    shape = (F.length("_t") > 2) & (F.left("_t", F.lit(1)) != F.left(low, F.lit(1))) & (F.left(rest, F.lit(1)) == F.left(low, F.lit(1)))
    distinct = tokens.select("_t").distinct().where("_t is not null").select("_t", low.alias("_low"), F.when(shape, rest).alias("_rest"))
    seen = known.withColumn("_known", F.lit(True))
    found = distinct.join(seen.withColumnRenamed("_word", "_low"), "_low", "left").withColumnRenamed("_known", "_is")
    found = found.join(seen.withColumnRenamed("_word", "_rest"), "_rest", "left").select("_t", F.col("_is").isNull().alias("_odd"), (F.col("_is").isNull() & F.col("_known").isNotNull()).alias("_double"))
    per = tokens.join(found, "_t", "left").groupBy(key).agg(F.max("_double").alias("_d"), F.count_if("_odd").alias("_n"))
    return per.select(key, F.when(F.col("_d"), "doubled_capital").when(F.col("_n") > max_unknown, "unknown_words").alias("issue"))


def containing(texts: DataFrame, key: str, text: str, phrases: DataFrame, phrase: str) -> DataFrame:
    """``key`` and the columns of ``phrases`` for each text that contains the phrase; keys name texts.

    Phrases meet texts by an inner word, which is whole on both sides: an equi join of keys and words, without the
    texts. Only the candidates' texts are searched. Phrases of one or two words are tried on all texts; more than
    ``SMALL`` of them are an error.
    """
    inner = F.filter(F.slice(F.split(phrase, " "), 2, F.greatest(F.size(F.split(phrase, " ")) - 2, F.lit(0))), lambda w: w != "")
    anchored = phrases.withColumn("_w", F.array_max(F.transform(inner, lambda w: F.struct(F.length(w), w.alias("w"))))["w"])
    words = texts.select(key, F.explode(F.array_distinct(F.split(text, " "))).alias("_w"))
    candidates = words.join(small(anchored.where("_w is not null")), "_w").drop("_w")
    hits = candidates.join(texts.select(key, F.col(text).alias("_t")), key).where(F.contains("_t", F.col(phrase)))
    short = anchored.where("_w is null")
    if short.limit(SMALL + 1).count() > SMALL:
        raise ValueError("too many phrases of one or two words: each is searched in every text")
    loose = texts.select(key, F.col(text).alias("_t")).join(F.broadcast(short), F.contains(F.col("_t"), F.col(phrase)))
    columns = [key, *phrases.columns]
    return hits.select(columns).unionByName(loose.select(columns))


def covered_by_windows(cues: DataFrame, windows: DataFrame, keys: list[str], bucket: float, min_cover: float = 0.5) -> DataFrame:
    """Cue and window pairs that overlap strictly, the cue by at least ``min_cover`` of its length.

    ``start``, ``end`` of the cues and ``w_start``, ``w_end`` of the windows; both sides are dealt to the time buckets
    that they touch, so the join is an equi join, and a pair is kept in the first bucket they share.
    """
    spread = lambda a, b: F.explode(F.sequence(F.floor(a / bucket), F.floor(b / bucket)))
    c = cues.withColumn("_b", spread(F.col("start"), F.col("end")))
    w = windows.withColumn("_b", spread(F.col("w_start"), F.col("w_end")))
    both = c.join(w, [*keys, "_b"])
    first = F.greatest(F.floor(F.col("start") / bucket), F.floor(F.col("w_start") / bucket))
    overlap = F.least("end", "w_end") - F.greatest("start", "w_start")
    length = F.greatest(F.lit(1e-6), F.col("end") - F.col("start"))
    return both.where((F.col("_b") == first) & (F.col("end") > F.col("w_start")) & (F.col("start") < F.col("w_end")) & (overlap / length >= min_cover)).drop("_b")
