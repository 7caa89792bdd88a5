"""Evaluation reports as aggregates: every denominator of 0 gives null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import language as G
from corpusloom.functions import lexicons as L
from corpusloom.functions import predicates as P


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    return F.bround(part / F.nullif(whole, F.lit(0)), digits)


def percent_text(part: Column, whole: Column) -> Column:
    """``a/b (x.x%)``, ``0/0`` without a whole."""
    return F.when(whole == 0, "0/0").otherwise(F.format_string("%d/%d (%.1f%%)", part, whole, part * 100.0 / whole))


def detection(df: DataFrame, gold: Column, predicted: Column) -> DataFrame:
    g, p = F.coalesce(gold, F.lit(False)), F.coalesce(predicted, F.lit(False))
    n = df.agg(F.count_if(g & p).alias("tp"), F.count_if(~g & p).alias("fp"), F.count_if(g & ~p).alias("fn"), F.count_if(~g & ~p).alias("tn"))
    return n.select("tp", "fp", "fn", "tn", share(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), share(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"), share(F.col("fp"), F.col("fp") + F.col("tn")).alias("false_positive_rate"))


def by_class(df: DataFrame, gold: str, predicted: str, classes: list[str]) -> DataFrame:
    """Support, precision, recall and F1 of each class, of absent ones too: one pass over the pairs' counts."""
    pairs = df.groupBy(F.col(gold).alias("g"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    dim = df.sparkSession.createDataFrame([(c,) for c in classes], "class string")
    hits = pairs.join(F.broadcast(dim), (F.col("g") == F.col("class")) | (F.col("p") == F.col("class")), "right")
    of = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    is_gold, is_guess = F.col("g").eqNullSafe(F.col("class")), F.col("p").eqNullSafe(F.col("class"))
    n = hits.groupBy("class").agg(of(is_gold & is_guess).alias("tp"), of(~is_gold & is_guess).alias("fp"), of(is_gold & ~is_guess).alias("fn"))
    precision, recall = F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0)), F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0))
    f1 = F.when((precision > 0) & (recall > 0), 2 * precision * recall / (precision + recall)).when(F.col("tp") + F.col("fn") > 0, 0.0)
    return n.select("class", (F.col("tp") + F.col("fn")).alias("support"), F.bround(precision, 4).alias("precision"), F.bround(recall, 4).alias("recall"), F.bround(f1, 4).alias("f1"))


def confusion(df: DataFrame, gold: str, predicted: str) -> DataFrame:
    return df.where(~F.col(gold).eqNullSafe(F.col(predicted))).groupBy(F.concat_ws("->", gold, predicted).alias("pair")).agg(F.count("*").alias("n"))


def with_total(df: DataFrame, group: str, missing: str = "unknown", total: str = "ALL", **sums: Column) -> DataFrame:
    """Sums by group and over all, in one rollup; a null group has a name of its own, told from the total by the grouping id."""
    key = F.coalesce(F.nullif(F.col(group), F.lit("")), F.lit(missing))
    made = df.withColumn("_g", key).rollup("_g").agg(F.grouping("_g").alias("_all"), F.count("*").alias("rows"), *[c.alias(n) for n, c in sums.items()])
    return made.select(F.when(F.col("_all") == 1, total).otherwise(F.col("_g")).alias(group), "rows", *sums)


def error_rate(errors: Column, words: Column) -> Column:
    """Micro rate; 0 without words."""
    return F.when(F.coalesce(F.sum(words), F.lit(0)) == 0, 0.0).otherwise(F.sum(errors) / F.sum(words))


def crude_report(df: DataFrame, always: Column | None = None) -> DataFrame:
    """Rates over rows with crude sources: ``source_lang``, ``source_text``, ``reference``, ``reply``, ``parsed`` (null if unusable)."""
    lang = F.coalesce("source_lang", F.lit("ru"))
    into = G.other_language(lang)
    chosen = G.crude(F.col("source_text"), lang) | (always if always is not None else F.lit(False))
    answer = F.coalesce("parsed.translation", F.lit(""))
    rows = df.where(chosen).select(
        "reply", F.col("parsed").isNotNull().alias("valid"), P.masked_in_reply(answer).alias("masked"), G.crude(F.col("reference"), into).alias("ref_crude"), G.crude(answer, into).alias("kept_crude"), G.tier(F.col("reference"), into).alias("ref"), G.tier(answer, into).alias("got")
    )
    rate = lambda hit, of=None: F.bround(F.avg(F.when(of, hit.cast("int")) if of is not None else hit.cast("int")), 4)
    tiered = F.col("ref") > 0
    kept, same = G.tier_kept(F.col("got"), F.col("ref")), F.col("got") == F.col("ref")
    by_tier = [c for t, name in L.TIER_NAMES.items() for c in (rate(kept, F.col("ref") == t).alias(f"kept_{name}"), rate(same, F.col("ref") == t).alias(f"same_{name}"), F.count_if(F.col("ref") == t).alias(f"n_{name}"))]
    return rows.agg(F.count("*").alias("n"), rate(P.refuses(F.col("reply"), L.EVALUATION_REFUSALS)).alias("refusal_rate"), rate(F.col("valid")).alias("json_valid_rate"), rate(kept, tiered).alias("kept_rate"), rate(same, tiered).alias("same_tier_rate"), rate(F.col("kept_crude"), F.col("ref_crude")).alias("present_rate"), rate(F.col("masked")).alias("masked_rate"), *by_tier)


def register_report(df: DataFrame, *groups: str) -> DataFrame:
    """Per group: kept, same, softened and harsher candidates, and sentences that some candidate keeps; ``src_tier``, ``tr_tier``, ``source_text``."""
    rows = df.where("src_tier > 0")
    kept = G.tier_kept(F.col("tr_tier"), F.col("src_tier"))
    return rows.groupBy(*groups).agg(F.count("*").alias("candidates"), F.count_if(kept).alias("kept"), F.count_if(F.col("tr_tier") == F.col("src_tier")).alias("same"), F.count_if(F.col("tr_tier") < F.col("src_tier")).alias("softened"), F.count_if(F.col("tr_tier") > F.col("src_tier")).alias("harsher"), F.count_distinct("source_text").alias("sentences"), F.count_distinct(F.when(kept, F.col("source_text"))).alias("sentences_kept"))


def gate(rate: Column, least: float) -> Column:
    """``pass`` or ``stop``; without rows the rate counts as 1."""
    return F.when(F.coalesce(rate, F.lit(1.0)) >= least, "pass").otherwise("stop")


def run_statistics(df: DataFrame, category: Column, valid: Column, ms: str) -> DataFrame:
    """Rows, share of valid answers, whole mean and longest time of a run."""
    return df.agg(F.count("*").alias("done"), F.bround(100 * F.avg(valid.cast("int")), 1).alias("valid_percent"), F.floor(F.sum(ms) / F.count("*")).alias("mean_ms"), F.max(ms).alias("max_ms"), F.count_distinct(category).alias("categories"))


def chrf_corpus(df: DataFrame, hypothesis: str, reference: str) -> float | None:
    """Corpus score: counts are summed in the cluster, one row of them is scored; null without rows."""
    from corpusloom.functions import udfs

    counts = df.select(F.posexplode(udfs.chrf_statistics(hypothesis, reference)).alias("n", "c")).groupBy("n").agg(*[F.sum(F.get("c", i)).alias(f"c{i}") for i in range(3)])
    rows = sorted(counts.collect())
    return round(udfs.chrf_score([tuple(r)[1:] for r in rows]), 2) if rows else None
