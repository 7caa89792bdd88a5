"""Subtitle mining: a filtered pool of pairs, scored by models behind a seam, ranked and selected under quotas."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import language as G
from corpusloom.functions import predicates as P
from corpusloom.functions import text as T
from corpusloom.functions import udfs
from corpusloom.functions import vectors as V
from corpusloom.operators import selection


def judged(pairs: DataFrame, films: DataFrame | None = None, keep: Callable[[Column], Column] | None = None, min_words: int = 3, max_words: int = 25) -> DataFrame:
    """Pairs (``line``, ``ru``, ``en``, ``film``) with ``reason``: origin, several speakers, the pair's filters, not wanted, duplicate.

    A line that passes claims its key: later lines with it are duplicates.
    """
    rows = pairs
    if films is not None:
        rows = rows.join(F.broadcast(films.select("film").distinct().withColumn("_ok", F.lit(True))), "film", "left")
    else:
        rows = rows.withColumn("_ok", F.lit(True))
    rows = rows.withColumn("_several", P.several_speakers(F.col("ru")) | P.several_speakers(F.col("en")))
    rows = rows.withColumns({"ru": T.subtitle_clean(udfs.composed_form("ru")), "en": T.subtitle_clean(udfs.composed_form("en"))})
    reason = F.coalesce(P.cascade(("origin", F.col("_ok").isNull()), ("multi_speaker", F.col("_several"))), P.pair_reason(F.col("ru"), F.col("en"), min_words, max_words))
    if keep is not None:
        reason = F.coalesce(reason, F.when(~F.coalesce(keep(F.col("ru")), F.lit(False)), "not_wanted"))
    rows = rows.withColumn("reason", reason).withColumn("_key", T.token_key(F.col("ru")))
    w = Window.partitionBy("_key", F.col("reason").isNull()).orderBy("line")
    return rows.withColumn("reason", F.coalesce("reason", F.when(F.row_number().over(w) > 1, "duplicate"))).drop("_ok", "_several", "_key")


def pool(rows: DataFrame, size: int, seed: str) -> DataFrame:
    """At most ``size`` kept pairs, each as likely as any other."""
    return selection.hash_sample(rows.where("reason is null").drop("reason"), size, seed, F.col("line"))


def emotion_lines(only: list[str] | None = None) -> Callable[[Column], Column]:
    """Keeps lines with an emotion word, of the given ones if any."""
    return lambda ru: F.exists(G.emotions(ru), lambda e: e.isin(only) if only else F.lit(True))


def scored(pairs: DataFrame, embed: Callable[[Column], Column], translate: Callable[[Column, str], Column], directions: list[str], min_align: float, max_chrf: float, min_span: int = 2, max_chrf_local: float = 85.0) -> DataFrame:
    """Aligned pairs in each direction with their departure from a literal translation. ``embed`` and ``translate`` are the seam."""
    aligned = pairs.withColumn("align_cos", F.bround(V.dot(embed(F.col("ru")), embed(F.col("en"))), 4)).where(F.col("align_cos") >= min_align)
    out = None
    for d in directions:
        src, ref = ("ru", "en") if d == "ru-en" else ("en", "ru")
        rows = aligned.withColumns({"direction": F.lit(d), "source": F.col(src), "human": F.col(ref)}).withColumn("literal", translate(F.col("source"), d))
        rows = rows.withColumn("d", udfs.divergence("literal", "human"))
        rewrite, local = F.col("d.chrf") <= max_chrf, (F.col("d.span") >= min_span) & (F.col("d.chrf") <= max_chrf_local)
        rows = rows.where(rewrite | local).withColumn("kind", F.when(rewrite, "rewrite").otherwise("local_swap"))
        out = rows if out is None else out.unionByName(rows)
    meaning = F.bround(V.dot(embed(F.col("literal")), embed(F.col("human"))), 4)
    return out.select(*pairs.columns, "align_cos", "direction", "source", "human", "literal", "kind", F.bround("d.chrf", 1).alias("chrf"), F.col("d.span").alias("span"), F.bround("d.novelty", 3).alias("novelty"), meaning.alias("meaning"))


def ranked(candidates: DataFrame, min_meaning: float, lexicon: list[str]) -> DataFrame:
    rows = candidates.withColumns({"address": G.address(F.col("ru")), "idioms": G.phrases(F.col("ru"), lexicon), "emotions": G.emotions(F.col("ru"))})
    return selection.ranked_candidates(rows, min_meaning).withColumns({"key": T.token_key(F.col("source")), "grp": F.col("film"), "bucket": F.when(F.col("address").isNotNull(), "capped").otherwise("general"), "label": F.get("emotions", 0)})


def counts(rows: DataFrame) -> DataFrame:
    """Reasons and totals of the pool in one pass."""
    return rows.groupBy(F.coalesce(F.concat(F.lit("reject_"), "reason"), F.lit("passed_filters")).alias("stat")).agg(F.count("*").alias("n"))
