"""Reports: detection, classes, rollups, rates, quantiles, run statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom import fixtures as X
from corpusloom.functions import language as G
from corpusloom.functions import text as T
from corpusloom.functions import udfs
from corpusloom.operators import reports, selection, votes
from corpusloom.plans import evaluation
from corpusloom.registry import query, table

GOLD = "(SELECT l.doc_id, l.quality = 1 AS gold, d.n_chars > 1000 AS guess, d.lang, CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 'clean' WHEN l.toxic = 1 THEN 'toxic' ELSE 'junk' END AS g, CASE WHEN d.n_chars > 1500 THEN 'clean' WHEN d.n_chars > 800 THEN 'toxic' ELSE 'other' END AS p FROM labels l JOIN documents d USING (doc_id))"


def judged(spark, sf):
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars", "lang"), "doc_id")
    g = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "clean").when(F.col("toxic") == 1, "toxic").otherwise("junk")
    p = F.when(F.col("n_chars") > 1500, "clean").when(F.col("n_chars") > 800, "toxic").otherwise("other")
    return rows.select("doc_id", "lang", (F.col("quality") == 1).alias("gold"), (F.col("n_chars") > 1000).alias("guess"), g.alias("g"), p.alias("p"))


@query(f"""SELECT tp, fp, fn, tn, round_even(tp / nullif(tp + fp, 0)::DOUBLE, 4) AS precision, round_even(tp / nullif(tp + fn, 0)::DOUBLE, 4) AS recall, round_even(fp / nullif(fp + tn, 0)::DOUBLE, 4) AS false_positive_rate
FROM (SELECT count(*) FILTER (gold AND guess) AS tp, count(*) FILTER (NOT gold AND guess) AS fp, count(*) FILTER (gold AND NOT guess) AS fn, count(*) FILTER (NOT gold AND NOT guess) AS tn FROM {GOLD})""")
def detection_scores(spark, sf):
    return reports.detection(judged(spark, sf), F.col("gold"), F.col("guess"))


@query(f"""WITH n AS (SELECT class, (SELECT count(*) FROM {GOLD} WHERE g = class AND p = class) AS tp, (SELECT count(*) FROM {GOLD} WHERE g <> class AND p = class) AS fp, (SELECT count(*) FROM {GOLD} WHERE g = class AND p <> class) AS fn FROM (VALUES ('clean'), ('toxic'), ('junk'), ('other'), ('absent')) c(class)),
r AS (SELECT class, tp + fn AS support, tp / nullif(tp + fp, 0)::DOUBLE AS pr, tp / nullif(tp + fn, 0)::DOUBLE AS re FROM n)
SELECT class, support, round_even(pr, 4) AS precision, round_even(re, 4) AS recall, round_even(CASE WHEN pr > 0 AND re > 0 THEN 2 * pr * re / (pr + re) WHEN support > 0 THEN 0.0 END, 4) AS f1 FROM r""")
def category_scores(spark, sf):
    return reports.by_class(judged(spark, sf), "g", "p", ["clean", "toxic", "junk", "other", "absent"])


@query(f"SELECT g || '->' || p AS pair, count(*) AS n FROM {GOLD} WHERE g <> p GROUP BY 1")
def confusion_pairs(spark, sf):
    return reports.confusion(judged(spark, sf), "g", "p")


@query(r"SELECT CASE WHEN grouping(role) = 1 THEN 'ALL' ELSE role END AS role, count(*) AS rows, sum(len(string_split_regex(trim(text), '\s+')))::BIGINT AS words, sum((length(text) % 7))::BIGINT AS errors FROM conversations GROUP BY ROLLUP (role)")
def wer_rollup(spark, sf):
    return reports.with_total(table(spark, sf, "conversations"), "role", words=F.sum(T.space_word_count(F.col("text"))), errors=F.sum(F.length("text") % 7).cast("bigint"))


@query("SELECT role, CASE WHEN sum(length(text)) = 0 THEN 0.0 ELSE sum(length(text) % 7)::DOUBLE / sum(length(text)) END AS rate FROM conversations GROUP BY role")
def micro_error_rate(spark, sf):
    return table(spark, sf, "conversations").groupBy("role").agg(reports.error_rate(F.length("text") % 7, F.length("text")).alias("rate"))


@query("SELECT lang, count(*) AS n, median(n_chars) AS middle, min(n_chars) AS low, max(n_chars) AS high, count(*) FILTER (n_chars < 500) AS small FROM documents GROUP BY lang")
def length_statistics(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.median("n_chars").alias("middle"), F.min("n_chars").alias("low"), F.max("n_chars").alias("high"), F.count_if(F.col("n_chars") < 500).alias("small"))


@query("SELECT share, n_chars FROM (SELECT n_chars, row_number() OVER (ORDER BY n_chars) - 1 AS pos FROM documents) r JOIN (SELECT share, floor(share * ((SELECT count(*) FROM documents) - 1))::BIGINT AS pos FROM (VALUES (0.1::DOUBLE), (0.25), (0.5), (0.75)) s(share)) p USING (pos)")
def quantile_picks(spark, sf):
    return selection.lower_quantiles(table(spark, sf, "documents"), "n_chars", [0.1, 0.25, 0.5, 0.75])


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY CUBE (lang, source) HAVING lang IS NOT NULL OR source IS NOT NULL")
def distribution_maps(spark, sf):
    return table(spark, sf, "documents").cube("lang", "source").agg(F.count("*").alias("n")).where("lang is not null or source is not null")


@query("SELECT user_id, count(*) FILTER (event_type = 'error') AS fails, count(*) FILTER (event_type = 'purchase') AS ok, round_even(count(*) FILTER (event_type = 'error') / nullif(count(*) FILTER (event_type IN ('error', 'purchase')), 0)::DOUBLE, 4) AS rate FROM events GROUP BY 1")
def failure_rates(spark, sf):
    fails, ok = F.count_if(F.col("event_type") == "error"), F.count_if(F.col("event_type") == "purchase")
    return table(spark, sf, "events").groupBy("user_id").agg(fails.alias("fails"), ok.alias("ok"), reports.share(fails, fails + ok).alias("rate"))


@query("SELECT count(*) AS done, round_even(100 * avg((event_type <> 'error')::INT), 1) AS valid_percent, floor(sum(event_id) / count(*))::BIGINT AS mean_ms, max(event_id) AS max_ms, count(DISTINCT event_type) AS categories FROM events")
def run_statistics(spark, sf):
    return reports.run_statistics(table(spark, sf, "events"), F.col("event_type"), F.col("event_type") != "error", "event_id")


@query("SELECT event_type, CASE WHEN b = 0 THEN '0/0' ELSE printf('%d/%d (%.1f%%)', a, b, a * 100.0 / b) END AS said, CASE WHEN coalesce(a / nullif(b, 0)::DOUBLE, 1) >= 0.5 THEN 'pass' ELSE 'stop' END AS gate FROM (SELECT event_type, count(*) FILTER (value > 50) AS a, count(*) AS b FROM events GROUP BY 1)")
def kept_rate_gate(spark, sf):
    n = table(spark, sf, "events").groupBy("event_type").agg(F.count_if(F.col("value") > 50).alias("a"), F.count("*").alias("b"))
    return n.select("event_type", reports.percent_text(F.col("a"), F.col("b")).alias("said"), reports.gate(F.col("a") / F.col("b"), 0.5).alias("gate"))


@query("""
WITH c AS (SELECT user_id, event_type AS flag, count(*) AS n, min(event_id) AS f, count(DISTINCT event_id % 2) AS kinds, min(event_id % 2) AS category FROM events GROUP BY 1, 2),
t AS (SELECT *, sum(n) OVER (PARTITION BY user_id) AS votes FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) = 1)
SELECT user_id, votes::BIGINT AS votes, n / votes::DOUBLE AS fraction, n / votes::DOUBLE >= 0.3 AND kinds = 1 AS eligible, CASE WHEN n / votes::DOUBLE >= 0.3 AND kinds = 1 THEN flag END AS flag, CASE WHEN n / votes::DOUBLE >= 0.3 AND kinds = 1 THEN category END AS category FROM t""")
def fan_in_vote(spark, sf):
    e = table(spark, sf, "events").withColumnRenamed("event_type", "flag").withColumn("half", F.col("event_id") % 2)
    return votes.agreement(e, "user_id", "flag", "half", "event_id", 0.3)


@query("SELECT source, count(*) AS n FROM documents WHERE coalesce(lang, '') <> 'en' GROUP BY 1 HAVING count(*) >= 3")
def contested_groups(spark, sf):
    rows = table(spark, sf, "documents").withColumn("resolution", F.when(F.col("lang") == "en", "agreed").otherwise("contested"))
    return votes.contested(rows, "source", "resolution")


@query("SELECT d.doc_id, d.lang, coalesce(l.quality, -1)::INT AS quality FROM documents d LEFT JOIN labels l USING (doc_id)")
def gold_prediction_join(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left").select("doc_id", "lang", F.coalesce("quality", F.lit(-1)).alias("quality"))


@query("SELECT conv_id, len(list(turn)) AS turns, max(CASE WHEN turn = 0 THEN role END) AS first_role FROM conversations GROUP BY conv_id")
def chat_messages(spark, sf):
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(turns.alias("m"))
    return rows.select("conv_id", F.size("m").cast("bigint").alias("turns"), F.try_element_at(F.transform(F.filter("m", lambda t: t["turn"] == 0), lambda t: t["role"]), F.lit(1)).alias("first_role"))


@query()
def register_report(spark, sf):
    lines = X.LINES.frame(spark).where("text is not null")
    rows = lines.select(F.col("text").alias("source_text"), F.when(F.col("id") % 2 == 0, "en").otherwise("ru").alias("source_lang"), G.tier(F.col("text"), F.lit("ru")).alias("src_tier"), G.tier(F.col("text"), F.lit("en")).alias("tr_tier"))
    return reports.register_report(rows.withColumn("src_tier", F.greatest("src_tier", F.lit(1))), "source_lang")


@query()
def crude_report(spark, sf):
    rows = X.REPLIES.frame(spark).withColumn("parsed", G.parse_reply(F.col("reply"))).withColumns({"source_lang": F.lit("ru"), "source_text": F.lit("блин, чёрт"), "reference": F.lit("damn it")})
    return reports.crude_report(rows)


@query()
def evaluation_detection(spark, sf):
    rows = X.REPLIES.frame(spark).withColumns({"has_subtext": F.col("id") % 2 == 0, "category": F.lit("idiom"), "translation": F.lit("Hi"), "source_lang": F.lit("ru"), "source_text": F.lit("x")})
    return evaluation.finished(rows)["detection"]


@query()
def word_error_by_conversation(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", T.speech_words(F.col("text")).alias("w"))
    both = c.join(c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("w").alias("h")), ["conv_id", "turn"])
    return both.withColumn("e", T.token_distance("w", "h")).groupBy("conv_id").agg(F.sum("e").alias("errors"), F.sum(F.size("w")).alias("words"), reports.error_rate(F.col("e"), F.size("w")).alias("rate"))


#: Letters of the texts beyond ASCII, and ASCII characters that the texts do not have; the other engine compares bytes.
LETTERS, BYTES = "óéñèíüçêäößÉÑÈÓÜÍÇÖÊÄáàâîôûùëïúÁÀ", "!\"#$%&()*+/:;<=>?@[]^_{|}~0123456"
PLAIN = f"translate(x.text, '{LETTERS}', '{BYTES}')"


@query(f"SELECT a.conv_id, a.turn, levenshtein({PLAIN.replace('x.', 'a.')}, {PLAIN.replace('x.', 'b.')})::INT AS chars FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1")
def character_distance(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    both = c.join(c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next")), ["conv_id", "turn"])
    return both.select("conv_id", "turn", F.levenshtein("text", "next").alias("chars"))
