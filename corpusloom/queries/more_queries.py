"""Smaller operators: routing, acceptance, leakage, catalogues, captions, listings."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom import fixtures as X
from corpusloom.functions import language as G
from corpusloom.functions import predicates as P
from corpusloom.functions import text as T
from corpusloom.functions import udfs
from corpusloom.operators import joins, reports, selection
from corpusloom.plans import audio, mining
from corpusloom.registry import query, table
from corpusloom.sources import readers

CATS = X.Inline("id int, category string, message string", ((1, "idiom", None), (2, None, '{"category": "sarcasm"}'), (3, None, "not json"), (4, None, None), (5, None, '{"x": 1}')))


@query(f"SELECT id, coalesce(category, CASE WHEN json_valid(message) THEN json_extract_string(message, '$.category') END, 'none') AS category FROM {CATS.sql()}")
def row_category(spark, sf):
    return CATS.frame(spark).select("id", G.row_category(F.col("category"), F.col("message")).alias("category"))


@query(f"SELECT line, coalesce(nullif(CASE WHEN line % 2 = 0 THEN '' ELSE 'male' END, ''), CASE WHEN line % 3 = 0 THEN 'female' END) AS gender FROM {X.CANDIDATES.sql()}")
def row_genders(spark, sf):
    given, hidden = F.when(F.col("line") % 2 == 0, "").otherwise("male"), F.when(F.col("line") % 3 == 0, "female")
    return X.CANDIDATES.frame(spark).select("line", G.first_of(given, hidden).alias("gender"))


@query()
def register_accept(spark, sf):
    rows = X.LINES.frame(spark).where("text is not null").withColumn("lang", F.when(F.col("text").rlike("[А-я]"), "ru").otherwise("en"))
    return rows.select("id", P.register_reason(F.col("text"), F.col("lang"), F.lit(1), G.tier(F.col("text"), F.col("lang"))).alias("reason"))


@query()
def idiom_accept(spark, sf):
    rows = X.LINES.frame(spark).where("text is not null")
    return rows.select("id", P.idiom_reason(F.col("text"), F.lit("ru"), F.lit("горох|скребут"), ["ныне там"]).alias("reason"))


@query("SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE contains(lower(n_name), 'an') OR contains(lower(r_name), 'an')")
def locale_search(spark, sf):
    both = table(spark, sf, "nation").join(F.broadcast(table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return both.where(F.contains(F.lower("n_name"), F.lit("an")) | F.contains(F.lower("r_name"), F.lit("an"))).select("n_nationkey")


LEAK = X.Inline("split string, key string, text string", (("train", "горох", "Как об стенку горох"), ("test", "там$", "а воз и ныне там"), ("train", "воз", "уехал воз"), ("test", "leg", "break a leg")))


@query(f"SELECT k.split, k.key, t.text FROM {LEAK.sql('k')} JOIN {LEAK.sql('t')} ON k.split <> t.split AND regexp_matches(replace(lower(t.text), 'ё', 'е'), k.key)")
def split_leakage(spark, sf):
    k = LEAK.frame(spark)
    texts = k.select(F.col("split").alias("other"), "text")
    return k.select("split", "key").join(F.broadcast(texts), (F.col("split") != F.col("other")) & F.regexp_like(T.plain_yo(F.col("text")), F.col("key"))).select("split", "key", "text")


@query("SELECT s_suppkey, n_name IS NULL AS missing FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON s_nationkey = n_nationkey")
def roster_catalogue(spark, sf):
    live = table(spark, sf, "nation").where("n_regionkey < 3")
    return table(spark, sf, "supplier").join(F.broadcast(live), F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", F.col("n_name").isNull().alias("missing"))


@query("SELECT coalesce(role, 'unknown') AS role, count(*) AS n, avg((length(text) > 200)::INT) AS true_ratio FROM conversations GROUP BY 1")
def dataset_stats(spark, sf):
    return table(spark, sf, "conversations").groupBy(F.coalesce("role", F.lit("unknown")).alias("role")).agg(F.count("*").alias("n"), F.avg((F.length("text") > 200).cast("int")).alias("true_ratio"))


@query("SELECT role AS kind, s.scope, count(*) AS n, avg((length(text) % 3 = 0)::INT) AS kept FROM conversations JOIN (VALUES ('all'), ('strong')) s(scope) ON s.scope = 'all' OR turn >= 2 GROUP BY ALL")
def pilot_scores(spark, sf):
    scopes = F.when(F.col("turn") >= 2, F.lit(["all", "strong"])).otherwise(F.lit(["all"]))
    return table(spark, sf, "conversations").withColumn("scope", F.explode(scopes)).groupBy(F.col("role").alias("kind"), "scope").agg(F.count("*").alias("n"), F.avg((F.length("text") % 3 == 0).cast("int")).alias("kept"))


@query("SELECT quality AS split, count(*) AS n, count(*) FILTER (toxic = 1) AS formality FROM labels GROUP BY 1")
def sft_counts(spark, sf):
    return table(spark, sf, "labels").groupBy(F.col("quality").alias("split")).agg(F.count("*").alias("n"), F.count_if(F.col("toxic") == 1).alias("formality"))


@query()
def own_voice_totals(spark, sf):
    rows = spark.createDataFrame([("a", "well um it's good", "well its good um"), ("b", "say cheese namaste", "say cheese")], "clip string, ref string, hyp string")
    words = rows.select("clip", T.english_words(F.col("ref")).alias("r"), T.english_words(F.col("hyp")).alias("h"))
    drop = lambda c, out: F.filter(c, lambda w: ~w.isin(out))
    out = words.withColumns({"rn": drop(F.col("r"), ["um", "uh"]), "hn": drop(F.col("h"), ["um", "uh"])}).withColumns({"re": drop(F.col("rn"), ["namaste"]), "he": drop(F.col("hn"), ["namaste"])})
    scored = out.select(*[x for r, h, n in (("r", "h", "raw"), ("rn", "hn", "nf"), ("re", "he", "en")) for x in (F.size(r).alias(f"words_{n}"), T.token_distance(r, h).alias(f"errors_{n}"))])
    return scored.agg(*[F.sum(c).alias(c) for c in scored.columns])


CAPTIONS = X.Inline("clip string, source string, text string, second string", (("a", "asr", "Привет, мир!", "привет мир"), ("b", "human", "x", "y"), ("c", "asr", "совсем другое", "ничего похожего"), ("d", "asr", "", ""), ("e", None, None, None)))


@query()
def cross_check(spark, sf):
    return audio.cross_checked(CAPTIONS.frame(spark)).select("clip", "cer", "asr_agree")


@query(f"SELECT clip, CASE WHEN coalesce(source, '') <> 'human' AND coalesce(text, '') = '' AND clip IN ('d', 'e', 'b') THEN 'new ' || clip ELSE text END AS text FROM {CAPTIONS.sql()}")
def resume_fill(spark, sf):
    made = spark.createDataFrame([(c, f"new {c}") for c in "abde"], "clip string, text string")
    return audio.filled(CAPTIONS.frame(spark).drop("second"), made).select("clip", "text")


@query()
def clip_pipeline(spark, sf):
    names = {"s": "start", "e": "end"}
    return audio.clips(X.SEGMENTS.frame(spark).withColumnsRenamed(names), X.CUES.frame(spark).withColumnsRenamed(names), shortest=0.6, longest=3.0)


PRICES = X.Inline("id int, price string", ((1, "0.000002"), (2, "x"), (3, None), (4, "0.0000155")))


@query(f"SELECT id, coalesce(printf('$%.2f', try_cast(price AS DOUBLE) * 1000000), '?') AS said FROM {PRICES.sql()}")
def price_texts(spark, sf):
    return PRICES.frame(spark).select("id", G.price_per_million(F.col("price")).alias("said"))


@query(f"SELECT DISTINCT split_part(ids, chr(9), 1) AS lang FROM {X.Inline('ids string', (('en' + chr(9) + 'x',), ('en-GB' + chr(9) + 'y',), ('ru',))).sql()} WHERE NOT contains(split_part(ids, chr(9), 1), '-')")
def spelling_languages(spark, sf):
    rows = spark.createDataFrame([("en\tx",), ("en-GB\ty",), ("ru",)], "ids string")
    return rows.select(F.split_part("ids", F.lit("\t"), F.lit(1)).alias("lang")).where(~F.contains("lang", F.lit("-"))).distinct()


STREAMS = X.Inline("film string, no int, lang string, codec string", (("f", 0, "eng", "text"), ("f", 1, "rus", "text"), ("f", 2, "rus", "image"), ("g", 0, "eng", "image"), ("g", 1, "eng", "text")))


@query(f"SELECT film, arg_min(no, (CASE WHEN lang = 'rus' THEN 0 ELSE 1 END, no)) AS no FROM {STREAMS.sql()} GROUP BY film")
def pick_streams(spark, sf):
    return STREAMS.frame(spark).groupBy("film").agg(F.min_by("no", F.struct(F.when(F.col("lang") == "rus", 0).otherwise(1), "no")).alias("no"))


@query(f"SELECT value, list_filter(string_split(keywords, '|'), lambda k: length(k) > 4) AS shown FROM {X.EMOJI.sql()} WHERE len(list_filter(string_split(keywords, '|'), lambda k: length(k) > 4)) > 0")
def renderable_sets(spark, sf):
    shown = F.filter(F.split("keywords", r"\|"), lambda k: F.length(k) > 4)
    return X.EMOJI.frame(spark).select("value", shown.alias("shown")).where(F.size("shown") > 0)


@query("SELECT r_name, list(n_name ORDER BY n_name) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def grouped_packs(spark, sf):
    both = table(spark, sf, "nation").join(F.broadcast(table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return both.groupBy("r_name").agg(F.array_sort(F.collect_list("n_name")).alias("nations"))


@query(f"SELECT word FROM {X.WORDS.sql()} WHERE locale = 'en' UNION ALL SELECT DISTINCT 'locale ' || coalesce(locale, 'all') FROM {X.WORDS.sql()}")
def dictionary_screen(spark, sf):
    w = X.WORDS.frame(spark)
    return w.where("locale = 'en'").select("word").union(w.select(F.concat(F.lit("locale "), F.coalesce("locale", F.lit("all"))).alias("word")).distinct())


@query("SELECT n_nationkey, 'nation ' || n_name || ' of {x} ' || n_regionkey AS said FROM nation")
def templates(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", T.template("nation {name} of {x} {region}", name=F.col("n_name"), region=F.col("n_regionkey")).alias("said"))


@query()
def probe_rows(spark, sf):
    text = spark.createDataFrame([('{"row": {"source_text": "a"}, "reply": null}',), ('{"source_text": "b"}',), ('{"source_text": " "}',)], "v string")
    s = F.from_json("v", "struct<row: struct<source_text: string>, source_text: string, reply: string>")
    return text.select(F.coalesce(s["row"]["source_text"], s["source_text"]).alias("source_text"), F.coalesce(s["reply"], F.lit("")).alias("reply")).where(~P.blank(F.col("source_text")))


@query(f"WITH f AS (SELECT source_text, arg_min(translation, line) AS translation FROM {X.CANDIDATES.sql()} WHERE source_text IS NOT NULL GROUP BY 1) SELECT * FROM f ORDER BY md5(source_text || ':sheet') LIMIT 4")
def review_sheet(spark, sf):
    first = X.CANDIDATES.frame(spark).where("source_text is not null").groupBy("source_text").agg(F.min_by("translation", "line").alias("translation"))
    return selection.hash_sample(first, 4, "sheet", F.col("source_text"))


@query()
def listed_lines(spark, sf):
    return spark.createDataFrame([('1. "First"\n- second\n\n3) third',)], "reply string").select(F.explode(G.listed_lines(F.col("reply"))).alias("line"))


@query(f"""SELECT source_text, string_agg('- translation: "' || translation || '" | nuance_note: "' || coalesce(nuance_note, '') || '"', chr(10) ORDER BY line) AS bullets FROM {X.CANDIDATES.sql()} WHERE source_text IS NOT NULL GROUP BY 1""")
def candidate_prompts(spark, sf):
    rows = X.CANDIDATES.frame(spark).where("source_text is not null").withColumn("b", G.candidate_bullets(F.col("translation"), F.col("nuance_note")))
    return rows.groupBy("source_text").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "b"))), lambda x: x["b"]), "\n").alias("bullets"))


@query()
def ranked_candidates(spark, sf):
    rows = X.PAIRS.frame(spark).where("ru <> '' and ru is not null").select(F.col("ru"), F.col("ru").alias("source"), F.lit("f").alias("film"), (F.col("id") / 12.0).alias("align_cos"), (F.col("id") * 7.0).alias("chrf"), F.lit(0.3).alias("novelty"), F.lit(0.9).alias("meaning"))
    return mining.ranked(rows, 0.5, X.IDIOMS).select("source", "score", "bucket", "label")


FILMS = X.Inline("film string, langs string", (("1/1", "Q7737,Q1860"), ("2/2", "Q1860"), ("3/3", "")))


@query(f"SELECT film FROM {FILMS.sql()} WHERE list_contains(string_split(langs, ','), 'Q7737')")
def film_origins(spark, sf):
    return FILMS.frame(spark).where(F.array_contains(F.split("langs", ","), "Q7737")).select("film")


@query()
def lexicon_hits(spark, sf):
    lexicon = spark.createDataFrame([(p, f"meaning of {p}") for p in X.IDIOMS], "ru string, note string")
    lines = X.LINES.frame(spark).where("text is not null")
    return lines.join(joins.small(lexicon), F.contains(F.lower("text"), F.lower("ru"))).select("id", "ru", "note")


@query("SELECT model, count(*) AS n, count(*) FILTER (NOT (starts_with(error, 'skipped --') OR starts_with(error, 'rate limited --'))) AS failures FROM (SELECT event_type AS model, CASE WHEN value < 30 THEN 'skipped -- x' WHEN value < 60 THEN 'HTTP 500' ELSE 'rate limited -- y' END AS error FROM events) GROUP BY 1")
def failure_classes(spark, sf):
    error = F.when(F.col("value") < 30, "skipped -- x").when(F.col("value") < 60, "HTTP 500").otherwise("rate limited -- y")
    return table(spark, sf, "events").select(F.col("event_type").alias("model"), error.alias("error")).groupBy("model").agg(F.count("*").alias("n"), F.count_if(P.model_failure(F.col("error"))).alias("failures"))


@query("SELECT doc_id, count(*) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_before FROM documents QUALIFY n_before <= 3")
def per_source_cap(spark, sf):
    w = Window.partitionBy("source").orderBy("doc_id")
    return table(spark, sf, "documents").select("doc_id", F.row_number().over(w).cast("bigint").alias("n_before")).where("n_before <= 3")


@query("SELECT source, count(*) AS candidates, count(*) FILTER (n_chars > 1000) AS kept, round_even(count(*) FILTER (n_chars > 1000) / count(*)::DOUBLE, 4) AS share FROM documents GROUP BY source")
def kept_by_generator(spark, sf):
    kept = F.count_if(F.col("n_chars") > 1000)
    return table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("candidates"), kept.alias("kept"), reports.share(kept, F.count("*")).alias("share"))


@query()
def subtitle_sections(spark, sf):
    lines = spark.createDataFrame([("f", 1, "[a]"), ("f", 2, "x"), ("f", 3, "[b]"), ("f", 4, "y"), ("g", 1, "z")], "file string, line int, value string")
    return readers.with_section(lines, F.nullif(F.regexp_extract("value", r"^\[(.*)\]$", 1), F.lit("")))
