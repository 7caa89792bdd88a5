"""Histories, keyed state, dictionaries and gestures."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom import fixtures as X
from corpusloom.functions import language as G
from corpusloom.functions import predicates as P
from corpusloom.functions import vectors as V
from corpusloom.operators import dedup, gestures, selection, state
from corpusloom.registry import query, table
from corpusloom.sources import readers, writers

LAST = "(SELECT max(epoch(ts)) FROM events)"


def events(spark, sf):
    return table(spark, sf, "events").withColumn("at", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6))


@query(f"SELECT event_id FROM events WHERE (event_type <> 'purchase' AND {LAST} - epoch(ts) > 20000 * 60) OR (event_type = 'signup' AND {LAST} - epoch(ts) > 86400)")
def ttl_expired(spark, sf):
    e = events(spark, sf)
    rows = e.join(F.broadcast(e.agg(F.max("at").alias("now"))))
    return rows.where(state.expired(F.col("now"), F.col("at"), F.col("event_type") == "purchase", F.col("event_type") == "signup", 20000, 86400)).select("event_id")


@query(f"SELECT event_id, CASE WHEN {LAST} - epoch(ts) < 300 * 60 THEN 'recent' ELSE 'other' END AS bucket FROM events")
def recency_buckets(spark, sf):
    e = events(spark, sf)
    return e.join(F.broadcast(e.agg(F.max("at").alias("now")))).select("event_id", state.recency(F.col("now"), F.col("at"), 300).alias("bucket"))


@query("SELECT event_id FROM events WHERE event_type <> 'purchase' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) > 20")
def history_limit(spark, sf):
    return selection.history_limit(table(spark, sf, "events"), ["user_id"], "event_id", 20, F.col("event_type") == "purchase").select("event_id")


@query("SELECT user_id, event_type, max(ts) AS ts, bool_or(value > 50) AS pinned, count(*) AS uses FROM events GROUP BY 1, 2")
def move_to_front(spark, sf):
    return state.moved_to_front(table(spark, sf, "events").withColumn("pinned", F.col("value") > 50), ["user_id"], ["event_type"], "ts", "pinned")


@query("SELECT user_id, event_id, event_type, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_wins(spark, sf):
    return state.latest(table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts"), ["user_id"], "ts", "event_id")


@query("""
WITH l AS (SELECT user_id, event_type, max(event_id) AS m FROM events GROUP BY 1, 2)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY m DESC, event_type)::INT AS place, event_type FROM l QUALIFY place <= 3""")
def recent_list(spark, sf):
    return state.recent_lists(table(spark, sf, "events"), "user_id", "event_id", "event_type", 3)


@query()
def use_history_fold(spark, sf):
    return state.use_histories(table(spark, sf, "events"), "user_id", "event_id", "event_type", "manual_back", 4)


@query("""
WITH r AS (SELECT *, sum((value >= 30)::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS g FROM events),
s AS (SELECT *, sum((value < 30)::INT) OVER (PARTITION BY user_id, g ORDER BY event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS streak FROM r)
SELECT user_id, arg_max(streak, event_id) AS consecutive_bad_runs, max(streak) >= 2 AS disabled, max(CASE WHEN value < 30 THEN event_id END) AS last_bad_run, count(*) AS runs FROM s GROUP BY 1""")
def run_health(spark, sf):
    return state.run_health(table(spark, sf, "events").withColumn("bad", F.col("value") < 30), "user_id", "event_id", "bad")


@query("""
WITH r AS (SELECT *, sum((value >= 30)::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS g FROM events),
s AS (SELECT user_id, sum((value < 30)::INT) OVER (PARTITION BY user_id, g ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS streak FROM r),
h AS (SELECT user_id, max(streak) >= 5 AS off FROM s GROUP BY 1)
SELECT c.c_custkey AS user_id, NOT coalesce(h.off, false) AS active FROM customer c LEFT JOIN h ON h.user_id = c.c_custkey""")
def active_roster(spark, sf):
    health = state.run_health(table(spark, sf, "events").withColumn("bad", F.col("value") < 30), "user_id", "event_id", "bad", 5)
    roster = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return state.active(roster, health, "user_id").select("user_id", "active")


@query(f"SELECT kind, count(*) AS n FROM {X.CLIPS.sql()} WHERE kind IN ('text', 'image') GROUP BY kind")
def type_filter(spark, sf):
    return X.CLIPS.frame(spark).where(F.col("kind").isin("text", "image")).groupBy("kind").agg(F.count("*").alias("n"))


@query(f"SELECT id, len(list_filter(string_split(mime, ','), lambda m: starts_with(m, 'text/'))) = len(string_split(mime, ',')) AS every, contains(mime, 'text/plain') AS some, len(list_filter(string_split(mime, ','), lambda m: m = 'text/html')) = 1 AS single FROM {X.CLIPS.sql()}")
def mime_filters(spark, sf):
    types = F.split("mime", ",")
    return X.CLIPS.frame(spark).select("id", P.mime_filter(types, F.lit("text/*"), "all").alias("every"), P.mime_filter(types, F.lit("text/plain"), "any").alias("some"), P.mime_filter(types, F.lit("text/html"), "one").alias("single"))


@query(f"WITH c AS (SELECT * FROM {X.CLIPS.sql()}) SELECT id + 100 AS id, kind, text, sensitive FROM c WHERE id > 5 AND NOT EXISTS (SELECT 1 FROM c o WHERE o.id <= 5 AND o.kind = c.kind AND o.text IS NOT DISTINCT FROM c.text AND o.sensitive = c.sensitive)")
def restore_new_items(spark, sf):
    c = X.CLIPS.frame(spark).select("id", "kind", "text", "sensitive")
    return dedup.restored(c.where("id <= 5"), c.where("id > 5").withColumn("id", F.col("id") + 100), "id")


@query(f"SELECT coalesce(n.word, o.word) AS word, coalesce(n.locale, o.locale) AS locale, CASE WHEN n.word IS NOT NULL THEN n.freq ELSE o.freq END AS freq FROM {X.WORDS.sql('o')} FULL OUTER JOIN (VALUES ('hello', 'en', 99), ('held', NULL, 50), ('held', 'en', 1)) n(word, locale, freq) ON o.word = n.word AND o.locale IS NOT DISTINCT FROM n.locale")
def dictionary_upsert(spark, sf):
    news = spark.createDataFrame([("hello", "en", 99), ("held", None, 50), ("held", "en", 1)], "word string, locale string, freq int")
    return dedup.upserted(X.WORDS.frame(spark).select("word", "locale", "freq"), news, ["word", "locale"])


@query(f"SELECT word, freq / 255.0::DOUBLE AS confidence FROM {X.WORDS.sql()} WHERE contains(lower(word), 'hel') UNION ALL SELECT word, freq / 255.0::DOUBLE FROM {X.WORDS.sql()} WHERE shortcut = 'hel'")
def dictionary_suggestions(spark, sf):
    w = X.WORDS.frame(spark)
    pick = lambda df: df.select("word", (F.col("freq") / 255.0).alias("confidence"))
    return pick(w.where(F.col("word").ilike("%hel%"))).union(pick(w.where("shortcut = 'hel'")))


@query(f"SELECT word, freq, locale FROM {X.WORDS.sql()} WHERE locale = 'en' OR locale IS NULL ORDER BY freq DESC, word")
def dictionary_order(spark, sf):
    return X.WORDS.frame(spark).where("locale = 'en' or locale is null").orderBy(F.col("freq").desc(), "word").select("word", "freq", "locale")


@query(f"SELECT q.word, EXISTS (SELECT 1 FROM {X.WORDS.sql()} WHERE t.word = q.word OR t.shortcut = q.word) AS known, coalesce((SELECT max(freq) FROM {X.WORDS.sql()} WHERE t.word = q.word), 0) / 255.0::DOUBLE AS frequency FROM (VALUES ('hello'), ('hlp'), ('nope')) q(word)")
def spell_and_frequency(spark, sf):
    asked = spark.createDataFrame([("hello",), ("hlp",), ("nope",)], "word string")
    w = X.WORDS.frame(spark)
    known = w.select("word").union(w.where("shortcut is not null").select("shortcut")).distinct().withColumn("_k", F.lit(True))
    freq = w.groupBy("word").agg(F.max("freq").alias("f"))
    return asked.join(F.broadcast(known), "word", "left").join(F.broadcast(freq), "word", "left").select("word", F.coalesce("_k", F.lit(False)).alias("known"), (F.coalesce("f", F.lit(0)) / 255.0).alias("frequency"))


@query(f"SELECT DISTINCT coalesce(locale, 'all') AS locale FROM {X.WORDS.sql()} ORDER BY 1")
def dictionary_locales(spark, sf):
    return X.WORDS.frame(spark).select("locale").distinct().select(F.coalesce("locale", F.lit("all")).alias("locale")).orderBy("locale")


@query(f"SELECT ' w=' || word || ';f=' || freq || ';l=' || coalesce(locale, 'null') || CASE WHEN shortcut IS NULL THEN '' ELSE ';s=' || shortcut END AS value FROM {X.WORDS.sql()}")
def dictionary_export(spark, sf):
    return writers.dictionary_lines(X.WORDS.frame(spark))


@query(f"SELECT word, freq, locale, shortcut FROM {X.WORDS.sql()}")
def dictionary_import(spark, sf):
    lines = writers.dictionary_lines(X.WORDS.frame(spark)).withColumn("line", F.monotonically_increasing_id())
    bad = spark.createDataFrame([("dictionary=main:x", 90), (" w=zero;f=0;l=en", 91), (" w=big;f=256;l=en", 92)], "value string, line bigint")
    return readers.dictionary_entries(lines.unionByName(bad)).drop("line")


SCORE = "0.7 * CASE WHEN contains(lower(name), 'smil') THEN 4.0 / length(name) ELSE 0 END + 0.3 * CASE WHEN contains(keywords, 'smil') THEN 1 ELSE 0 END"


@query(f"SELECT value, round({SCORE}, 6)::DOUBLE AS score FROM (SELECT * FROM {X.EMOJI.sql()} ORDER BY {SCORE} DESC, value LIMIT 4) WHERE {SCORE} > 0")
def emoji_suggestions(spark, sf):
    keyword = F.exists(F.split("keywords", r"\|"), lambda k: F.contains(F.lower(k), F.lit("smil"))).cast("int")
    scored = X.EMOJI.frame(spark).withColumn("score", 0.7 * G.contains_weight(F.col("name"), F.lit("smil")) + 0.3 * keyword)
    return scored.orderBy(F.col("score").desc(), "value").limit(4).where("score > 0").select("value", F.round("score", 6).alias("score"))


@query(f"SELECT code, word, count(*) OVER (PARTITION BY code) - row_number() OVER (PARTITION BY code ORDER BY pos) + 1 AS weight FROM {X.CODES.sql()}")
def reverse_weight(spark, sf):
    by = Window.partitionBy("code")
    return X.CODES.frame(spark).select("code", "word", (F.count("*").over(by) - F.row_number().over(by.orderBy("pos")) + 1).cast("bigint").alias("weight"))


@query(f"SELECT code, word, pos FROM {X.CODES.sql()} WHERE starts_with(code, 'ab') ORDER BY code, pos DESC LIMIT 3")
def prefix_lookup(spark, sf):
    return X.CODES.frame(spark).where(F.col("code").startswith("ab")).orderBy("code", F.col("pos").desc()).limit(3)


@query(f"WITH w AS (SELECT id, text, row_number() OVER (PARTITION BY pinned ORDER BY created DESC) AS rn FROM {X.CLIPS.sql()}) SELECT a.code, a.word, b.word AS phrase FROM {X.CODES.sql('a')} LEFT JOIN {X.CODES.sql('b')} ON a.word = b.code")
def phrase_self_join(spark, sf):
    c = X.CODES.frame(spark)
    return c.select("code", "word").join(c.select(F.col("code").alias("word"), F.col("word").alias("phrase")), "word", "left").select("code", "word", "phrase")


KEYBOARD = [(c, float(x), float(y)) for y, row in enumerate(("qwertyuiop", "asdfghjkl", "zxcvbnm")) for x, c in enumerate(row)]


def words_with_paths(spark):
    w = spark.createDataFrame([("hello", 200), ("help", 120), ("jello", 20), ("héllo", 10), ("zoo", 90)], "word string, freq int")
    keys = spark.createDataFrame(KEYBOARD, "letter string, x double, y double")
    return gestures.ideal_paths(w, keys).join(w, "word"), keys


@query()
def gesture_ideal_paths(spark, sf):
    return words_with_paths(spark)[0].select("word", F.round(V.path_length(F.col("points")), 6).alias("length"), F.size("points").alias("n"))


@query()
def gesture_best_words(spark, sf):
    words, keys = words_with_paths(spark)
    drawn = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for c in "hello" for k, x, y in KEYBOARD if k == c])
    near = gestures.pruned(words, ["h", "j", "g"], ["o", "p", "i"], 12.0, 1.0)
    return gestures.best_words(near, drawn, 32, 3, shape_dev=0.3).select("word", F.round(F.log("inverse"), 6).alias("cost"))


@query("SELECT letter, sqrt((x - 4) ** 2 + (y - 1) ** 2) AS distance FROM (VALUES " + ", ".join(f"('{c}', {x}, {y})" for c, x, y in KEYBOARD) + ") k(letter, x, y) ORDER BY distance, letter LIMIT 4")
def closest_keys(spark, sf):
    keys = spark.createDataFrame(KEYBOARD, "letter string, x double, y double")
    return gestures.closest_keys(keys, F.lit(4.0), F.lit(1.0), 4).select("letter", "distance")


@query()
def gesture_thinning(spark, sf):
    points = table(spark, sf, "events").select("user_id", "event_id", (F.col("event_id") % 97).cast("double").alias("x"), F.col("value").alias("y"))
    return gestures.thinned(points, "user_id", "event_id", 40.0)


@query()
def model_manifest(spark, sf):
    text = '{"models": [{"tier": "int4", "file": "a-int4.litertlm", "version": "1", "bytes": 5, "sha256": "x"}, {"tier": "huge", "file": "b", "version": "1", "bytes": 5, "sha256": "y"}]}'
    return readers.manifest_models(spark.createDataFrame([(text,)], "raw string"), "raw")


@query()
def recording_pairs(spark, sf):
    listing = spark.createDataFrame([("a.txt",), ("a.m4a",), ("a.wav",), ("b.txt",), ("c.wav",), ("d.mp3",), ("d.txt",)], "name string")
    return readers.paired_files(listing, ["wav", "m4a", "mp3"])


def raw_lines(spark, text: str):
    return spark.createDataFrame([("f", i + 1, v) for i, v in enumerate(text.split("\n"))], "file string, line int, value string")


@query()
def sectioned_table(spark, sf):
    return readers.table_sections(raw_lines(spark, "; note\n[Description]\nname x y\n[Data]\nab foo\nab\tbar baz\n; skip\n\nba qux"))


@query()
def emoji_table(spark, sf):
    return readers.emoji_table(raw_lines(spark, "# c\n[people]\nA;man;a|b\n\tA1;ignored;z\nB;woman;c\n[food]\nC;cake;sweet"))


@query()
def idiom_list(spark, sf):
    return readers.idiom_list(raw_lines(spark, "# head\n## train idiom ru\nёлк/ель | ёлки-палки | wow | L\nkey | idiom | meaning\n## test equiv en\nleg | break a leg | luck"))
