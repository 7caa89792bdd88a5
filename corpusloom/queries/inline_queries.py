"""Queries on small inline inputs: Cyrillic text, replies, dictionaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom import fixtures as X
from corpusloom.functions import language as G
from corpusloom.functions import lexicons as L
from corpusloom.functions import predicates as P
from corpusloom.functions import text as T
from corpusloom.functions import udfs
from corpusloom.functions import vectors as V
from corpusloom.operators import joins, votes
from corpusloom.plans import checks, mining
from corpusloom.registry import query
from corpusloom.sources import readers

LINES = X.LINES.sql()
LOW = "replace(lower(text), 'ё', 'е')"
W = r"[\p{L}\p{M}\p{N}_]"
CLEAN = rf"""trim(regexp_replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(coalesce(text, '')), '<[^>]+>|\{{[^}}]*\}}', ' ', 'g'),
  '\[[^\]]*\]|\([^)]*\)', ' ', 'g'), '[♪♫#]', ' ', 'g'), '^\s*[-–—]\s*', ''), '...', '…'), '\s+', ' ', 'g'), ' -–—')"""
START, END = r"(^|[^а-яё])", r"($|[^\p{L}\p{M}\p{N}_])"


def stems(pattern: str, russian: bool) -> str:
    """The stems in the other engine's dialect: it has no look-around and ASCII word borders."""
    pattern = pattern.replace(r"фиг(?!ур)", r"фиг($|[^у]|у($|[^р]))").replace(r"piss(?!ed off)", r"piss($|[^e]|e($|[^d])|ed($|[^ ])|ed ($|[^o])|ed o($|[^f])|ed of($|[^f]))")
    pattern = pattern.replace(r"\b", END)
    head = START + f"({L.RU_PREFIXES})?" if russian else r"(^|[^\p{L}\p{M}\p{N}_])"
    return f"(?i){head}({pattern})".replace("'", "''")


def tier_sql(text: str, table: dict, russian: bool) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(coalesce({text}, ''), '{stems(table[k], russian)}') THEN {k}" for k in (3, 2, 1)) + " ELSE 0 END"


def lines(spark):
    return X.LINES.frame(spark)


@query(f"SELECT id, {CLEAN} AS clean FROM {LINES}")
def subtitle_clean(spark, sf):
    return lines(spark).select("id", T.subtitle_clean(udfs.composed_form("text")).alias("clean"))


@query(rf"SELECT id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '♪[^♪]*♪', ' ', 'g'), '\([^)]*\)|\[[^\]]*\]', ' ', 'g'), '^\s*[—–-]\s*', ''), '\s[—–]\s', ' ', 'g'), '\s+', ' ', 'g')) AS clean FROM {LINES}")
def cue_clean(spark, sf):
    return lines(spark).select("id", T.cue_clean(F.col("text")).alias("clean"))


@query(rf"SELECT id, list_filter(list_transform(string_split_regex(trim(regexp_replace(regexp_replace({LOW}, '[^\p{{L}}\p{{M}}\p{{N}}_\s-]', ' ', 'g'), '\s+', ' ', 'g')), ' '), lambda w: trim(w, '-')), lambda w: w <> '') AS words FROM {LINES}")
def speech_words(spark, sf):
    return lines(spark).select("id", T.speech_words(F.col("text")).alias("words"))


@query()
def speech_words_without_fillers(spark, sf):
    return lines(spark).select("id", T.speech_words(F.col("text"), True).alias("words"))


@query(f"SELECT id, trim(translate(coalesce(text, ''), '’‘', '''''')) AS k FROM {LINES}")
def plain_quotes(spark, sf):
    return lines(spark).select("id", T.plain_quotes(F.col("text")).alias("k"))


@query()
def typographic_fold(spark, sf):
    return lines(spark).select("id", T.typographic_fold(udfs.compatible_form("text")).alias("k"))


@query()
def english_words(spark, sf):
    return lines(spark).select("id", T.english_words(F.col("text")).alias("words"))


@query(f"SELECT id, regexp_matches(coalesce(text, ''), '[\\p{{L}}]\\*+[\\p{{L}}]|[\\p{{L}}]\\*{{2,}}|\\*{{2,}}[\\p{{L}}]|[\\p{{L}}]#+[\\p{{L}}]') AS masked FROM {LINES}")
def masking(spark, sf):
    return lines(spark).select("id", P.masked_in_row(F.col("text")).alias("masked"))


@query(f"SELECT id, len(regexp_extract_all(text, '(^|\\n|\\s)[-–—]\\s*\\S')) >= 2 AS several FROM {LINES}")
def multi_speaker(spark, sf):
    return lines(spark).select("id", P.several_speakers(F.col("text")).alias("several"))


def _markers(markers: list[str]) -> str:
    head = "left(lower(trim(coalesce(text, ''))), 200)"
    return "(" + " OR ".join("contains({}, '{}')".format(head, m.replace("'", "''")) for m in markers) + ")"


@query(f"SELECT id, {_markers(L.GENERATOR_REFUSALS)} AS generator, {_markers(L.EVALUATION_REFUSALS)} AS evaluation FROM {LINES}")
def refusal_markers(spark, sf):
    return lines(spark).select("id", P.refuses(F.col("text"), L.GENERATOR_REFUSALS).alias("generator"), P.refuses(F.col("text"), L.EVALUATION_REFUSALS).alias("evaluation"))


@query(f"SELECT id, {tier_sql('text', L.RU_TIERS, True)} AS ru, {tier_sql('text', L.EN_TIERS, False)} AS en FROM {LINES}")
def register_tiers(spark, sf):
    return lines(spark).select("id", G.tier(F.col("text"), F.lit("ru")).alias("ru"), G.tier(F.col("text"), F.lit("en")).alias("en"))


@query(f"SELECT id, regexp_matches(coalesce(text, ''), '{stems(L.RU_CRUDE, True)}') AS ru, regexp_matches(coalesce(text, ''), '{stems(L.EN_CRUDE, False)}') AS en FROM {LINES}")
def crude_words(spark, sf):
    return lines(spark).select("id", G.crude(F.col("text"), F.lit("ru")).alias("ru"), G.crude(F.col("text"), F.lit("en")).alias("en"))


def _emotion(pattern: str) -> str:
    edge = r"(^|[^\p{L}\p{M}\p{N}_])"
    p = pattern.replace(r"тоск(?!ан)\w*", r"тоск($|[^а]|а($|[^н]))").replace(r"\bжалко\b", edge + "жалко" + END).replace(r"\bтошно\b", edge + "тошно" + END).replace(r"\bстыдно\b", edge + "стыдно" + END).replace(r"\bнеловко\b", edge + "неловко" + END)
    return p.replace(r"\b", edge).replace(r"\w*", "")


@query("SELECT id, list_filter([" + ", ".join(f"CASE WHEN regexp_matches({LOW}, '{_emotion(p)}') THEN '{n}' END" for n, p in L.EMOTIONS.items()) + f"], lambda x: x IS NOT NULL) AS emotions FROM {LINES} WHERE text IS NOT NULL")
def emotion_hits(spark, sf):
    return lines(spark).where("text is not null").select("id", G.emotions(F.col("text")).alias("emotions"))


@query(f"""SELECT id, CASE WHEN f AND v THEN 'both' WHEN f THEN 'ty' WHEN v THEN 'vy' END AS address FROM (SELECT id,
  list_has_any(regexp_extract_all(lower(text), '[а-яё]+'), {L.FAMILIAR}) AS f, list_has_any(regexp_extract_all(lower(text), '[а-яё]+'), {L.FORMAL}) AS v FROM {LINES})""")
def address_register(spark, sf):
    return lines(spark).select("id", G.address(F.col("text")).alias("address"))


@query(f"SELECT id, list_filter({[p.replace('ё', 'е') for p in X.IDIOMS]}, lambda p: contains({LOW}, p)) AS idioms FROM {LINES} WHERE text IS NOT NULL")
def idiom_hits(spark, sf):
    return lines(spark).where("text is not null").select("id", G.phrases(F.col("text"), X.IDIOMS).alias("idioms"))


@query(f"SELECT id, CASE WHEN c > 0 AND c >= l THEN 'ru' ELSE 'en' END AS lang FROM (SELECT id, len(regexp_extract_all(coalesce(text, ''), '[\\x{{0400}}-\\x{{04FF}}]')) AS c, len(regexp_extract_all(coalesce(text, ''), '[A-Za-z]')) AS l FROM {LINES})")
def source_lang(spark, sf):
    return lines(spark).select("id", G.source_language(F.coalesce("text", F.lit(""))).alias("lang"))


@query()
def interjection_only(spark, sf):
    return lines(spark).where("text is not null").select("id", P.interjection_only(F.col("text")).alias("empty_talk"), P.usable_seed(F.col("text")).alias("usable"))


@query()
def pair_filters(spark, sf):
    return X.PAIRS.frame(spark).select("id", P.pair_reason(F.col("ru"), F.col("en")).alias("reason"), F.round(P.latin_share(F.col("ru")), 6).alias("latin_share"))


@query()
def mining_pool_counts(spark, sf):
    pairs = X.PAIRS.frame(spark).withColumn("line", F.col("id")).withColumn("film", F.lit("1999/1"))
    again = pairs.withColumn("line", F.col("line") + 100)
    return mining.counts(mining.judged(pairs.unionByName(again)))


@query(f"""SELECT line, list_filter([CASE WHEN source_lang IS NULL THEN 'missing source_lang' END, CASE WHEN source_text IS NULL THEN 'missing source_text' END, CASE WHEN translation IS NULL THEN 'missing translation' END,
  CASE WHEN has_subtext IS NULL THEN 'missing has_subtext' END, CASE WHEN category IS NULL THEN 'missing category' END, CASE WHEN nuance_note IS NULL THEN 'missing nuance_note' END,
  CASE WHEN NOT coalesce(source_lang IN ('ru', 'en'), false) THEN 'source_lang not allowed' END, CASE WHEN NOT coalesce(category IN ('none', 'formality_shift', 'idiom', 'sarcasm', 'emotional_subtext'), false) THEN 'category not allowed' END,
  CASE WHEN NOT has_subtext AND trim(coalesce(nuance_note, '')) <> '' THEN 'note without subtext' END, CASE WHEN has_subtext AND trim(coalesce(nuance_note, '')) = '' THEN 'subtext without note' END], lambda x: x IS NOT NULL) AS problems FROM {X.CANDIDATES.sql()}""")
def schema_problems(spark, sf):
    c = F.col
    return X.CANDIDATES.frame(spark).select("line", P.schema_problems(c("source_lang"), c("source_text"), c("translation"), c("has_subtext"), c("category"), c("nuance_note")).alias("problems"))


@query()
def candidate_checks(spark, sf):
    return checks.candidate_problems(X.CANDIDATES.frame(spark)).select("line", "problems")


@query()
def candidate_carryover(spark, sf):
    return checks.split(checks.candidate_problems(X.CANDIDATES.frame(spark)))[2]


@query(f"""
WITH c AS (SELECT source_text, has_subtext, count(*) AS n, min(line) AS f, count(DISTINCT category) + max(CASE WHEN category IS NULL THEN 1 ELSE 0 END) AS kinds, min(category) AS category FROM {X.CANDIDATES.sql()} GROUP BY 1, 2),
t AS (SELECT source_text, sum(n) OVER (PARTITION BY source_text) AS votes, has_subtext, n, kinds, category FROM c QUALIFY row_number() OVER (PARTITION BY source_text ORDER BY n DESC, f) = 1)
SELECT source_text, votes::BIGINT AS votes, n / votes::DOUBLE AS fraction, n / votes::DOUBLE >= 0.6 AND kinds = 1 AS eligible, CASE WHEN n / votes::DOUBLE >= 0.6 AND kinds = 1 THEN has_subtext END AS has_subtext, CASE WHEN n / votes::DOUBLE >= 0.6 AND kinds = 1 THEN category END AS category FROM t""")
def agreement_vote(spark, sf):
    return votes.agreement(X.CANDIDATES.frame(spark), "source_text", "has_subtext", "category", "line", 0.6)


@query()
def parse_reply(spark, sf):
    return X.REPLIES.frame(spark).select("id", G.parse_reply(F.col("reply")).alias("p")).select("id", F.col("p").isNotNull().alias("valid"), "p.*")


@query()
def reply_status(spark, sf):
    return X.REPLIES.frame(spark).select("id", G.reply_status(F.col("reply"), F.col("finish")).alias("status"))


@query(f"SELECT id, CASE WHEN coalesce(h, '') = '' THEN text ELSE text || chr(10) || '(' || h || ')' END AS turn FROM (SELECT id, text, concat_ws(', ', CASE WHEN id % 3 = 0 THEN 'speaker: male' WHEN id % 3 = 1 THEN 'speaker: female' END, CASE WHEN id % 2 = 0 THEN 'addressee: female' END) AS h FROM {LINES})")
def user_turns(spark, sf):
    g = F.when(F.col("id") % 3 == 0, "male").when(F.col("id") % 3 == 1, "female").otherwise("unknown")
    return lines(spark).select("id", G.user_turn(F.col("text"), g, F.when(F.col("id") % 2 == 0, "female")).alias("turn"))


@query()
def answer_turns(spark, sf):
    c = F.col
    return X.CANDIDATES.frame(spark).select("line", G.answer_json(c("translation"), c("has_subtext"), c("category"), c("nuance_note")).alias("answer"))


@query(f"SELECT line, CASE WHEN model = 'a' THEN 'Context for this sentence: the speaker is a man and the person addressed is a woman.' WHEN model = 'b' THEN 'Context for this sentence: the speaker is a woman.' END AS said FROM {X.CANDIDATES.sql()}")
def gender_sentences(spark, sf):
    m = F.col("model")
    return X.CANDIDATES.frame(spark).select("line", G.gender_sentence(F.when(m == "a", "male").when(m == "b", "female"), F.when(m == "a", "female")).alias("said"))


KEYS = X.Inline("ids string", (("en/1999/12345/6.xml.gz\tru/1999/12345/7.xml.gz",), ("en/x/1/2",), ("bad",), ("en/2001/123456789/1",), ("en/2001/0042/1",), ("en/1990/tt5/1",)))


@query(f"""SELECT ids, k AS film, CASE WHEN regexp_matches(split_part(k, '/', 2), '^\\d+$') THEN 'tt' || CASE WHEN length(ltrim(split_part(k, '/', 2), '0')) < 7 THEN lpad(ltrim(split_part(k, '/', 2), '0'), 7, '0') ELSE ltrim(split_part(k, '/', 2), '0') END END AS code
FROM (SELECT ids, CASE WHEN len(string_split(ids, '/')) >= 3 AND regexp_matches(split_part(ids, '/', 2), '^\\d+$') THEN split_part(ids, '/', 2) || '/' || split_part(split_part(ids, chr(9), 1), '/', 3) END AS k FROM {KEYS.sql()})""")
def film_keys(spark, sf):
    return KEYS.frame(spark).select("ids", T.film_key(F.col("ids")).alias("film")).withColumn("code", T.film_code(F.col("film")))


FILES = X.Inline("name string", (("m-int4.litertlm",), ("m-small.litertlm",), ("other.bin",), ("big__crude_probe__1.jsonl",), ("a__profanity_test.jsonl",), ("b__x.jsonl",)))


@query(f"SELECT name, nullif(regexp_extract(name, '-(small|int4|int8)\\.litertlm$', 1), '') AS tier, CASE WHEN contains(name, 'crude_probe') THEN 'probe' WHEN contains(name, 'profanity_test') THEN 'prof' ELSE 'test' END AS kind, split_part(name, '__', 1) AS model FROM {FILES.sql()}")
def file_facts(spark, sf):
    n = F.col("name")
    return FILES.frame(spark).select("name", T.model_tier(n).alias("tier"), T.result_kind(n).alias("kind"), T.model_of_result(n).alias("model"))


@query()
def speaker_segments(spark, sf):
    rows = X.Inline("raw string", (("12.34 15.6049 speaker_1",), ("1,2,spk 3",), ("5 4 a",), ("x 1 b",), ("1 2",), ("0.5, 0.75, bob",))).frame(spark)
    return rows.select("raw", T.speaker_segment(F.col("raw")).alias("s")).select("raw", "s.*")


RAM = X.Inline("total bigint, need bigint", ((11_200_000_000, 4_000_000_000), (7_400_000_000, 7_000_000_000), (5_600_000_000, 100), (3_000_000_000, 5)))


@query(f"SELECT total, CASE WHEN total >= 10500000000 THEN 'int8' WHEN total >= 7000000000 THEN 'int4' WHEN total >= 5000000000 THEN 'small' END AS tier, total >= need + 500000000 AS fits FROM {RAM.sql()}")
def memory_tiers(spark, sf):
    return RAM.frame(spark).select("total", G.memory_tier(F.col("total")).alias("tier"), P.fits_memory(F.col("total"), F.col("need"), F.lit(500_000_000)).alias("fits"))


@query()
def token_edit_distance(spark, sf):
    a = lines(spark).where("text is not null").select("id", T.speech_words(F.col("text")).alias("w"))
    return a.join(a.toDF("other", "w2"), F.col("other") == F.col("id") + 1).select("id", "other", T.token_distance("w", "w2").alias("errors"), F.size("w").alias("words"))


@query()
def seq_ratio(spark, sf):
    p = X.PAIRS.frame(spark)
    return p.select("id", F.round(udfs.sequence_ratio("ru", "en"), 6).alias("ratio"))


@query()
def chrf_sentence(spark, sf):
    return X.PAIRS.frame(spark).select("id", F.round(udfs.chrf("en", "ru"), 4).alias("score"), udfs.divergence("ru", "en").alias("d")).select("id", "score", "d.span", F.round("d.novelty", 6).alias("novelty"))


@query()
def rekey_to_seeds(spark, sf):
    seeds = spark.createDataFrame([("I’m ready – let’s go",), ("день рождения сегодня вечером",), ("совсем другая строка",)], "source_text string")
    rows = spark.createDataFrame([(1, "I'm ready - let's go"), (2, "ден рождения сегодня вечером"), (3, "совсем другая строка"), (4, "ничего общего"), (5, None)], "id int, source_text string")
    return joins.rekeyed(rows, seeds, "source_text")


@query()
def entity_candidates(spark, sf):
    return X.CLIPS.frame(spark).where("text is not null").select("id", udfs.entity_candidates("text").alias("found"))


@query()
def composer_rules(spark, sf):
    rows = spark.createDataFrame([("vie", "t"), ("a", "a"), ("A", "a"), ("x", "y"), ("", "a")], "before string, typed string")
    return rows.select("before", "typed", G.composed(F.col("before"), F.col("typed"), {"aa": "â", "a": "ă", "iet": "iêt"}).alias("c")).select("before", "typed", "c.*")


@query()
def subtitle_cues(spark, sf):
    raw = "1\n00:00:01,000 --> 00:00:02,500\n- Привет!\n<i>Как</i> дела?\n\n2\n00:01:00.5 --> 00:01:02,25\n[music]\n\nno time\nhere\n\n3\n01:00:00,000 --> 01:00:01,000\nEnd"
    return readers.cue_rows(spark.createDataFrame([("a", raw)], "film string, raw string"), "film", "raw")


@query()
def aligned_cues_numbered(spark, sf):
    raw = "1\n00:00:01,000 --> 00:00:02,500\nHello — there\n\n2\n00:00:03,000 --> 00:00:04,000\n12:30\n\n3\n00:00:05,000 --> 00:00:06,000\nBye"
    return readers.numbered_cues(spark.createDataFrame([("a", raw)], "film string, raw string"), "film", "raw")


@query()
def level_in_db(spark, sf):
    rows = spark.createDataFrame([(1, [0.5, -0.5]), (2, [0.0, 0.0, 0.0]), (3, [1.0])], "id int, x array<double>")
    return rows.select("id", F.round(V.level_db(F.col("x")), 6).alias("db"))


@query()
def training_labels(spark, sf):
    rows = spark.createDataFrame([(1, [5, 6, 7, 8], [5, 6, 9]), (2, [1], [1]), (3, list(range(20)), [0])], "id int, ids array<int>, head array<int>")
    rows = rows.withColumn("shared", V.shared_prefix(F.col("ids"), F.col("head")))
    return rows.select("id", "shared", V.prefix_labels(F.col("ids"), F.col("shared"), 10).alias("labels"), V.padded(F.col("head"), F.lit(4), 0).alias("padded"))


@query()
def spec_maps(spark, sf):
    return spark.createDataFrame([("a=2,b=3",), ("c = 1 , d=4,",)], "spec string").select("spec", F.explode(T.spec_map(F.col("spec"), ",", "=")).alias("key", "value"))
