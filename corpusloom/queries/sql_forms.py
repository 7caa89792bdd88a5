"""SQL forms of queries whose SQL needs helpers of its own: the same results, written for the other engine.

That engine has no look-around, ASCII word borders, and a distance of strings that counts bytes; hence the detours.
"""

# ruff: noqa: E731

from __future__ import annotations

from corpusloom import fixtures as X
from corpusloom.functions import lexicons as L
from corpusloom.functions import text as T
from corpusloom.queries import inline_queries as I
from corpusloom.queries import row_queries as R

LINES, LOW = X.LINES.sql(), I.LOW
FORMS: dict[str, str] = {}
def lst(xs): return "["+", ".join("'"+x.replace("'","''")+"'" for x in xs)+"]"
WORDS_SQL = rf"list_filter(list_transform(string_split_regex(trim(regexp_replace(regexp_replace({LOW}, '[^\p{{L}}\p{{M}}\p{{N}}_\s-]', ' ', 'g'), '\s+', ' ', 'g')), ' '), lambda w: trim(w, '-')), lambda w: w <> '')"
FORMS["speech_words_without_fillers"] = f"SELECT id, list_filter({WORDS_SQL}, lambda w: NOT list_contains({lst(T.FILLERS)}, w)) AS words FROM {LINES}"
FORMS["typographic_fold"] = rf"SELECT id, trim(regexp_replace(replace(translate(nfc_normalize(coalesce(text, '')), '’‘“”«»–—‑‐', '''''\"\"\"\"----'), '…', '...'), '\s+', ' ', 'g')) AS k FROM {LINES}".replace('\\"','"')
spelled = "CASE w "+" ".join(f"WHEN '{k.replace(chr(39),chr(39)*2)}' THEN '{v}'" for k,v in T.CONTRACTIONS.items())+" ELSE w END"
ENG = rf"list_filter(flatten(list_transform(list_filter(string_split(trim(regexp_replace(regexp_replace(translate(lower({{}}), '’-', ''' '), '[^\p{{{{L}}}}\p{{{{M}}}}\p{{{{N}}}}_\s'']', ' ', 'g'), '\s+', ' ', 'g')), ' '), lambda w: w <> ''), lambda w: string_split(trim({spelled}, ''''), ' '))), lambda w: w <> '')"
FORMS["english_words"] = f"SELECT id, {ENG.format('text')} AS words FROM {LINES}"
def interj(c):
    low=f"replace(lower({c}), 'ё', 'е')"
    tok=rf"list_filter(string_split_regex({low}, '[^\p{{L}}\p{{M}}\p{{N}}]+'), lambda t: t <> '' AND NOT regexp_full_match(t, '\d+'))"
    return f"(len(list_filter({tok}, lambda t: length(t) > 1 AND NOT list_contains({lst(L.INTERJECTIONS)}, t))) = 0 OR len(list_distinct({tok})) < 2)"
WC = r"len(regexp_extract_all({}, '[\p{{L}}\p{{M}}\p{{N}}_'']+'))"
LINE = "trim(coalesce(text, ''))"
FORMS["interjection_only"] = f"SELECT id, {interj('text')} AS empty_talk, {WC.format(LINE)} BETWEEN 4 AND 20 AND regexp_matches({LINE}, '[А-Яа-яЁё]') AND NOT regexp_matches({LINE}, '[A-Za-z]') AND NOT {interj(LINE)} AS usable FROM {LINES} WHERE text IS NOT NULL"
def tokens(c): return rf"array_to_string(regexp_extract_all(replace(lower({c}), 'ё', 'е'), '[\p{{L}}\p{{M}}\p{{N}}_'']+'), ' ')"
LAT = lambda c: f"len(regexp_extract_all({c}, '[A-Za-z]'))"
CYR = lambda c: f"len(regexp_extract_all({c}, '[А-Яа-яЁё]'))"
SHARE = lambda c: f"{LAT(c)} / greatest(1, {LAT(c)} + {CYR(c)})::DOUBLE"
def reason(ru,en):
    a,b=WC.format(ru),WC.format(en)
    credits="(?i)"+L.CREDITS.replace("'","''")
    return rf"""CASE WHEN coalesce({ru}, '') = '' OR coalesce({en}, '') = '' THEN 'empty'
  WHEN NOT regexp_matches({ru}, '[А-Яа-яЁё]') OR {SHARE(ru)} > 0.3 THEN 'ru_script' WHEN regexp_matches({en}, '[А-Яа-яЁё]') OR NOT regexp_matches({en}, '[A-Za-z]') THEN 'en_script'
  WHEN regexp_matches({ru}, '{credits}') OR regexp_matches({en}, '{credits}') THEN 'credits' WHEN {a} NOT BETWEEN 3 AND 25 OR {b} NOT BETWEEN 3 AND 25 THEN 'length'
  WHEN regexp_matches(regexp_replace({ru}, '[А-Яа-яЁёA-Za-z]', '', 'g'), '[\p{{L}}\p{{M}}]') OR regexp_matches(regexp_replace({en}, '[A-Za-zÀ-ÖØ-öø-ÿ]', '', 'g'), '[\p{{L}}\p{{M}}]') THEN 'mojibake'
  WHEN {interj(ru)} OR {interj(en)} THEN 'interjection' WHEN greatest({a}, {b}) / greatest(1, least({a}, {b}))::DOUBLE > 2.5 THEN 'len_ratio' WHEN {tokens(ru)} = {tokens(en)} THEN 'identical' END"""
FORMS["pair_filters"] = f"SELECT id, {reason('ru','en')} AS reason, round({SHARE('ru')}, 6) AS latin_share FROM {X.PAIRS.sql()}"
clean = lambda c: I.CLEAN.replace("text",c)
several = lambda c: rf"coalesce(len(regexp_extract_all({c}, '(^|\n|\s)[-–—]\s*\S')) >= 2, false)"
FORMS["mining_pool_counts"] = f"""WITH p AS (SELECT id AS line, * FROM {X.PAIRS.sql()} UNION ALL SELECT id + 100, * FROM {X.PAIRS.sql()}),
c AS (SELECT line, {several('ru')} OR {several('en')} AS several, {clean('ru')} AS ru, {clean('en')} AS en FROM p),
r AS (SELECT line, ru, CASE WHEN several THEN 'multi_speaker' ELSE {reason('ru','en')} END AS reason FROM c),
d AS (SELECT coalesce(reason, CASE WHEN row_number() OVER (PARTITION BY {tokens('ru')}, reason IS NULL ORDER BY line) > 1 THEN 'duplicate' END) AS reason FROM r)
SELECT coalesce('reject_' || reason, 'passed_filters') AS stat, count(*) AS n FROM d GROUP BY 1"""
MASK = r"[\p{L}]\*+[\p{L}]|[\p{L}]\*{2,}|\*{2,}[\p{L}]|[\p{L}]#+[\p{L}]"
SP = lambda c: rf"len(list_filter(string_split_regex(trim(coalesce({c}, '')), '\s+'), lambda x: x <> ''))"
PROB = """list_filter([CASE WHEN source_lang IS NULL THEN 'missing source_lang' END, CASE WHEN source_text IS NULL THEN 'missing source_text' END, CASE WHEN translation IS NULL THEN 'missing translation' END,
  CASE WHEN has_subtext IS NULL THEN 'missing has_subtext' END, CASE WHEN category IS NULL THEN 'missing category' END, CASE WHEN nuance_note IS NULL THEN 'missing nuance_note' END,
  CASE WHEN NOT coalesce(source_lang IN ('ru', 'en'), false) THEN 'source_lang not allowed' END, CASE WHEN NOT coalesce(category IN ('none', 'formality_shift', 'idiom', 'sarcasm', 'emotional_subtext'), false) THEN 'category not allowed' END,
  CASE WHEN NOT has_subtext AND trim(coalesce(nuance_note, '')) <> '' THEN 'note without subtext' END, CASE WHEN has_subtext AND trim(coalesce(nuance_note, '')) = '' THEN 'subtext without note' END], lambda x: x IS NOT NULL)"""
CY = r"regexp_matches(source_text, '[\x{0400}-\x{04FF}]')"
FINE = rf"""list_filter([CASE WHEN source_lang = 'ru' AND NOT {CY} OR source_lang = 'en' AND {CY} THEN 'language' END, CASE WHEN {SP('nuance_note')} > 25 THEN 'long note' END,
  CASE WHEN lower(trim(coalesce(source_text, ''))) <> '' AND lower(trim(coalesce(source_text, ''))) = lower(trim(coalesce(translation, ''))) THEN 'echo' END, CASE WHEN trim(coalesce(translation, '')) = '' THEN 'no translation' END,
  CASE WHEN regexp_matches(coalesce(translation, ''), '{MASK}') THEN 'masked' END], lambda x: x IS NOT NULL)"""
CHECKS = f"(SELECT *, list_concat(CASE WHEN len(p) > 0 THEN p ELSE f END, CASE WHEN row_number() OVER (PARTITION BY source_text, model ORDER BY line) > 1 THEN ['repeat'] ELSE [] END) AS problems FROM (SELECT *, {PROB} AS p, {FINE} AS f FROM {X.CANDIDATES.sql()}))"
FORMS["candidate_checks"] = f"SELECT line, problems FROM {CHECKS}"
FORMS["candidate_carryover"] = f"SELECT DISTINCT source_text FROM {CHECKS} WHERE len(problems) > 0 AND source_text <> '' ORDER BY source_text"
# replies
BARE = "trim(regexp_replace(regexp_replace(trim(regexp_replace(coalesce(reply, ''), '(?s)<think>.*?</think>', '', 'g')), '(?s)^(?:```json|```)', ''), '```$', ''))"
BODY = f"nullif(regexp_extract({BARE}, '(?s)\\{{.*\\}}'), '')"
PARSE = f"""(SELECT id, reply, finish, CASE WHEN json_type(j, '$.translation') = 'VARCHAR' THEN true ELSE false END AS valid, json_extract_string(j, '$.translation') AS t,
  CASE WHEN json_extract_string(j, '$.category') IN {tuple(L.CATEGORIES)} THEN json_extract_string(j, '$.category') ELSE 'none' END AS given,
  CASE json_type(j, '$.has_subtext') WHEN 'VARCHAR' THEN lower(trim(json_extract_string(j, '$.has_subtext'))) = 'true' WHEN 'BOOLEAN' THEN json_extract_string(j, '$.has_subtext') = 'true' WHEN 'UBIGINT' THEN json_extract_string(j, '$.has_subtext') <> '0' ELSE false END AS truth,
  CASE WHEN json_type(j, '$.nuance_note') IN ('NULL', 'BOOLEAN') THEN '' ELSE coalesce(json_extract_string(j, '$.nuance_note'), '') END AS note
FROM (SELECT *, CASE WHEN json_valid({BODY}) THEN {BODY}::JSON END AS j FROM {X.REPLIES.sql()}))"""
FORMS["parse_reply"] = f"SELECT id, valid, CASE WHEN valid THEN t END AS translation, CASE WHEN valid THEN truth AND given <> 'none' END AS has_subtext, CASE WHEN valid THEN CASE WHEN truth THEN given ELSE 'none' END END AS category, CASE WHEN valid THEN note END AS nuance_note FROM {PARSE}"
heads = lambda m: "(" + " OR ".join(f"contains(left(lower(trim(b)), 200), '{x.replace(chr(39), chr(39)*2)}')" for x in m) + ")"
FORMS["reply_status"] = f"""SELECT id, CASE WHEN b = '' THEN 'empty' WHEN o > 0 AND (c < o OR coalesce(finish, '') = 'length') THEN 'truncated' WHEN o = 0 AND {heads(L.GENERATOR_REFUSALS)} THEN 'refused' WHEN o = 0 OR c < o THEN 'no_json' ELSE 'ok' END AS status
FROM (SELECT *, strpos(b, '{{') AS o, CASE WHEN contains(b, '}}') THEN length(b) - strpos(reverse(b), '}}') + 1 ELSE 0 END AS c FROM (SELECT *, {BARE} AS b FROM {X.REPLIES.sql()}))"""
FORMS["answer_turns"] = f"""SELECT line, '{{"translation": ' || to_json(translation)::VARCHAR || ', "has_subtext": ' || coalesce(has_subtext, false)::VARCHAR || ', "category": ' || to_json(CASE WHEN has_subtext THEN category ELSE 'none' END)::VARCHAR || ', "nuance_note": ' || to_json(CASE WHEN has_subtext THEN coalesce(nuance_note, '') ELSE '' END)::VARCHAR || '}}' AS answer FROM {X.CANDIDATES.sql()}"""
SEG = X.Inline("raw string", (("12.34 15.6049 speaker_1",), ("1,2,spk 3",), ("5 4 a",), ("x 1 b",), ("1 2",), ("0.5, 0.75, bob",)))
FORMS["speaker_segments"] = rf"""SELECT raw, CASE WHEN ok THEN round(a, 3) END AS start, CASE WHEN ok THEN round(b, 3) END AS "end", CASE WHEN ok THEN coalesce(nullif(regexp_extract(p[3], '([0-9]+)[^0-9]*$', 1), ''), p[3]) END AS speaker
FROM (SELECT *, coalesce(len(p) >= 3 AND b > a, false) AS ok FROM (SELECT *, try_cast(p[1] AS DOUBLE) AS a, try_cast(p[2] AS DOUBLE) AS b FROM (SELECT raw, string_split_regex(trim(raw), '[,\s]+') AS p FROM {SEG.sql()})))"""
def dist(a,b): # word lists as strings of one byte for each distinct word
    return f"levenshtein(array_to_string(list_transform({a}, lambda w: chr((32 + list_position(list_distinct(list_concat({a}, {b})), w))::INT)), ''), array_to_string(list_transform({b}, lambda w: chr((32 + list_position(list_distinct(list_concat({a}, {b})), w))::INT)), ''))"
FORMS["token_edit_distance"] = f"WITH w AS (SELECT id, {WORDS_SQL} AS w FROM {LINES} WHERE text IS NOT NULL) SELECT a.id, b.id AS other, {dist('a.w','b.w')}::INT AS errors, len(a.w)::INT AS words FROM w a JOIN w b ON b.id = a.id + 1"
FORMS["composer_rules"] = """SELECT before, typed, CASE WHEN ends_with(t, 'iet') THEN 2 WHEN ends_with(t, 'aa') THEN 1 ELSE 0 END AS "delete",
  CASE WHEN ends_with(t, 'iet') THEN CASE WHEN upper(right(before || typed, 3)[1]) = right(before || typed, 3)[1] THEN 'IÊT' ELSE 'iêt' END WHEN ends_with(t, 'aa') THEN CASE WHEN upper(right(before || typed, 2)[1]) = right(before || typed, 2)[1] THEN 'Â' ELSE 'â' END
  WHEN ends_with(t, 'a') THEN CASE WHEN upper(right(before || typed, 1)) = right(before || typed, 1) THEN 'Ă' ELSE 'ă' END ELSE typed END AS "insert"
FROM (SELECT *, lower(before || typed) AS t FROM (VALUES ('vie', 't'), ('a', 'a'), ('A', 'a'), ('x', 'y'), ('', 'a')) v(before, typed))"""
FORMS["level_in_db"] = "SELECT id, round(10 * log10(list_avg(list_transform(x, lambda v: v * v)) + 1e-10), 6) AS db FROM (VALUES (1, [0.5::DOUBLE, -0.5]), (2, [0.0, 0.0, 0.0]), (3, [1.0])) v(id, x)"
FORMS["training_labels"] = """SELECT id, shared::INT AS shared, CASE WHEN len(ids) <= 10 THEN list_transform(ids, lambda v, i: CASE WHEN i <= shared THEN -100 ELSE v END) END AS labels, list_resize(head, 4, 0) AS padded
FROM (SELECT *, coalesce(list_position(list_transform(range(1, least(len(ids), len(head)) + 1), lambda i: ids[i] = head[i]), false) - 1, least(len(ids), len(head))) AS shared FROM (VALUES (1, [5, 6, 7, 8], [5, 6, 9]), (2, [1], [1]), (3, range(20)::INT[], [0])) v(id, ids, head))"""
FORMS["spec_maps"] = "SELECT spec, trim(split_part(p, '=', 1)) AS key, trim(split_part(p, '=', 2))::INT AS value FROM (SELECT spec, unnest(string_split(spec, ',')) AS p FROM (VALUES ('a=2,b=3'), ('c = 1 , d=4,')) v(spec)) WHERE trim(p) <> ''"
FORMS["chunk_spans"] = """SELECT total, (i * 300.0)::DOUBLE AS start, (CASE WHEN i < c - 1 THEN 300.0 ELSE total - i * 300.0 END)::DOUBLE AS length FROM
(SELECT total, c, unnest(CASE WHEN c > 0 THEN range(c) ELSE [NULL] END) AS i FROM (SELECT total::DOUBLE AS total, (CASE WHEN total <= 0 THEN 0 WHEN n > 0 AND tail < 60 THEN n ELSE n + (tail > 0)::INT END)::BIGINT AS c FROM (SELECT total, floor(total / 300) AS n, total - floor(total / 300) * 300 AS tail FROM (VALUES (0.0), (50.0), (600.0), (630.0), (700.0), (1200.5)) v(total))))"""
FORMS["frame_segments"] = """WITH f AS (SELECT speaker, i FROM range(100) r(i), (VALUES ('s0'), ('s1')) s(speaker) WHERE (speaker = 's0' AND i BETWEEN 10 AND 44 AND i <> 20) OR (speaker = 's1' AND (i BETWEEN 35 AND 69 OR i = 90))),
g AS (SELECT *, sum(CASE WHEN i - p <= 2 THEN 0 ELSE 1 END) OVER (PARTITION BY speaker ORDER BY i) AS run FROM (SELECT *, lag(i) OVER (PARTITION BY speaker ORDER BY i) AS p FROM f))
SELECT speaker, round(60 + min(i) * 0.1, 3)::DOUBLE AS start, round(60 + (max(i) + 1) * 0.1, 3)::DOUBLE AS "end" FROM g GROUP BY speaker, run HAVING max(i) + 1 - min(i) >= 2.5"""
FORMS["bounded_segments"] = f"""WITH RECURSIVE c AS (SELECT film, s, e, text, row_number() OVER (PARTITION BY film ORDER BY s, e) AS n FROM {X.CUES.sql()}),
r AS (SELECT film, n, 1 AS seg, s AS "start", e AS "end", text FROM c WHERE n = 1
  UNION ALL SELECT c.film, c.n, CASE WHEN j THEN seg ELSE seg + 1 END, CASE WHEN j THEN "start" ELSE c.s END, c.e, CASE WHEN j THEN r.text || ' ' || c.text ELSE c.text END FROM (SELECT r.*, c.s - r."end" <= 0.6 AND c.e - r."start" <= 15 AS j FROM r JOIN c ON c.film = r.film AND c.n = r.n + 1) r JOIN c ON c.film = r.film AND c.n = r.n + 1)
SELECT film, "start", "end", text FROM r WHERE "end" - "start" >= 1 QUALIFY row_number() OVER (PARTITION BY film, seg ORDER BY n DESC) = 1"""
FORMS["alignment_group_texts"] = f"""WITH c AS (SELECT film, text, row_number() OVER (PARTITION BY film ORDER BY s) AS n FROM {X.CUES.sql()})
SELECT DISTINCT string_agg(b.text, ' ' ORDER BY b.n) AS text FROM c a JOIN (VALUES (1), (2), (3)) k(k) ON true JOIN c b ON b.film = a.film AND b.n BETWEEN a.n AND a.n + k.k - 1 GROUP BY a.film, a.n, k.k HAVING count(*) = k.k"""
CHAT = "(?:"+L.CHATTER+")"
EVMASK = r"(^|[^\p{L}\p{M}\p{N}_])[\p{L}\p{M}\p{N}_]+\*{2,}|\*{2,}[\p{L}\p{M}\p{N}_]|(^|[^\p{L}\p{M}\p{N}_])[\p{L}\p{M}\p{N}_]\*+"
LANG = "CASE WHEN regexp_matches(text, '[А-я]') THEN 'ru' ELSE 'en' END"
TIER = f"CASE WHEN {LANG} = 'ru' THEN {I.tier_sql('text', L.RU_TIERS, True)} ELSE {I.tier_sql('text', L.EN_TIERS, False)} END"
FORMS["register_accept"] = rf"""SELECT id, CASE WHEN regexp_matches(text, '{CHAT}') THEN 'chatter' WHEN {SP('text')} < 4 OR {SP('text')} > 18 THEN 'length' WHEN regexp_matches(text, '{EVMASK}') THEN 'masked'
  WHEN ({LANG} = 'ru') <> regexp_matches(text, '(?i)[а-яё]') THEN 'language' WHEN {TIER} <> 1 THEN 'tier' END AS reason FROM {LINES} WHERE text IS NOT NULL"""
FORMS["idiom_accept"] = rf"""SELECT id, CASE WHEN regexp_matches(text, '{CHAT}') THEN 'chatter' WHEN {SP('text')} < 4 OR {SP('text')} > 20 THEN 'length' WHEN NOT regexp_matches(text, '(?i)[а-яё]') THEN 'language'
  WHEN NOT regexp_matches({LOW}, 'горох|скребут') THEN 'no idiom' WHEN contains(lower(text), 'ныне там') THEN 'benchmark idiom' END AS reason FROM {LINES} WHERE text IS NOT NULL"""
V = "(VALUES ('a', 'well um it''s good', 'well its good um'), ('b', 'say cheese namaste', 'say cheese')) v(clip, ref, hyp)"
FORMS["own_voice_totals"] = f"""WITH w AS (SELECT {ENG.format('ref')} AS r, {ENG.format('hyp')} AS h FROM {V}), n AS (SELECT *, list_filter(r, lambda x: x NOT IN ('um', 'uh')) AS rn, list_filter(h, lambda x: x NOT IN ('um', 'uh')) AS hn FROM w),
e AS (SELECT *, list_filter(rn, lambda x: x <> 'namaste') AS re, list_filter(hn, lambda x: x <> 'namaste') AS he FROM n)
SELECT sum(len(r))::BIGINT AS words_raw, sum({dist('r','h')})::BIGINT AS errors_raw, sum(len(rn))::BIGINT AS words_nf, sum({dist('rn','hn')})::BIGINT AS errors_nf, sum(len(re))::BIGINT AS words_en, sum({dist('re','he')})::BIGINT AS errors_en FROM e"""
FORMS["probe_rows"] = """SELECT source_text, coalesce(json_extract_string(v, '$.reply'), '') AS reply FROM (SELECT v, coalesce(json_extract_string(v, '$.row.source_text'), json_extract_string(v, '$.source_text')) AS source_text FROM (VALUES ('{"row": {"source_text": "a"}, "reply": null}'), ('{"source_text": "b"}'), ('{"source_text": " "}')) t(v)) WHERE trim(source_text) <> ''"""
FORMS["listed_lines"] = r"""SELECT l AS line FROM (SELECT unnest(list_transform(string_split('1. "First"' || chr(10) || '- second' || chr(10) || chr(10) || '3) third', chr(10)), lambda x: regexp_replace(trim(trim(x), '"'), '^[0-9.\- ]+', ''))) AS l) WHERE l <> ''"""
FORMS["lexicon_hits"] = f"SELECT id, ru, 'meaning of ' || ru AS note FROM {LINES}, (SELECT unnest({lst(X.IDIOMS)}) AS ru) WHERE contains(lower(text), lower(ru))"
SUB = "(VALUES ('f', 1, '[a]'), ('f', 2, 'x'), ('f', 3, '[b]'), ('f', 4, 'y'), ('g', 1, 'z')) v(file, line, value)"
FORMS["subtitle_sections"] = rf"SELECT file, line, value, section FROM (SELECT *, last_value(h IGNORE NULLS) OVER (PARTITION BY file ORDER BY line) AS section FROM (SELECT *, nullif(regexp_extract(value, '^\[(.*)\]$', 1), '') AS h FROM {SUB})) WHERE h IS NULL"
FORMS["register_report"] = f"""WITH t AS (SELECT text, CASE WHEN id % 2 = 0 THEN 'en' ELSE 'ru' END AS source_lang, greatest(1, {I.tier_sql('text', L.RU_TIERS, True)}) AS s, {I.tier_sql('text', L.EN_TIERS, False)} AS t FROM {LINES} WHERE text IS NOT NULL)
SELECT source_lang, count(*) AS candidates, count(*) FILTER (abs(t - s) <= 1) AS kept, count(*) FILTER (t = s) AS same, count(*) FILTER (t < s) AS softened, count(*) FILTER (t > s) AS harsher, count(DISTINCT text) AS sentences, count(DISTINCT CASE WHEN abs(t - s) <= 1 THEN text END) AS sentences_kept FROM t GROUP BY 1"""
ANSWER = "CASE WHEN valid THEN t ELSE '' END"
HEADS = lambda m: heads(m).replace("trim(b)", "trim(coalesce(reply, ''))")
FORMS["crude_report"] = f"""WITH r AS (SELECT *, 'damn it' AS reference, {ANSWER} AS a FROM {PARSE}),
m AS (SELECT {HEADS(L.EVALUATION_REFUSALS)} AS refused, valid, regexp_matches(a, '{EVMASK}') AS masked, regexp_matches(reference, '{I.stems(L.EN_CRUDE, False)}') AS rc, regexp_matches(a, '{I.stems(L.EN_CRUDE, False)}') AS kc, {I.tier_sql('reference', L.EN_TIERS, False)} AS ref, {I.tier_sql('a', L.EN_TIERS, False)} AS got FROM r)
SELECT count(*) AS n, round_even(avg(refused::INT), 4) AS refusal_rate, round_even(avg(valid::INT), 4) AS json_valid_rate, round_even(avg((abs(got - ref) <= 1)::INT) FILTER (ref > 0), 4) AS kept_rate, round_even(avg((got = ref)::INT) FILTER (ref > 0), 4) AS same_tier_rate, round_even(avg(kc::INT) FILTER (rc), 4) AS present_rate, round_even(avg(masked::INT), 4) AS masked_rate, """ + ", ".join(f"round_even(avg((abs(got - ref) <= 1)::INT) FILTER (ref = {t}), 4) AS kept_{n}, round_even(avg((got = ref)::INT) FILTER (ref = {t}), 4) AS same_{n}, count(*) FILTER (ref = {t}) AS n_{n}" for t,n in L.TIER_NAMES.items()) + " FROM m"
FORMS["evaluation_detection"] = f"""SELECT tp, fp, fn, tn, round_even(tp / nullif(tp + fp, 0)::DOUBLE, 4) AS precision, round_even(tp / nullif(tp + fn, 0)::DOUBLE, 4) AS recall, round_even(fp / nullif(fp + tn, 0)::DOUBLE, 4) AS false_positive_rate FROM (SELECT count(*) FILTER (g AND p) AS tp, count(*) FILTER (NOT g AND p) AS fp, count(*) FILTER (g AND NOT p) AS fn, count(*) FILTER (NOT g AND NOT p) AS tn FROM (SELECT id % 2 = 0 AS g, valid AND truth AND given <> 'none' AS p FROM {PARSE}))"""
FORMS["model_manifest"] = "SELECT 'int4' AS tier, 'a-int4.litertlm' AS file, '1' AS version, 5::BIGINT AS bytes, 'x' AS sha256"
NAMES = "(VALUES ('a.txt'), ('a.m4a'), ('a.wav'), ('b.txt'), ('c.wav'), ('d.mp3'), ('d.txt')) v(name)"
FORMS["recording_pairs"] = f"WITH f AS (SELECT name, split_part(name, '.', 1) AS stem, split_part(name, '.', 2) AS ext FROM {NAMES}) SELECT arg_min(a.name, list_position(['wav', 'm4a', 'mp3'], a.ext)) AS recording, t.name AS transcript FROM f t JOIN f a ON a.stem = t.stem AND a.ext IN ('wav', 'm4a', 'mp3') WHERE t.ext = 'txt' GROUP BY t.name"
def lines_sql(text): return "(SELECT 'f' AS file, unnest(range(1, len(l) + 1)) AS line, unnest(l) AS value FROM (SELECT string_split('" + text.replace("'", "''").replace("\n", "' || chr(10) || '").replace("\t","' || chr(9) || '") + "', chr(10)) AS l))"
FILL = "SELECT *, last_value(h IGNORE NULLS) OVER (PARTITION BY file ORDER BY line) AS section FROM ({})"
st = lines_sql("; note\n[Description]\nname x y\n[Data]\nab foo\nab\tbar baz\n; skip\n\nba qux")
FORMS["sectioned_table"] = rf"""SELECT file, line::INT AS line, section, regexp_extract(value, '^(\S+)[ \t]+(.*)$', 1) AS key, regexp_extract(value, '^(\S+)[ \t]+(.*)$', 2) AS value FROM ({FILL.format(rf"SELECT *, nullif(regexp_extract(value, '^\s*\[([^\]]+)\]\s*$', 1), '') AS h FROM {st} WHERE NOT regexp_matches(value, '^\s*;') AND trim(value) <> ''")}) WHERE h IS NULL"""
et = lines_sql("# c\n[people]\nA;man;a|b\n\tA1;ignored;z\nB;woman;c\n[food]\nC;cake;sweet")
FORMS["emoji_table"] = rf"""WITH r AS (SELECT file, line::INT AS line, section AS category, starts_with(value, chr(9)) AS varies, trim(split_part(value, ';', 1), ' ' || chr(9)) AS value, trim(split_part(value, ';', 2)) AS name, list_filter(string_split(split_part(value, ';', 3), '|'), lambda k: k <> '') AS keywords FROM ({FILL.format(rf"SELECT *, nullif(regexp_extract(value, '^\[([^\]]+)\]', 1), '') AS h FROM {et} WHERE NOT starts_with(value, '#') AND trim(value) <> ''")}) WHERE h IS NULL),
b AS (SELECT *, last_value(CASE WHEN NOT varies THEN {{'v': value, 'n': name, 'k': keywords}} END IGNORE NULLS) OVER (PARTITION BY file, category ORDER BY line) AS base_row FROM r)
SELECT file, line, category, value, CASE WHEN varies THEN base_row.n ELSE name END AS name, CASE WHEN varies THEN base_row.k ELSE keywords END AS keywords, CASE WHEN varies THEN base_row.v END AS base FROM b"""
it = lines_sql("# head\n## train idiom ru\nёлк/ель | ёлки-палки | wow | L\nkey | idiom | meaning\n## test equiv en\nleg | break a leg | luck")
FORMS["idiom_list"] = rf"""SELECT line::INT AS line, split_part(section, ' ', 1) AS split, split_part(section, ' ', 2) AS kind, split_part(section, ' ', 3) AS lang, translate(trim(p[1]), 'ё/', 'е|') AS key, trim(p[2]) AS idiom, trim(p[3]) AS meaning, coalesce(trim(p[4]) = 'L', false) AS literal FROM (SELECT *, string_split(value, ' | ') AS p FROM ({FILL.format(rf"SELECT *, nullif(regexp_extract(value, '^## (.*)$', 1), '') AS h FROM {it} WHERE trim(value) <> ''")}) WHERE h IS NULL AND NOT starts_with(value, '#')) WHERE len(p) IN (3, 4)"""
FORMS["use_history_fold"] = """WITH RECURSIVE u AS (SELECT user_id, event_type AS x, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
r AS (SELECT user_id, n, [x] AS recent FROM u WHERE n = 1 UNION ALL SELECT u.user_id, u.n, CASE WHEN list_contains(r.recent, u.x) THEN r.recent ELSE list_append(r.recent, u.x)[-4:] END FROM r JOIN u ON u.user_id = r.user_id AND u.n = r.n + 1)
SELECT user_id, recent FROM r QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC) = 1"""
FORMS["gesture_thinning"] = """WITH RECURSIVE p AS (SELECT user_id, event_id, (event_id % 97)::DOUBLE AS x, value AS y, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
r AS (SELECT user_id, event_id, n, x, y, x AS lx, y AS ly, true AS kept FROM p WHERE n = 1
  UNION ALL SELECT p.user_id, p.event_id, p.n, p.x, p.y, CASE WHEN k THEN p.x ELSE lx END, CASE WHEN k THEN p.y ELSE ly END, k FROM (SELECT p.*, r.lx, r.ly, (p.x - r.lx) ** 2 + (p.y - r.ly) ** 2 >= 1600 AS k FROM r JOIN p ON p.user_id = r.user_id AND p.n = r.n + 1) p)
SELECT user_id, event_id, x, y FROM r WHERE kept"""
FORMS["greedy_capped_select"] = f"""WITH RECURSIVE d AS (SELECT doc_id, md5({R.TOKENS}) AS key, source AS grp, CASE WHEN lang = 'en' THEN 'capped' ELSE 'free' END AS bucket, lang AS label, n_chars, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS n FROM documents),
r AS (SELECT 0::BIGINT AS n, []::VARCHAR[] AS keys, []::VARCHAR[] AS grps, []::VARCHAR[] AS labels, 0 AS capped, NULL::BIGINT AS doc_id
  UNION ALL SELECT n, CASE WHEN k THEN list_append(keys, key) ELSE keys END, CASE WHEN k THEN list_append(grps, coalesce(grp, 'unknown')) ELSE grps END, CASE WHEN k AND label IS NOT NULL THEN list_append(labels, label) ELSE labels END, capped + (k AND bucket = 'capped')::INT, CASE WHEN k THEN id END
  FROM (SELECT d.n, d.key, d.grp, d.bucket, d.label, d.doc_id AS id, r.keys, r.grps, r.labels, r.capped, NOT list_contains(r.keys, d.key) AND len(list_filter(r.grps, lambda g: g = coalesce(d.grp, 'unknown'))) < 5 AND len(list_filter(r.labels, lambda l: l = d.label)) < 30 AND (d.bucket <> 'capped' OR r.capped < 18) AS k FROM r JOIN d ON d.n = r.n + 1 WHERE len(r.keys) < 60))
SELECT doc_id, key, grp, bucket, label, n_chars FROM d WHERE doc_id IN (SELECT doc_id FROM r WHERE doc_id IS NOT NULL)"""
CAPTIONS = X.Inline("clip string, source string, text string, second string", (("a", "asr", "Привет, мир!", "привет мир"), ("b", "human", "x", "y"), ("c", "asr", "совсем другое", "ничего похожего"), ("d", "asr", "", ""), ("e", None, None, None)))
#: Cyrillic letters as single bytes, for the other engine's distance of bytes.
LETTERS = "'абвгдежзийклмнопрстуфхцчшщъыьэюя', 'abcdefghijklmnopqrstuvwxyzABCDEF'"
CHARACTERS = lambda c: rf"translate(trim(regexp_replace(regexp_replace(replace(lower(coalesce({c}, '')), 'ё', 'е'), '[^\p{{L}}\p{{M}}\p{{N}}\s]', ' ', 'g'), '\s+', ' ', 'g')), {LETTERS})"
FORMS["cross_check"] = f"""SELECT clip, round_even(cer, 4) AS cer, cer <= 0.1 AS asr_agree FROM (SELECT clip, CASE WHEN source <> 'human' AND second IS NOT NULL THEN CASE WHEN t = '' THEN CASE WHEN s = '' THEN 0.0 ELSE 1.0 END ELSE levenshtein(s, t)::DOUBLE / length(t) END END AS cer
FROM (SELECT *, {CHARACTERS('second')} AS s, {CHARACTERS('text')} AS t FROM {CAPTIONS.sql()}))"""
EMOTIONS = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(replace(lower(ru), 'ё', 'е'), '{I._emotion(p)}') THEN '{n}' END" for n, p in L.EMOTIONS.items()) + "], lambda x: x IS NOT NULL)"
FORMS["ranked_candidates"] = f"""SELECT ru AS source, round_even(id / 12.0::DOUBLE * greatest((100 - id * 7.0::DOUBLE) / 100, 0.3) + 0.1 * least(2, len(list_filter({lst([p.replace('ё', 'е') for p in X.IDIOMS])}, lambda p: contains(replace(lower(ru), 'ё', 'е'), p)))), 4) AS score,
  CASE WHEN list_has_any(regexp_extract_all(lower(ru), '[а-яё]+'), {L.FAMILIAR + L.FORMAL}) THEN 'capped' ELSE 'general' END AS bucket, {EMOTIONS}[1] AS label FROM {X.PAIRS.sql()} WHERE ru <> ''"""
RAWCUES = "1\n00:00:01,000 --> 00:00:02,500\n- Привет!\n<i>Как</i> дела?\n\n2\n00:01:00.5 --> 00:01:02,25\n[music]\n\nno time\nhere\n\n3\n01:00:00,000 --> 01:00:01,000\nEnd"
NUMCUES = "1\n00:00:01,000 --> 00:00:02,500\nHello — there\n\n2\n00:00:03,000 --> 00:00:04,000\n12:30\n\n3\n00:00:05,000 --> 00:00:06,000\nBye"
def q(t): return "'"+t.replace("'","''").replace("\n","' || chr(10) || '")+"'"
TIMES = r"(\d+):(\d\d):(\d\d)[,.](\d+)\s*-->\s*(\d+):(\d\d):(\d\d)[,.](\d+)"
def cues(raw):
    sec=lambda k: f"regexp_extract(b, '{TIMES}', {k})::INT * 3600 + regexp_extract(b, '{TIMES}', {k+1})::INT * 60 + regexp_extract(b, '{TIMES}', {k+2})::INT + rpad(regexp_extract(b, '{TIMES}', {k+3}), 3, '0')::INT / 1000.0::DOUBLE"
    return rf"""(SELECT n, {sec(1)} AS start, {sec(5)} AS "end", regexp_replace(regexp_replace(b, '(?s)^.*?{TIMES}[^\n]*', ''), '\s*\n\s*', ' ', 'g') AS text FROM (SELECT unnest(range(len(l))) AS n, unnest(l) AS b FROM (SELECT string_split_regex({q(raw)}, '\n\s*\n') AS l)) WHERE regexp_matches(b, '{TIMES}'))"""
FORMS["subtitle_cues"] = f"""SELECT * FROM (SELECT 'a' AS film, start, "end", {I.CLEAN} AS text FROM {cues(RAWCUES)}) WHERE text <> ''"""
CUE = rf"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '♪[^♪]*♪', ' ', 'g'), '\([^)]*\)|\[[^\]]*\]', ' ', 'g'), '^\s*[—–-]\s*', ''), '\s[—–]\s', ' ', 'g'), '\s+', ' ', 'g'))"
FORMS["aligned_cues_numbered"] = rf"""SELECT 'a' AS film, start, "end", text, row_number() OVER (ORDER BY n)::INT AS id FROM (SELECT n, start, "end", {CUE} AS text FROM {cues(NUMCUES)}) WHERE text <> '' AND NOT regexp_matches(text, '^[\d.,:\s]+$')"""
