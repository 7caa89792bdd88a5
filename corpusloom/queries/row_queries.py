"""Row functions, dedupe, set operations and joins over the driver's text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import predicates as P
from corpusloom.functions import text as T
from corpusloom.operators import dedup, joins, selection, vectors_join
from corpusloom.plans import checks
from corpusloom.registry import query, table

KEY = r"trim(regexp_replace(replace(lower(text), 'ё', 'е'), '\s+', ' ', 'g'))"
TOKENS = r"array_to_string(regexp_extract_all(replace(lower(text), 'ё', 'е'), '[\p{L}\p{M}\p{N}_'']+'), ' ')"
WORDS = r"len(list_filter(string_split_regex(trim(regexp_replace(text, '\s+', ' ', 'g')), ' '), lambda x: x <> ''))"


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


@query(f"SELECT doc_id, {KEY} AS k FROM documents")
def key_exact(spark, sf):
    return docs(spark, sf).select("doc_id", T.exact_key(F.col("text")).alias("k"))


@query(f"SELECT doc_id, {TOKENS} AS k FROM documents")
def key_tokens(spark, sf):
    return docs(spark, sf).select("doc_id", T.token_key(F.col("text")).alias("k"))


@query(r"SELECT doc_id, trim(regexp_replace(lower(text), '[^\p{L}\p{M}\p{N}_]+', ' ', 'g')) AS k FROM documents")
def key_register(spark, sf):
    return docs(spark, sf).select("doc_id", T.register_key(F.col("text")).alias("k"))


@query(r"SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{M}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS k FROM documents")
def key_echo(spark, sf):
    return docs(spark, sf).select("doc_id", T.echo_key(F.col("text")).alias("k"))


@query(r"SELECT doc_id, trim(regexp_replace(regexp_replace(replace(lower(text), 'ё', 'е'), '[^\p{L}\p{M}\p{N}\s]', ' ', 'g'), '\s+', ' ', 'g')) AS k FROM documents")
def key_characters(spark, sf):
    return docs(spark, sf).select("doc_id", T.character_key(F.col("text")).alias("k"))


@query(rf"SELECT doc_id, len(regexp_extract_all(text, '[\p{{L}}\p{{M}}\p{{N}}_'']+')) AS word_tokens, {WORDS}::BIGINT AS space_words FROM documents")
def word_count(spark, sf):
    return docs(spark, sf).select("doc_id", T.word_count(F.col("text")).alias("word_tokens"), T.space_word_count(F.col("text")).alias("space_words"))


@query(r"SELECT page_id, left(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), 400) AS text FROM pages")
def html_strip(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.html_text(F.col("html")).alias("text"))


REASONS = rf"""
SELECT doc_id, lang, CASE WHEN text = '' THEN 'empty' WHEN {WORDS} < 20 THEN 'short' WHEN {WORDS} > 400 THEN 'long'
  WHEN len(regexp_extract_all(text, '[#*$%&|<>]')) * 20 > length(text) THEN 'symbols'
  WHEN row_number() OVER (PARTITION BY {KEY} ORDER BY doc_id) > 1 THEN 'duplicate' END AS reason FROM documents"""


@query(REASONS)
def reject_cascade(spark, sf):
    return checks.document_reasons(docs(spark, sf)).select("doc_id", "lang", "reason")


@query(f"SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM ({REASONS}) GROUP BY 1")
def reject_reason_counts(spark, sf):
    return checks.document_reasons(docs(spark, sf)).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"SELECT coalesce(reason, 'kept') AS reason, coalesce(lang, 'ALL') AS lang, count(*) AS n FROM ({REASONS}) GROUP BY GROUPING SETS ((reason, lang), (reason))")
def reject_reasons_by_language(spark, sf):
    return checks.document_reasons(docs(spark, sf)).groupingSets([["reason", "lang"], ["reason"]], "reason", "lang").agg(F.count("*").alias("n")).select(F.coalesce("reason", F.lit("kept")).alias("reason"), F.coalesce("lang", F.lit("ALL")).alias("lang"), "n")


@query(f"SELECT doc_id, source, lang FROM documents QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY doc_id) = 1")
def dedup_first_wins(spark, sf):
    return dedup.first_wins(docs(spark, sf), T.exact_key(F.col("text")), "doc_id").select("doc_id", "source", "lang")


@query(f"""
WITH k AS (SELECT d.doc_id, {KEY} AS k, coalesce(l.quality = 1, false) AS held FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT doc_id, min(doc_id) OVER (PARTITION BY k) AS position, held FROM k
QUALIFY row_number() OVER (PARTITION BY k ORDER BY held DESC, CASE WHEN held THEN doc_id ELSE -doc_id END) = 1""")
def dedup_last_wins_protected(spark, sf):
    rows = docs(spark, sf).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left").withColumn("held", F.coalesce(F.col("quality") == 1, F.lit(False)))
    return dedup.last_wins(rows, T.exact_key(F.col("text")), "doc_id", F.col("held")).select("doc_id", "position", "held")


@query(f"SELECT md5({KEY}) AS key_md5, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY {KEY} HAVING count(*) > 1")
def exact_dup_groups(spark, sf):
    return docs(spark, sf).groupBy(T.exact_key(F.col("text")).alias("k")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1").select(F.md5("k").alias("key_md5"), "n", "first_id")


@query(r"SELECT lower(array_to_string(list_slice(string_split_regex(trim(text), '\s+'), 1, 3), ' ')) AS head, count(*) AS n FROM documents WHERE trim(text) <> '' GROUP BY 1 HAVING count(*) > 1")
def first3_clusters(spark, sf):
    head = F.lower(F.array_join(F.slice(T.split_words(F.col("text")), 1, 3), " "))
    return docs(spark, sf).groupBy(head.alias("head")).agg(F.count("*").alias("n")).where("head <> '' and n > 1")


@query("SELECT doc_id, source, lang, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) > 1 AS repeat FROM documents")
def repeat_flags(spark, sf):
    return dedup.flag_repeats(docs(spark, sf), ["source", "lang"], "doc_id").select("doc_id", "source", "lang", "repeat")


@query("SELECT s.source, l.lang FROM (SELECT DISTINCT source FROM documents) s CROSS JOIN (SELECT DISTINCT lang FROM documents) l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.source = s.source AND d.lang = l.lang AND d.doc_id % 7 = 0)")
def missing_pairs_matrix(spark, sf):
    d = docs(spark, sf)
    return joins.missing_pairs(d.select("source").distinct(), d.select("lang").distinct(), d.where("doc_id % 7 = 0").select("source", "lang"), "source", "lang")


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def resume_anti(spark, sf):
    return docs(spark, sf).join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti").select("doc_id", "source")


@query("""
SELECT doc_id, source FROM documents WHERE source IN (SELECT source FROM documents GROUP BY 1 HAVING count(*) % 2 = 0)
  AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0) AND (doc_id, source) NOT IN (SELECT (doc_id, source) FROM documents WHERE lang = 'fr')""")
def retry_semi_anti(spark, sf):
    d = docs(spark, sf).select("doc_id", "source", "lang")
    active = d.groupBy("source").agg(F.count("*").alias("n")).where("n % 2 = 0")
    return joins.retry_eligible(d.select("doc_id", "source"), active, table(spark, sf, "labels").where("quality = 0"), d.where("lang = 'fr'"), "doc_id", "source")


@query(f"WITH k AS (SELECT doc_id, lang, {TOKENS} AS k FROM documents) SELECT doc_id FROM k WHERE lang <> 'en' AND k NOT IN (SELECT k FROM k WHERE lang = 'en') AND k NOT IN (SELECT {TOKENS} FROM benchmark)")
def avoid_anti(spark, sf):
    d = docs(spark, sf)
    key = T.token_key(F.col("text"))
    return dedup.without(d.where("lang <> 'en'"), key, d.where("lang = 'en'").select(key), table(spark, sf, "benchmark").select(key)).select("doc_id")


@query("SELECT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)")
def benchmark_contamination(spark, sf):
    bench = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("phrase"))
    return joins.containing(docs(spark, sf), "doc_id", "text", bench, "phrase").select("item_id", "doc_id")


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE contains(d.text, b.text))")
def contamination_anti(spark, sf):
    return docs(spark, sf).join(benchmark_contamination(spark, sf).select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id")


@query("SELECT c.conv_id, c.turn, d.doc_id FROM conversations c LEFT JOIN (SELECT doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY n_chars ORDER BY doc_id) = 1) d ON length(c.text) = d.n_chars")
def first_match_join(spark, sf):
    left = table(spark, sf, "conversations").select("conv_id", "turn", F.length("text").cast("bigint").alias("n_chars"))
    return joins.first_match(left, docs(spark, sf).select("doc_id", "n_chars"), "n_chars", "doc_id").select("conv_id", "turn", "doc_id")


@query("SELECT DISTINCT d.doc_id, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def seed_with_meta(spark, sf):
    return joins.with_meta(docs(spark, sf).select("doc_id", "source"), table(spark, sf, "labels").withColumn("line", F.col("quality")), "doc_id", "line")


@query("SELECT DISTINCT doc_id FROM documents WHERE lang = 'en' UNION ALL SELECT item_id + 1000000 FROM benchmark")
def union_all(spark, sf):
    return dedup.merged(docs(spark, sf).where("lang = 'en'").select("doc_id"), table(spark, sf, "benchmark").select((F.col("item_id") + 1000000).alias("doc_id")))


@query(f"""
WITH p AS (SELECT 'good' AS part, 0 AS o, doc_id, {KEY} AS k FROM documents JOIN labels USING (doc_id) WHERE quality = 1
  UNION ALL SELECT 'all', 1, doc_id, {KEY} FROM documents)
SELECT part, doc_id FROM p QUALIFY row_number() OVER (PARTITION BY k ORDER BY o, doc_id) = 1""")
def union_first_wins(spark, sf):
    d = docs(spark, sf).select("doc_id", "text")
    good = d.join(table(spark, sf, "labels").where("quality = 1").select("doc_id"), "doc_id", "left_semi")
    return dedup.merged_first_wins([("good", good), ("all", d)], T.exact_key(F.col("text")), "doc_id").select("part", "doc_id")


@query("SELECT source FROM documents WHERE lang = 'de' EXCEPT SELECT source FROM documents WHERE doc_id < 40")
def set_except(spark, sf):
    d = docs(spark, sf)
    return d.where("lang = 'de'").select("source").subtract(d.where("doc_id < 40").select("source"))


@query("SELECT source FROM documents WHERE lang = 'de' INTERSECT SELECT source FROM documents WHERE doc_id < 40")
def set_intersect(spark, sf):
    d = docs(spark, sf)
    return d.where("lang = 'de'").select("source").distinct().join(d.where("doc_id < 40").select("source"), "source", "left_semi")


@query("SELECT DISTINCT doc_id FROM (SELECT doc_id FROM labels WHERE quality = 0 UNION SELECT doc_id FROM labels WHERE toxic = 1)")
def union_of_sets(spark, sf):
    rows = table(spark, sf, "labels")
    return rows.where("quality = 0").select("doc_id").union(rows.where("toxic = 1").select("doc_id")).distinct()


@query("SELECT DISTINCT lang FROM documents ORDER BY lang")
def distinct_languages(spark, sf):
    return docs(spark, sf).select("lang").distinct().orderBy("lang")


@query("SELECT a.lang, b.quality, c.k AS tier, round_even(n * c.k / 7.0, 0)::BIGINT AS quota FROM (SELECT lang, count(*) AS n FROM documents GROUP BY 1) a CROSS JOIN (SELECT DISTINCT quality FROM labels) b CROSS JOIN (VALUES (1), (2), (3)) c(k)")
def quota_grid(spark, sf):
    langs = docs(spark, sf).groupBy("lang").agg(F.count("*").alias("n"))
    grid = langs.crossJoin(F.broadcast(table(spark, sf, "labels").select("quality").distinct())).withColumn("tier", F.explode(F.lit([1, 2, 3])))
    return grid.select("lang", "quality", "tier", F.bround(F.col("n") * F.col("tier") / 7.0).cast("bigint").alias("quota"))


@query("SELECT doc_id FROM documents ORDER BY md5(doc_id::VARCHAR || ':s1'), doc_id LIMIT 50")
def hash_sample(spark, sf):
    return selection.hash_sample(docs(spark, sf).select("doc_id"), 50, "s1", F.col("doc_id"))


@query("SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 25")
def first_lines(spark, sf):
    return docs(spark, sf).select("doc_id", "n_chars").orderBy("doc_id").limit(25)


@query("""
WITH r AS (SELECT doc_id, source, lang = 'en' AS preferred, row_number() OVER (PARTITION BY source ORDER BY (lang = 'en') DESC, md5(doc_id::VARCHAR || ':rr')) AS turn FROM documents)
SELECT doc_id, source, preferred, turn FROM r WHERE turn <= 5 ORDER BY turn, source LIMIT 60""")
def round_robin_by_source(spark, sf):
    return selection.round_robin(docs(spark, sf), "source", F.col("lang") == "en", 60, 5, "rr", F.col("doc_id")).select("doc_id", "source", "preferred", F.col("turn").cast("bigint").alias("turn"))


@query("SELECT doc_id, lang, t.copy::INT AS copy FROM documents, range(1, 4) t(copy) WHERE t.copy <= CASE lang WHEN 'de' THEN 3 WHEN 'fr' THEN 2 ELSE 1 END")
def oversample_lang(spark, sf):
    return selection.oversampled(docs(spark, sf).select("doc_id", "lang"), F.col("lang"), {"de": 3, "fr": 2, "en": 0})


@query("""
WITH s AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2),
m AS (SELECT source, sum(n)::BIGINT AS size, arg_max(lang, (n, lang)) AS lang FROM s GROUP BY 1),
t AS (SELECT source, size, lang, coalesce(sum(size) OVER (PARTITION BY lang ORDER BY md5(source || ':b') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS taken_before,
  round_even(0.3 * sum(size) OVER (PARTITION BY lang), 0)::BIGINT AS target FROM m)
SELECT source, size, lang, taken_before, target, taken_before < target AS is_test FROM t""")
def group_budget_split(spark, sf):
    return selection.group_budget(docs(spark, sf), "source", "lang", 0.3, "b")


@query("SELECT d.doc_id FROM (SELECT doc_id, source, coalesce(quality = 1, false) AS good FROM documents LEFT JOIN labels USING (doc_id)) d QUALIFY good OR NOT bool_or(good) OVER (PARTITION BY d.source)")
def keep_good_else_all(spark, sf):
    rows = docs(spark, sf).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return selection.keep_good_else_all(rows, "source", F.col("quality") == 1).select("doc_id")


@query()
def greedy_capped_select(spark, sf):
    rows = docs(spark, sf).select("doc_id", F.md5(T.token_key(F.col("text"))).alias("key"), F.col("source").alias("grp"), F.when(F.col("lang") == "en", "capped").otherwise("free").alias("bucket"), F.col("lang").alias("label"), "n_chars")
    return selection.capped_greedy(rows, [F.col("n_chars").desc(), F.col("doc_id")], 60, 5, 0.3, 30)


PAIR_SQL = """SELECT a.vec_id AS i, b.vec_id AS j, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cos
FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id WHERE list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= {least}"""


@query(PAIR_SQL.format(least=0.35))
def near_dup_pairs(spark, sf):
    return vectors_join.near_pairs(table(spark, sf, "embeddings"), "vec_id", "embedding", "label", 0.35).withColumn("cos", F.round("cos", 6))


@query(f"WITH p AS ({PAIR_SQL.format(least=0.25)}) SELECT vec_id AS id, (SELECT count(*) FROM p WHERE p.i = e.vec_id OR p.j = e.vec_id) AS neighbours FROM embeddings e")
def near_dup_neighbours(spark, sf):
    return vectors_join.neighbour_counts(table(spark, sf, "embeddings"), "vec_id", "embedding", "label", 0.25)


@query(f"WITH p AS ({PAIR_SQL.format(least=0.25)}) SELECT vec_id AS id, (SELECT count(*) FROM p WHERE p.i = e.vec_id OR p.j = e.vec_id) AS neighbours FROM embeddings e ORDER BY neighbours DESC, id LIMIT 25")
def most_templated(spark, sf):
    return near_dup_neighbours(spark, sf).orderBy(F.col("neighbours").desc(), "id").limit(25)


COMPONENTS = f"""
WITH RECURSIVE p AS ({PAIR_SQL.format(least=0.35)}), e AS (SELECT i, j FROM p UNION SELECT j, i FROM p),
r AS (SELECT vec_id AS id, vec_id AS root FROM embeddings UNION SELECT e.j, r.root FROM r JOIN e ON r.id = e.i),
c AS (SELECT id, min(root) AS root FROM r GROUP BY id)"""


@query(COMPONENTS + " SELECT id, root FROM c")
def near_dup_components(spark, sf):
    e = table(spark, sf, "embeddings")
    return vectors_join.groups(e, "vec_id", vectors_join.near_pairs(e, "vec_id", "embedding", "label", 0.35))


@query(COMPONENTS + ", g AS (SELECT root, count(*) AS n, count(DISTINCT vec_id % 2) AS k FROM c JOIN embeddings ON id = vec_id GROUP BY root HAVING count(*) > 1) SELECT count(*) AS groups, coalesce(sum(n), 0)::BIGINT AS rows_in_groups, count(*) FILTER (k > 1) AS mixed_groups FROM g")
def near_dup_report(spark, sf):
    rows = near_dup_components(spark, sf).withColumn("half", F.pmod("id", F.lit(2)))
    return vectors_join.group_report(rows, "root", "half")


@query(COMPONENTS + " SELECT id, root FROM c QUALIFY row_number() OVER (PARTITION BY root ORDER BY (id % 3 = 0) DESC, id) = 1")
def near_dup_representatives(spark, sf):
    rows = near_dup_components(spark, sf).withColumn("has", F.pmod("id", F.lit(3)) == 0)
    return vectors_join.representatives(rows, "root", "has", "id").select("id", "root")


@query(r"SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}')) AS emails FROM documents")
def entity_emails(spark, sf):
    from corpusloom.functions.udfs import EMAIL

    return docs(spark, sf).select("doc_id", F.regexp_count("text", F.lit(EMAIL)).cast("bigint").alias("emails"))


@query(r"SELECT page_id, len(regexp_extract_all(html, '(?:https?://|www\.)[^\s<>\"'')]+[^\s<>\"'').,;:!?]')) AS urls FROM pages")
def entity_urls(spark, sf):
    from corpusloom.functions.udfs import URL

    return table(spark, sf, "pages").select("page_id", F.regexp_count("html", F.lit(URL)).cast("bigint").alias("urls"))


@query(r"SELECT doc_id, text = '' OR regexp_matches(text, '(^|\n|\s)[-–—]\s*\S') AND len(regexp_extract_all(text, '(^|\n|\s)[-–—]\s*\S')) >= 2 AS several FROM documents")
def speaker_dashes(spark, sf):
    return docs(spark, sf).select("doc_id", ((F.col("text") == "") | P.several_speakers(F.col("text"))).alias("several"))
