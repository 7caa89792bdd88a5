"""Sources, sinks and whole runs: what is written to the shared folder, read back, and answered by injected models."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom import fixtures as X
from corpusloom.functions import language as G
from corpusloom.functions import lexicons as L
from corpusloom.functions import text as T
from corpusloom.operators import joins, reports, selection, state
from corpusloom.plans import checks, curation, evaluation, mining, seams
from corpusloom.queries.sql_forms import CHECKS, PARSE, lst
from corpusloom.registry import query, table
from corpusloom.shared import put, shared_path, written
from corpusloom.sources import readers, writers
from corpusloom.streaming import events as streams

DOCUMENT = "doc_id bigint, text string, lang string"


@query("SELECT doc_id, text, lang FROM documents")
def json_lines_strict(spark, sf):
    path = shared_path(spark, "jsonl")
    writers.json_lines(table(spark, sf, "documents").select("doc_id", "text", "lang"), path)
    return readers.json_lines(spark, path, DOCUMENT)


@query("SELECT doc_id, text, lang FROM documents WHERE doc_id % 10 <> 0")
def json_lines_tolerant(spark, sf):
    path = shared_path(spark, "jsonl")
    line = F.to_json(F.struct("doc_id", "text", "lang"))
    table(spark, sf, "documents").select(F.when(F.col("doc_id") % 10 == 0, F.left(line, F.lit(9))).otherwise(line)).write.text(path)
    return readers.json_lines(spark, path, DOCUMENT, strict=False)


@query("SELECT row_number() OVER (ORDER BY p_partkey) AS line, p_name AS seed FROM part QUALIFY p_partkey % 5 <> 0")
def seed_lines(spark, sf):
    path = f"{shared_path(spark, 'seeds')}.txt"
    lines = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 5 == 0, " ").otherwise(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("value"))
    lines.orderBy("p_partkey").select("value").write.text(path)
    return readers.seeds(spark, path).select("line", "seed")


@query("SELECT row_number() OVER (ORDER BY n_name) AS line, lower(n_name) AS seed FROM nation ORDER BY 1 LIMIT 10")
def first_seeds(spark, sf):
    path = f"{shared_path(spark, 'seeds')}.txt"
    writers.single_file(table(spark, sf, "nation").orderBy("n_name").select(F.lower("n_name").alias("value")), path, "text")
    return readers.seeds(spark, path, 10).select("line", "seed")


@query("SELECT doc_id, CASE lang WHEN 'en' THEN 'batch_1.jsonl' ELSE 'batch_2.jsonl' END AS _batch_file FROM documents WHERE lang IN ('en', 'de')")
def final_batches_with_file(spark, sf):
    folder, docs = shared_path(spark, "batches"), table(spark, sf, "documents").select("doc_id", "text", "lang")
    for name, lang in (("batch_1.jsonl", "en"), ("batch_2.jsonl", "de"), ("batch_1_dropped.jsonl", "fr"), ("batch_2_prefilter.jsonl", "es")):
        writers.json_lines(docs.where(F.col("lang") == lang), f"{folder}/{name}")
    return readers.final_batches(readers.with_file(readers.json_lines(spark, f"{folder}/*.jsonl", DOCUMENT))).select("doc_id", "_batch_file")


@query("SELECT DISTINCT trim(n_name) AS seed FROM nation UNION SELECT r_name FROM region")
def lines_of_existing_files(spark, sf):
    folder = shared_path(spark, "lines")
    writers.single_file(table(spark, sf, "nation").select(F.concat("n_name", F.lit("  ")).alias("value")), f"{folder}-a.txt", "text")
    writers.single_file(table(spark, sf, "region").select(F.col("r_name").alias("value")), f"{folder}-b.txt", "text")
    return readers.distinct_lines(spark, [f"{folder}-a.txt", f"{folder}-b.txt", f"{folder}-missing.txt"])


@query("SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS line, n_name AS ru, lower(n_name) AS en, '1999/' || n_nationkey AS film FROM nation QUALIFY line < 20")
def aligned_archive(spark, sf):
    rows = table(spark, sf, "nation").orderBy("n_nationkey").select("n_nationkey", "n_name").collect()  # a dimension of 25 rows makes the archive
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("x.ru", "".join(f"{r.n_name}\n" for r in rows))
        z.writestr("x.en", "".join(f"{r.n_name.lower()}\n" for r in rows))
        z.writestr("x.ids", "".join(f"en/1999/{r.n_nationkey}/1\tru/1999/{r.n_nationkey}/2\n" for r in rows))
    path = f"{shared_path(spark, 'archive')}.zip"
    put(spark, path, packed.getvalue())
    return readers.aligned_zip(spark, path, 20)


@query("""SELECT * FROM (VALUES ('a.srt', 1.0::DOUBLE, 2.5::DOUBLE, 'Привет'), ('b.srt', 1.0, 2.5, 'Привет'), ('c.srt', 0.5, 1.0, 'Plain')) v(file, start, "end", text)""")
def subtitle_files(spark, sf):
    folder, cue = shared_path(spark, "subtitles"), "1\n00:00:01,000 --> 00:00:02,500\n- Привет\n\n2\n00:00:03,000 --> 00:00:04,000\n[шум]\n"
    for name, raw in (("a.srt", cue.encode()), ("b.srt", cue.encode("cp1251")), ("c.srt", b"\xef\xbb\xbf1\r\n00:00:00,500 --> 00:00:01,000\r\nPlain\r\n")):
        put(spark, f"{folder}/{name}", raw)
    return readers.subtitles(spark, f"{folder}/*.srt")


ROUTE = "CASE WHEN len(problems) = 0 THEN 'clean' ELSE 'rejects' END"


@query(f"SELECT {ROUTE} AS route, line, source_text FROM {CHECKS}")
def routed_batches(spark, sf):
    folder = shared_path(spark, "routes")
    checked = checks.candidate_problems(X.CANDIDATES.frame(spark))
    writers.routed(checked.select("line", "source_text", "problems"), F.when(F.size("problems") == 0, "clean").otherwise("rejects"), folder)
    return spark.read.schema("line int, source_text string, route string").json(folder).select("route", "line", "source_text")


@query("SELECT doc_id, lang FROM documents WHERE doc_id % 20 = 3")
def frozen_split_file(spark, sf):
    path, docs = shared_path(spark, "frozen"), table(spark, sf, "documents").select("doc_id", "lang")
    writers.frozen(docs.where("doc_id % 20 = 3"), path)
    writers.frozen(docs, path)  # a second run leaves it as it is
    return spark.read.schema("doc_id bigint, lang string").json(path)


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def tsv_report(spark, sf):
    path = shared_path(spark, "report")
    writers.tab_separated(table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n")), path, "lang")
    return spark.read.option("header", True).option("sep", "\t").schema("lang string, n bigint").csv(path)


@query("SELECT count(*) AS rows, sum(n_chars)::BIGINT AS chars, count(DISTINCT lang) AS languages FROM documents")
def json_report(spark, sf):
    path = shared_path(spark, "report")
    writers.report(table(spark, sf, "documents").agg(F.count("*").alias("rows"), F.sum("n_chars").alias("chars"), F.count_distinct("lang").alias("languages")), path)
    return spark.read.schema("rows bigint, chars bigint, languages bigint").json(path)


def event_stream(spark, sf, folder: str, batches: int):
    """The events as files that arrive one after another."""
    rows = table(spark, sf, "events")
    rows.repartition(batches, "event_id").write.parquet(f"{folder}/in")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


@query("SELECT event_id, upper(event_type) AS event_type FROM events")
def appended_stream(spark, sf):
    folder = shared_path(spark, "stream")
    source = event_stream(spark, sf, folder, 4)
    sink = writers.appended(source.select("event_id", "event_type"), f"{folder}/out", f"{folder}/log", lambda b: b.withColumn("event_type", F.upper("event_type")))
    sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("event_id bigint, event_type string").json(f"{folder}/out").select("event_id", "event_type")


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def change_feed(spark, sf):
    """The feed's last state, after all changes: each micro-batch of changes replaces the state of a table in full."""
    folder = shared_path(spark, "feed")
    source = event_stream(spark, sf, folder, 2)
    feed = streams.change_feed(source.select("user_id", "event_type"), "user_id", "event_type")

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{folder}/now")

    feed.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/now")


@query("SELECT 'int4' AS tier, 'm-int4.litertlm' AS file, '3' AS version, 5::BIGINT AS bytes, sha256('hello') AS sha256 UNION ALL SELECT 'int8', 'm-int8.litertlm', '3', 0, sha256('')")
def model_files(spark, sf):
    folder = shared_path(spark, "models")
    put(spark, f"{folder}/m-int4.litertlm", b"hello")
    put(spark, f"{folder}/m-int8.litertlm", b"")
    return writers.file_manifest(spark, f"{folder}/*.litertlm", T.model_tier(F.col("_metadata.file_name")), "3")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'changed' ELSE c_name END AS c_name, c_acctbal FROM customer WHERE c_custkey % 7 <> 0")
def rows_deleted_and_updated(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    left = writers.without_ids(rows, rows.where("c_custkey % 7 = 0"), "c_custkey")
    return writers.with_updates(left, rows.where("c_custkey % 3 = 0").select("c_custkey", F.lit("changed").alias("c_name")), "c_custkey")


@query(f"SELECT line, list_contains(p, 'echo drift') AS drift FROM (SELECT line, CASE WHEN len(q) = 0 AND model = 'b' AND coalesce(source_text, '') <> '' THEN ['echo drift'] ELSE [] END AS p FROM (SELECT *, list_filter(problems, lambda x: starts_with(x, 'missing') OR contains(x, 'allowed') OR contains(x, 'subtext')) AS q FROM {CHECKS}))")
def echo_drift(spark, sf):
    """Model ``a`` repeats the source with other punctuation, ``b`` says something else, ``c`` repeats nothing."""
    m = F.col("model")
    rows = X.CANDIDATES.frame(spark).withColumn("echo", F.when(m == "a", F.concat(F.upper("source_text"), F.lit(" ..."))).when(m == "b", "%%"))
    return checks.candidate_problems(rows, echo="echo").select("line", F.array_contains("problems", "echo drift").alias("drift"))


@query("""
WITH r AS (SELECT *, sum((value >= 30)::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS g FROM events WHERE event_id % 2 = 0),
s AS (SELECT *, sum((value < 30)::INT) OVER (PARTITION BY user_id, g ORDER BY event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS streak FROM r)
SELECT user_id, arg_max(streak, event_id) AS consecutive_bad_runs, max(streak) >= 2 AS disabled FROM s GROUP BY 1""")
def roster_state(spark, sf):
    """The state of the roster, saved and loaded again; it is empty before the first run."""
    path = shared_path(spark, "health")
    schema = "user_id bigint, consecutive_bad_runs bigint, disabled boolean"
    assert readers.saved_state(spark, path, schema).isEmpty()
    runs = table(spark, sf, "events").where("event_id % 2 = 0").withColumn("bad", F.col("value") < 30)
    writers.json_lines(state.run_health(runs, "user_id", "event_id", "bad").select("user_id", "consecutive_bad_runs", "disabled"), path)
    return readers.saved_state(spark, path, schema)


def reply(seed: str, model: str) -> str:
    """A deterministic model: it declines some seeds, is busy for others, and fails for others still."""
    n = sum(map(ord, seed))
    if n % 7 == 0:
        raise seams.Refused("declined")
    if model == "b" and n % 5 == 0:
        raise seams.RateLimited("busy")
    if model == "b" and n % 3 == 0:
        raise ValueError("broken")
    return f"{model}:{seed.lower()}"


CODE = "list_sum(list_transform(string_split(n_name, ''), lambda c: ascii(c)))"
STATUS = f"CASE WHEN {CODE} % 7 = 0 THEN 'refused' WHEN m = 'b' AND {CODE} % 5 = 0 THEN 'rate limited' WHEN m = 'b' AND {CODE} % 3 = 0 THEN 'failed' ELSE 'ok' END"
SAID = f"CASE {STATUS} WHEN 'ok' THEN m || ':' || lower(n_name) WHEN 'refused' THEN 'declined' WHEN 'failed' THEN 'broken' ELSE 'busy' END"


@query(f"SELECT n_name AS seed, m AS model, {STATUS} AS status, {SAID} AS reply FROM nation, (VALUES ('a'), ('b')) v(m)")
def generated_pairs(spark, sf):
    return seams.answered(table(spark, sf, "nation").select(F.col("n_name").alias("seed"), F.explode(F.lit(["a", "b"])).alias("model")), reply, None)


@query(f"SELECT n_name AS seed, m AS model, CASE WHEN {STATUS} = 'refused' THEN 'refused' ELSE 'ok' END AS status, CASE WHEN {STATUS} = 'refused' THEN 'declined' WHEN {STATUS} = 'ok' AND n_nationkey < 15 THEN m || ':' || lower(n_name) ELSE 'later' END AS reply FROM nation, (VALUES ('a'), ('b')) v(m)")
def resumed_run(spark, sf):
    """A run broke off after 15 seeds; the second takes up what is missing or may be tried again, and keeps the rest."""
    seeds = table(spark, sf, "nation").select(F.col("n_name").alias("seed"), "n_nationkey")
    models = spark.createDataFrame([("a",), ("b",)], "model string")
    first = written(seams.answered(seeds.where("n_nationkey < 15").withColumn("model", F.explode(F.lit(["a", "b"]))), reply, None), "first-run")

    def later(seed: str, model: str) -> str:
        if sum(map(ord, seed)) % 7 == 0:
            raise seams.Refused("declined")
        return "later"

    return seams.resumed(seeds.select("seed"), models, first, later, None)


@query(f"SELECT n_name AS seed, m AS model FROM nation, (VALUES ('a'), ('b')) v(m) WHERE m = 'b' AND {STATUS} NOT IN ('ok', 'refused') AND n_nationkey % 4 <> 1")
def retried_pairs(spark, sf):
    """Failures of the active model whose seed is not covered by now."""
    pairs = table(spark, sf, "nation").select(F.col("n_name").alias("seed"), F.explode(F.lit(["a", "b"])).alias("model"))
    made = written(seams.answered(pairs, reply, None), "run")
    covered = table(spark, sf, "nation").where("n_nationkey % 4 = 1").select(F.col("n_name").alias("seed"))
    active = spark.createDataFrame([("b",)], "model string")
    return joins.retry_eligible(made.where("status not in ('ok', 'refused')").select("seed", "model"), active, covered, made.where("status in ('ok', 'refused')"), "seed", "model")


@query(f"SELECT n_name AS seed, CASE WHEN {CODE} % 7 = 0 THEN NULL WHEN {CODE} % 5 = 0 OR {CODE} % 3 = 0 THEN 'a' ELSE 'b' END AS path, CASE WHEN {CODE} % 7 = 0 THEN 3 WHEN {CODE} % 5 = 0 OR {CODE} % 3 = 0 THEN 3 ELSE 1 END AS tries FROM nation")
def fallback_chain(spark, sf):
    """Two tries of model ``b``, then one of ``a``; the last one counts."""
    log = seams.with_fallback(reply, "b", "a")(F.col("n_name"))
    rows = table(spark, sf, "nation").select(F.col("n_name").alias("seed"), log.alias("log")).withColumn("last", F.element_at("log", -1))
    return rows.select("seed", F.when(F.col("last.error").isNull(), F.col("last.path")).alias("path"), F.size("log").alias("tries"))


def worth(seed: str, _: str) -> str:
    if seed.endswith("7"):
        raise ValueError("no verdict")
    return "" if len(seed) > 8 else "too plain"


def annotate(seed: str, annotator: str) -> str:
    if seed.endswith("3") or (annotator == "y" and seed.endswith("4")):
        raise ValueError("no answer")
    return f"{annotator} says {seed[-1]}"


def adjudicate(seed: str, candidates: str) -> str:
    if seed.endswith("4"):
        raise ValueError("no majority")
    return f"{len(candidates.splitlines())} of 2"


ODD, PLAIN = "n_name LIKE '%7'", "length(n_name) <= 8"


@query(f"""SELECT route, count(*) AS n, string_agg(seed || '=' || value, ';' ORDER BY seed, value) AS rows FROM (
SELECT 'skipped' AS route, n_name AS seed, CASE WHEN {ODD} THEN 'detection error: no verdict' WHEN {PLAIN} THEN 'too plain' WHEN n_name LIKE '%3' THEN 'all annotators failed' ELSE 'adjudicator error: no majority' END AS value FROM nation WHERE {ODD} OR {PLAIN} OR n_name LIKE '%3' OR n_name LIKE '%4'
UNION ALL SELECT 'candidates', n_name, a || ' says ' || right(n_name, 1) FROM nation, (VALUES ('x'), ('y')) v(a) WHERE NOT ({ODD} OR {PLAIN} OR n_name LIKE '%3') AND NOT (n_name LIKE '%4' AND a = 'y')
UNION ALL SELECT 'adjudicated', n_name, '2 of 2' FROM nation WHERE NOT ({ODD} OR {PLAIN} OR n_name LIKE '%3' OR n_name LIKE '%4')) GROUP BY route""")
def annotation_routes(spark, sf):
    routes = seams.annotated(table(spark, sf, "nation").select(F.col("n_name").alias("seed")), worth, ["x", "y"], annotate, adjudicate)
    rows = None
    for route, df in routes.items():
        value = next(c for c in df.columns if c in ("verdict", "candidate", "reason"))
        part = df.select(F.lit(route).alias("route"), "seed", F.col(value).alias("value"))
        rows = part if rows is None else rows.unionByName(part)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("seed", "value"))), lambda r: F.concat(r["seed"], F.lit("="), r["value"]))
    return rows.groupBy("route").agg(F.count("*").alias("n"), F.array_join(listed, ";").alias("rows"))


def ask(cell: str, call: int) -> list[str]:
    """Three lines a call; every fourth call of a cell with an even number fails."""
    n = int(cell)
    if n % 2 == 0 and call % 4 == 3:
        raise ValueError("busy")
    return [f"line {(n + call * 2 + k) % 7} of {cell}" for k in range(3)]


@query("""WITH RECURSIVE c AS (SELECT n_nationkey::VARCHAR AS cell, 3 + n_nationkey % 3 AS quota, n_nationkey AS n FROM nation),
l AS (SELECT cell, quota, call, k, 3 * call + k AS at, (n + call * 2 + k) % 7 AS x, n % 2 = 0 AND call % 4 = 3 AS fails FROM c, range(5) a(call), range(3) b(k)),
s AS (SELECT cell, quota, -1 AS at, []::INT[] AS kept, NULL::INT AS call, NULL::VARCHAR AS line, NULL::VARCHAR AS reason, false AS said FROM c
  UNION ALL SELECT l.cell, l.quota, l.at, CASE WHEN NOT l.fails AND len(s.kept) < l.quota AND NOT list_contains(s.kept, l.x::INT) AND l.x <> 3 THEN list_append(s.kept, l.x::INT) ELSE s.kept END, l.call::INT,
    CASE WHEN NOT l.fails THEN 'line ' || l.x || ' of ' || l.cell END, CASE WHEN l.fails THEN 'failed: busy' WHEN list_contains(s.kept, l.x::INT) THEN 'repeat' WHEN l.x = 3 THEN 'three' END, len(s.kept) < l.quota AND (NOT l.fails OR l.k = 0)
  FROM s JOIN l ON l.cell = s.cell AND l.at = s.at + 1)
SELECT cell, call, line, reason FROM s WHERE said""")
def quota_loop(spark, sf):
    """Cells of a grid are asked for lines until their quota is met, five calls at most."""
    cells = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("cell"), (F.col("n_nationkey") % 3 + 3).alias("quota"))
    return seams.until_quota(cells, ask, lambda cell, line: "three" if line.startswith("line 3 ") else None, 5)


@query("SELECT line, CASE WHEN line = 1 THEN 'key|name' ELSE cells END AS cells FROM (SELECT 1 + row_number() OVER (ORDER BY n_nationkey) AS line, n_nationkey || '|<' || n_name || '> & co' AS cells FROM nation UNION ALL SELECT 1, NULL)")
def review_sheet_file(spark, sf):
    path = f"{shared_path(spark, 'sheet')}.xlsx"
    writers.spreadsheet(table(spark, sf, "nation").select(F.col("n_nationkey").alias("key"), F.format_string("<%s> & co", "n_name").alias("name")), path, "key")
    return readers.spreadsheets(spark, path).select("line", F.array_join("cells", "|").alias("cells"))


@query(f"""SELECT id, CASE WHEN f AND v THEN 'both' WHEN f THEN 'ty' WHEN v THEN 'vy' END AS address, array_to_string(list_filter({lst([p.replace("ё", "е") for p in X.IDIOMS])}, lambda p: contains(replace(lower(text), 'ё', 'е'), p)), ',') AS idioms FROM (SELECT *,
  list_has_any(regexp_extract_all(lower(text), '[а-яё]+'), {L.FAMILIAR}) AS f, list_has_any(regexp_extract_all(lower(text), '[а-яё]+'), {L.FORMAL}) AS v FROM {X.LINES.sql()}) WHERE text IS NOT NULL""")
def detection_evidence(spark, sf):
    """What the detection goes by, as one struct for each sentence."""
    rows = X.LINES.frame(spark).where("text is not null").select("id", F.struct(G.address(F.col("text")).alias("address"), G.phrases(F.col("text"), X.IDIOMS).alias("idioms")).alias("evidence"))
    return rows.select("id", "evidence.address", F.array_join("evidence.idioms", ",").alias("idioms"))


@query(f"SELECT 'clean' AS output, count(*) FILTER (len(problems) = 0) AS n FROM {CHECKS} UNION ALL SELECT 'rejects', count(*) FILTER (len(problems) > 0) FROM {CHECKS} UNION ALL SELECT 'next seeds', count(DISTINCT source_text) FILTER (len(problems) > 0 AND source_text <> '') FROM {CHECKS} UNION ALL SELECT 'reason ' || p, count(*) FROM (SELECT unnest(problems) AS p FROM {CHECKS}) GROUP BY p")
def batch_run(spark, sf):
    """A whole batch: candidates from a JSON lines file, checks, three outputs, and counts of them and of the reasons."""
    folder = shared_path(spark, "batch")
    writers.json_lines(X.CANDIDATES.frame(spark), f"{folder}/candidates")
    checked = checks.candidate_problems(readers.json_lines(spark, f"{folder}/candidates", X.CANDIDATES.schema))
    outputs = dict(zip(("clean", "rejects", "next seeds"), checks.split(checked), strict=True))
    counts = None
    for name, df in outputs.items():
        writers.json_lines(df, f"{folder}/{name.replace(' ', '_')}")
        n = spark.read.text(f"{folder}/{name.replace(' ', '_')}").agg(F.count("*").alias("n")).select(F.lit(name).alias("output"), "n")
        counts = n if counts is None else counts.union(n)
    reasons = checked.select(F.explode("problems").alias("p")).groupBy("p").agg(F.count("*").alias("n"))
    return counts.union(reasons.select(F.concat(F.lit("reason "), "p").alias("output"), "n"))


KEYED = "trim(regexp_replace(replace(lower(source_text), 'ё', 'е'), '\\s+', ' ', 'g'))"
VECTORS = "SELECT vec_id, 'text ' || vec_id // 3 AS source_text, CASE WHEN vec_id % 50 = 7 THEN 'held.jsonl' ELSE 'batch.jsonl' END AS _batch_file, label, embedding FROM embeddings"


@query(f"""
WITH v AS ({VECTORS}), k AS (SELECT *, row_number() OVER (PARTITION BY source_text ORDER BY (_batch_file = 'held.jsonl') DESC, CASE WHEN _batch_file = 'held.jsonl' THEN vec_id ELSE -vec_id END) AS rn, _batch_file = 'held.jsonl' AS fixed FROM v),
r AS (SELECT vec_id, fixed, embedding, label FROM k WHERE rn = 1),
near AS (SELECT DISTINCT a.vec_id FROM r a JOIN r b ON b.fixed AND NOT a.fixed AND a.label = b.label AND list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.93)
SELECT CASE WHEN fixed THEN 'held.jsonl' WHEN vec_id IN (SELECT vec_id FROM near) THEN 'dropped: near a fixed row' ELSE 'train' END AS split, count(*) AS n FROM r GROUP BY 1""")
def curation_run(spark, sf):
    """Last-wins load of two files, one held out, near duplicates of held rows dropped, no test budget; counts by split."""
    e = table(spark, sf, "embeddings")
    rows = e.select(F.col("vec_id").alias("line"), F.concat(F.lit("text "), (F.col("vec_id") / 3).cast("int").cast("string")).alias("source_text"), F.when(F.col("vec_id") % 50 == 7, "held.jsonl").otherwise("batch.jsonl").alias("_batch_file"), F.col("embedding").alias("vector"), F.col("label").cast("string").alias("source_lang"), F.lit("none").alias("category"), F.lit(False).alias("has_subtext"))
    made = curation.curated(rows, ["held.jsonl"], test_share=0.0)
    return made.groupBy("split").agg(F.count("*").alias("n"))


@query("SELECT a.vec_id AS i, b.vec_id AS j, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cos FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id WHERE list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.35")
def near_dup_pairs_banded(spark, sf):
    from corpusloom.operators import vectors_join

    return vectors_join.banded_pairs(table(spark, sf, "embeddings"), "vec_id", "embedding", "label", 0.35, recall=1 - 1e-7, bits=4).withColumn("cos", F.round("cos", 6))


@query()
def mining_run(spark, sf):
    """The whole chain: pool, score (by embeddings and translations of a seam), rank, select under quotas."""
    pairs = X.PAIRS.frame(spark).withColumn("line", F.col("id")).withColumn("film", F.concat(F.lit("f"), F.col("id") % 3)).drop("id")
    pool = mining.pool(mining.judged(pairs), 10, "pool")
    embed = lambda c: F.array(F.lit(1.0), F.lit(0.0))
    scored = mining.scored(pool, embed, lambda c, d: F.upper(c), ["ru-en", "en-ru"], 0.5, 95.0)
    ranked = mining.ranked(scored.withColumn("chrf", F.col("chrf").cast("double")), 0.5, X.IDIOMS)
    return selection.capped_greedy(ranked, [F.col("score").desc(), F.col("source")], 6, 3).select("source", "direction", "kind", "score")


CLASSES = ["none", "idiom", "sarcasm"]
JUDGED = f"(SELECT CASE WHEN id % 2 = 0 THEN 'idiom' ELSE 'none' END AS g, CASE WHEN valid AND truth THEN given ELSE 'none' END AS p FROM {PARSE})"


@query(f"""WITH n AS (SELECT class, (SELECT count(*) FROM {JUDGED} WHERE g = class AND p = class) AS tp, (SELECT count(*) FROM {JUDGED} WHERE g <> class AND p = class) AS fp, (SELECT count(*) FROM {JUDGED} WHERE g = class AND p <> class) AS fn FROM (SELECT unnest({lst(L.CATEGORIES)}) AS class)),
r AS (SELECT class, tp + fn AS support, tp / nullif(tp + fp, 0)::DOUBLE AS pr, tp / nullif(tp + fn, 0)::DOUBLE AS re FROM n)
SELECT 'class ' || class AS name, support AS n, round_even(CASE WHEN pr > 0 AND re > 0 THEN 2 * pr * re / (pr + re) WHEN support > 0 THEN 0.0 END, 4) AS value FROM r
UNION ALL SELECT 'pair ' || g || '->' || p, count(*), NULL FROM {JUDGED} WHERE g <> p GROUP BY g, p""")
def evaluation_run(spark, sf):
    """Replies read from a file, parsed, compared; classes and confusion in one listing."""
    path = shared_path(spark, "replies")
    writers.json_lines(X.REPLIES.frame(spark), path)
    rows = readers.json_lines(spark, path, X.REPLIES.schema).withColumns({"has_subtext": F.col("id") % 2 == 0, "category": F.lit("idiom"), "translation": F.lit("Hi"), "source_lang": F.lit("ru"), "source_text": F.lit("x")})
    made = evaluation.finished(rows)
    classes = made["categories"].select(F.concat(F.lit("class "), "class").alias("name"), F.col("support").alias("n"), F.col("f1").alias("value"))
    return classes.union(made["confusion"].select(F.concat(F.lit("pair "), "pair"), "n", F.lit(None).cast("double")))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN '# Rules' || chr(10) || chr(10) || '## Pending' || chr(10) || chr(10) || '### Proposed: ' || n_name || chr(10) || chr(10) || 'Ask first.' || chr(10) || chr(10) || 'Examples: a; b' || chr(10) || chr(10) || '(none yet)' || chr(10) ELSE '# Rules' || chr(10) || chr(10) || '### Proposed: ' || n_name || chr(10) || chr(10) || 'Ask first.' || chr(10) || chr(10) || 'Examples: a; b' || chr(10) END AS document FROM nation")
def proposed_rules(spark, sf):
    document = F.when(F.col("n_nationkey") % 2 == 0, "# Rules\n\n## Pending\n\n(none yet)\n").otherwise("# Rules\n\n")
    return table(spark, sf, "nation").select("n_nationkey", T.with_proposal(document, F.col("n_name"), F.lit("Ask first."), F.lit(["a", "b"])).alias("document"))


SAID_LINES = X.Inline("id int, text string", ((1, "Мможет быть"), (2, "Ссора и ввод"), (3, "глокая куздра"), (4, "он Ммможет"), (5, ""), (6, "Может глокая"), (7, None)))
KNOWN = ["может", "быть", "ссора", "ввод", "он", "и"]


@query(f"""WITH t AS (SELECT id, unnest(regexp_extract_all(text, '[А-Яа-яЁё]+')) AS t FROM {SAID_LINES.sql()}), k AS (SELECT id, t, NOT list_contains({lst(KNOWN)}, lower(t)) AS odd, length(t) > 2 AND left(t, 1) <> lower(left(t, 1)) AND t[2] = lower(t[1]) AND list_contains({lst(KNOWN)}, t[2:]) AS twice FROM t)
SELECT l.id, CASE WHEN bool_or(odd AND twice) THEN 'doubled_capital' WHEN count(*) FILTER (odd) > 1 THEN 'unknown_words' END AS issue FROM {SAID_LINES.sql('l')} LEFT JOIN k ON k.id = l.id GROUP BY l.id""")
def fluency_issues(spark, sf):
    words = spark.createDataFrame([(w,) for w in KNOWN], "word string")
    return joins.fluency_issues(SAID_LINES.frame(spark), "id", "text", words)


@query("SELECT source, lang, count(*) AS n, round_even(count(*) / sum(count(*)) OVER (PARTITION BY source), 4) AS share FROM documents GROUP BY source, lang")
def audit_shares(spark, sf):
    """The audit of a dataset: each category's share of its source."""
    n = table(spark, sf, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    return n.withColumn("share", reports.share(F.col("n"), F.sum("n").over(Window.partitionBy("source"))))
