"""Interval, gap and streak operators over ``events`` and inline segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom import fixtures as X
from corpusloom.operators import alignment, intervals, joins, state
from corpusloom.registry import query, table

SECONDS = "epoch(ts)::DOUBLE"
EV = f"(SELECT event_id, user_id, event_type, value, {SECONDS} AS s, {SECONDS} + 600 AS e FROM events) ev"
ISLANDS = """
, fresh AS (SELECT *, CASE WHEN s - max(e) OVER (PARTITION BY {k} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) < {gap} THEN 0 ELSE 1 END AS f FROM {src}),
marked AS (SELECT *, sum(f) OVER (PARTITION BY {k} ORDER BY s, e ROWS UNBOUNDED PRECEDING)::BIGINT AS island FROM fresh)"""


def events(spark, sf):
    ts = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    return table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", ts.alias("s"), (ts + 600).alias("e"))


@query(f"WITH src AS (SELECT * FROM {EV})" + ISLANDS.format(k="user_id", gap="3600", src="src") + " SELECT user_id, island, min(s) AS s, max(e) AS e, count(*) AS parts FROM marked GROUP BY 1, 2")
def user_gap_islands(spark, sf):
    return intervals.gap_islands(events(spark, sf), ["user_id"], "s", "e", 3600.0)


@query(f"WITH src AS (SELECT * FROM {X.SEGMENTS.sql()})" + ISLANDS.format(k="film, speaker", gap="0.5", src="src") + " SELECT film, speaker, island, min(s) AS s, max(e) AS e, count(*) AS parts FROM marked GROUP BY 1, 2, 3")
def speaker_merge(spark, sf):
    return intervals.gap_islands(X.SEGMENTS.frame(spark), ["film", "speaker"], "s", "e", 0.5)


@query(f"""
WITH p AS (SELECT film, t FROM (SELECT film, s AS t FROM {X.SEGMENTS.sql()} UNION SELECT film, e FROM {X.SEGMENTS.sql()})),
c AS (SELECT film, t AS s, lead(t) OVER (PARTITION BY film ORDER BY t) AS e FROM p),
b AS (SELECT c.film, c.s, c.e FROM c JOIN {X.SEGMENTS.sql('g')} ON g.film = c.film AND g.s < c.e AND g.e > c.s GROUP BY ALL HAVING count(DISTINCT speaker) >= 2),
m AS (SELECT *, sum(CASE WHEN s = pe THEN 0 ELSE 1 END) OVER (PARTITION BY film ORDER BY s) AS i FROM (SELECT *, lag(e) OVER (PARTITION BY film ORDER BY s) AS pe FROM b))
SELECT film, min(s) AS s, max(e) AS e FROM m GROUP BY film, i""")
def overlap_sweep(spark, sf):
    return intervals.overlaps(X.SEGMENTS.frame(spark), ["film"], "speaker", "s", "e")


@query(f"""
WITH w AS (SELECT user_id, s AS ws, s + 1800 AS we FROM {EV} WHERE event_type = 'purchase'), c AS (SELECT event_id, user_id, s, e FROM {EV} WHERE event_type = 'view')
SELECT c.event_id, w.ws AS w_start FROM c JOIN w USING (user_id) WHERE c.e > w.ws AND c.s < w.we AND (least(c.e, w.we) - greatest(c.s, w.ws)) / greatest(1e-6, c.e - c.s) >= 0.5""")
def interval_cover_join(spark, sf):
    e = events(spark, sf)
    cues = e.where("event_type = 'view'").select("event_id", "user_id", F.col("s").alias("start"), F.col("e").alias("end"))
    windows = e.where("event_type = 'purchase'").select("user_id", F.col("s").alias("w_start"), (F.col("s") + 1800).alias("w_end"))
    return joins.covered_by_windows(cues, windows, ["user_id"], 1800.0).select("event_id", "w_start")


@query()
def bounded_segments(spark, sf):
    return intervals.bounded_segments(X.CUES.frame(spark).withColumnsRenamed({"s": "start", "e": "end"}), "film")


HOLES = X.Inline("id int, a double, b double, h1 double, h2 double, h3 double, h4 double", ((1, 0.0, 10.0, 2.0, 3.0, 8.0, 12.0), (2, 0.0, 10.0, -1.0, 11.0, 3.0, 4.0), (3, 5.0, 6.0, 0.0, 5.0, 6.0, 7.0), (4, 0.0, 4.0, 1.0, 2.0, 2.0, 3.0)))


@query(f"""
WITH p AS (SELECT id, t FROM (SELECT id, unnest([a, b, h1, h2, h3, h4]) AS t, a, b FROM {HOLES.sql()}) WHERE t BETWEEN a AND b GROUP BY ALL),
c AS (SELECT id, t AS x, lead(t) OVER (PARTITION BY id ORDER BY t) AS y FROM p),
k AS (SELECT c.id, x, y FROM c JOIN {HOLES.sql('h')} ON h.id = c.id WHERE y IS NOT NULL AND NOT (h1 < y AND h2 > x) AND NOT (h3 < y AND h4 > x)),
m AS (SELECT *, sum(CASE WHEN x = py THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY x) AS i FROM (SELECT *, lag(y) OVER (PARTITION BY id ORDER BY x) AS py FROM k))
SELECT id, min(x) AS a, max(y) AS b FROM m GROUP BY id, i""")
def interval_difference(spark, sf):
    hole = lambda p, q: F.struct(F.col(p).alias("a"), F.col(q).alias("b"))
    rows = HOLES.frame(spark).select("id", F.explode(intervals.difference(F.col("a"), F.col("b"), F.array(hole("h1", "h2"), hole("h3", "h4")))).alias("p"))
    return rows.select("id", "p.a", "p.b")


@query(f"SELECT event_id, s + i * (e - s) / n AS a, s + (i + 1) * (e - s) / n AS b FROM (SELECT event_id, s, s + value AS e, greatest(1, ceil(value / 25.0))::INT AS n, unnest(range(n)) AS i FROM {EV})")
def split_long(spark, sf):
    return events(spark, sf).select("event_id", F.explode(intervals.equal_parts(F.col("s"), F.col("s") + F.col("value"), 25.0)).alias("p")).select("event_id", F.col("p.a").alias("a"), F.col("p.b").alias("b"))


@query()
def chunk_spans(spark, sf):
    rows = spark.createDataFrame([(0.0,), (50.0,), (600.0,), (630.0,), (700.0,), (1200.5,)], "total double")
    return rows.select("total", F.explode_outer(intervals.tumbling_chunks(F.col("total"), 300.0)).alias("c")).select("total", "c.*")


@query()
def frame_segments(spark, sf):
    frames = spark.range(100).select(F.col("id").alias("frame"), F.explode(F.lit(["s0", "s1"])).alias("speaker"))
    on = ((F.col("speaker") == "s0") & (F.col("frame").between(10, 44)) & (F.col("frame") != 20)) | ((F.col("speaker") == "s1") & (F.col("frame").between(35, 69) | (F.col("frame") == 90)))
    return intervals.frame_segments(frames, ["speaker"], "frame", on, 0.1, offset=60.0)


@query("""
WITH o AS (SELECT event_id, user_id, ts, CASE event_type WHEN 'purchase' THEN 'ok' WHEN 'error' THEN 'failed' WHEN 'view' THEN 'failed' ELSE 'refused' END AS outcome FROM events),
r AS (SELECT *, sum((outcome = 'ok')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM o),
s AS (SELECT *, sum((outcome = 'failed')::INT) OVER (PARTITION BY user_id, run ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS streak FROM r)
SELECT event_id, streak, bool_or(streak >= 4) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS tripped FROM s""")
def failure_streak(spark, sf):
    outcome = F.when(F.col("event_type") == "purchase", "ok").when(F.col("event_type").isin("error", "view"), "failed").otherwise("refused")
    rows = table(spark, sf, "events").withColumn("outcome", outcome)
    return intervals.failure_streaks(rows, ["user_id"], ["ts", "event_id"], "outcome").select("event_id", "streak", "tripped")


@query()
def alignment_group_texts(spark, sf):
    return alignment.group_texts(X.CUES.frame(spark).withColumnsRenamed({"s": "start", "e": "end"}), "film", 3)


@query()
def monotonic_align(spark, sf):
    import difflib

    cues = X.CUES.frame(spark).select(F.col("film").alias("video"), F.col("s").alias("start"), F.col("e").alias("end"), "text")
    other = cues.withColumns({"start": F.col("start") + 0.2, "text": F.upper("text")}).where("text <> 'BLIP'")
    return alignment.align(cues, other, lambda a, b: difflib.SequenceMatcher(None, a.lower(), b.lower()).ratio())


@query("SELECT event_id, user_id, event_type FROM events QUALIFY lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS DISTINCT FROM event_type")
def consecutive_changes(spark, sf):
    return state.changes(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "user_id", "event_type")
