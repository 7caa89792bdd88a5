"""Operators on small fixtures, sources and sinks, plans, streaming."""

import json
import math
import zipfile
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import alignment, dedup, gestures, intervals, joins, reports, selection, state, vectors_join, votes
from corpusloom.plans import curation, mining, seams
from corpusloom.sources import readers, writers
from corpusloom.streaming import events


def test_last_wins_keeps_the_protected_row(spark):
    rows = spark.createDataFrame([(1, "A ", False), (2, "a", True), (3, "a", True), (4, "b", False), (5, "B", False)], "line int, t string, held boolean")
    got = {r.line: r.position for r in dedup.last_wins(rows, T.exact_key(F.col("t")), "line", F.col("held")).collect()}
    assert got == {2: 1, 5: 4}


def test_upsert_and_restore_are_null_safe(spark):
    now = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "k string, l string, v int")
    news = spark.createDataFrame([("a", None, 9), ("c", None, None)], "k string, l string, v int")
    assert sorted(map(tuple, dedup.upserted(now, news, ["k", "l"]).collect()), key=str) == [("a", None, 9), ("b", "x", 2), ("c", None, None)]
    saved = spark.createDataFrame([(7, "a", None), (8, "n", None)], "id int, t string, u string")
    assert [r.id for r in dedup.restored(saved.where("id = 7").withColumn("id", F.lit(1)), saved, "id").collect()] == [8]


def test_vote_rules(spark):
    rows = [("s", True, "idiom", 1), ("s", True, "idiom", 2), ("s", False, "none", 3), ("t", True, "idiom", 1), ("t", True, "sarcasm", 2), ("u", None, "none", 2), ("u", True, "idiom", 1), ("v", None, "none", 1)]
    got = {r.s: (r.eligible, r.f, r.category) for r in votes.agreement(spark.createDataFrame(rows, "s string, f boolean, c string, line int"), "s", "f", "c", "line", 0.5).collect()}
    assert got == {"s": (True, True, "idiom"), "t": (False, None, None), "u": (True, True, "idiom"), "v": (True, None, "none")}


def greedy(rows, target, per_group, share, per_label):
    out, keys, groups, labels, n = [], set(), Counter(), Counter(), 0
    for r in rows:
        if len(out) == target:
            break
        if r["key"] in keys or groups[r["grp"]] >= per_group or (r["label"] and labels[r["label"]] >= per_label):
            continue
        if r["bucket"] == "capped":
            if n >= int(target * share):
                continue
            n += 1
        keys.add(r["key"])
        groups[r["grp"]] += 1
        labels[r["label"]] += bool(r["label"])
        out.append(r["at"])
    return out


@pytest.mark.parametrize("seed", range(4))
def test_greedy_selection_equals_the_sequential_rule(spark, seed):
    import random

    rng = random.Random(seed)
    rows = [{"at": i, "key": f"k{rng.randrange(60)}", "grp": f"g{rng.randrange(6)}", "bucket": rng.choice(["capped", "free"]), "label": rng.choice([None, "x", "y"])} for i in range(400)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "at int, key string, grp string, bucket string, label string")
    got = selection.capped_greedy(df.repartition(7), [F.col("at")], 20, 4, 0.3, 6)
    assert sorted(r.at for r in got.collect()) == greedy(rows, 20, 4, 0.3, 6)


def test_group_budget_holds_groups_together(spark):
    rows = spark.createDataFrame([(i, max(i, 1), "ab"[i % 2]) for i in range(40)], "id int, root int, category string")
    taken = selection.group_budget(rows, "root", "category", 0.25, "s").where("is_test")
    sizes = {r.category: r.n for r in taken.groupBy("category").agg(F.sum("size").alias("n")).collect()}
    assert all(4 <= n <= 6 for n in sizes.values()) and set(sizes) == {"a", "b"}


def test_segments_overlaps_and_merges(spark):
    cues = spark.createDataFrame([("f", 0.0, 1.0, "a"), ("f", 1.4, 2.5, "b"), ("f", 5.0, 5.4, "c"), ("f", 8.0, 10.0, "d")], "k string, start double, end double, text string")
    assert [(r.start, r.end, r.text) for r in intervals.bounded_segments(cues, "k").orderBy("start").collect()] == [(0.0, 2.5, "a b"), (8.0, 10.0, "d")]
    segs = spark.createDataFrame([("a", 0.0, 5.0), ("b", 4.0, 7.0), ("a", 6.0, 8.0)], "s string, x double, y double").withColumn("f", F.lit(1))
    assert [(r.x, r.y) for r in intervals.overlaps(segs, ["f"], "s", "x", "y").orderBy("x").collect()] == [(4.0, 5.0), (6.0, 7.0)]
    five = spark.createDataFrame([("a", 0.0, 1.0), ("a", 1.2, 2.0), ("b", 2.1, 3.0), ("a", 2.3, 4.0), ("a", 9.0, 10.0)], "s string, x double, y double")
    assert intervals.gap_islands(five, ["s"], "x", "y", 0.5).count() == 3 and intervals.gap_islands(five, ["s"], "x", "y", 0.0).count() == 5


def test_frames_to_segments(spark):
    frames = spark.range(100).select(F.col("id").alias("frame"), F.explode(F.lit([0, 1])).alias("speaker"))
    on = ((F.col("speaker") == 0) & F.col("frame").between(10, 44) & (F.col("frame") != 20)) | ((F.col("speaker") == 1) & (F.col("frame").between(35, 69) | (F.col("frame") == 90)))
    got = intervals.frame_segments(frames, ["speaker"], "frame", on, 0.1, offset=60.0).orderBy("speaker")
    assert [(r.start, r.end) for r in got.collect()] == [(61.0, 64.5), (63.5, 67.0)]


def test_streaks_and_health(spark):
    rows = spark.createDataFrame([("m", i, o) for i, o in enumerate(["failed", "failed", "refused", "failed", "ok", "failed", "failed"])], "m string, at int, o string")
    got = intervals.failure_streaks(rows, ["m"], ["at"], "o", 3).orderBy("at").collect()
    assert [r.streak for r in got] == [1, 2, 2, 3, 0, 1, 2] and [r.tripped for r in got] == [False] * 3 + [True] * 4
    runs = spark.createDataFrame([("m", 1, True), ("m", 2, True), ("m", 3, False), ("n", 1, True), ("n", 2, False), ("n", 3, True)], "m string, run int, bad boolean")
    health = {r.m: (r.consecutive_bad_runs, r.disabled) for r in state.run_health(runs, "m", "run", "bad").collect()}
    assert health == {"m": (0, True), "n": (1, False)}


def test_use_rules():
    assert state.used(["p"], ["a", "b"], "b", "auto_front", "auto_front", 9, 2) == (["p"], ["b", "a"])
    assert state.used(["p"], ["a", "b"], "c", "auto_front", "auto_front", 9, 2) == (["p"], ["c", "a"])
    assert state.used(["p", "q"], ["a"], "q", "auto_front", "manual_back", 9, 2) == (["q", "p"], ["a"])
    assert state.used([], ["a", "b"], "a", "manual_front", "manual_back", 9, 2) == ([], ["a", "b"])
    assert state.used([], ["a", "b"], "c", "manual_front", "manual_back", 9, 2) == ([], ["b", "c"])


def test_near_pairs_and_tiles(spark, monkeypatch):
    rows = spark.createDataFrame([(0, [1.0, 0.0], "ru"), (1, [0.995, 0.0998749], "ru"), (2, [1.0, 0.0], "en"), (3, None, "ru")], "id int, v array<double>, g string")
    assert [(r.i, r.j) for r in vectors_join.near_pairs(rows, "id", "v", "g", 0.95).collect()] == [(0, 1)]
    counts = {r.id: r.neighbours for r in vectors_join.neighbour_counts(rows, "id", "v", "g", 0.85).collect()}
    assert counts == {0: 1, 1: 1, 2: 0, 3: 0}
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    want = {(r.i, r.j) for r in vectors_join.near_pairs(e, "vec_id", "embedding", "label", 0.3).collect()}
    monkeypatch.setattr(vectors_join, "TILE", 7)
    assert {(r.i, r.j) for r in vectors_join.near_pairs(e, "vec_id", "embedding", "label", 0.3).collect()} == want and len(want) > 20


def test_banding_leaves_dense_classes_to_tiles(spark, monkeypatch):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    want = {(r.i, r.j): r.cos for r in vectors_join.near_pairs(e, "vec_id", "embedding", "label", 0.3).collect()}
    monkeypatch.setattr(vectors_join, "STRIPE", 3)
    few = vectors_join.banded_pairs(e, "vec_id", "embedding", "label", 0.3, recall=0.5, bits=4)  # one bucket in 16: no pair is missed for that
    assert {(r.i, r.j): r.cos for r in few.collect()} == pytest.approx(want) and len(want) > 20
    copies = [(f"c{k}", [1.0, 0.0] if k < 40 else [0.8, 0.6], "copies") for k in range(80)]
    lone = [(f"l{k}", [math.cos(k), math.sin(k)], None) for k in range(3)] + [("m0", [math.cos(0), math.sin(0)], None)]
    rows = spark.createDataFrame(copies + lone, "id string, v array<double>, g string")
    got = [(r.i, r.j) for r in vectors_join.banded_pairs(rows, "id", "v", "g", 0.75, recall=0.01, bits=24).collect()]
    assert len(got) == len(set(got)) == 80 * 79 // 2 + 1 and ("l0", "m0") in got and all(i < j for i, j in got)
    v = np.random.default_rng(5).standard_normal((300, 64))
    v = np.vstack([v, v[:1] + 0.02]) / np.linalg.norm(np.vstack([v, v[:1] + 0.02]), axis=1)[:, None]
    wide = spark.createDataFrame([(k, x.tolist(), "wide") for k, x in enumerate(v)] + [(k, [1.0] + [0.0] * 63, "copies") for k in range(1000, 1050)], "id long, v array<double>, g string")
    want = {(0, 300)} | {(i, j) for i in range(1000, 1050) for j in range(i + 1, 1050)}
    assert {(r.i, r.j) for r in vectors_join.banded_pairs(wide, "id", "v", "g", 0.93).collect()} == want


def test_fuzzy_rekey(spark):
    seeds = spark.createDataFrame([("I’m ready – let’s go",), ("день рождения сегодня вечером",), ("день рождения сегодня вечерам",)], "t string")
    rows = spark.createDataFrame([(1, "I'm ready - let's go"), (2, "ден рождения сегодня вечером"), (3, None), (4, "мимо")], "id int, t string")
    got = {r.id: (r.t, r.echoed) for r in joins.rekeyed(rows, seeds, "t").collect()}
    assert got == {1: ("I’m ready – let’s go", "I'm ready - let's go"), 2: ("ден рождения сегодня вечером", None), 3: (None, None), 4: ("мимо", None)}
    got = {r.id: r.t for r in joins.rekeyed(rows, seeds.where("t not like '%вечерам'"), "t").collect()}
    assert got[2] == "день рождения сегодня вечером"


def test_alike_candidates_hold_every_close_pair(spark):
    import difflib
    import random

    rng = random.Random(6)
    seeds = list({"".join(rng.choice("abcdefghijklmnop ") for _ in range(rng.randrange(1, 60))) for _ in range(120)})
    rows = set()
    for s in seeds:
        t = list(s)
        for _ in range(rng.randrange(3)):
            t[rng.randrange(len(t))] = rng.choice("abcdexyz")
        rows.add("".join(t))
    rows = list(rows)
    frame = lambda texts: spark.createDataFrame([(t,) for t in texts], "t string")
    for ratio in (0.8, 0.95):
        got = {(r.a, r.b) for r in joins.alike_candidates(frame(rows), frame(seeds), "t", ratio).collect()}
        want = {(a, b) for a in rows for b in seeds if a != b and difflib.SequenceMatcher(None, a, b).ratio() >= ratio}
        assert want <= got and len(want) > 20
    assert len(got) < len(rows) * len(seeds) / 4


def test_runs_stop_skip_and_go_on(spark):
    pairs = spark.createDataFrame([(f"s{i}", "m") for i in range(60)], "seed string, model string").coalesce(1).sortWithinPartitions("seed")

    def call(seed, model):
        if seed == "s40":
            raise seams.OutOfCredits("none left")
        if seed in ("s1", "s10", "s11", "s12", "s13"):
            raise ValueError("broken")
        return seed

    by = lambda df: Counter(r.status for r in df.collect())
    got = by(seams.answered(pairs, call, None))
    assert got == {"ok": 30, "failed": 5, "out of credits": 25}  # s0, s1, s10, ... in the order of texts
    assert by(seams.answered(pairs, call, 4))["skipped"] == 55 and by(seams.answered(pairs, call, None, lambda: False)) == {"out of credits": 60}
    first = seams.answered(pairs, call, None)
    after = seams.resumed(pairs.select("seed"), spark.createDataFrame([("m",)], "model string"), first, lambda s, m: "later", None).collect()
    assert len(after) == 60 and Counter(r.reply == "later" for r in after) == {False: 30, True: 30}


def test_mining_run_keeps_its_quotas(spark):
    from corpusloom.queries import queries

    rows = queries()["mining_run"](spark, "/root/testdata/sf0.001").collect()
    assert 0 < len(rows) <= 6 and len({r.source for r in rows}) == len(rows)
    assert {r.kind for r in rows} <= {"rewrite", "local_swap"} and {r.direction for r in rows} <= {"ru-en", "en-ru"}
    assert rows == sorted(rows, key=lambda r: (-r.score, r.source))


def test_lines_are_numbered_over_blocks(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"line {i}\n" for i in range(5000)))
    (tmp_path / "b.txt").write_text("x\n\ny")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000b")
    try:
        got = {(r.file, r.line): r.value for r in readers.numbered_lines(spark, f"{tmp_path}/*.txt").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {("a.txt", i + 1): f"line {i}" for i in range(5000)} | {("b.txt", 1): "x", ("b.txt", 2): "", ("b.txt", 3): "y"}


def test_files_of_several_tasks_are_one_file(spark, tmp_path):
    from corpusloom.queries import queries

    rows = spark.range(90).select(F.col("id").alias("a"))
    for name in ("b 1.v2+ü%20.jsonl", "b_dropped.jsonl"):
        writers.json_lines(rows.repartition(3), f"{tmp_path}/b/{name}")
    (tmp_path / "b" / "part-1.jsonl").write_text('{"a": 90}\n')
    got = readers.final_batches(readers.with_file(readers.json_lines(spark, f"{tmp_path}/b/*.jsonl", "a bigint"))).collect()
    assert sorted((r.a, r._batch_file) for r in got) == [(i, "b 1.v2+ü%20.jsonl") for i in range(90)] + [(90, "part-1.jsonl")]
    rows.repartitionByRange(3, "a").sortWithinPartitions("a").select(F.col("a").cast("string").alias("value")).write.text(f"{tmp_path}/lines.txt")
    lines = readers.numbered_lines(spark, f"{tmp_path}/lines.txt").collect()
    assert sorted((r.line, r.value, r.file) for r in lines) == [(i + 1, str(i), "lines.txt") for i in range(90)]
    made = queries()["final_batches_with_file"](spark, "/root/testdata/sf0.001")
    parts = Counter(f.rsplit("/", 2)[1] for f in made.inputFiles())
    assert parts["batch_1.jsonl"] > 1 and parts["batch_2.jsonl"] > 1  # no task writes a whole batch


def test_alignment(spark):
    ru = spark.createDataFrame([("v", 1.0, 2.0, "a"), ("v", 2.1, 3.0, "b"), ("v", 10.0, 11.0, "c")], "video string, start double, end double, text string")
    en = spark.createDataFrame([("v", 1.0, 3.0, "ab"), ("v", 10.0, 11.0, "c")], "video string, start double, end double, text string")
    like = lambda x, y: 1.0 if x.replace(" ", "") == y.replace(" ", "") else 0.0
    rows = alignment.align(en, ru, like).orderBy("step").collect()
    assert [(r.kind, r.right_ids) for r in rows] == [("1:2", "1+2"), ("1:1", "3")]
    assert {r.text for r in alignment.group_texts(en, "video", 3).collect()} == {"ab", "c", "ab c"}


def test_best_path_is_the_best_of_all_paths():
    """Against a search over all monotonic paths of short tracks; paths of equal score may differ."""
    import functools
    import random

    rng = random.Random(5)

    def track(n, most):
        at, cues = 0.0, []
        for _ in range(n):
            at += rng.choice([0.1, 1.0, 6.0])
            cues.append((at, at + rng.uniform(0.5, 3), rng.choice("abc")))
        return cues

    def like(x, y):
        return len(set(x) & set(y)) / len(set(x) | set(y))

    def gain(left, right, i, j, a, b):
        s, e = max(left[i][0], right[j][0]), min(left[i + a - 1][1], right[j + b - 1][1])
        if e + alignment.SLACK < s:
            return None
        whole = max(left[i + a - 1][1], right[j + b - 1][1]) - min(left[i][0], right[j][0])
        text = lambda cues, k, c: " ".join(x[2] for x in cues[k : k + c])
        return like(text(left, i, a), text(right, j, b)) + alignment.TIME * max(0.0, e - s) / whole - alignment.MERGE * (a + b - 2)

    for _ in range(25):
        left, right = track(rng.randrange(6), 3), track(rng.randrange(7), 5)

        @functools.cache
        def best(i, j, left=tuple(left), right=tuple(right)):
            if (i, j) == (len(left), len(right)):
                return 0.0
            found = []
            if i < len(left):
                found.append(best(i + 1, j) - alignment.SKIP)
            if j < len(right):
                found.append(best(i, j + 1) - alignment.SKIP)
            for a in range(1, min(3, len(left) - i) + 1):
                for b in range(1, min(5, len(right) - j) + 1):
                    if (g := gain(left, right, i, j, a, b)) is not None:
                        found.append(g + best(i + a, j + b))
            return max(found)

        path = alignment.best_path(left, right, like)
        total = sum(gain(left, right, i, j, a, b) if a and b else -alignment.SKIP for i, j, a, b, _ in path)
        assert abs(total - best(0, 0)) < 1e-9
        assert sum(p[2] for p in path) == len(left) and sum(p[3] for p in path) == len(right)


def test_tracks_far_apart_do_not_fit_the_band():
    right = [(300.0 + k, 300.5 + k, "b") for k in range(20)]
    with pytest.raises(ValueError):
        alignment.best_path([(0.0, 1.0, "a"), (1000.0, 1001.0, "c")], right, lambda x, y: 0.0)


def test_reports(spark):
    rows = spark.createDataFrame([(True, True), (True, False), (False, True), (False, False)], "g boolean, p boolean")
    r = reports.detection(rows, F.col("g"), F.col("p")).first()
    assert (r.precision, r.recall, r.false_positive_rate) == (0.5, 0.5, 0.5)
    assert reports.detection(rows.limit(0), F.col("g"), F.col("p")).first().precision is None
    got = {r.language: (r.rows, r.words, r.errors) for r in reports.with_total(spark.createDataFrame([("hi", 10, 2), ("ta", 10, 2), (None, 0, 0)], "language string, w int, e int"), "language", words=F.sum("w"), errors=F.sum("e")).collect()}
    assert got == {"hi": (1, 10, 2), "ta": (1, 10, 2), "unknown": (1, 0, 0), "ALL": (3, 20, 4)}


def test_json_sources_and_sinks(spark, tmp_path):
    (tmp_path / "stage_b_1.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    (tmp_path / "stage_b_prefilter.jsonl").write_text('{"a": 3}\nbroken\n')
    rows = readers.final_batches(readers.with_file(readers.json_lines(spark, str(tmp_path), "a int", strict=False)))
    assert sorted((r.a, r._batch_file) for r in rows.collect()) == [(1, "stage_b_1.jsonl"), (2, "stage_b_1.jsonl")]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        readers.json_lines(spark, str(tmp_path / "stage_b_prefilter.jsonl"), "a int").collect()
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    writers.frozen(df, f"{tmp_path}/test")
    writers.frozen(df.limit(0), f"{tmp_path}/test")
    assert spark.read.json(f"{tmp_path}/test").count() == 2
    writers.routed(df, F.when(F.col("id") == 1, "clean").otherwise("rejects"), f"{tmp_path}/routes")
    assert {r.route for r in spark.read.json(f"{tmp_path}/routes").collect()} == {"clean", "rejects"}
    writers.report(df.agg(F.count("*").alias("n")), f"{tmp_path}/report")
    assert json.loads(spark.read.text(f"{tmp_path}/report").first().value) == {"n": 2}
    assert sorted(map(tuple, writers.with_updates(df, spark.createDataFrame([(2, "z"), (9, "n")], "id int, v string"), "id").collect())) == [(1, "x"), (2, "z")]
    assert [r.id for r in writers.without_ids(df, df.where("id = 1"), "id").collect()] == [2]


def test_zip_lines_subtitles_and_manifest(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "m.zip", "w") as z:
        z.writestr("c.en-ru.ru", "раз\nдва\nтри\n")
        z.writestr("c.en-ru.en", "one\ntwo\n")
        z.writestr("c.en-ru.ids", "en/1999/12/1\tru\nbad\n")
    got = readers.aligned_zip(spark, f"{tmp_path}/m.zip").orderBy("line").collect()
    assert [tuple(r) for r in got] == [(0, "раз", "one", "1999/12"), (1, "два", "two", None)]
    (tmp_path / "a.srt").write_bytes("1\r\n00:00:01,000 --> 00:00:02,500\r\n- Привет\r\n\r\n2\r\n00:00:03,5 --> 00:00:04,000\r\n[шум]\r\n".encode("cp1251"))
    assert [(r.start, r.end, r.text) for r in readers.subtitles(spark, f"{tmp_path}/a.srt").collect()] == [(1.0, 2.5, "Привет")]
    (tmp_path / "m-int4.litertlm").write_bytes(b"abc")
    row = writers.file_manifest(spark, f"{tmp_path}/*.litertlm", T.model_tier(F.col("_metadata.file_name")), "1").first()
    assert (row.tier, row.bytes, row.sha256[:8]) == ("int4", 3, "ba7816bf")
    (tmp_path / "seeds.txt").write_text(" b \n\na\nb\n")
    assert [r.seed for r in readers.seeds(spark, f"{tmp_path}/seeds.txt").orderBy("line").collect()] == ["b", "a", "b"]
    assert [r.seed for r in readers.seeds(spark, f"{tmp_path}/seeds.txt", 2).collect()] == ["b", "a"]
    assert readers.distinct_lines(spark, [f"{tmp_path}/seeds.txt", f"{tmp_path}/none.txt"]).count() == 2
    with pytest.raises(Exception, match="unsafe"):
        readers.manifest_models(spark.createDataFrame([('{"models": [{"tier": "int4", "file": "../x"}]}',)], "raw string"), "raw").collect()


def test_mining_pool_and_ranking(spark):
    pairs = spark.createDataFrame([(1, "- Ну ты и даёшь, приятель!", "Wow, unbelievable, my friend!", "1/1"), (2, "ну ты и даёшь приятель", "Wow, unbelievable, my friend!", "1/1"), (3, "- Раз.\n- Два.", "- One.\n- Two.", "1/1"), (4, "Мне так обидно и тоскливо", "It hurts me so badly", "2/2")], "line int, ru string, en string, film string")
    rows = mining.judged(pairs)
    assert {r.line: r.reason for r in rows.collect()} == {1: None, 2: "duplicate", 3: "multi_speaker", 4: None}
    films = spark.createDataFrame([("2/2",)], "film string")
    assert {r.line: r.reason for r in mining.judged(pairs, films, mining.emotion_lines()).collect()} == {1: "origin", 2: "origin", 3: "origin", 4: None}
    found = mining.scored(mining.pool(rows, 10, "s"), lambda c: F.array(F.lit(1.0), F.lit(0.0)), lambda c, d: F.concat(F.lit("literal "), c), ["ru-en"], 0.5, 60.0)
    best = mining.ranked(found, 0.5, ["ну ты и даешь"]).orderBy(F.col("score").desc()).first()
    assert best.line == 1 and best.idioms == ["ну ты и даешь"] and best.bucket == "capped"


def test_curation_split(spark):
    rows = [(i, "ru", f"text {i}", "idiom" if i % 2 else "none", bool(i % 2), [1.0 if k == i else 0.0 for k in range(45)], "a.jsonl") for i in range(40)]
    rows.append((40, "ru", "near 3", "none", False, [1.0 if k == 3 else 0.0 for k in range(45)], "a.jsonl"))
    rows.append((41, "ru", "held", "none", False, [1.0 if k == 44 else 0.0 for k in range(45)], "held.jsonl"))
    rows.append((42, "ru", "HELD", "none", True, [1.0 if k == 44 else 0.0 for k in range(45)], "b.jsonl"))
    df = spark.createDataFrame(rows, "line int, source_lang string, source_text string, category string, has_subtext boolean, vector array<double>, _batch_file string")
    got = {r.source_text: r.split for r in curation.curated(df, ["held.jsonl"], test_share=0.1).collect()}
    assert got["held"] == "held.jsonl" and "HELD" not in got and got["text 3"] == got["near 3"]
    n = Counter(got.values())
    assert 4 <= n["test"] <= 6 and n["train"] + n["test"] == 41
    frozen = df.where("line = 3").select("source_lang", "source_text", "category", "has_subtext", "vector", "_batch_file", "line")
    again = {r.source_text: r.split for r in curation.curated(df, ["held.jsonl"], frozen).collect()}
    assert again["text 3"] == "test" and again["near 3"].startswith("dropped")


def test_seams(spark):
    def call(prompt, model):
        if model == "bad" or prompt == "x":
            raise ValueError("no")
        return f"{model}:{prompt}"

    rows = spark.createDataFrame([("a",), ("x",)], "seed string").coalesce(1)
    got = sorted(map(tuple, seams.fan_out(rows, ["good", "bad"], call).collect()))
    assert got == [("a", "bad", "failed", "no"), ("a", "good", "ok", "good:a"), ("x", "bad", "failed", "no"), ("x", "good", "failed", "no")]
    log = rows.where("seed = 'a'").select(seams.with_fallback(call, "bad", "good")("seed").alias("l")).first().l
    assert [(t.path, t.reply) for t in log] == [("bad", None), ("bad", None), ("good", "good:a")]


def test_gestures(spark):
    keys = spark.createDataFrame([("a", 0.0, 0.0), ("b", 1.0, 0.0), ("c", 2.0, 0.0)], "letter string, x double, y double")
    words = spark.createDataFrame([("abc", 10), ("ac", 5), ("cá", 5)], "word string, freq int")
    paths = gestures.ideal_paths(words, keys).join(words, "word")
    assert {r.word: [(p.x, p.y) for p in r.points] for r in paths.collect()} == {"abc": [(0, 0), (1, 0), (2, 0)], "ac": [(0, 0), (2, 0)], "cá": [(2, 0), (0, 0)]}
    pts = spark.createDataFrame([(1, i, float(i), 0.0) for i in range(10)], "o int, t int, x double, y double")
    assert [r.t for r in gestures.thinned(pts, "o", "t", 3.0).orderBy("t").collect()] == [0, 3, 6, 9]


def test_streaming_history(spark, tmp_path):
    src = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    src.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(src.schema).parquet(f"{tmp_path}/in")
    q = events.latest_uses(stream, "user_id", "event_type", "ts").writeStream.format("memory").queryName("uses").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    want = {(r.user_id, r.event_type): r.uses for r in state.moved_to_front(src.withColumn("p", F.lit(False)), ["user_id"], ["event_type"], "ts", "p").collect()}
    assert {(r.user_id, r.event_type): r.uses for r in spark.table("uses").collect()} == want
    q = events.deduplicated(stream, ["user_id", "event_type"], "ts", "60 days").writeStream.format("memory").queryName("firsts").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("firsts").count() == len(want)
    q = writers.appended(stream, f"{tmp_path}/out", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.json(f"{tmp_path}/out").count() == src.count()


def test_gesture_thinning_takes_all_users(spark, tmp_path):
    from corpusloom.queries import queries

    rows = [(k, k * 7 % 11, k * 37 % 101 / 1.0) for k in range(1, 200)] + [(300, 4000, 1.0)]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint, value double").write.parquet(f"{tmp_path}/events.parquet")
    last, want = {}, []
    for event, user, value in rows:
        x, y = float(event % 97), value
        if user not in last or (x - last[user][0]) ** 2 + (y - last[user][1]) ** 2 >= 1600:
            last[user] = x, y
            want.append((user, event, x, y))
    got = queries()["gesture_thinning"](spark, str(tmp_path))
    assert sorted(map(tuple, got.select("user_id", "event_id", "x", "y").collect())) == sorted(want) and len(last) == 12
