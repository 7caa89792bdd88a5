import random

from corpusloom.llm import common, lines
from tests.llm.util import frame, odd_texts


def sample(rng, n=80):
    pool = [f"line {i} {rng.random()}" for i in range(60)] + ["", "  "]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 40))) for _ in range(n)]
    for _ in range(n):
        a, b = rng.choice(texts).split("\n"), rng.choice(texts).split("\n")
        i, k = rng.randrange(len(a) + 1), rng.randrange(len(b) + 1)
        texts.append("\n".join(b[:k] + a[i : i + 20] + b[k:]))
    return texts


def slow_runs(ids, texts, least=2):
    """Brute force over contiguous runs of lines, without chunks: lines in any run with ``least`` lines of text that occurred before."""
    docs = [(i, t.split("\n")) for i, t in sorted(zip(ids, texts, strict=True))]
    places, out = {}, {}
    for i, rows in docs:
        gone = set()
        for a in range(len(rows)):
            for b in range(a + 1, len(rows) + 1):
                if sum(bool(x.strip()) for x in rows[a:b]) >= least:
                    old = places.setdefault(tuple(rows[a:b]), (i, b))
                    if old[0] != i or a >= old[1]:
                        gone |= set(range(a, b))
        out[i] = "\n".join(x for k, x in enumerate(rows) if k not in gone), len(gone)
    return out


def test_against_brute_force(spark, monkeypatch):
    texts = sample(random.Random(1), 40) + [t or "" for t in odd_texts()]
    texts += ["hot\nlines\nof\nmany\n" + str(i % 3) for i in range(60)]
    ids = list(range(500, 500 + len(texts)))
    random.Random(2).shuffle(ids)
    df = frame(spark, texts, ids).withColumnRenamed("lang", "chunk").withColumnRenamed("source", "first")
    want = slow_runs(ids, texts)
    for hot in (1000, 15):  # with and without keys that stay where they are
        monkeypatch.setattr(common, "HOT_KEYS", hot)
        got = {r.doc_id: r for r in lines.dedup_lines(df).collect()}
        assert {i: (r.text, r.line_stats.removed_lines) for i, r in got.items()} == want
    assert sum(n for _, n in want.values()) > 300 and list(got[500].asDict()) == [*df.columns, "line_stats"]
    assert sum(r.line_stats.removed_chunks for r in got.values()) > 60


def test_boundaries_withstand_shifts():
    rng = random.Random(4)
    rows = [f"{rng.random()}".encode() for _ in range(400)]
    ends = {b for _, b in lines.chunks(rows, 2, 4, 64)}
    moved = {b - 3 for _, b in lines.chunks([b"x", b"y", b"z", *rows], 2, 4, 64)}
    assert len(ends & moved) > 0.9 * len(ends)
    assert [a for a, _ in lines.chunks(rows, 2, 4, 64)][1:] == [b for _, b in lines.chunks(rows, 2, 4, 64)][:-1]
    assert max(b - a for a, b in lines.chunks([b"same"] * 500, 2, 1 << 30, 64)) <= 64


def test_defined_cases(spark):
    assert lines.dedup_lines(frame(spark, [])).collect() == []
    body = "\n".join(f"row {i}" for i in range(30))
    rows = lines.dedup_lines(frame(spark, [body, body, None, body], [5, 5, 7, None])).collect()
    assert sorted((str(r.doc_id), r.text is not None and len(r.text) > 100) for r in rows) == [("5", True), ("5", True), ("7", False), ("None", False)]
    assert [r.text for r in rows if r.doc_id == 7] == [None]


def test_every_repeated_run_goes(spark):
    texts = sample(random.Random(3), 40) + ["p\nq", "new\np\nq\nold", "x\nx\nx", "x\nx\nx\nx\nx", "k\n\n\nl\n\n", "0\n\nk\n\n\nl\n\n\n1", "\nk\n\n\nl", "r\ns\nr\ns\nr"]
    ids = list(range(len(texts)))
    for least in (2, 3):
        got = {r.doc_id: (r.text, r.line_stats.removed_lines) for r in lines.dedup_lines(frame(spark, texts, ids), min_lines=least).collect()}
        assert got == slow_runs(ids, texts, least)
    assert lines.dedup_lines(frame(spark, [])).collect() == []


def test_op5_query_cuts_a_passage_inside_other_text(spark, tmp_path):
    from corpusloom.llm import queries

    texts = [f"a{k}\nshared one {k}\nshared two {k}\nb{k}" for k in range(20)] + [f"c{k}\nshared one {k}\nshared two {k}\nd{k}" for k in range(20)]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.text for r in queries.op5_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {k: t if k < 20 else f"c{k - 20}\nd{k - 20}" for k, t in enumerate(texts)}


def test_runs_in_defined_cases(spark):
    rows = lines.dedup_lines(frame(spark, ["a\nb\nc", "a\nb\nc", None, "b\nc"], [5, 5, 7, None])).collect()
    assert sorted((str(r.doc_id), r.text) for r in rows if r.doc_id != 7) == [("5", "a\nb\nc"), ("5", "a\nb\nc"), ("None", "")]
    assert [r.text for r in rows if r.doc_id == 7] == [None]
