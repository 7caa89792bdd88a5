import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import common, phrases, repeats, suffixes
from tests.llm.util import frame, odd_texts

DATA = "/root/testdata/sf0.001/documents.parquet"


def covered(sequences, length):
    """Brute force: for each sequence, which of its symbols are covered by a window that starts elsewhere too."""
    count = Counter(s[i : i + length] for s in sequences for i in range(len(s) - length + 1))
    out = []
    for s in sequences:
        flags = [False] * len(s)
        for i in range(len(s) - length + 1):
            if count[s[i : i + length]] > 1:
                flags[i : i + length] = [True] * length
        out.append(flags)
    return out


def byte_rows(texts, length):
    data = [(t or "").encode() for t in texts]
    for d, flags in zip(data, covered(data, length), strict=True):
        kept = bytes(b for b, f in zip(d, flags, strict=True) if not f)
        spans = sum(f and not (i and flags[i - 1]) for i, f in enumerate(flags))
        yield len(d), sum(flags), spans, hashlib.sha256(kept).hexdigest()


def word_rows(texts, length):
    data = [tuple((t or "").encode().split()) for t in texts]
    for d, flags in zip(data, covered(data, length), strict=True):
        kept = b" ".join(w for w, f in zip(d, flags, strict=True) if not f)
        yield len(d), sum(flags), hashlib.sha256(kept).hexdigest()


def tangled(rng, n, words=6):
    """Short texts over a small vocabulary, with copies, cut copies and shared passages."""
    vocab = ["ab", "c", "Def", "é", "ghij", "k"][:words] + [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 120))) for _ in range(n)]
    for _ in range(n // 2):
        a, b = rng.choice(texts), rng.choice(texts)
        i, j = sorted(rng.randrange(len(a) + 1) for _ in range(2))
        k = rng.randrange(len(b) + 1)
        texts.append(b[:k] + a[i:j] + b[k:])
    return [*texts, "aaaa " * 60, "aaaa " * 61, "x" * 500, None, "", texts[0], texts[0]]


def test_bucket_pointers_equal_brute_force(monkeypatch):
    rng = random.Random(3)
    for length in (1, 5, 8, 9, 16, 30, 100):
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 200))) for _ in range(15)]
        parts += [parts[0], parts[1][20:150], b"a" * 150, b"\0" * 40 + b"ab", b"b\0\0a" * 30, b"\0" * 33, b"b\0\0"]
        weights = [rng.choice([1, 2]) for _ in parts]
        count = Counter()
        for p, w in zip(parts, weights, strict=True):
            for i in range(len(p) - length + 1):
                count[p[i : i + length]] += w
        for q, some in ((8, 1 << 16), (2, 50)):
            monkeypatch.setattr(suffixes, "GRAM", q)
            monkeypatch.setattr(suffixes, "RANGE", some)
            classes, n = suffixes.solve(parts, weights, length)
            names = {}
            for p, found in zip(parts, classes, strict=True):
                windows = [p[i : i + length] for i in range(len(p) - length + 1)]
                assert n[found].tolist() == [count[w] for w in windows]
                assert all(names.setdefault(w, c) == c for w, c in zip(windows, found.tolist(), strict=True))


def test_contexts_depend_on_the_window_alone(monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, 3000).astype(np.uint64) + np.uint64(1)
    lo, hi, at, _ = repeats.contexts(x, 50, 10)
    assert lo[0] == 0 and hi[-1] == len(x) - 50 and (lo[1:] == hi[:-1] + 1).all()
    anchor = np.repeat(at, hi - lo + 1) - np.arange(len(x) - 49)
    assert ((anchor >= 0) & (anchor <= 40)).all()
    for i in (0, 17, 400, 2950):
        assert repeats.contexts(x[i : i + 50], 50, 10)[2][0] == anchor[i]
    monkeypatch.setattr(repeats, "PIECE", 700)
    lo, hi, at, _ = repeats.contexts(x, 50, 10)
    assert (np.repeat(at, hi - lo + 1) - np.arange(len(x) - 49) == anchor).all()


@pytest.mark.parametrize("cell", [repeats.CELL, 5000, 300])
def test_both_against_brute_force(spark, monkeypatch, cell):
    """With small cells anchors are split over many of them; with one hot key in three rows and few hot keys, joins take both ways."""
    monkeypatch.setattr(repeats, "CELL", cell)
    monkeypatch.setattr(common, "HOT_KEYS", 1000 if cell > 300 else 20)
    texts = tangled(random.Random(cell), 60)
    ids = [None if i == 4 else i % 40 for i in range(len(texts))]
    df = frame(spark, texts, ids).withColumnRenamed("source", "spans").withColumnRenamed("lang", "key")
    for length in (20, 64):
        rows = suffixes.dedup_substrings(df, length, with_text=True).collect()
        want = sorted((str(i), *r) for i, r in zip(ids, byte_rows(texts, length), strict=True))
        assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == want
        assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in rows)
    rows = phrases.dedup_phrases(df, 9).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in rows) == sorted((str(i), *r) for i, r in zip(ids, word_rows(texts, 9), strict=True))


def test_blocks_of_windows_are_found_from_the_window_alone():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 3, 2000).astype(np.uint64) + np.uint64(1)
    lo, hi, at, _ = repeats.contexts(x, 50, 10)
    anchor = np.repeat(at, hi - lo + 1) - np.arange(len(x) - 49)
    for width in (1, 6, 41):
        first, last, a, b, block = repeats.blocks_of(lo, hi, at, width, 50)
        windows = np.concatenate([np.arange(i, j + 1) for i, j in zip(first, last, strict=True)])
        assert sorted(windows) == list(range(len(x) - 49))
        assert (np.repeat(block, last - first + 1) == anchor[windows] // width).all()
        assert (a >= last).all() and (b <= first + 50).all() and (b - a == 51 - width).all()


@pytest.mark.parametrize("kind", ["bytes", "words"])
def test_a_common_passage_leaves_no_row_for_each_window(spark, monkeypatch, kind):
    """One passage in 400 texts, and near copies of it: more text than a cell at each of its anchors, yet few rows leave the cells."""
    monkeypatch.setattr(repeats, "CELL", 4000)
    rng = random.Random(8)
    words = lambda n: [f"{rng.randrange(10**5)}" for _ in range(n)]
    common = words(40)
    texts = [" ".join(words(30) + common + words(30)) for _ in range(400)]
    texts += [" ".join(common[:i] + words(1) + common[i + 1 :]) for i in range(40) for _ in range(5)]
    made, write = {"scan": 0, "found": 0}, repeats.written

    def counted(df, name):
        out = write(df, name)
        if name in made:
            made[name] = max(made[name], out.count())
        return out

    monkeypatch.setattr(repeats, "written", counted)
    df = frame(spark, texts)
    if kind == "bytes":
        rows = suffixes.dedup_substrings(df, 100).collect()
        assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == [(i, *r) for i, r in enumerate(byte_rows(texts, 100))]
    else:
        rows = phrases.dedup_phrases(df, 20).collect()
        assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows) == [(i, *r) for i, r in enumerate(word_rows(texts, 20))]
    assert made["found"] < made["scan"] / 2


def test_contract_lengths_on_documents(spark):
    texts = odd_texts() + [r.text for r in spark.read.parquet(DATA).select("text").orderBy("doc_id").collect()][:120]
    rows = suffixes.dedup_substrings(frame(spark, texts)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == [(i, *r) for i, r in enumerate(byte_rows(texts, 400))]
    rows = phrases.dedup_phrases(frame(spark, texts)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows) == [(i, *r) for i, r in enumerate(word_rows(texts, 35))]


def test_empty_tables(spark):
    assert suffixes.dedup_substrings(frame(spark, [])).collect() == []
    assert phrases.dedup_phrases(frame(spark, [])).collect() == []


def test_texts_without_id_whose_short_hashes_collide(spark):
    shared = "one two three four five six seven eight nine ten"
    texts = [f"a8733 {shared}", f"x y z b43166 {shared} tail"]
    df = frame(spark, texts, [None, None])
    assert df.selectExpr("hash(text) as h").distinct().count() == 1
    rows = phrases.dedup_phrases(df, 9).collect()
    assert sorted((r.n_words, r.n_removed, r.kept_sha256) for r in rows) == sorted(word_rows(texts, 9))
    rows = suffixes.dedup_substrings(df, 20).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == sorted(byte_rows(texts, 20))


def test_automata_locate_what_the_dictionary_has(monkeypatch):
    texts = [b"a b c d e", b"x a b c a b", b"", b"c d e c d"]
    flags = phrases.located(texts, {b"a b c", b"c d"})
    assert [f.astype(int).tolist() for f in flags] == [[1, 1, 1, 1, 0], [0, 1, 1, 1, 0, 0], [], [1, 1, 0, 1, 1]]
    assert not any(f.any() for f in phrases.located(texts, set()))
    many = b" ".join(b"w%d" % i for i in range(200))
    monkeypatch.setattr(phrases, "CHARACTERS", 100)  # words of two characters
    monkeypatch.setattr(phrases, "PAIR", 7)
    (flags,) = phrases.located([b"x " + many + b" y w3 w4"], {many, b"w3 w4"})
    assert flags.tolist() == [False, *[True] * 200, False, True, True]


def test_many_rows_without_id(spark):
    """100,000 rows without an id and one with the id -1: only true repeats go."""
    texts = [f"w{i} alpha beta gamma delta epsilon zeta eta theta iota {i * 7}" for i in range(100_000)]
    both = " ".join(f"z{i}" for i in range(40))
    texts[5], texts[77_777] = f"{both} one", f"two {both}"
    rows = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("cast(null as bigint) doc_id", "text").union(spark.createDataFrame([(-1, f"minus {both}")], "doc_id bigint, text string"))
    got = {r.n_removed: r["count"] for r in phrases.dedup_phrases(rows).groupBy("n_removed").count().collect()}
    assert got == {0: len(texts) - 2, 40: 3}
