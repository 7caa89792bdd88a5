import hashlib
import random

import xxhash

from corpusloom.llm import fingerprints as fp
from tests.llm.util import WORD, frame, odd_texts

DATA = "/root/testdata/sf0.001/documents.parquet"


def shingles(text):
    w = WORD.findall(text or "")
    return [w[i : i + 5] for i in range(len(w) - 4)] if len(w) >= 5 else [[" ".join(w)]] if w else []


def slow(hashes):
    return sum(1 << b for b in range(64) if sum((h >> b) & 1 for h in hashes) * 2 > len(hashes))


def test_votes_against_brute_force(spark):
    rng = random.Random(1)
    lists = [[], [rng.getrandbits(64) - (1 << 63)], *[[rng.getrandbits(64) - (1 << 63) for _ in range(n)] for n in (2, 3, 254, 255, 256, 600, 3000)]]
    rows = spark.createDataFrame([(i, h) for i, h in enumerate(lists)], "i int, h array<bigint>").select("i", fp.simhash("h").alias("f")).collect()
    for r in rows:
        assert r.f % (1 << 64) == slow([h % (1 << 64) for h in lists[r.i]])


def slow_hash(shingle):
    """XXH64 of the words one after another, each seeded by the hash before it."""
    h = 42
    for w in shingle:
        h = xxhash.xxh64_intdigest(w.encode(), h)
    return h


def test_fingerprints_against_an_independent_hash(spark):
    texts = odd_texts() + [r.text for r in spark.read.parquet(DATA).select("text").collect()][:80]
    df = frame(spark, texts)
    for r in df.select("doc_id", fp.fingerprint(df.text).alias("f")).collect():
        assert r.f % (1 << 64) == slow([slow_hash(s) for s in shingles(texts[r.doc_id])]), texts[r.doc_id]


def test_both_joins_of_the_search_agree(spark, monkeypatch):
    texts = [r.text for r in spark.read.parquet(DATA).select("text").collect()]
    df = frame(spark, texts + texts[:30])
    one = sorted((r.doc_id, r.n_near) for r in fp.fingerprint_report(df).where("n_near is not null").collect())
    monkeypatch.setattr(fp, "SMALL", 0)
    assert one == sorted((r.doc_id, r.n_near) for r in fp.fingerprint_report(df).where("n_near is not null").collect()) and one


def test_report_against_brute_force(spark):
    texts = odd_texts() + [r.text for r in spark.read.parquet(DATA).select("text").collect()]
    ids = [i * 3 - 30 for i in range(len(texts))]
    df = frame(spark, texts, ids)
    got = {r.doc_id: r for r in fp.fingerprint_report(df).collect()}
    prints = {r.doc_id: r.f for r in df.select("doc_id", fp.fingerprint(df.text).alias("f")).collect()}
    for k, i in enumerate(ids):
        t, nxt = texts[k] or "", texts[(k + 1) % len(texts)] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == f"{prints[i] % (1 << 64):016x}"
        nid = ids[(k + 1) % len(ids)]
        bits = lambda a, b: 1 - ((a ^ b) % (1 << 64)).bit_count() / 64
        assert r.near_next == bits(prints[i], prints[nid])
        assert r.near_edited == bits(prints[i], int(r.edited_fingerprint, 16))
        if edited == t:
            assert r.near_edited == 1
        want = sum(((prints[i] ^ prints[j]) % (1 << 64)).bit_count() <= 3 for j in ids if j != i) if i % 20 == 0 else None
        assert r.n_near == want
    assert len(got) == len(ids)


def test_terms_weigh_by_occurrence(spark):
    df = frame(spark, ["one two three four five", "one  two\tthree four five", "a b", "b a", None, ""])
    f = [r.f for r in df.select("doc_id", fp.fingerprint(df.text).alias("f")).orderBy("doc_id").collect()]
    assert f[0] == f[1] != 0 and f[2] != f[3] and f[4] == f[5] == 0


def test_null_and_repeated_ids(spark):
    rows = fp.fingerprint_report(frame(spark, ["abcd", "efgh", "efgh", "x"], [None, 1, 1, 2])).collect()
    assert len(rows) == 4
    (null,) = [r for r in rows if r.doc_id is None]
    assert null.edited_sha256 == hashlib.sha256(b"ab").hexdigest() and null.near_next is None
    assert fp.fingerprint_report(frame(spark, [])).collect() == []
    (alone,) = fp.fingerprint_report(frame(spark, ["abcd"], [9])).collect()
    assert alone.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and alone.near_next == 1
