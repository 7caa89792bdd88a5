import random
import re

import numpy as np
import pytest
import xxhash

from corpusloom.llm import components, near
from tests.llm.util import frame, odd_texts

DATA = "/root/testdata/sf0.001/documents.parquet"


def slow_fingerprint(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def slow_components(ids, prints, radius=3):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


def near_values(rng, n, families):
    """Random fingerprints and chains of neighbours around some of them."""
    out = {rng.getrandbits(64) for _ in range(n)}
    for size in families:
        x = rng.getrandbits(64)
        for _ in range(size):
            out.add(x)
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4])):
                x ^= 1 << b
    return sorted(out)


@pytest.mark.parametrize("radius", [1, 2, 3, 5])
def test_bit_sliced_links_equal_all_pairs(radius):
    rng = random.Random(radius)
    v = near_values(rng, 60, [40, 7, 3, 2])
    values, bucket = np.array(v, np.uint64), np.sort(np.array([rng.randrange(3) for _ in v]))
    i, j = near.linked(values, bucket, radius)
    label = np.arange(len(v))
    near.joined_labels(label, i, j)
    want = np.arange(len(v))
    pairs = [(a, b) for a in range(len(v)) for b in range(a) if bucket[a] == bucket[b] and (v[a] ^ v[b]).bit_count() <= radius]
    near.joined_labels(want, np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int))
    assert (label == want).all()


def test_links_between_groups_only():
    rng = random.Random(8)
    v = near_values(rng, 30, [40, 20])
    values, bucket = np.array(v, np.uint64), np.zeros(len(v), int)
    group = np.array([rng.randrange(4) * 10 for _ in v])
    near_pairs = {(b, a) for a in range(len(v)) for b in range(a) if group[a] != group[b] and (v[a] ^ v[b]).bit_count() <= 3}
    i, j = near.linked(values, bucket, 3, None, group)
    of = lambda edges: slow_groups(4, [(group[a] // 10, group[b] // 10) for a, b in edges])
    assert {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist(), strict=True)} <= near_pairs
    assert of(zip(i, j, strict=True)) == of(near_pairs)
    even = {(a, b) for a, b in near_pairs if (a + b) % 2 == 0}
    i, j = near.linked(values, bucket, 3, None, group, lambda i, j: (i + j) % 2 == 0)
    assert of(zip(i, j, strict=True)) == of(even) and (i + j).sum() % 2 == 0


def slow_groups(n, edges):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def slow_similar(texts, least=0.8, size=5):
    """Groups (smallest position) by all pairs of texts whose five-word shingles have a Jaccard similarity of 0.8."""
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set())
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    edges = []
    for x, i in enumerate(order):
        for j in order[x + 1 :]:
            if len(sets[i]) < least * len(sets[j]):
                break
            common = len(sets[i] & sets[j])
            if common >= least * (len(sets[i]) + len(sets[j]) - common):
                edges.append((i, j))
    return slow_groups(len(texts), edges), edges


def edited(rng, text, share):
    words = text.split(" ")
    for _ in range(max(1, int(len(words) * share))):
        words[rng.randrange(len(words))] = f"z{rng.random()}"
    return " ".join(words)


@pytest.mark.parametrize("shingles", [near.SHINGLES, 3000])
def test_groups_of_similar_texts_against_all_pairs(spark, monkeypatch, shingles):
    """Recall of linked pairs is at least 0.9, and no two texts are joined that links do not connect; with small cells, groups lie in several tiles."""
    monkeypatch.setattr(near, "SHINGLES", shingles)
    rng = random.Random(11)
    texts = odd_texts() + [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").orderBy("doc_id").collect()]
    bases = [t for t in texts if t and 60 < len(t.split(" ")) < 400][:60]
    texts += [edited(rng, b, rng.choice([0.004, 0.01, 0.02, 0.03])) for b in bases for _ in range(3)]
    texts += [edited(rng, bases[0], 0.012) for _ in range(120)]  # one group of many near copies
    want, edges = slow_similar(texts)
    rows = near.similar(frame(spark, texts)).collect()
    of = {r.node: r.root for r in rows}
    nodes = [r[0] for r in frame(spark, texts).selectExpr("doc_id", "xxhash64(coalesce(text, '')) n").orderBy("doc_id").select("n").collect()]
    assert set(of) == set(nodes)
    got = [of[n] for n in nodes]
    found = sum(got[a] == got[b] for a, b in edges)
    assert len(edges) > 2000 and found >= 0.9 * len(edges)
    pairs = [(a, b) for a, b in edges if a >= len(texts) - 120 or texts[a] != texts[b]]
    assert sum(got[a] == got[b] for a, b in pairs) >= 0.9 * len(pairs)
    assert all(len({want[i] for i in range(len(texts)) if got[i] == g}) == 1 for g in set(got))


def test_links_and_tiles(spark, monkeypatch):
    rng = random.Random(5)
    v = near_values(rng, 300, [200, 50, 9, 2, 2])
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in v], "bits bigint")
    want = slow_components(list(range(len(v))), v)
    for tile in (near.TILE, 16):
        monkeypatch.setattr(near, "TILE", tile)
        roots = {r.node % (1 << 64): r.root % (1 << 64) for r in components.components(near.links(df)).collect()}
        groups = {}
        for x, c in zip(v, want, strict=True):
            groups.setdefault(c, set()).add(x)
        for g in groups.values():
            assert len({roots.get(x, x) for x in g}) == 1
        assert len({roots.get(x, x) for x in v}) == len(groups)


def test_near_duplicates_against_brute_force(spark):
    texts = odd_texts() + [r.text for r in spark.read.parquet(DATA).select("text").collect()]
    texts += [t.replace("e", "E", 3) for t in texts[20:40]] + [t + " tail" for t in texts[40:60]]
    ids = [None if i == 3 else 1000 - i for i in range(len(texts))]
    rows = near.near_duplicates(frame(spark, texts, ids)).collect()
    prints = [slow_fingerprint(t) for t in texts]
    want = sorted(zip([str(i) for i in ids], [f"{p:016x}" for p in prints], slow_components(ids, prints), strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in rows) == want


def test_empty_and_alone(spark):
    assert near.near_duplicates(frame(spark, [])).collect() == []
    (row,) = near.near_duplicates(frame(spark, ["only one"], [7])).collect()
    assert row.component_id == 7
    assert [r.component_id for r in near.near_duplicates(frame(spark, ["", None, " "], [5, 4, 9])).collect()] == [4, 4, 4]


def test_long_chain_of_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 2000), (5, 5)], "u bigint, v bigint")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 2000: 1000}
