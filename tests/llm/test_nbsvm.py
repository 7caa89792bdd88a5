import random
import zlib

import numpy as np

from corpusloom.llm import nbsvm, queries
from tests.llm.util import frame, odd_texts

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_on_documents(spark):
    rows = queries.op3_quality_classifier(spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    asked = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(asked) > 50 and sum(r.predicted == labels[r.doc_id] for r in asked) / len(asked) > 0.93


def test_descent_meets_the_optimum_of_the_hinge_loss():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 30, 8)).astype(np.int32) for _ in range(80)]
    y = np.where([3 in r or 7 in r for r in rows], 1, -1)
    values = [np.ones(len(r)) for r in rows]
    w = nbsvm.descend(rows, values, y, 1.0, 2000)
    loss = lambda w: (w @ w) / 2 + sum(max(0, 1 - k * (w[r].sum() + w[-1])) for r, k in zip(rows, y, strict=True))
    best = loss(w)
    for _ in range(300):
        other = w.copy()
        other[[*range(30), -1]] += rng.normal(0, 0.02, 31)
        assert loss(other) >= best - 1e-3


M = (1 << 64) - 1


def slow_grams(text):
    """Slots of a text's n-grams, one at a time."""
    import re

    import xxhash

    def shape(w):
        for pattern, by in ((rb"[A-Z]", b"X"), (rb"[a-z]", b"x"), (rb"[0-9]", b"d"), (rb"[\x80-\xff]+", b"u")):
            w = re.sub(pattern, by, w)
        return re.sub(rb"(?s)(.)\1+", rb"\1+", w)[:24]

    words = (text or "").encode().split()
    w = [xxhash.xxh3_64_intdigest(x.lower()) for x in words]
    s = [(xxhash.xxh3_64_intdigest(shape(x), 7) + (0x51ED270B if i and w[i] == w[i - 1] else 0)) & M for i, x in enumerate(words)]
    a, b = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
    found = {x * a & M for x in w} | {(x ^ b) * a & M for x in s}
    found |= {(x * b + y) * a & M for x, y in zip(w, w[1:], strict=False)}
    pairs = [(x * a + y * b) & M for x, y in zip(s, s[1:], strict=False)]
    found |= {p * a & M for p in pairs} | {((p * b + z) * b) & M for p, z in zip(pairs, s[2:], strict=False)}
    return {x >> 64 - nbsvm.BITS for x in found}


def test_scores_of_the_query_against_brute_force(spark):
    """Log-count ratios, the scaled margin and the curve in plain Python, from the labelled rows outside the held-out fold."""
    import math

    small = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.doc_id in texts}
    docs = queries.documents(spark, small)
    frame_of = spark.createDataFrame(list(labels.items()), "doc_id bigint, quality int")
    model = nbsvm.fitted(docs, frame_of)
    up, down = {}, {}
    for d, q in labels.items():
        for g in slow_grams(texts[d]):
            counts = up if q == 1 else down
            counts[g] = counts.get(g, 0) + 1
    slots = 1 << nbsvm.BITS
    all_up, all_down = sum(up.values()) + slots, sum(down.values()) + slots
    r = lambda g: math.log((up.get(g, 0) + 1) / all_up) - math.log((down.get(g, 0) + 1) / all_down)
    seen = sorted({*up, *down})
    assert np.allclose(model["r"][seen], [r(g) for g in seen], atol=1e-5)
    got = {x.doc_id: x.score for x in queries.op3_quality_classifier(spark, small).collect()}
    assert got.keys() == texts.keys()
    for d, t in texts.items():
        grams = slow_grams(t)
        norm = math.sqrt(sum(r(g) ** 2 for g in grams)) or 1
        margin = sum(r(g) * float(model["w"][g]) for g in grams) / norm + float(model["w"][-1])
        assert abs(got[d] - 1 / (1 + math.exp(-(model["a"] * margin + model["b"])))) < 1e-3


def test_defined_cases(spark):
    df = frame(spark, odd_texts())
    labels = spark.createDataFrame([(3, 1), (3, 0), (None, 1), (99, 1), (4, None)], "doc_id bigint, quality int")
    assert {r.score for r in nbsvm.scores(df, nbsvm.fitted(df, labels)).collect()} == {0.5}
    labels = spark.createDataFrame([(3, 1), (4, 1)], "doc_id bigint, quality int")
    assert {round(r.score, 6) for r in nbsvm.scores(df, nbsvm.fitted(df, labels)).collect()} == {0.75}
    assert nbsvm.scores(frame(spark, []), nbsvm.train([], [], nbsvm.Fit())).collect() == []


def test_accepted_keeps_all_columns_and_the_sample_is_bounded(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefgh") * 3 + ("!!" if i % 2 else "") for _ in range(60)) for i in range(300)]
    df = frame(spark, texts)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(300)], "doc_id bigint, quality int")
    model = nbsvm.fitted(df, labels, fit=nbsvm.Fit(max_rows=50))
    kept = nbsvm.accepted(df, model)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == set(range(0, 300, 2))
