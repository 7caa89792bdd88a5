import math
from collections import Counter

import pytest

from corpusloom.llm import mixing
from tests.llm.util import SCHEMA, frame


def source_frame(spark, sizes):
    return spark.createDataFrame([(k * 100000 + i, f"t{i}", "en", s, 1) for k, (s, n) in enumerate(sizes.items()) for i in range(n)], SCHEMA)


def test_shares_meet_the_weights(spark):
    df = source_frame(spark, {"a": 6000, "b": 3000, "c": 300, None: 100})
    got = Counter(r.source for r in mixing.mix(df, {"a": 1, "b": 2, "c": 1, "null": 0}).select("source").collect())
    total = sum(got.values())
    assert abs(total - 9400) < 400 and got[None] == 0
    for s, share in (("a", 0.25), ("b", 0.5), ("c", 0.25)):
        assert abs(got[s] / total - share) < 0.02


def test_counts_are_poisson(spark):
    df = source_frame(spark, {"a": 20000})
    drawn = Counter(Counter(r.doc_id for r in mixing.mix(df, {"a": 1}, epochs=2.0).select("doc_id").collect()).values())
    for k in range(1, 6):
        assert abs(drawn[k] / 20000 - math.exp(-2) * 2**k / math.factorial(k)) < 0.012


def test_same_seed_same_rows_and_high_rates(spark):
    df = source_frame(spark, {"a": 50, "b": 1000})
    one = mixing.mix(df, {"a": 1}, seed="x").collect()
    assert sorted(one) == sorted(mixing.mix(df.repartition(5), {"a": 1}, seed="x").collect())
    assert abs(len(one) - 1050) < 150 and min(Counter(r.doc_id for r in one).values()) >= 8


def test_counts_are_poisson_beyond_the_largest_part(spark):
    """Mean 12 is drawn as two parts of mean 6: mean and variance are 12, shares are those of the distribution."""
    df = source_frame(spark, {"a": 20000})
    drawn = Counter(r.doc_id for r in mixing.mix(df, {"a": 1}, epochs=12.0).select("doc_id").collect())
    counts = [drawn[i] for i in range(20000)]
    mean = sum(counts) / 20000
    variance = sum((c - mean) ** 2 for c in counts) / 20000
    assert abs(mean - 12) < 0.1 and abs(variance - 12) < 0.5
    for k in (6, 10, 12, 15, 20):
        assert abs(counts.count(k) / 20000 - math.exp(-12) * 12**k / math.factorial(k)) < 0.008


def test_defined_cases(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(frame(spark, ["a"]).selectExpr("*", "1 as mix_key"))
    df = spark.createDataFrame([(1, None, "en", None, 1), (2, "b", None, "null", 1), (3, "", "en", "x", None), (3, "", "en", "x", None), (4, "long " * 100_000, "en", "x", 9)], SCHEMA)
    one_row = {r.doc_id: r for r in mixing.mix(df, {None: 1}, epochs=50.0).collect()}
    assert set(one_row) == {1} and one_row[1].text is None and one_row[1].source is None
    assert {r.doc_id for r in mixing.mix(df, {"null": 1}, epochs=50.0).collect()} == {2}
    counts = Counter(r.doc_id for r in mixing.mix(df, {"x": 1}, epochs=10.0).collect())
    assert set(counts) == {3, 4} and counts[3] % 2 == 0


def test_rows_without_id_draw_apart(spark):
    df = frame(spark, [f"t{i}" for i in range(3000)], [None] * 3000)
    drawn = Counter(r.text for r in mixing.mix(df, {"s": 1}).select("text").collect())
    counts = Counter(drawn.get(f"t{i}", 0) for i in range(3000))
    for k in range(4):
        assert abs(counts[k] / 3000 - math.exp(-1) / math.factorial(k)) < 0.04


def test_columns_with_working_names_keep_their_values(spark):
    names = ["row", "own", "s", "n", "sums", "parts", "rate", "u", "w", "mix_u", "mix_n", "mix_source", "mix_fixed", "mix_sums"]
    df = source_frame(spark, {"a": 40}).selectExpr("*", *[f"concat('{x}', doc_id) as {x}" for x in names])
    rows = mixing.mix(df, {"a": 1}, epochs=3.0).collect()
    assert rows and rows[0].asDict().keys() == {*df.columns, "mix_rate", "mix_copy", "mix_key"}
    assert all(r[x] == f"{x}{r.doc_id}" for r in rows for x in names) and all(r.source == "a" and r.mix_rate == 3.0 for r in rows)
