import sys

import corpus_pipeline
from corpusloom.llm import lines, near
from tests.llm.test_lines import slow_runs
from tests.llm.test_near import slow_similar
from tests.llm.util import frame

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = before, docs
        if name != "bpe":
            assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "near dedup", "source mixing", "bpe"]

    before, after = seen["quality classifier"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in after.collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert len([d for d in good if d in kept]) > 0.9 * len(good) and len(kept) < before.count()

    before, after = seen["line dedup"]
    rows = before.collect()
    assert {r.doc_id: r.text for r in after.collect()} == {i: t for i, (t, _) in slow_runs([r.doc_id for r in rows], [r.text for r in rows]).items()}
    assert all(r.n_chars == len(r.text) for r in after.collect())

    before, after = seen["near dedup"]
    rows = sorted(before.collect())
    groups, edges = slow_similar([r.text for r in rows])
    assert edges and sorted(r.doc_id for r in after.collect()) == [rows[i].doc_id for i in sorted(set(groups))]

    before, after = seen["source mixing"]
    assert {r.doc_id for r in after.collect()} <= {r.doc_id for r in before.collect()} and abs(after.count() - before.count()) < 60
    assert seen["bpe"][1].count() == after.count()
    assert corpus_pipeline.run(spark, SF).count() == after.count()


def test_one_row_of_a_group_stays(spark):
    texts = ["a b c d", "a b c d", "a b c d", "other words here", None, ""]
    df = frame(spark, texts, [3, 2, 2, None, 9, 8]).withColumnRenamed("source", "bits")
    rows = near.representatives(df).collect()
    assert sorted((str(r.doc_id), r.text) for r in rows) == [("2", "a b c d"), ("8", ""), ("None", "other words here")]
    assert rows[0].asDict().keys() == {"doc_id", "text", "lang", "bits", "n_chars"}


def test_entry_imports_without_the_subpackage(monkeypatch):
    import importlib

    monkeypatch.setitem(sys.modules, "corpusloom.llm", None)
    monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    entry = importlib.reload(importlib.import_module("__spark_entry__"))
    assert not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in entry.queries())
    assert lines is not None
    monkeypatch.undo()
    assert "op1_token_files" in importlib.reload(entry).queries()
