"""Extra columns whose names the operators use themselves change nothing, and come back where columns are kept."""

import pytest

from corpusloom.llm import bpe, fingerprints, lines, mixing, nbsvm, near, phrases, rules, suffixes, token_files
from tests.llm.test_tokens import PATH
from tests.llm.util import frame, odd_texts

NAMES = ["id", "th", "bits", "key", "tab", "node", "label", "did", "own", "ctx", "pos", "f", "g", "e", "t", "n", "c", "l", "place", "y", "tie", "spans", "found", "root", "u", "v", "s", "row", "rate", "chunk", "whole", "a", "b", "first", "marks", "body", "runs", "one", "total", "tile", "next_t", "_place", "at", "words"]
TEXTS = odd_texts() + ["a line\nanother line\nthird", "x\na line\nanother line\ny", " ".join(f"w{i}" for i in range(80)), " ".join(f"w{i}" for i in range(80)) + " tail"]


def model(df):
    return nbsvm.fitted(df, df.sparkSession.createDataFrame([(3, 1), (9, 0), (12, 1), (13, 0)], "doc_id bigint, quality int"))


OPERATORS = {
    "op1": lambda df: token_files.read_tokens(df.sparkSession, token_files.write_tokens(df, PATH, 2)),
    "op2": lambda df: suffixes.dedup_substrings(df, 20),
    "op3": lambda df: nbsvm.scores(df, model(df)),
    "op4": near.near_duplicates,
    "op5": lambda df: lines.dedup_lines(df).select("doc_id", "text", "line_stats"),
    "op6": fingerprints.fingerprint_report,
    "op7": lambda df: phrases.dedup_phrases(df, 9),
    "op8": lambda df: mixing.mix(df, epochs=2.0).select("doc_id", "text", "mix_copy", "mix_key"),
    "op9": rules.judge,
    "op10": lambda df: bpe.encode_decode(df, PATH),
    "kept": lambda df: nbsvm.accepted(df, model(df)).select("doc_id", "text"),
    "alike": lambda df: near.representatives(df).select("doc_id", "text"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_names(spark, name):
    df = frame(spark, TEXTS)
    more = df.selectExpr("*", *[f"concat('{n} ', doc_id) as `{n}`" for n in NAMES])
    run = OPERATORS[name]
    rows = lambda d: sorted(map(str, run(d).collect()))
    assert rows(more) == rows(df)


@pytest.mark.parametrize("keep", [lambda d: lines.dedup_lines(d), lambda d: mixing.mix(d, epochs=2.0), lambda d: near.representatives(d), lambda d: nbsvm.accepted(d, model(d))])
def test_kept_columns_have_their_values(spark, keep):
    more = frame(spark, TEXTS).selectExpr("*", *[f"concat('{n} ', doc_id) as `{n}`" for n in NAMES])
    rows = keep(more).collect()
    assert rows and all(r[n] == f"{n} {r.doc_id}" for r in rows for n in NAMES)
    assert list(rows[0].asDict())[: len(more.columns)] == more.columns
