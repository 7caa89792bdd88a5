"""Inputs that every operator is tried on, and small helpers."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in zip(ids, texts, strict=True)], SCHEMA)


def odd_texts():
    """Null, empty, white space only, odd characters, a very long text, and repeated texts."""
    prose = "The quick brown fox's tail, it's 42 times longer; don't ask.\nCafé ñandú Übergröße ΣΑΣ ﬁne é."
    return [None, "", " \t\n\x0b\x0c\r ", prose, prose, "a b c\u0085d\x1ce", "<|endoftext|>x<|startoftext|> y<|endoftext|>", "日本語テキスト 😀😀 \u0000 zero", "w" * 5000, "word " * 20000 + "end.", "'s't'LL ... !!! $$$ 1234567"]
