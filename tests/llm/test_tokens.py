import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusloom.llm import bpe, token_files
from tests.llm.util import frame, odd_texts

PATH = public_tokenizers.path("word_bpe_49k.json")
DATA = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_bpe_equals_the_library(spark, library):
    texts = odd_texts() + [r.text for r in spark.read.parquet(DATA).select("text").collect()]
    rows = bpe.encode_decode(frame(spark, texts).repartition(3), PATH, with_texts=True).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids, text = expected(library, texts[r.doc_id])
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.decoded == text
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_on_an_empty_table(spark):
    assert bpe.encode_decode(frame(spark, []), PATH).collect() == []


def test_pair_index_updates_lists_across_pieces():
    vocab = {s: i for i, s in enumerate(["a", "b", "a</w>", "b</w>", "ab", "abab", "ab</w>"])}
    index = bpe.PairIndex(vocab, ["a b", "a b</w>", "ab ab"], "</w>")
    assert index.encode(["ababa", "ab", "", "a", "abab"]) == [[5, 2], [6], [], [2], [4, 6]]
    with pytest.raises(ValueError):
        bpe.PairIndex(vocab, ["ab ab", "a b"], "</w>")


def test_chunks_equal_the_library_one_by_one(library):
    import random

    rng = random.Random(1)
    letters = "abzAZéÉñßÜøŒœĿŀİıſƏǅǆɏªº"
    marks = "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~0129\u0301\u00a0…"
    chunks = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 9))) + "".join(rng.choice(marks) for _ in range(rng.choice([0, 0, 1, 2, 3]))) + rng.choice(["", "", "s", "t"]) for _ in range(4000)]
    chunks += ["<|endoftext|>", "a<|endoftext|>", "x<|", "don't", "we'll", "ÇA", "İ", "ŉ", "ﬁ", "K"]
    chunks = [c.encode() for c in {c for c in chunks if c}]
    for by_library in (True, False):
        bpe_codec = bpe.Codec(bpe.read_spec(PATH), by_library)
        assert bpe_codec.known_rules
        want = [library.encode(c.decode(), add_special_tokens=False).ids for c in chunks]
        got = [np.frombuffer(b, "<u2").tolist() for b in bpe_codec.library_bytes(chunks, "<u2")] if by_library else [np.frombuffer(ids, "<u4").tolist() for ids, _ in bpe_codec.encode_chunks(chunks)]
        assert got == want


def test_memo_is_bounded():
    memo = bpe.Memo(10)
    for i in range(0, 1000, 5):
        assert memo.fill(set(range(i, i + 5)), lambda keys: [k * 2 for k in keys])[i] == i * 2
    assert len(memo.new) + len(memo.old) <= 30


def test_token_files_round_trip(spark, library):
    texts = odd_texts()
    ids = [7, 3, None, 5, 5, 1, 2, 100, -4, 9, 8]
    folder = token_files.write_tokens(frame(spark, texts, ids), PATH, end_id=2)
    rows = sorted(token_files.read_tokens(spark, folder, with_ids=True).collect(), key=lambda r: r.start)
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, texts[i] or ""))
    assert [r.doc_id for r in rows] == [ids[i] for i in order]
    start = 0
    for r, i in zip(rows, order, strict=True):
        want = expected(library, texts[i])[0] + [2]
        assert r.ids == want and r.start == start and r.n_tokens == len(want)
        assert r.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
        start += len(want)


def test_token_files_of_an_empty_table(spark):
    folder = token_files.write_tokens(frame(spark, []), PATH, end_id=2)
    assert token_files.read_tokens(spark, folder).collect() == []
