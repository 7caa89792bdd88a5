"""Substring dedup by words: repeated-phrase automata.

Each word is removed that a window of ``length`` words covers whose word sequence also starts anywhere else. Recurring
passages (runs of recurring windows) are confirmed by their words in cells of candidate text (see ``repeats``) and
sent, as text and without positions, to the shards of documents that have them. A shard is a block of documents. Its
passages are compiled into one Aho-Corasick automaton over word numbers, and all its texts are streamed through: what
the automaton finds is what is removed. A document with no passage of its own is streamed like any other.

Defined cases: a null text has no words; repeated rows are occurrences of each other; rows whose id is null are
treated alike; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bpe import blocks
from corpusloom.llm.repeats import View, hashed, reported

#: Bytes of the texts of a shard: the automaton's first state has a branch for each word that begins a passage, and
#: branches are searched one by one, so small shards are faster.
SHARD = 1 << 17
#: Words that have a character each, and second characters of the words of a larger vocabulary.
CHARACTERS, PAIR = 0xD000, 0x1000


def solve(parts: list[bytes], weights: list[int], length: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each part the classes of its windows, and the number of windows in each class; a part stands for as many as its weight."""
    number: dict[bytes, int] = {}
    known: dict[bytes, int] = {}
    classes, each = [], []
    for part, weight in zip(parts, weights, strict=True):
        data = np.array([number.setdefault(w, len(number)) for w in part.split()], dtype="<u4").tobytes()
        found = np.array([known.setdefault(data[i : i + 4 * length], len(known)) for i in range(0, len(data) - 4 * length + 1, 4)], dtype=np.int64)
        classes.append(found)
        each.append(np.full(len(found), weight, dtype=np.float64))
    if not parts:
        return [], np.zeros(0)
    return classes, np.bincount(np.concatenate(classes), weights=np.concatenate(each), minlength=len(known))


def located(texts: list[bytes], passages: set[bytes]) -> list[np.ndarray]:
    """Which words of each text an occurrence of a passage covers.

    A word is one character of the automaton's strings, or two if the words are too many for that.
    """
    import ahocorasick

    words = [t.split() for t in texts]
    flags = [np.zeros(len(w), dtype=bool) for w in words]
    if not passages:
        return flags
    vocabulary = {w for p in passages for w in p.split(b" ")}
    size = 1 if len(vocabulary) < CHARACTERS else 2
    code = {w: chr(i + 1) if size == 1 else chr(CHARACTERS + i // PAIR) + chr(i % PAIR + 1) for i, w in enumerate(vocabulary)}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_STRING)
    of = code.__getitem__
    for passage in passages:
        automaton.add_word("".join(map(of, passage.split(b" "))))
    automaton.make_automaton()
    get, other = code.get, "\0" * size
    for some, covered in zip(words, flags, strict=True):
        for end, n in automaton.iter("".join([get(w, other) for w in some])):
            covered[(end + 1 - n) // size : (end + 1) // size] = True
    return flags


def word_symbols():
    def symbols(text: bytes):
        data = b" ".join(text.split())
        raw = np.frombuffer(data, dtype=np.uint8)
        if not len(raw):
            return data, np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        spaces = np.flatnonzero(raw == 32)
        starts, ends = np.r_[0, spaces + 1], np.r_[spaces, len(raw)]
        return data, hashed(raw.astype(np.uint64) + np.uint64(1), starts, ends), starts, ends

    return symbols


def word_view(length: int) -> View:
    return View(length, min(8, length), word_symbols, solve, scale=7, with_data=True)


def passages_of(each: DataFrame) -> DataFrame:
    """``did``, ``th``, ``found``: the passages of each document, as text."""
    return each.groupBy("did", "th").agg(F.collect_set("r.data").alias("found"))


def dedup_phrases(df: DataFrame, length: int = 35, with_text: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id, ``n_words``, ``n_removed``, ``kept_sha256``; ``with_text`` adds ``kept`` (the kept words, joined by a space)."""

    def row(text: bytes, covered: np.ndarray):
        words = text.split()
        if covered.any():
            kept = [words[i] for i in np.flatnonzero(~covered).tolist()]
        else:
            kept = words
        joined = b" ".join(kept)
        return (len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode())

    def make():
        def shard(texts: list[bytes], found: list):
            made = []
            for a, b in blocks(texts, SHARD):
                passages = {p for some in found[a:b] for p in some or ()}
                made += map(row, texts[a:b], located(texts[a:b], passages))
            return made

        return shard

    return reported(df, word_view(length), passages_of, make, "n_words bigint, n_removed bigint, kept_sha256 string" + ", kept string" * with_text, id_column, text_column)
