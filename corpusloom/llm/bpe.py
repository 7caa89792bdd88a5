"""BPE encoding and decoding with a pair occurrence index.

The rules come from a ``tokenizers`` JSON file. Its normalizer and pre-tokenizer cut a text into pieces; the merges
are our own. All distinct new pieces of a block of documents lie in one symbol array. An index maps each pair to all
its positions there, a heap holds the ranks that occur, and ranks are applied in ascending order: every position of
the lowest rank is merged from left to right, and only the lists of the pairs beside it are updated.

White space ends a piece and is dropped by the vocabulary's rules, so a text is the sequence of its chunks between
ASCII white space, and a bounded memo holds the chunks that were met lately.

Defined cases: a null text counts as empty; an empty text has no ids; repeated rows give repeated results; null ids
pass through; any other column is ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import string
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.common import map_batches, text_bytes

#: Chunks in each of the two generations of a worker's memo (bare ids by the library, ids and text by the pair index),
#: pieces likewise, and text bytes that are encoded together. The memo stays with the worker from task to task.
LIBRARY_MEMO, MEMO, PIECES, BLOCK = 400_000, 250_000, 100_000, 1 << 20


class Memo:
    """Two generations of a dict: at most ``2 * size`` keys, the ones used lately stay."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def fill(self, keys: set, make: Callable[[list], Iterable]) -> dict:
        """A dict that holds all ``keys``; ``make`` gives the values of those not known."""
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        missing = set(keys).difference(new)
        if missing:
            fresh = list(missing.difference(old))
            if len(fresh) < len(missing):
                missing.difference_update(fresh)
                new.update(zip(missing, map(old.__getitem__, missing), strict=True))
            new.update(zip(fresh, make(fresh), strict=True))
        return self.new


class PairIndex:
    """Merges of one vocabulary, applied to many pieces at once."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        self.vocab, self.suffix, self.rank, self.pair_of = vocab, suffix, {}, []
        self.shift = max(vocab.values(), default=0).bit_length()
        made: dict[int, int] = {}
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, ab = vocab[left], vocab[right], vocab[left + right]
            self.rank[a << self.shift | b] = rank
            made.setdefault(ab, rank)
            self.pair_of.append((a, b, ab))
        if len(made) < len(self.rank) or len(self.rank) < len(merges) or any(max(made.get(a, -1), made.get(b, -1)) >= rank for rank, (a, b, _) in enumerate(self.pair_of)):
            raise ValueError("a merge comes before the merges that make its parts: ascending ranks would not be exact")

    def letters_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all pieces in a row, -1 behind each, and where the -1 stand; characters without a symbol go."""
        text = np.frombuffer("\n".join([*pieces, ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        stops = np.cumsum(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) + 1) - 1
        distinct, back = np.unique(text, return_inverse=True)
        get, chars = self.vocab.get, list(map(chr, distinct.tolist()))
        inner, last = (np.array([get(c + end, -2) for c in chars], dtype=np.int64) for end in ("", self.suffix))
        symbols = inner[back]
        filled = np.flatnonzero(np.diff(stops, prepend=-1) > 1)
        symbols[stops[filled] - 1] = last[back[stops[filled] - 1]]
        symbols[stops] = -1
        symbols = symbols[symbols != -2]
        return symbols, np.flatnonzero(symbols == -1)

    def occurrences(self, symbols: np.ndarray) -> dict[int, list[int]]:
        """Rank to all positions of its pair, ascending."""
        distinct, back = np.unique(symbols, return_inverse=True)
        n, known = len(distinct), distinct.tolist()
        pairs, where = np.unique(back[:-1] * n + back[1:], return_inverse=True)
        get, shift = self.rank.get, self.shift
        ranks = np.array([get(known[p // n] << shift | known[p % n], -1) if known[p // n] >= 0 and known[p % n] >= 0 else -1 for p in pairs.tolist()], dtype=np.int64)[where]
        at = np.flatnonzero(ranks >= 0)
        at = at[np.argsort(ranks[at], kind="stable")]
        cuts = np.flatnonzero(np.diff(ranks[at])) + 1
        return {int(ranks[some[0]]): some.tolist() for some in np.split(at, cuts) if len(some)}

    def encode_all(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and the end of each piece among them."""
        made, stops = self.letters_of(pieces)
        index = self.occurrences(made) if len(made) > 1 else {}
        rank_of, pair_of, shift = self.rank.get, self.pair_of, self.shift
        symbols, n = made.tolist(), len(made)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        active = list(index)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            a, b, ab = pair_of[r]
            for p in sorted(index.pop(r)):
                if symbols[p] != a or symbols[q := after[p]] != b:  # a -1 stands behind the last symbol
                    continue
                symbols[p], symbols[q] = ab, -2
                after[p] = end = after[q]
                before[end] = p
                if (x := symbols[end]) >= 0 and (found := rank_of(ab << shift | x)) is not None:
                    if found in index:
                        index[found].append(p)
                    else:
                        index[found] = [p]
                        heapq.heappush(active, found)
                if (left := before[p]) >= 0 and (x := symbols[left]) >= 0 and (found := rank_of(x << shift | ab)) is not None:
                    if found in index:
                        index[found].append(left)
                    else:
                        index[found] = [left]
                        heapq.heappush(active, found)
        whole = np.array(symbols, dtype=np.int64)
        return whole[whole >= 0], np.cumsum(whole >= 0)[stops] if len(stops) else stops

    def encode(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each piece."""
        ids, ends = self.encode_all(pieces)
        return [x.tolist() for x in np.split(ids, ends[:-1])] if pieces else []


class Letters(dict):
    """What the rules make of a letter, by code point: filled as letters are met, for ``str.translate``."""

    def __init__(self, pieces_of: Callable[[str], list[str]]):
        self.pieces_of = pieces_of

    def __missing__(self, point: int) -> str:
        (made,) = self.pieces_of(chr(point))
        self[point] = made
        return made


class Codec:
    """Encoder and decoder of one tokenizer file; ``encode`` is the pair index or the library itself."""

    def __init__(self, spec: str, by_library: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        rules = json.loads(spec)
        model = rules["model"]
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.added = {t["content"]: t["id"] for t in rules["added_tokens"]}
        self.names = {i: t for t, i in [*model["vocab"].items(), *self.added.items()]}
        self.width = 2 if max(self.names) < 1 << 16 else 4
        if not by_library:
            if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges") or rules.get("decoder") or rules.get("post_processor"):
                raise ValueError("the pair index reads plain BPE files without prefixes, byte fallback or a decoder of their own")
            if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in rules["added_tokens"]):
                raise ValueError("the pair index reads added tokens that match the raw text")
            self.merger = PairIndex(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
            self.pieces = Memo(PIECES)
        self.chunks = Memo(LIBRARY_MEMO if by_library else MEMO)
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.by_library = by_library
        self.ends = np.zeros(max(self.names) + 1, dtype=np.int64)
        suffix = model.get("end_of_word_suffix")
        self.ends[[i for i, t in self.names.items() if suffix and t.endswith(suffix)]] = 1
        # Letters that stay letters under any of the file's rules, then punctuation that starts no contraction and no
        # added token: pieces that are known without asking the library for each chunk.
        self.simple = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-&(-/:;=?@\[-`{}~]*)")
        self.letters = Letters(self.pieces_of)
        self.lowers = self.pieces_of("ABCXYZabcxyz") == ["abcxyzabcxyz"] and all("".join(self.pieces_of(c)) == c.lower() for c in string.ascii_letters)
        self.known_rules = bool(suffix) and self.pieces_of("Éa!?") == ["Éa".translate(self.letters), "!?"]

    def pieces_of(self, text: str) -> list[str]:
        if self.library.normalizer:
            text = self.library.normalizer.normalize_str(text)
        return [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def cut(self, chunk: str) -> tuple:
        """The pieces of a chunk of raw text: strings to be merged, and ids of added tokens."""
        if self.known_rules:
            if self.lowers and chunk.isalpha() and chunk.isascii():
                return (chunk.lower(),)
            if found := self.simple.fullmatch(chunk):
                word = found[1].translate(self.letters)
                return (word, found[2]) if found[2] else (word,)
        out: list = []
        for part in self.split.split(chunk) if self.split else [chunk]:
            if part in self.added:
                out.append(self.added[part])
            elif part:
                out += self.pieces_of(part)
        return tuple(out)

    def made(self, pieces: list) -> list[tuple[bytes, bytes]]:
        """Ids and text of each piece; the merges of all strings are done together."""
        names, words = self.names, [p for p in pieces if isinstance(p, str)]
        ids, ends = self.merger.encode_all(words)
        data, texts = ids.astype("<u4").tobytes(), [names[i] for i in ids.tolist()]
        cuts = [0, *ends.tolist()]
        of = {w: (data[4 * a : 4 * b], " ".join(texts[a:b]).encode()) for w, a, b in zip(words, cuts, cuts[1:], strict=False)}
        return [of[p] if isinstance(p, str) else (np.array([p], dtype="<u4").tobytes(), names[p].encode()) for p in pieces]

    def encode_chunks(self, chunks: list[bytes]) -> list[tuple[bytes, bytes]]:
        """Ids (little-endian unsigned 32-bit integers) and decoded text of chunks without white space."""
        cuts = list(map(self.cut, b" ".join(chunks).decode().split(" "))) if chunks else []
        known = self.pieces.fill({p for cut in cuts for p in cut}, self.made)
        return [known[c[0]] if len(c) == 1 else joined([known[p] for p in c]) for c in cuts]

    def library_bytes(self, chunks: list[bytes], kind: str) -> list[bytes]:
        """Ids of each chunk as bytes of ``kind``, encoded by the library.

        Chunks of letters, perhaps with punctuation, are encoded together: each has one or two pieces, and the last id
        of a piece is an end of word, so the ids are cut by counting ends. All others are encoded one by one.
        """
        texts = [c.decode() for c in chunks]
        found = [self.simple.fullmatch(t) for t in texts] if self.known_rules else [None] * len(texts)
        out = [b""] * len(texts)
        alone = [i for i, f in enumerate(found) if not f]
        for i, e in zip(alone, self.library.encode_batch_fast([texts[i] for i in alone], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, dtype=kind).tobytes()
        together = [i for i, f in enumerate(found) if f]
        for a in range(0, len(together), 1000):
            some = together[a : a + 1000]
            ids = np.array(self.library.encode_batch_fast([" ".join([texts[i] for i in some])], add_special_tokens=False)[0].ids, dtype=np.int64)
            pieces = np.cumsum([2 if found[i][2] else 1 for i in some])
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != pieces[-1] or ends[-1] != len(ids):
                raise ValueError("the pieces of a chunk are not as expected")
            data, width = ids.astype(kind).tobytes(), np.dtype(kind).itemsize
            cuts = [0, *(ends[pieces - 1] * width).tolist()]
            for i, x, y in zip(some, cuts, cuts[1:], strict=False):
                out[i] = data[x:y]
        return out


def joined(parts: Iterable[tuple[bytes, bytes]]) -> tuple[bytes, bytes]:
    """Ids and text of parts in a row: without a decoder of its own a vocabulary's tokens are joined by one space."""
    parts = list(parts)
    return b"".join([p[0] for p in parts]), b" ".join([p[1] for p in parts if p[0]])


_codecs: dict[tuple, Codec] = {}


def codec(spec: str, by_library: bool = False) -> Codec:
    """One codec for each worker process and file."""
    key = hashlib.sha256(spec.encode()).hexdigest(), by_library
    if key not in _codecs:
        _codecs[key] = Codec(spec, by_library)
    return _codecs[key]


def blocks(texts: list[bytes], most: int = BLOCK) -> Iterable[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_decode(df: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", with_texts: bool = False) -> DataFrame:
    """Encode each text and decode its ids again.

    Returns the id column, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``; ``with_texts`` adds ``ids`` (little-endian
    unsigned 32-bit integers) and ``decoded``. ``tokenizer`` is the path of a ``tokenizers`` JSON file on the driver.
    No shuffle: each task encodes the documents of its own partition.
    """
    spec = df.sparkSession.sparkContext.broadcast(read_spec(tokenizer))
    key = df.schema[id_column]
    schema = f"`{id_column}` {key.dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids binary, decoded string" * with_texts

    def one():
        bpe = codec(spec.value)

        def batch(rows: pa.RecordBatch):
            texts = text_bytes(rows.column(1))
            counts, id_sums, text_sums, id_bytes, decoded = [], [], [], [], []
            for a, b in blocks(texts):
                chunks = [t.split() for t in texts[a:b]]
                get = bpe.chunks.fill(set().union(*chunks), bpe.encode_chunks).__getitem__
                for words in chunks:
                    ids, text = joined(map(get, words))
                    counts.append(len(ids) // 4)
                    id_sums.append(hashlib.sha256(ids).hexdigest())
                    text_sums.append(hashlib.sha256(text).hexdigest())
                    if with_texts:
                        id_bytes.append(ids)
                        decoded.append(text.decode())
            columns = [rows.column(0), pa.array(counts, pa.int64()), pa.array(id_sums, pa.string()), pa.array(text_sums, pa.string())]
            if with_texts:
                columns += [pa.array(id_bytes, pa.binary()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[id_column, "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: len(columns)])

        return batch

    return map_batches(df.select(id_column, text_column), one, schema)
