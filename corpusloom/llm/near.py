"""SimHash near-dedup with bit-sliced comparison.

Documents have a 64-bit SimHash of their word shingles. Distinct fingerprints are dealt to permuted block tables (one
for each choice of blocks that must agree); what shares a table's key is a bucket. All buckets of a task lie in one
array of fingerprints that is stored as 64 bit planes. Shifting the planes by 1, 2, ... puts the members of a bucket
against each other; each plane's differences are added to all distances at once by carry-save counters, 64 lanes to a
machine word, and a block of lanes is abandoned once all of it is beyond the radius. A bucket is done when its members
are all connected. Only the edges of a spanning forest leave a task. A bucket of more than ``TILE`` members is split
into tiles, and pairs of tiles are compared in different tasks.

Defined cases: a null text counts as empty; texts without words have fingerprint zero and are linked like any other;
equal fingerprints are always linked; a row whose id is null takes the component of its fingerprint; a component's id
is the smallest id in it (null if all are null); repeated rows stay; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from corpusloom.llm.common import bounded_batches, joined, map_batches, text_bytes, written
from corpusloom.llm.components import components

BITS, WORDS = 64, 1024
#: Members of a bucket beyond which it is split, and fingerprints that are compared together.
TILE, TOGETHER = 16_384, 1 << 17
#: Shingles of a set beyond which it is not broadcast, shingles of the sets of a cell, and buckets that may be broadcast.
LIGHT, SHINGLES, LARGE = 1 << 13, 1 << 18, 50_000


def mixed(hashes: np.ndarray, turn: int) -> np.ndarray:
    """Hashes of the hashes, for fingerprints that are independent of the first; unchanged for turn 0."""
    if not turn:
        return hashes
    h = hashes + np.uint64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    for by, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ h >> np.uint64(by)) * np.uint64(times)
    return h ^ h >> np.uint64(31)


def votes(hashes: np.ndarray) -> int:
    """A bit is set if it is set in over half the hashes."""
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 14):
        counts += np.unpackbits(hashes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def simhashes(text: bytes, size: int, seed: int, several: int = 1) -> list[int]:
    """SimHashes of a text's shingles by XXH64; those after the first vote with hashes of these hashes."""
    import xxhash

    words = text.lower().split()  # of bytes: A-Z only, white space 0x20 and 0x09-0x0D
    if not words:
        return [0] * several
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]]).tolist()
    n = max(1, len(words) - size + 1)
    ends = (ends - 1)[min(size, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends, strict=False)), dtype=np.uint64, count=n)
    return [votes(mixed(hashes, k)) for k in range(several)]


def fingerprints(df: DataFrame, size: int = 3, seed: int = 42, id_column: str = "doc_id", text_column: str = "text", several: int = 0) -> DataFrame:
    """``id`` and ``bits`` (long) of each row; with ``several``, ``bits`` is an array and ``th`` the text's ``xxhash64``."""

    def one():
        def batch(rows: pa.RecordBatch):
            bits = np.array([simhashes(t, size, seed, several or 1) for t in text_bytes(rows.column(1))], dtype=np.uint64).view(np.int64)
            column = pa.FixedSizeListArray.from_arrays(pa.array(bits.ravel()), several).cast(pa.list_(pa.int64())) if several else pa.array(bits.ravel())
            yield pa.RecordBatch.from_arrays([rows.column(0), column, *rows.columns[2:]], names=["id", "bits", "th"][: len(rows.columns)])

        return batch

    own = [F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("th")] if several else []
    return map_batches(df.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"), *own), one, "id bigint, bits array<bigint>, th bigint" if several else "id bigint, bits bigint")


def planes_of(values: np.ndarray) -> np.ndarray:
    """64 planes of packed bits, one lane for each value, with a word of padding."""
    n = len(values)
    bits = np.unpackbits(values.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    out = np.zeros((BITS, (n + 63) // 64 + 1), dtype=np.uint64)
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    out.view(np.uint8)[:, : packed.shape[1]] = packed
    return out


def shifted(plane: np.ndarray, by: int) -> np.ndarray:
    """The plane with lane i holding what lane ``i + by`` held."""
    words, rest = divmod(by, 64)
    moved = np.zeros_like(plane)
    if words < len(plane):
        moved[: len(plane) - words] = plane[words:]
    if rest:
        high = np.zeros_like(moved)
        high[:-1] = moved[1:] << np.uint64(64 - rest)
        moved = (moved >> np.uint64(rest)) | high
    return moved


def within(planes: np.ndarray, others: list[np.ndarray] | Callable, lanes: np.ndarray, radius: int) -> np.ndarray:
    """Lanes (packed) of ``lanes`` whose distance is at most ``radius``: bit-sliced carry-save counters, block by block."""
    width = radius.bit_length()
    out = np.zeros_like(lanes)
    for a in range(0, len(lanes), WORDS):
        live = lanes[a : a + WORDS]
        if not live.any():
            continue
        counters = [np.zeros_like(live) for _ in range(width)]
        over = ~live
        for b in range(BITS):
            carry = planes[b][a : a + WORDS] ^ others(b)[a : a + WORDS]
            for c in counters:
                c ^= carry
                carry = carry & ~c
            over |= carry
            if b % 8 == 7 and b > 8:
                if width and radius != (1 << width) - 1:
                    over |= beyond(counters, radius)
                if (over == np.uint64(0xFFFFFFFFFFFFFFFF)).all():
                    break
        else:
            if radius != (1 << width) - 1:
                over |= beyond(counters, radius)
        out[a : a + WORDS] = ~over
    return out


def beyond(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is over ``radius``."""
    more, same = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for i in reversed(range(len(counters))):
        if radius >> i & 1:
            same &= counters[i]
        else:
            more |= same & counters[i]
            same &= ~counters[i]
    return more


def lane_numbers(packed: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(packed.view(np.uint8), bitorder="little")[:n])


def packed_lanes(flags: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(words, dtype=np.uint64)
    bits = np.packbits(flags, bitorder="little")
    out.view(np.uint8)[: len(bits)] = bits
    return out


def joined_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the labels (smallest position) of linked lanes, in place."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label[:] = label[label]


def linked(values: np.ndarray, bucket: np.ndarray, radius: int, side: np.ndarray | None = None, group: np.ndarray | None = None, check: Callable | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions, all within ``radius``) that connect what the links within the buckets of ``values`` connect.

    ``bucket`` ascends. With ``side``, only lanes of different sides of a bucket are compared (two tiles); with
    ``group``, only lanes of different groups; with ``check``, only links that it accepts (positions to flags) count.
    Lanes that are connected already are not compared again.
    """
    n = len(values)
    label = np.arange(n)
    if group is not None:
        _, first, back = np.unique(group, return_index=True, return_inverse=True)
        label = first[back]
    at = np.arange(n)  # positions of the lanes that are still compared
    found = []
    shift = 1
    while len(at) > shift:
        now, own = values[at], bucket[at]
        planes = planes_of(now)
        words = planes.shape[1]
        for _ in range(max(8, shift // 4)):  # then leave out what is done
            if len(at) <= shift:
                break
            flags = np.zeros(len(at), dtype=bool)
            flags[:-shift] = own[shift:] == own[:-shift]
            if not flags.any():
                break
            flags[:-shift] &= label[at[shift:]] != label[at[:-shift]]
            if side is not None:
                flags[:-shift] &= side[at[shift:]] != side[at[:-shift]]
            hits = lane_numbers(within(planes, lambda b, s=shift, p=planes: shifted(p[b], s), packed_lanes(flags, words), radius), len(at))
            i, j = at[hits], at[hits + shift]
            if check is not None and len(i):
                good = check(i, j)
                i, j = i[good], j[good]
            found.append((i, j))
            joined_labels(label, i, j)
            shift += 1
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        sizes = np.diff(np.r_[starts, len(at)])
        root = label[at]
        alike = np.minimum.reduceat(root, starts) == np.maximum.reduceat(root, starts)
        keep = np.repeat((sizes > shift) & ~alike, sizes)
        at = at[keep]
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 2
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def bucket_masks(radius: int, agreeing: int) -> list[int]:
    blocks = radius + agreeing
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    found = [sum(masks[i] for i in chosen) for chosen in combinations(range(blocks), agreeing)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in found]


def links(distinct: DataFrame, radius: int = 3, agreeing: int = 2) -> DataFrame:
    """Links ``u``, ``v`` whose components are those of all pairs within ``radius``.

    ``distinct`` has ``bits`` (one fingerprint, or an array of which any may be near), and perhaps ``node`` (named by the links; else the fingerprint) and ``label`` (only nodes
    of different labels are compared). With ``agreeing`` blocks of
    ``radius + agreeing`` a key has ``64 * agreeing / (radius + agreeing)`` bits; each setting finds every pair.
    """
    spark = distinct.sparkSession
    bounded_batches(spark)
    masks = bucket_masks(radius, agreeing)
    node = F.col("node") if "node" in distinct.columns else F.col("bits")
    label = F.col("label") if "label" in distinct.columns else node
    prints = F.col("bits") if isinstance(distinct.schema["bits"].dataType, ArrayType) else F.array("bits")
    key = F.col("bits").bitwiseAND(F.element_at(F.lit(masks), F.pmod("tab", F.lit(len(masks))) + 1))
    rows = distinct.select(F.posexplode(prints).alias("turn", "bits"), node.alias("node"), label.alias("label"))
    rows = rows.select("bits", "node", "label", F.explode(F.sequence(F.col("turn") * len(masks), F.col("turn") * len(masks) + (len(masks) - 1))).alias("tab"))
    # a bucket of more than a tile is split; there are few of them, and their rows are found without a shuffle of all rows
    large = rows.groupBy("tab", key.alias("key")).agg(F.count("*").alias("n")).where(F.col("n") > TILE).select(F.col("tab").alias("t"), "key", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    large = written(large, "large")
    many = large.limit(LARGE + 1).count()
    if many:
        on = (F.col("tab") == F.col("t")) & (key == F.col("key"))
        rows = rows.join(F.broadcast(large) if many <= LARGE else large, on, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
        rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), "tiles").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        rows = rows.select("bits", "tab", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "node", "label")
    else:
        rows = rows.select("bits", "tab", F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("own"), "node", "label")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "tab", key, "a", "b").sortWithinPartitions("tab", key, "a", "b")
    masks_of = np.array(masks, dtype=np.int64)

    def compare(batches):
        held: list[np.ndarray] = []

        def flush(table: np.ndarray):
            change = np.r_[True, (table[1:, 1:5] != table[:-1, 1:5]).any(axis=1)]
            bucket = np.cumsum(change)
            several = np.bincount(bucket)[bucket] > 1
            table, bucket = table[several], bucket[several]
            across = table[:, 3] != table[:, 4]
            for some in (~across, across):
                if some.any():
                    part = table[some]
                    values = np.ascontiguousarray(part[:, 0]).view(np.uint64)
                    i, j = linked(values, bucket[some], radius, part[:, 5] if some is across else None, part[:, 7])
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(part[i, 6], part[j, 6])), pa.array(np.maximum(part[i, 6], part[j, 6]))], names=["u", "v"])

        for rows_in in batches:
            bits, tab, *rest = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in rows_in.columns)
            table = np.stack([bits, tab, bits & masks_of[tab % len(masks_of)], *rest], axis=1)
            if not len(table):
                continue
            held.append(table)
            if sum(map(len, held)) >= TOGETHER:
                table = np.concatenate(held)
                last = table[-1, 1:5]
                cut = len(table) - int(np.argmax((table[::-1, 1:5] != last).any(axis=1))) if (table[:, 1:5] != last).any() else 0
                if cut:
                    yield from flush(table[:cut])
                held = [table[cut:]]
        if held and sum(map(len, held)):
            yield from flush(np.concatenate(held))

    return rows.mapInArrow(compare, "u bigint, v bigint")


def classes_of(rows: DataFrame, radius: int) -> DataFrame:
    """``bits`` and the ``root`` and ``least`` id of its class for each distinct fingerprint of ``rows`` (``id``, ``bits``)."""
    distinct = rows.groupBy("bits").agg(F.min("id").alias("least"))
    roots = components(links(distinct, radius))
    return written(distinct.join(roots, distinct["bits"] == roots["node"], "left").select("bits", "least", F.coalesce("root", "bits").alias("root")), "classes")


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Distinct 64-bit hashes of a text's shingles of ``size`` words, A-Z in lower case; of all its words if there are fewer; none without words."""
    import xxhash

    words = text.lower().split()
    n = max(len(words) - size + 1, 1 if words else 0)
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(b" ".join(words[i : i + size])) for i in range(n)), dtype=np.uint64, count=n)).view(np.int64)


def shingle_sets(df: DataFrame, pairs: DataFrame, shingle: int, text: Column) -> DataFrame:
    """``node`` and ``s`` (``shingle_set``) of the texts in ``pairs``."""
    ends = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()

    def one():
        def batch(rows: pa.RecordBatch):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([shingle_set(t, shingle) for t in text_bytes(rows.column(1))], pa.list_(pa.int64()))], names=["node", "s"])

        return batch

    texts = df.select(F.xxhash64(text).alias("node"), text.alias("text"))
    return map_batches(texts.join(ends.hint("shuffle_hash"), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")), one, "node bigint, s array<bigint>")


def renamed(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """``pairs`` (``u``, ``v``) with each end replaced by its name; ``names`` has two columns, a node and its name."""
    return pairs.join(names.toDF("u", "a"), "u").join(names.toDF("v", "b"), "v").select(F.col("a").alias("u"), F.col("b").alias("v"))


def confirmed(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The ``pairs`` (``u``, ``v``) whose ``sets`` (``node``, ``s``) have a Jaccard similarity of ``least``; two empty sets are alike.

    A node with very many pairs keeps its pairs where they are (``common.joined``), if its set is not long.
    """
    total = pairs.count()

    def side(name: str) -> DataFrame:
        n = pairs.groupBy(F.col(name).alias("node")).agg(F.count("*").alias("n"))
        weight = F.when(F.size("s") <= LIGHT, F.col("n")).otherwise(0)
        return sets.join(n, "node").select(F.col("node").alias(name), F.col("s").alias(f"s_{name}"), weight.alias(f"n_{name}"))

    both = joined(joined(pairs, side("u"), ["u"], "n_u", total), side("v"), ["v"], "n_v", total)
    common = F.size(F.array_intersect("s_u", "s_v"))
    whole = F.size("s_u") + F.size("s_v") - common
    return both.where((whole == 0) | (common >= least * whole)).select("u", "v")


def similar(df: DataFrame, least: float = 0.8, shingle: int = 5, size: int = 2, radius: int = 7, several: int = 2, seed: int = 42, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``node`` (a text's ``xxhash64``) and ``root`` of each distinct text: connected by pairs of texts that are alike.

    Two texts are alike if their sets of ``shingle``-word shingles have a Jaccard similarity of ``least``. Candidates are
    pairs with one of ``several`` independent SimHash fingerprints (of ``size``-word shingles) within ``radius``, found by
    the bit-sliced comparison; each is confirmed by the sets. The first round confirms as few candidates as connect
    everything; those that fail leave groups apart. The second round (``linked_by_sets``) tries every candidate between
    such groups, within what candidates connect.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = fingerprints(df, size, seed, id_column, text_column, several=several)
    nodes = written(rows.groupBy(F.col("th").alias("node")).agg(F.first("bits").alias("bits")), "nodes")
    tried = written(links(nodes, radius).distinct(), "candidates")
    groups = nodes.select("node", F.col("node").alias("root"))
    if not tried.head(1):
        return groups
    sets = written(shingle_sets(df, tried, shingle, text), "sets")  # of all nodes that have a candidate
    groups = regrouped(groups, confirmed(tried, sets, least))
    reach = written(components(tried).join(groups.withColumnRenamed("root", "label"), "node").withColumnRenamed("root", "reach"), "reach")
    return regrouped(groups, linked_by_sets(nodes.join(reach, "node").join(sets, "node"), radius, least))


def regrouped(groups: DataFrame, links_: DataFrame) -> DataFrame:
    """``groups`` (``node``, ``root``) with the groups joined that the links connect."""
    good = written(links_, "links")
    if not good.head(1):
        return groups
    roots = components(renamed(good, groups))
    return written(groups.join(roots.toDF("root", "new"), "root", "left").select("node", F.coalesce("new", "root").alias("root")), "groups")


def linked_by_sets(nodes: DataFrame, radius: int, least: float) -> DataFrame:
    """Links ``u``, ``v`` that connect all nodes of different ``label`` whose fingerprints are near and whose sets are alike.

    ``nodes``: ``node``, ``bits`` (array), ``label``, ``reach`` (only nodes of the same one can be near) and ``s``. The nodes
    of a ``reach`` with several labels meet in a cell, with their sets. A reach with more than ``SHINGLES`` elements in
    its sets is dealt to tiles, and each pair of tiles is a cell. Nothing but links that join labels leaves a cell.
    """
    spark = nodes.sparkSession
    bounded_batches(spark)
    nodes = written(nodes.select("node", "bits", "label", "reach", "s"), "reached")
    total = F.sum(F.size("s").cast("bigint") + 1)
    open_ = nodes.groupBy("reach").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"), F.ceil(total / SHINGLES).cast("int").alias("tiles"))
    open_ = written(open_.where("low <> high").select("reach", "n", "tiles"), "open")
    rows = joined(nodes, open_, ["reach"], "n", nodes.count()).withColumn("own", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.select("reach", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "node", "label", "bits", "s")
    cell = ["reach", "a", "b"]
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *cell).sortWithinPartitions(*cell)

    def compare(batches):
        held: list[tuple] = []
        size = 0

        def flush(rows: list[tuple]):
            reach, a, b, own, node, label = (np.array(c, dtype=np.int64) for c in list(zip(*rows, strict=True))[:6])
            prints = np.array([r[6] for r in rows], dtype=np.int64).view(np.uint64)
            sets = [r[7] for r in rows]
            sizes = np.array(list(map(len, sets)))
            bucket = np.cumsum(np.r_[True, (reach[1:] != reach[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            across = a != b
            for some in (np.flatnonzero(~across), np.flatnonzero(across)):
                if not len(some):
                    continue
                for turn in range(prints.shape[1]):

                    def alike(i, j, some=some, turn=turn):
                        p, q = some[i], some[j]
                        common = np.minimum(sizes[p], sizes[q])
                        good = common >= least * np.maximum(sizes[p], sizes[q])
                        for before in range(turn):
                            good &= np.bitwise_count(prints[p, before] ^ prints[q, before]) > radius
                        for k in np.flatnonzero(good).tolist():
                            common = len(np.intersect1d(sets[p[k]], sets[q[k]], assume_unique=True))
                            good[k] = common >= least * (sizes[p[k]] + sizes[q[k]] - common)
                        return good

                    i, j = linked(np.ascontiguousarray(prints[some, turn]), bucket[some], radius, own[some] if across[some[0]] else None, label[some], alike)
                    u, v = node[some[i]], node[some[j]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

        now = None
        for batch in batches:
            flat, ends = batch.column(7).values.to_numpy(), batch.column(7).offsets.to_numpy()
            parts = [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            for row in zip(*(c.to_pylist() for c in batch.columns[:7]), parts, strict=True):
                if row[:3] != now:
                    if size >= SHINGLES:
                        yield from flush(held)
                        held, size = [], 0
                    now = row[:3]
                held.append(row)
                size += len(row[7]) + 1
        if held:
            yield from flush(held)

    return rows.mapInArrow(compare, "u bigint, v bigint")


def representatives(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", **how) -> DataFrame:
    """One row of each group of ``similar`` texts, all columns: that of the smallest id (rows without an id last)."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    far = F.lit((1 << 63) - 1)
    own = [F.coalesce(F.col(id_column).cast("bigint"), far).alias("_did"), F.xxhash64(text).alias("_th")]
    groups = similar(df, id_column=id_column, text_column=text_column, **how)
    firsts = df.select(*own).groupBy("_th").agg(F.min("_did").alias("_did"))
    chosen = firsts.join(groups, firsts["_th"] == groups["node"]).groupBy("root").agg(F.min(F.struct("_did", "_th")).alias("c")).select("c.*")
    kept = df.select(F.struct(*df.columns).alias("_row"), *own).join(chosen.hint("shuffle_hash"), ["_did", "_th"], "left_semi")
    return kept.groupBy("_did", "_th").agg(F.first("_row").alias("_row")).select("_row.*")


def near_duplicates(df: DataFrame, size: int = 3, radius: int = 3, seed: int = 42, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id, ``fingerprint`` (hex) and ``component_id`` of each row."""
    rows = written(fingerprints(df, size, seed, id_column, text_column), "simhash")
    classes = classes_of(rows, radius)
    first = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    found = classes.join(first, "root").select("bits", "component_id")
    return rows.join(found, "bits").select(F.col("id").alias(id_column), F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")
