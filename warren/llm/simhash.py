"""SimHash near-duplicates, linked through BK-trees over shards of fingerprints."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from warren.llm.common import checkpointed, components, map_arrow, utf8

BITS, RADIUS, SHINGLE, SEED = 64, 4, 4, 42
#: A shard with more fingerprints than this is dealt again by the bits it doesn't share yet, then by pairs of blocks.
LARGE_SHARD = 4096
#: Fingerprints aimed at in a shard; sets how many bits a shard key has.
SHARD = 2048
#: Places of trees that a step of a search holds at once.
VISITS = 4_000_000
#: Similar texts have an exact Jaccard of their shingle sets of this or more.
SIMILARITY = 0.8
#: Slots in which shingles are counted, and those of a part of them; the counts order the shingles, rare ones first.
SLOTS, PART = 1 << 20, 1 << 16
#: A shingle by which more sets than this meet is crowded: its sets are compared by clusters, not pair by pair.
CROWD = 16
#: Sets, and shingles of them, aimed at in a block of a cluster; a task compares two blocks.
BLOCK_SETS, BLOCK_SHINGLES = 512, 300_000
#: The trees' radius there. A bit may differ wherever a set's balance of ones and zeros is within a quarter of its size,
#: which holds for nearly all bits of longer texts, so a smaller radius could lose pairs.
WIDE = BITS


def fingerprint(text: bytes, words: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text's word shingles, unsigned; zero without words."""
    w = text.lower().split()  # bytes: lowers A-Z only, splits at ASCII white space only
    if not w:
        return 0
    shingles = [b" ".join(s) for s in zip(*(w[i:] for i in range(words)))] or [b" ".join(w)]
    digests = np.frombuffer(b"".join([xxhash.xxh64_digest(s, seed) for s in shingles]), np.uint8).reshape(-1, 8)
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(digests), 4096):
        set_bits += np.unpackbits(digests[at : at + 4096], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(digests)).tobytes(), "big")


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """`keys` and the fingerprint `fp` (as a signed long) of every row; null text has no words."""
    kinds = dict(docs.dtypes)

    def rows(batch: pa.RecordBatch) -> dict:
        found = np.array([fingerprint(t, shingle) for t in utf8(batch.column("__text"))], np.uint64)
        return {k: batch.column(k) for k in keys} | {"fp": found.view(np.int64)}

    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "fp bigint"])
    return map_arrow(docs.select(*keys, F.col(text).alias("__text")), rows, schema)


def _masks(blocks: int, bits: list[int]) -> list[int]:
    return [sum(1 << bits[i] for i in part) for part in np.array_split(np.arange(len(bits)), blocks)]


def shard_masks(n: int, radius: int = RADIUS) -> list[int]:
    """The bits that shards share: any two fingerprints within the radius agree on all bits of one mask at least.

    Of m blocks at most `radius` differ, so some m - radius blocks agree. More blocks mean longer keys; m grows
    with the logarithm of the input so that a shard of unrelated fingerprints stays near SHARD.
    """
    m = radius + 1
    while n > SHARD << (BITS * (m - radius) // m) and m < radius + 4:
        m += 1
    blocks = _masks(m, list(range(BITS)))
    return [sum(c) for c in combinations(blocks, m - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _shards(fps: DataFrame, masks: list[int], tag: str, *more: str) -> DataFrame:
    """Each fingerprint once per mask, keyed by the mask and the bits under it."""
    keys = F.array(*[F.xxhash64(F.lit(f"{tag}{i}"), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(masks)])
    return fps.select("fp", *more, F.posexplode(keys).alias("mask", "shard"))


class Trees:
    """BK-trees, one for each shard: every node holds one fingerprint, its children are keyed by their distance to it.

    `shard` numbers each fingerprint's tree from 0, rising. All trees grow level by level at once: what is below a
    node is grouped by its distance to the node, and each group's first is the child at the end of that edge. Nodes
    are numbered by level, parent and edge, so a node's edges within a span are one run of `edges`.
    """

    def __init__(self, fps: np.ndarray, shard: np.ndarray):
        self.fps, items, below = fps, np.arange(len(fps)), shard.astype(np.int64) - (int(shard[-1]) + 1 if len(shard) else 0)
        member, edges, nodes = [], [], 0
        while len(items):
            order = np.argsort(below, kind="stable")
            items, below = items[order], below[order]
            first = np.r_[True, below[1:] != below[:-1]]
            member.append(items[first])
            edges.append(below[first])
            node = nodes + np.cumsum(first) - 1
            nodes += int(first.sum())
            pivot = items[first][np.cumsum(first) - 1]
            items, below = items[~first], (node * (BITS + 1) + np.bitwise_count(fps[items] ^ fps[pivot]))[~first]
        none = np.zeros(0, np.int64)
        self.member, self.edges = np.concatenate(member or [none]), np.concatenate(edges or [none])

    def search(self, queries: np.ndarray, trees: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, member, distance) within the radius, where query i looks in its tree; only edges that can hold one are followed."""
        q, node = np.arange(len(queries)), trees.astype(np.int64)
        while len(q):
            far = np.bitwise_count(queries[q] ^ self.fps[self.member[node]]).astype(np.int64)
            near = far <= radius
            yield q[near], self.member[node[near]], far[near]
            low = np.searchsorted(self.edges, node * (BITS + 1) + np.maximum(far - radius, 0))
            many = np.searchsorted(self.edges, node * (BITS + 1) + np.minimum(far + radius, BITS), "right") - low
            last = np.cumsum(many)
            node = np.repeat(low - last + many, many) + np.arange(last[-1])
            q = np.repeat(q, many)


def within(fps: np.ndarray, shard: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, distance) of all places i, j of one shard within the radius, both ways and each with itself."""
    trees, sizes = Trees(fps, shard), np.bincount(shard)[shard]
    part = np.cumsum(sizes) // VISITS  # so many queries at once that no level visits more places
    for at in np.split(np.arange(len(fps)), np.flatnonzero(np.diff(part)) + 1):
        for q, m, far in trees.search(fps[at], shard[at], radius):
            yield at[q], m, far


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots (each the smallest of its set) after joining the sets of a[i] and b[i]."""
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while ((up := root[root]) != root).any():
            root = up
    return root


def local_roots(fps: np.ndarray, shard: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each of the shards' fingerprints the place of the first member of its component within the shard."""
    root = np.arange(len(fps))
    for q, m, _ in within(fps, shard, radius):
        less = m < q
        root = unite(root, q[less], m[less])
    return root


def _link_shards(radius: int):
    """Rows (shard, fp) sorted by shard to edges (u, v) that connect what lies within the radius."""

    def edges(shard: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((fp, shard))
        shard, fp = shard[order], fp[order]
        new = np.r_[True, (shard[1:] != shard[:-1]) | (fp[1:] != fp[:-1])][: len(fp)]
        shard, fp = shard[new], fp[new]
        root = local_roots(fp.view(np.uint64), np.cumsum(np.r_[False, shard[1:] != shard[:-1]]), radius)
        moved = np.flatnonzero(root != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[root[moved]])], names=["u", "v"])

    return lambda batches: _by_shard(batches, edges)


def _sized(dealt: DataFrame) -> DataFrame | None:
    """(shard, count) of the shards that are too large, None without one."""
    large = checkpointed(dealt.groupBy("shard").count().filter(F.col("count") > LARGE_SHARD))
    return None if large.isEmpty() else large


def near_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints (column fp) within the radius, directly or by others.

    Shards take the place of whole-table trees, which would have no bound as a broadcast: each shard's tree and
    its queries meet in one task. A shard holds what shares the bits of one mask; large shards are dealt again,
    exactly, by five blocks of the remaining bits, since two fingerprints that share the mask and lie within
    the radius agree on one of those blocks too. What is large even then (a ball of thousands of different
    fingerprints) is dealt to pairs of hashed blocks, so every two still meet and no task holds more than two blocks.
    """
    masks = shard_masks(fps.count(), radius)
    dealt = _shards(fps, masks, "a")
    if (large := _sized(dealt)) is not None:
        marked = dealt.join(large.select("shard", F.lit(True).alias("large")), "shard", "left")
        branches = F.lit(None).cast("array<bigint>")
        for i, mask in enumerate(masks):
            rest = [b for b in range(BITS) if not mask >> b & 1]
            branches = F.when(F.col("mask") == i, F.array(*[F.xxhash64(F.lit(f"b{i}.{j}"), "shard", F.col("fp").bitwiseAND(F.lit(_signed(m)))) for j, m in enumerate(_masks(radius + 1, rest))])).otherwise(branches)
        again = marked.filter("large").select(F.explode(branches).alias("shard"), "fp")
        dealt = marked.filter("large is null").select("shard", "fp")
        if (large := _sized(again)) is not None:
            marked = again.join(large, "shard", "left")
            again = marked.filter("count is null").select("shard", "fp")
            blocks = F.ceil(F.col("count") / (LARGE_SHARD // 2))
            paired = marked.filter("count is not null").withColumn("own", F.pmod(F.xxhash64("fp"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
            dealt = dealt.unionByName(paired.select(F.xxhash64(F.lit("c"), "shard", F.least("own", "other"), F.greatest("own", "other")).alias("shard"), "fp"))
        dealt = dealt.unionByName(again)
    whole = dealt.select("shard", "fp").repartition(F.col("shard")).sortWithinPartitions("shard")
    return whole.mapInArrow(_link_shards(radius), "u bigint, v bigint").filter("u is not null")


def shingle_set(text: bytes, words: int = SHINGLE) -> set[bytes]:
    """The distinct word shingles of a text: the whole text if it has fewer words, none without words."""
    w = text.lower().split()
    return {b" ".join(s) for s in zip(*(w[i:] for i in range(words)))} or ({b" ".join(w)} if w else set())


def jaccard(a: set, b: set) -> float:
    return (both := len(a & b)) / (len(a) + len(b) - both) if a or b else 1.0


def _digests(shingles: set[bytes], seed: int = SEED) -> bytes:
    return b"".join(sorted([xxhash.xxh64_digest(s, seed) for s in shingles]))


def shingle_levels(docs: DataFrame, shingle: int) -> bytes:
    """A level for each slot of shingles, rising with how often its shingles are in a text; 1 if it is once.

    Tasks count by slots and pass parts of the slots on; a part's counts are added in one task and become levels of a
    byte. Levels order the shingles only, so their coarseness costs time and loses nothing.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.uint32)
        for batch in batches:
            for t in batch.column("text"):
                found = np.frombuffer(_digests(shingle_set(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle)), np.uint64)
                np.add.at(total, (found % np.uint64(SLOTS)).astype(np.int64), np.uint32(1))
        parts = [(k, x) for k, x in enumerate(total.reshape(-1, PART)) if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int32()), pa.array([np.minimum(x, 65535).astype("<u2").tobytes() for _, x in parts], pa.binary())], names=["part", "counts"])

    def levels(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(PART, np.int64)
        for b in batches:
            for x in b.column("counts"):
                total += np.frombuffer(x.as_buffer(), "<u2")
        step = max(1, int(total.mean()) // 16)
        level = np.where(total <= 1, total, np.minimum(255, 1 + np.maximum(1, total // step))).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([level.tobytes()], pa.binary())], names=["part", "levels"])

    out = bytearray(SLOTS)
    for k, x in docs.select("text").mapInArrow(count, "part int, counts binary").groupBy("part").applyInArrow(levels, "part int, levels binary").toLocalIterator():
        out[k * PART : (k + 1) * PART] = x
    return bytes(out)


def set_print(shingles: set[bytes], seed: int = SEED, levels: np.ndarray | None = None, similarity: float = SIMILARITY) -> tuple[int, int, int, int, np.ndarray]:
    """A key of the set (equal sets only share it), its size, its SimHash, and its first shingles by level and hash.

    A set that is similar shares one of its own first shingles with these: of n shingles at least similarity * n are
    common, so the n - similarity * n + 1 first ones of both, in one order for all sets, can't all differ. Those at level
    1 are in no other set; they are left out and their number comes before the others.
    """
    if not shingles:
        return 0, 0, 0, 0, np.zeros(0, np.int64)
    digests = _digests(shingles, seed)
    key, found, set_bits = xxhash.xxh64_intdigest(digests, seed), np.frombuffer(digests, np.uint8).reshape(-1, 8), np.zeros(BITS, np.int64)
    for at in range(0, len(found), 4096):
        set_bits += np.unpackbits(found[at : at + 4096], axis=1).sum(0, dtype=np.int64)
    fp, n, tokens = int.from_bytes(np.packbits(2 * set_bits > len(found)).tobytes(), "big"), len(found), np.frombuffer(digests, np.uint64)
    level = np.full(n, 2, np.uint8) if levels is None else levels[(tokens % np.uint64(SLOTS)).astype(np.int64)]
    order = np.lexsort((tokens, level))[: n - math.ceil(similarity * n - 1e-6) + 1]
    alone = int((level[order] == 1).sum())
    return _signed(key), n, _signed(fp), alone, tokens[order[alone:]].view(np.int64)


def set_prints(docs: DataFrame, keys: list[str], shingle: int, similarity: float) -> DataFrame:
    """`keys`, the set's key `fp`, `size`, SimHash `near` and first shingles (`firsts`, behind `alone` others) of every row of `docs` (with text)."""
    kinds, levels = dict(docs.dtypes), docs.sparkSession.sparkContext.broadcast(shingle_levels(docs, shingle))

    def rows(batch: pa.RecordBatch) -> dict:
        order = np.frombuffer(levels.value, np.uint8)
        fp, size, near, alone, firsts = zip(*(set_print(shingle_set(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle), SEED, order, similarity) for t in batch.column("text")))
        new = {"fp": pa.array(fp, pa.int64()), "size": pa.array(size, pa.int32()), "near": pa.array(near, pa.int64()), "alone": pa.array(alone, pa.int32()), "firsts": pa.array(firsts, pa.list_(pa.int64()))}
        return {k: batch.column(k) for k in keys} | new

    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "fp bigint, size int, near bigint, alone int, firsts array<bigint>"])
    return map_arrow(docs.select(*keys, "text"), rows, schema)


def _by_shard(batches: Iterator[pa.RecordBatch], work) -> Iterator[pa.RecordBatch]:
    """Calls `work` (columns of whole shards to a batch) on batches sorted by their first column, the shard."""
    kept: list[list[np.ndarray]] = []
    for batch in batches:
        if batch.num_rows:
            kept.append([np.asarray(c) for c in batch.columns])
            if kept[-1][0][0] != kept[-1][0][-1]:
                whole = [np.concatenate(x) for x in zip(*kept)]
                last = np.searchsorted(whole[0], whole[0][-1])
                yield work(*(c[:last] for c in whole))
                kept = [[c[last:] for c in whole]]
    if kept:
        yield work(*(np.concatenate(x) for x in zip(*kept)))


def _pairs(similarity: float):
    """Rows (shard, fp, size, near, place, cluster) to pairs of sets that may be similar, by the shard's BK-tree.

    A pair's sizes, and what follows the first shingle that both have, must leave room for what they need in common.
    Sets of one cluster are compared already.
    """

    def pairs(shard, fp, size, near, place, cluster) -> pa.RecordBatch:
        out, starts, rest = [], np.r_[True, shard[1:] != shard[:-1]], size - place
        number = np.cumsum(starts) - 1
        mixed = np.zeros(number[-1] + 1, bool)
        mixed[number[cluster != cluster[np.flatnonzero(starts)[number]]]] = True  # shards with more than one cluster
        here = np.flatnonzero(mixed[number])
        if len(here):
            prints, of = near[here].view(np.uint64), np.cumsum(np.r_[False, np.diff(number[here]) != 0])
            for q, m, _ in within(prints, of, WIDE):
                q, m = here[q], here[m]
                ok = (fp[m] < fp[q]) & (cluster[m] != cluster[q]) & (np.minimum(size[q], size[m]) >= similarity * np.maximum(size[q], size[m]) - 1e-6)
                ok &= np.minimum(rest[q], rest[m]) >= similarity / (1 + similarity) * (size[q] + size[m]) - 1e-6
                out.append((fp[q[ok]], fp[m[ok]]))
        u, v = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return lambda batches: _by_shard(batches, pairs)


def _crowded(prints: DataFrame) -> DataFrame:
    """(shard, fp, place, n, hub) of shards with more than one set, a shard being a shingle: their number and the smallest of them.

    Shards are counted by partial aggregation, and the join back leaves hot shards to be split, so no task holds one.
    """
    spread = prints.select("fp", "alone", "firsts").dropDuplicates(["fp"]).select("fp", "alone", F.posexplode("firsts").alias("place", "shard")).select("shard", "fp", (F.col("alone") + F.col("place")).alias("place"))
    counts = spread.groupBy("shard").agg(F.count("*").alias("n"), F.min("fp").alias("hub")).filter("n > 1")
    return spread.join(counts, "shard")


def _similar(shingle: int, similarity: float):
    def confirm(batch: pa.RecordBatch) -> dict:
        last, of_last, ok = None, set(), []
        for u, a, b in zip(batch.column("u").to_pylist(), batch.column("a"), batch.column("b")):  # a text at a time
            if u != last:
                last, of_last = u, shingle_set(a.as_buffer().to_pybytes(), shingle)
            ok.append(jaccard(of_last, shingle_set(b.as_buffer().to_pybytes(), shingle)) >= similarity)
        return {c: batch.column(c).filter(pa.array(ok)) for c in ("u", "v")}

    return confirm


def _linked_blocks(shingle: int, similarity: float):
    """Rows (key, fp, near, text) sorted by key to edges (u, v) that connect each key's similar sets.

    The BK-tree of the sets' SimHashes names the pairs, as in small shards; their common shingles decide, which are
    counted by products of 0/1 matrices, some thousand shingles at a time.
    """

    def links(fps: list[int], prints: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        sizes, n = np.array([len(x) for x in sets]), len(sets)
        _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(n), sizes)[often[column] > 1]
        column = (np.cumsum(often > 1) - 1)[column[often[column] > 1]]
        order = np.argsort(column, kind="stable")
        row, column, common = row[order], column[order], np.zeros((n, n), np.float32)
        for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            a, b = np.searchsorted(column, (low, low + 4096))
            there = np.zeros((n, 4096), np.float32)
            there[row[a:b], column[a:b] - low] = 1
            common += there @ there.T
        share = common.astype(np.float64) / (sizes[:, None] + sizes[None, :] - common.astype(np.float64))
        named = np.zeros((n, n), bool)
        for q, m, _ in within(np.array(prints, np.int64).view(np.uint64), np.zeros(n, np.int64), WIDE):
            named[q, m] = True
        root = unite(np.arange(n), *np.nonzero(np.tril(named & (share >= similarity), -1)))
        fp, moved = np.array(fps, np.int64), np.flatnonzero(root != np.arange(n))
        return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[root[moved]])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, fps, prints, sets = None, [], [], []
        for batch in batches:
            for key, fp, near, text in zip(*(batch.column(c) for c in ("key", "fp", "near", "text"))):
                if (key := key.as_py()) != last:
                    if len(fps) > 1:
                        yield links(fps, prints, sets)
                    last, fps, prints, sets = key, [], [], []
                fps.append(fp.as_py())
                prints.append(near.as_py())
                sets.append(np.frombuffer(b"".join([xxhash.xxh64_digest(x, SEED) for x in shingle_set(text.as_buffer().to_pybytes(), shingle)]), np.uint64))
        if len(fps) > 1:
            yield links(fps, prints, sets)

    return run


def _clusters(crowded: DataFrame) -> DataFrame | None:
    """(fp, cluster, size, near) of the sets in crowded shards, those that share sets being one cluster; None where no shard is crowded."""
    members = crowded.filter(F.col("n") > CROWD)
    if members.isEmpty():
        return None
    whole = components(members.select(F.col("fp").alias("u"), F.col("hub").alias("v"))).select(F.col("node").alias("fp"), F.col("component").alias("cluster"))
    return checkpointed(whole.join(members.select("fp", "size", "near").dropDuplicates(["fp"]), "fp"))


def _cluster_links(sized: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The links within clusters.

    A cluster's sets are dealt to blocks and every two blocks meet in one task, so neither a row for each pair nor a
    whole cluster in a task is needed.
    """
    blocks = sized.groupBy("cluster").agg(F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).alias("blocks"))
    own = sized.join(blocks, "cluster").withColumn("own", F.pmod(F.xxhash64("fp"), "blocks"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).filter("own <> other or blocks = 1")
    keyed = met.select(F.xxhash64("cluster", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "fp", "near")
    rows = keyed.join(texts, "fp").select("key", "fp", "near", "text").repartition(F.col("key")).sortWithinPartitions("key")
    return checkpointed(rows.mapInArrow(_linked_blocks(shingle, similarity), "u bigint, v bigint").distinct())


def similar_links(docs: DataFrame, prints: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Edges (u, v) that connect all sets of `prints` at this exact Jaccard or above, directly or by others.

    Sets meet by the first shingles that they share, which every similar pair does; wherever they meet, BK-trees over their
    SimHashes give the pairs and the texts decide. What meets in a shingle that more than CROWD sets share is dealt by
    clusters; in other shards a set has at most CROWD - 1 pairs for each of its first shingles.
    """
    sets = prints.select("fp", "size", "near").dropDuplicates(["fp"])
    crowded = checkpointed(_crowded(prints).join(sets, "fp"))
    clusters = _clusters(crowded)
    rows = crowded.withColumn("cluster", F.col("fp"))
    if clusters:
        rows = crowded.filter(F.col("n") <= CROWD).join(clusters.select("fp", "cluster"), "fp", "left").withColumn("cluster", F.coalesce("cluster", "fp"))
    shards = rows.select("shard", "fp", "size", "near", "place", "cluster").repartition(F.col("shard")).sortWithinPartitions("shard")
    pairs = checkpointed(shards.mapInArrow(_pairs(similarity), "u bigint, v bigint").distinct())

    wanted = pairs.select(F.explode(F.array("u", "v")).alias("fp"))
    wanted = (wanted.unionByName(clusters.select("fp")) if clusters else wanted).distinct()
    rows = prints.join(wanted, "fp", "left_semi").groupBy("fp").agg(F.min("__row").alias("__row"))
    texts = checkpointed(docs.select("__row", "text").join(rows, "__row").dropDuplicates(["fp"]).select("fp", F.coalesce("text", F.lit("")).alias("text")))
    of_u, of_v = texts.select(F.col("fp").alias("u"), F.col("text").alias("a")), texts.select(F.col("fp").alias("v"), F.col("text").alias("b"))
    links = checkpointed(map_arrow(pairs.join(of_v, "v").join(of_u, "u").select("u", "v", "a", "b"), _similar(shingle, similarity), "u bigint, v bigint"))
    return links.unionByName(_cluster_links(clusters, texts, shingle, similarity)) if clusters else links


def groups(prints: DataFrame, member: Column, radius: int = RADIUS, links: DataFrame | None = None) -> DataFrame:
    """Adds `component_id`, the smallest `member` among all rows of the row's component, to rows with fp.

    Components are of `links` (u, v), or else of all fingerprints within the radius.
    """
    prints = prints.withColumn("__member", member)
    least = prints.groupBy("fp").agg(F.min("__member").alias("__least"))
    nodes = components(near_links(least.select("fp"), radius) if links is None else links)
    linked = nodes.join(least.withColumnRenamed("fp", "node"), "node")
    best = linked.groupBy("component").agg(F.min("__least").alias("__best"))
    moved = nodes.join(best, "component").select(F.col("node").alias("fp"), "__best")
    whole = least.join(moved, "fp", "left").select("fp", F.coalesce("__best", "__least").alias("component_id"))
    return prints.join(whole, "fp").drop("__member")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of `docs`.

    Defined results: null and empty texts have fingerprint zero and are linked like any other; null ids never
    name a component unless it has no other id; repeated rows and ties stay, each with its own row; an empty
    table gives no rows; other columns are not read.
    """
    prints = checkpointed(fingerprints(docs, ["doc_id"], shingle=shingle))
    return groups(prints, F.col("doc_id"), radius).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, similarity: float | None = None) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component the row with the smallest id stays.

    Near is a SimHash within the radius or, with `similarity`, an exact Jaccard of the shingle sets at or above it, and no
    such pair is left out; texts without words are then copies of each other.

    Defined results: rows are told apart by a cryptographic digest of all their columns, so repeated ids and null ids
    are safe (a null id stays only in a group without another), and of wholly equal rows one stays; null and empty
    texts are one group; ties in id fall to the digest; a text of any length is one row; an empty table gives no
    rows; all columns stay, whatever their names.
    """
    names = docs.columns
    keyed = docs.withColumn("__row", F.sha2(F.concat(*[F.coalesce(F.md5(F.col(c).cast("string")), F.lit("null")) for c in names]), 256))
    member = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("__row").alias("r"))
    if similarity is None:
        prints, links = checkpointed(fingerprints(keyed, ["__row", "doc_id"], shingle=shingle)), None
    else:
        prints = checkpointed(set_prints(keyed, ["__row", "doc_id"], shingle, similarity))
        links = similar_links(keyed, prints, shingle, similarity)
        prints = prints.select("__row", "doc_id", "fp")
    rest = groups(prints, member, radius, links).filter("__row = component_id.r").select("__row").distinct()
    one = Window.partitionBy("__row").orderBy("__row")
    return keyed.join(rest, "__row", "left_semi").withColumn("__n", F.row_number().over(one)).filter("__n = 1").select(*names)
