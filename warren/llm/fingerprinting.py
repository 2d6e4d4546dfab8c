"""Document fingerprints from closed syncmers."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warren.llm.common import map_arrow, utf8

#: Bytes of an anchor, and of the inner substrings whose smallest must lie at its edge.
K, S = 12, 5
#: Anchors that a fingerprint keeps: the smallest by hash. None keeps all of them.
KEPT = 64
#: An anchor in a fingerprint: the upper half of its hash, and its place in bytes.
ANCHOR = np.dtype([("hash", ">u4"), ("place", ">u4")])
#: Documents aimed at in a range of ids, and the most ranges there are.
ROWS_A_RANGE, MOST_RANGES = 4000, 20_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _A
    x ^= x >> np.uint64(29)
    x *= _B
    return x ^ (x >> np.uint64(32))


def syncmers(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the k-mers whose smallest inner substring is their first or their last.

    Whether a k-mer is an anchor depends on its own bytes only, so an edit moves no anchor outside of it.
    """
    n = len(text)
    if n < K:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    b = np.frombuffer(text, np.uint8).astype(np.uint64)
    inner = b[: n - S + 1].copy()
    for j in range(1, S):
        inner |= b[j : n - S + 1 + j] << np.uint64(8 * j)
    inner = _mixed(inner)
    least, width, span = inner, 1, K - S + 1
    while width < span:
        step = min(width, span - width)
        least, width = np.minimum(least[:-step], least[step:]), width + step
    at = np.flatnonzero((inner[: n - K + 1] == least) | (inner[K - S :] == least))
    # a k-mer's hash joins those of inner substrings that together cover it
    tail = inner[at + K - S]
    for j in range(0, K - S, S):
        tail = _mixed(tail ^ (inner[at + j] + np.uint64(j + 1)))
    return at, tail


def anchored(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The syncmers of a text; one without any (of less than 18 bytes) is one anchor itself, an empty one has none."""
    at, hashes = syncmers(text)
    if len(at) or not text:
        return at, hashes
    return np.zeros(1, np.int64), np.full(1, int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little"), np.uint64)


def sketch(text: bytes, kept: int | None = KEPT) -> np.ndarray:
    """The anchors with the smallest distinct hashes, by hash, each with its first place (places stop at 4 GB)."""
    at, hashes = anchored(text)
    found, first = np.unique(hashes >> np.uint64(32), return_index=True)
    out = np.zeros(len(found[:kept]), ANCHOR)
    out["hash"], out["place"] = found[:kept], np.minimum(at[first[:kept]], 0xFFFFFFFF)
    return out


def likeness(a: np.ndarray, b: np.ndarray, kept: int | None = KEPT) -> float:
    """The share of anchors that two fingerprints have in common in the same order of places, among the smallest of both.

    Common anchors are matched by place: the most that stand in one order in both texts count. With all anchors kept
    the share is exact, else an estimate. Two empty fingerprints are alike.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    least = np.union1d(a["hash"], b["hash"])[:kept]
    _, i, j = np.intersect1d(a["hash"], b["hash"], assume_unique=True, return_indices=True)
    among = np.isin(a["hash"][i], least)
    i, j = i[among], j[among]
    ends: list[int] = []  # of the shortest-ending rising runs of each length
    for place in b["place"][j[np.argsort(a["place"][i], kind="stable")]].tolist():
        at = bisect_left(ends, place)
        ends[at : at + 1] = [place]
    return len(ends) / len(least)


def anchors(docs: DataFrame) -> DataFrame:
    """(doc_id, place, hash) of every anchor of every row, places in bytes."""
    kind = dict(docs.dtypes)["doc_id"]

    def rows(batch: pa.RecordBatch) -> dict:
        found = [anchored(t) for t in utf8(batch.column("text"))]
        which = np.repeat(np.arange(len(found)), [len(x[0]) for x in found])
        return {"doc_id": batch.column("doc_id").take(pa.array(which)), "place": np.concatenate([x[0] for x in found]), "hash": np.concatenate([x[1] for x in found]).view(np.int64)}

    return map_arrow(docs.select("doc_id", "text"), rows, f"doc_id {kind}, place bigint, hash bigint")


def _with_next(batches: Iterator[pa.RecordBatch], kept: int | None) -> Iterator[pa.RecordBatch]:
    """Sorted rows (range, guard, doc_id, text) to results; a range's last row is a guard for its neighbour only."""
    held, out = None, []

    def result(one, after):
        doc_id, text, own = one
        n, e = len(text), len(text) // 4
        edited = (text[: n - e] + after[0][:e]).encode()
        new = sketch(edited, kept) if e else own
        out.append((doc_id, n, hashlib.sha256(edited).hexdigest(), own.tobytes().hex(), new.tobytes().hex(), likeness(own, new, kept), likeness(own, after[1], kept)))

    def batch_of() -> pa.RecordBatch:
        kinds = [id_kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        made = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names=NAMES)
        out.clear()
        return made

    for batch in batches:
        id_kind = batch.schema.field("doc_id").type
        for part, guard, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            own = sketch(text.encode(), kept)
            if held and held[0] == part:
                result(held[1], (text, own))
            held = None if guard else (part, (doc_id, text, own))
        if out:
            yield batch_of()


SCHEMA = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
NAMES = ["doc_id", *(f.split()[0] for f in SCHEMA.split(", "))]


def edited_fingerprints(docs: DataFrame, kept: int | None = KEPT) -> DataFrame:
    """Fingerprints of every row's text and of its edited text (its last quarter from the next document's start).

    With `kept=None` fingerprints keep all anchors and likeness is exact.

    Documents meet the next one in ranges of ids, bounded by quantiles of the ids (at most MOST_RANGES numbers
    on the driver). The first document of each range also goes to the range before it as a guard, so texts are
    shuffled once and no range needs another.

    Defined results: null text is empty; null ids count as the smallest; rows that tie in id
    follow each other in order of text, in one range and so in one task; a table of one row is its own next; a text of any length is one
    row, of which a task holds two at a time; an empty table gives no rows; other columns are not read.
    """
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    ids = docs.select(order.alias("o"))
    n = ids.count()
    parts = max(1, min(MOST_RANGES, n // ROWS_A_RANGE))
    cuts = ids.agg(F.percentile_approx("o", [i / parts for i in range(1, parts)], 100 * parts).alias("c")).first()["c"] if n and parts > 1 else []
    bounds = [-(1 << 63), *sorted({c for c in cuts or [] if c > -(1 << 63)})]
    steps = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)]
    lit = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
    search = lambda o: F.aggregate(lit(steps), F.lit(1).cast("long"), lambda at, s: F.when((at + s <= len(bounds)) & (F.get(lit(bounds), (at + s - 1).cast("int")) <= o), at + s).otherwise(at)) - 1
    firsts = {r["p"]: r["f"] for r in ids.groupBy(search(F.col("o")).alias("p")).agg(F.min("o").alias("f")).collect()}  # at most MOST_RANGES rows
    there = sorted(firsts) or [0]
    first = [firsts.get(i) for i in range(len(bounds))]
    before = {p: there[i - 1] for i, p in enumerate(there)}
    rows = docs.select(order.alias("o"), "doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("p", search(F.col("o")))
    own = F.struct(F.col("p").alias("p"), F.lit(0).alias("guard"))
    as_guard = F.struct(F.get(lit([before.get(i, 0) for i in range(len(bounds))]), F.col("p").cast("int")).alias("p"), F.lit(1).alias("guard"))
    sent = F.when(F.col("o") == F.get(lit(first), F.col("p").cast("int")), F.array(own, as_guard)).otherwise(F.array(own))
    dealt = rows.select("o", "doc_id", "text", F.explode(sent).alias("to")).select("to.p", "to.guard", "o", "doc_id", "text")
    sorted_rows = dealt.repartition(len(bounds), "p").sortWithinPartitions("p", "guard", "o", "text")
    return sorted_rows.select("p", "guard", "doc_id", "text").mapInArrow(lambda batches: _with_next(batches, kept), f"doc_id {dict(docs.dtypes)['doc_id']}, {SCHEMA}")
