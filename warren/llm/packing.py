"""Best-fit packing of tokenised documents into sequences."""

from __future__ import annotations

import base64
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warren.llm.common import checkpointed, map_arrow, running_total

CAPACITY = 2048
VOCABULARY = "byte_bpe_50k.json"
#: Pieces of one length in a ranking bucket.
ROWS_A_BUCKET = 1500
#: Runs of equal bins that a plan may have to be broadcast; the number of lengths bounds them to a few thousand.
BROADCAST_RUNS = 100_000


#: How the byte-level vocabulary cuts texts before merging, and its special token.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = {"<|endoftext|>": 50256}


class Ids:
    """Token ids of texts as little-endian unsigned 32-bit bytes, as `tokenizers` gives them for the file at `path`.

    tiktoken merges by the same vocabulary, read as ranks from the file beside it, in a quarter of the time; both
    agree on every code point. It gives up on runs of some 100,000 blanks, which `tokenizers` then encodes itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=CUTS, mergeable_ranks=ranks, special_tokens=SPECIAL)
        self.exact = Tokenizer.from_file(path)

    def __call__(self, text: str) -> bytes:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()
        except ValueError:  # the pattern's stack is spent
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@cache
def ids_of(path: str) -> Ids:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Ids(path)


def tokenised_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document, its ids followed by id 0.

    Only documents over the capacity are cut; the first piece takes what the full ones leave.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def rows(batch: pa.RecordBatch) -> dict:
        encode, out = ids_of(path), {k: [] for k in ("i", "piece", "start", "length", "crc", "ids")}
        for i, text in enumerate(batch.column("text")):
            ids = encode(text.as_py() or "") + b"\0\0\0\0"
            n, at, piece = len(ids) // 4, 0, 0
            while at < n:
                size = n if n <= capacity else (n % capacity or capacity) if at == 0 else capacity
                part = ids[4 * at : 4 * (at + size)]
                for k, v in (("i", i), ("piece", piece), ("start", at), ("length", size), ("crc", zlib.crc32(part)), ("ids", part)):
                    out[k].append(v)
                at, piece = at + size, piece + 1
        found = {
            "doc_id": batch.column("doc_id").take(pa.array(out["i"], pa.int64())),
            "piece": pa.array(out["piece"], pa.int32()),
            "start": pa.array(out["start"], pa.int64()),
            "length": pa.array(out["length"], pa.int64()),
            "ids_crc32": pa.array(out["crc"], pa.int64()),
        }
        return found | ({"ids": pa.array(out["ids"], pa.binary())} if with_ids else {})

    return map_arrow(docs.select("doc_id", "text"), rows, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids)


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """Bins for `counts` items of each length: ([(length, how many of it in one bin), ...], how many such bins).

    Large items (over a third of the capacity) first: at most two share a bin, each matched greedily, largest
    first, with the largest that still fits. The rest go by falling length into the smallest gap that takes them.
    Works on runs of equal bins, so its cost depends on the capacity, not on the number of items.
    """
    left = {s: c for s, c in counts.items() if c > 0}
    gaps: dict[int, list] = {}  # gap to runs (contents, bins)

    def put(contents, bins):
        gap = capacity - sum(s * q for s, q in contents)
        gaps.setdefault(gap, []).append((contents, bins))

    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    for s in large:
        while left.get(s):
            mate = next((p for p in large if left.get(p) and p + s <= capacity and (p != s or left[s] > 1)), None)
            if mate is None:
                put([(s, 1)], left.pop(s))
            elif mate == s:
                bins, left[s] = left[s] // 2, left[s] % 2
                put([(s, 2)], bins)
            else:
                bins = min(left[s], left[mate])
                put([(s, 1), (mate, 1)], bins)
                left[s] -= bins
                left[mate] -= bins
    for s in sorted((s for s in left if left[s] and 3 * s <= capacity), reverse=True):
        c = left[s]
        for gap in sorted(g for g in gaps if g >= s):
            each = gap // s
            runs = gaps.pop(gap)
            while runs and c:
                contents, bins = runs.pop()
                full = min(bins, c // each)
                if full:
                    put([*contents, (s, each)], full)
                    c, bins = c - full * each, bins - full
                if bins and c:  # fewer than one bin takes
                    put([*contents, (s, c)], 1)
                    c, bins = 0, bins - 1
                if bins:
                    runs.append((contents, bins))
            if runs:
                gaps.setdefault(gap, []).extend(runs)
            if not c:
                break
        if c:
            each = capacity // s
            if c // each:
                put([(s, each)], c // each)
            if c % each:
                put([(s, c % each)], 1)
    return [run for runs in gaps.values() for run in runs]


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece and length (1 to capacity).

    A plan for the whole table needs only how many pieces have each length: at most `capacity` rows come to the
    driver and a few thousand runs of equal bins go back. A piece's rank among those of its length, from
    distributed prefix sums, then names its bin and its place there. Ranks are by a hash of the id, so sequences
    mix documents from all over the table. The runs are broadcast behind a check of their number, so a length that
    most pieces have (full ones) is no join key of one task.
    """
    per_length = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    slots, base = [], 0
    begun = dict.fromkeys(per_length, 0)
    for contents, bins in plan_bins(per_length, capacity):
        offset = 0
        for s, each in contents:
            slots.append((s, begun[s], begun[s] + bins * each, each, base, offset))
            begun[s] += bins * each
            offset += s * each
        base += bins
    plan = pieces.sparkSession.createDataFrame(slots, "length long, first long, past long, each long, base long, place long")
    # for every length its runs in one array, found by their bounds
    runs = plan.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("first", "past", "each", "base", "place"))).alias("__runs"))
    digits = len(f"{max(1, sum(per_length.values()) // ROWS_A_BUCKET // 8):x}")
    rows = pieces.withColumn("__h", F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "piece", *[c for c in ("ids_crc32",) if c in pieces.columns])))
    ranked = running_total(rows, ["length"], [F.col("__h"), F.col("doc_id"), F.col("piece")], (F.col("__h"), digits), F.lit(1), "__rank")
    run = F.element_at(F.filter("__runs", lambda r: (r["first"] <= F.col("__rank")) & (F.col("__rank") < r["past"])), 1)
    step = F.col("__rank") - F.col("__run.first")
    return (
        ranked.join(F.broadcast(runs) if len(slots) <= BROADCAST_RUNS else runs, "length")
        .withColumn("__run", run)
        .withColumn("sequence_id", F.col("__run.base") + F.floor(step / F.col("__run.each")))
        .withColumn("offset", F.col("__run.place") + F.col("length") * (step % F.col("__run.each")))
        .drop("__h", "__rank", "__runs", "__run")
    )


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenises `docs` (doc_id, text) once and packs the pieces.

    Defined results: null text is empty and gives the closing id alone; null ids stay null; repeated rows are
    packed each; a text of any length is cut whole, held by one task a few times over; pieces that tie in length and
    hash are alike and take either place; an empty table gives no rows; other columns are not read.
    """
    return pack(checkpointed(tokenised_pieces(docs, path, capacity)), capacity)
