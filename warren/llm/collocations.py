"""Phrase collocations from depth-truncated suffix subtrees, built by groups of word prefixes."""

from __future__ import annotations

import heapq
from array import array
from collections import Counter
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from warren.llm.common import checkpointed

#: Words of the longest phrase, occurrences of the rarest candidate, and rows of each language's report.
DEPTH, LEAST, TOP = 5, 100, 2000
#: A phrase goes where a longer one has at least this share of its occurrences, in hundredths.
SHARE = 100
#: Suffixes of a group, at most: what one subtree may hold. Prefixes above it are extended by a word.
GROUP_SUFFIXES = 2_000_000
#: Prefixes are weighed in so many slots; the table of slots and their groups is broadcast.
SLOTS = 1 << 14
#: Bits of the filter of frequent words (16 for each) and slots of that of frequent word pairs (one for so many words), both
#: broadcast and within these bounds. Smaller ones let more suffixes pass, which changes no result.
FILTER_BITS, PAIR_SLOTS, WORDS_A_SLOT = (1 << 16, 1 << 27), (1 << 18, 1 << 26), 16
#: Entries that a task counts before it passes them on, and bytes of text that it takes at once.
HELD, PORTION = 250_000, 1 << 20
#: Parts that a language's phrases are ranked in before they are ranked together.
RANK_PARTS = 32

_BREAKS = bytes(10 if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
#: Stands between pieces; no UTF-8 text holds this byte.
CUT = b"\xff"


def tokens(texts: list[bytes]) -> list[bytes]:
    """The words of texts and CUT between their pieces: A-Z in lower case (bytes.lower knows no others), cut at stops and line ends."""
    return b"\n".join(texts).lower().translate(_BREAKS).replace(b"\n", b" \xff ").split()


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Each language's texts as words, about PORTION bytes at a time."""
    for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
        held: dict[str, list] = {}
        size: Counter = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("__text").to_pylist()):
            if text:
                held.setdefault(lang, []).append(text)
                size[lang] += len(text)
                if size[lang] >= PORTION:
                    yield lang, tokens(held.pop(lang))
                    del size[lang]
        for lang, texts in held.items():
            yield lang, tokens(texts)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("__text"))


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("n", pa.int64())])


def _counted(docs: DataFrame, phrases) -> DataFrame:
    """(lang, phrase, n): what `phrases(lang, words)` names, counted within the task before it is passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            counts: dict[str, Counter] = {}
            held = 0
            for lang, words in _portions(batches):
                own = counts.setdefault(lang, Counter())
                before = len(own)
                own.update(phrases(lang, words))
                held += len(own) - before
                if held > HELD:
                    yield from ((k, p, n) for k, c in counts.items() for p, n in c.items())
                    counts, held = {}, 0
            yield from ((k, p, n) for k, c in counts.items() for p, n in c.items())

        yield from _batched(rows(), _COUNTED)

    return _texts(docs).mapInArrow(run, "lang string, phrase binary, n bigint")


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, n) of every word."""
    counted = _counted(docs, lambda lang, words: words).filter(F.col("phrase") != F.lit(CUT))
    return counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh32_intdigest(lang.encode()))


def _place(lang: str, word: bytes, bits: int) -> int:
    return _hash(lang, word) % bits


def frequent_filter(frequent: DataFrame, bounds: tuple[int, int] = FILTER_BITS) -> bytearray:
    """A bit for each frequent word's hash, so that no frequent word is missed; its size is bounded."""
    bits = min(max(bounds[0], 1 << (16 * frequent.count()).bit_length()), bounds[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            places = [_place(k, w, bits) for k, w in zip(b.column("lang").to_pylist(), b.column("phrase").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([p >> 5 for p in places], pa.int64()), pa.array([1 << (p & 31) for p in places], pa.int64())], names=["cell", "bit"])

    filled = frequent.select("lang", "phrase").mapInArrow(run, "cell bigint, bit bigint").groupBy("cell").agg(F.expr("bit_or(bit)").alias("bit"))
    out = bytearray(bits // 8)
    for cell, bit in filled.toLocalIterator():
        out[4 * cell : 4 * cell + 4] = bit.to_bytes(4, "little")
    return out


class _Frequent:
    """The words of a language that pass the filter as numbers (0 for others and CUT), and their hashes by number."""

    def __init__(self, table: bytes):
        self.table, self.bits = table, 8 * len(table)
        self.reset()

    def reset(self) -> None:
        self.numbers: dict[str, dict[bytes, int]] = {}
        self.hashes = array("Q", [0])
        self.held = 0

    def of(self, lang: str, words: list[bytes]) -> np.ndarray:
        if self.held > HELD:
            self.reset()
        outer = self

        class Known(dict):
            def __missing__(self, word: bytes) -> int:
                h = _hash(lang, word)
                at = h % outer.bits
                number = 0
                if word != CUT and outer.table[at >> 3] >> (at & 7) & 1:
                    number = len(outer.hashes)
                    outer.hashes.append(h)
                outer.held += 1
                self[word] = number
                return number

        known = self.numbers.setdefault(lang, Known())
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def pairs(self, ids: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
        """The places whose word and the next are frequent, and the slots of these pairs."""
        at = np.nonzero((ids[:-1] > 0) & (ids[1:] > 0))[0]
        h = np.frombuffer(self.hashes, np.uint64)
        mixed = (h[ids[at]] * np.uint64(0x9E3779B97F4A7C15) + h[ids[at + 1]]) * np.uint64(0xD6E8FEB86659FD93)
        return at, (mixed >> np.uint64(20)) & np.uint64(slots - 1)


def pair_filter(docs: DataFrame, words, slots: int, least: int = LEAST) -> bytearray:
    """A bit for each slot that holds at least `least` pairs of frequent words, so that no frequent pair is missed.

    A task counts its pairs by slots and passes the counts on as bytes that stop at `least`, which keeps the comparison
    exact; counts of equal parts of the slots are added in one task. A part is passed on whole, or as the places and
    counts of its slots where that is less, so what a task passes on goes with its pairs and never beyond the slots.
    """
    part = min(slots, 1 << 16)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total, found, size = _Frequent(words.value), np.zeros(slots, np.uint16), [], 0

        def added() -> None:
            nonlocal total, found, size
            if found:
                total = np.minimum(total + np.minimum(np.bincount(np.concatenate(found).astype(np.int64), minlength=slots), least).astype(np.uint16), least)
                found, size = [], 0

        for lang, portion in _portions(batches):
            _, own = known.pairs(known.of(lang, portion), slots)
            found.append(own)
            size += len(own)
            if size > 3_000_000:
                added()
        added()
        counted = total.astype(np.uint8)
        parts, coded = [], []
        for k in range(slots // part):
            own = counted[k * part : (k + 1) * part]
            at = np.flatnonzero(own)
            if len(at):
                parts.append(k)
                coded.append(at.astype("<u2").tobytes() + own[at].tobytes() if 3 * len(at) < part else own.tobytes())
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(coded, pa.binary())], names=["part", "counts"])

    def summed(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(part, np.uint16)
        for b in batches:
            for x in b.column("counts"):
                coded, n = x.as_buffer(), len(x.as_buffer()) // 3
                if len(coded) == part:
                    total = np.minimum(total + np.frombuffer(coded, np.uint8), least).astype(np.uint16)
                else:
                    at = np.frombuffer(coded, "<u2", n)
                    total[at] = np.minimum(total[at] + np.frombuffer(coded, np.uint8, n, 2 * n), least)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(total >= least, bitorder="little").tobytes()], pa.binary())], names=["part", "bits"])

    found = _texts(docs).mapInArrow(count, "part int, counts binary").groupBy("part").applyInArrow(summed, "part int, bits binary")
    out = bytearray(slots // 8)
    for k, bits in found.toLocalIterator():
        out[k * part // 8 : (k + 1) * part // 8] = bits
    return out


def suffixes(docs: DataFrame, frequent: DataFrame, total: int, depth: int = DEPTH, least: int = LEAST) -> DataFrame:
    """(lang, phrase, n): what begins at each word, `depth` words at most, each followed by a space.

    A suffix ends before the first word that is rare by itself or after the word before, as no candidate holds either;
    those of one word, whose counts are known, are left out. `total` is the number of words.
    """
    context = docs.sparkSession.sparkContext
    words = context.broadcast(bytes(frequent_filter(frequent)))
    slots = min(max(PAIR_SLOTS[0], 1 << (total // WORDS_A_SLOT).bit_length()), PAIR_SLOTS[1])
    pairs = context.broadcast(bytes(pair_filter(docs, words, slots, least)))
    state: dict = {}

    def phrases(lang: str, own: list[bytes]) -> Iterator[bytes]:
        if not state:
            state["known"], state["bits"] = _Frequent(words.value), np.frombuffer(pairs.value, np.uint8)
        known, bits = state["known"], state["bits"]
        at, slot = known.pairs(known.of(lang, own), slots)
        at = at[bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1 > 0]
        good = np.zeros(len(own) + depth, bool)
        good[at] = True
        more = np.ones(len(at), np.int64)
        reaches = np.ones(len(at), bool)
        for k in range(1, depth - 1):
            reaches &= good[at + k]
            more += reaches
        for i, n in zip(at.tolist(), more.tolist()):
            yield b" ".join(own[i : i + n + 1]) + b" "

    return _counted(docs, phrases)


def _prefix(depth: int) -> Column:
    """The first `depth` words of a suffix, or all it has."""
    return F.substring_index(F.col("phrase").cast("string"), " ", depth)


def _slot(depth: int, slots: int) -> Column:
    return F.pmod(F.xxhash64("lang", _prefix(depth), F.lit(depth)), F.lit(slots))


def prefix_groups(rows: DataFrame, budget: int, depth: int = DEPTH, slots: int = SLOTS) -> list[list[tuple[int, int]]]:
    """For each depth the (slot, group) of the prefixes of so many words; a slot without a group is extended by a word.

    Vertical partitioning: slots of one-word prefixes are weighed by their suffixes; those above the budget are
    weighed again by prefixes of two words, and so on; the slots that remain fill groups of at most the budget,
    heaviest first. What is above the budget at full depth is a group by itself, whose equal suffixes are summed.
    """
    levels, open_, weights = [], rows, []
    for d in range(1, depth + 1):
        found = open_.groupBy(_slot(d, slots).alias("slot")).count().collect()  # at most `slots` rows
        closed = [r for r in found if d == depth or r["count"] <= budget]
        levels.append({r["slot"] for r in closed})
        weights += [(r["count"], d, r["slot"]) for r in closed]
        if len(closed) == len(found):
            break
        heavy = [r["slot"] for r in found if r["count"] > budget]
        open_ = open_.filter(_slot(d, slots).isin(heavy))
    weights.sort(key=lambda x: (-x[0], x[1:]))
    out: list[list[tuple[int, int]]] = [[] for _ in levels]
    free: list[tuple[int, int]] = []  # (taken, group), the emptiest first
    made = 0
    for weight, d, slot in weights:
        if free and free[0][0] + weight <= budget:
            taken, group = heapq.heappop(free)
        else:
            taken, group, made = 0, made, made + 1
        out[d - 1].append((slot, group))
        heapq.heappush(free, (taken + weight, group))
    return out


def grouped(rows: DataFrame, groups: list[list[tuple[int, int]]], slots: int = SLOTS) -> DataFrame:
    """Adds to each suffix its group and `closed`, the words of the prefix that decided it.

    The groups of each depth's slots are a constant array of at most `slots` entries, looked up by place.
    """
    found = []
    for d, level in enumerate(groups, 1):
        known = dict(level)
        table = F.split(F.lit(",".join(str(known.get(i, "")) for i in range(slots))), ",")
        group = F.nullif(F.get(table, _slot(d, slots).cast("int")), F.lit("")).cast("long")
        found.append(F.when(group.isNotNull(), F.struct(group.alias("group"), F.lit(d).alias("closed"))))
    return rows.withColumn("__found", F.coalesce(*found)).select(*rows.columns, "__found.group", "__found.closed")


def subtree_counts(rows: DataFrame, groups: int, least: int = LEAST) -> DataFrame:
    """(lang, phrase, n): the nodes of the groups' suffix trees with the totals of their leaves.

    A task reads its groups' suffixes in order: the words that one shares with the next are the depth at which their
    paths part, and a node below it is complete, so the tree is a stack of one path. Nodes of fewer words than the
    prefix that decided a group have leaves in other groups: these parts are passed on whole and summed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            lang, path, totals, parts = None, [], [], []

            def left(keep: int):
                while len(path) > keep:
                    n, part = totals.pop(), parts.pop()
                    k = len(path)
                    if k > 1 and (n >= least or part > k):
                        yield lang, b" ".join(path), n
                    path.pop()
                    if totals:
                        totals[-1] += n
                        parts[-1] = max(parts[-1], part)

            for batch in batches:
                for own, phrase, n, closed in zip(*(batch.column(c).to_pylist() for c in ("lang", "phrase", "n", "closed"))):
                    words = phrase.split(b" ")[:-1]
                    same = 0
                    if own == lang:
                        for a, b in zip(path, words):
                            if a != b:
                                break
                            same += 1
                    yield from left(same)
                    lang = own
                    path.extend(words[same:])
                    totals.extend([0] * (len(words) - same))
                    parts.extend([0] * (len(words) - same))
                    totals[-1] += n
                    parts[-1] = max(parts[-1], closed)
            yield from left(0)

        yield from _batched(rows(), _COUNTED)

    dealt = rows.repartition(groups, "group").sortWithinPartitions("lang", "phrase")
    nodes = dealt.select("lang", "phrase", "n", "closed").mapInArrow(run, "lang string, phrase binary, n bigint")
    return nodes.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def phrase_counts(docs: DataFrame, folder: str, depth: int = DEPTH, least: int = LEAST, budget: int = GROUP_SUFFIXES, slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """(lang, n) of all words, and (lang, words, n): the phrases of at most `depth` words, array `words`, found at least `least` times."""
    spark = docs.sparkSession
    words = checkpointed(word_counts(docs))
    frequent = words.filter(F.col("n") >= least)
    path = f"{folder}/suffixes-{uuid4().hex}"
    total = words.agg(F.sum("n")).first()[0] or 0
    suffixes(docs, frequent, total, depth, least).write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema("lang string, phrase binary, n bigint").parquet(path)
    # enough groups for every partition to have several, of at most the budget
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    fair = max(1, min(budget, rows.count() // (4 * partitions)))
    groups = prefix_groups(rows, fair, depth, slots)
    made = 1 + max((g for level in groups for _, g in level), default=0)
    nodes = subtree_counts(grouped(rows, groups, slots), max(partitions, made // 4), least)
    known = frequent.unionByName(nodes)
    return words.groupBy("lang").agg(F.sum("n").alias("total")), known.select("lang", F.split(F.col("phrase").cast("string"), " ").alias("words"), F.col("n"))


def collocations(docs: DataFrame, folder: str, depth: int = DEPTH, least: int = LEAST, top: int = TOP, share: int = SHARE, budget: int = GROUP_SUFFIXES, slots: int = SLOTS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first `top` phrases of 2 to `depth` words.

    A phrase found a >= `least` times is cut where floor(1000 * a * n / (l * r)) is least (l and r: occurrences of the
    two parts, n: all words); it goes if a longer candidate around it has at least `share` hundredths of its
    occurrences. `folder` is a place that all executors reach.

    Defined results: null texts have no words; a null language is `und`; texts of any length are split whole, however
    long their words; rows that repeat count each; ties go by more occurrences, then by the phrase's bytes, and equal
    scores of two cuts to the shorter first part; an empty table gives no rows; other columns are not read. Counts
    are exact; arithmetic is decimal.
    """
    totals, known = phrase_counts(docs, folder, depth, least, budget, slots)
    known = checkpointed(known)
    phrase = lambda a: F.array_join(a, " ")
    many = F.size("words")
    longer = known.filter(many > 2)
    inner = [F.slice("words", at, many - F.lit(size)) for size in range(1, depth - 1) for at in range(1, size + 2)]
    inside = longer.withColumn("part", F.explode(F.array(*inner))).filter(F.size("part") > 1)
    most = inside.groupBy("lang", phrase("part").alias("phrase")).agg(F.max("n").alias("around"))
    found = known.filter(many > 1).select("lang", phrase("words").alias("phrase"), "words", F.col("n").alias("a"))
    found = found.join(most, ["lang", "phrase"], "left").filter(F.col("around").isNull() | (100 * F.col("around") < share * F.col("a"))).drop("around")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), many - 1)))
    cuts = cuts.withColumn("first", phrase(F.slice("words", F.lit(1), F.col("k")))).withColumn("rest", phrase(F.slice("words", F.col("k") + 1, many - F.col("k"))))
    part = lambda name, n: known.select("lang", phrase("words").alias(name), F.col("n").alias(n))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(totals.withColumnRenamed("total", "n"), "lang")
    long = lambda c: F.col(c).cast("decimal(17,0)")
    scored = cuts.withColumn("__an", (long("a") * long("n")).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")).withColumn("__lr", long("l") * long("r"))
    scored = scored.withColumn("score", F.expr("__an div __lr").cast("long"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    rank = lambda *keys: F.row_number().over(Window.partitionBy("lang", *keys).orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
    # first among a part of a language's phrases, so that the last window has at most RANK_PARTS * top rows of a language
    best = best.withColumn("__part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).withColumn("__rank", rank("__part")).filter(F.col("__rank") <= top)
    return best.withColumn("rank", rank()).filter(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
t AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, words[i:i + k - 1] AS ws FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(words) >= k)),
f AS (SELECT lang, ws, array_to_string(ws, ' ') AS phrase, count(*) AS c FROM g GROUP BY lang, ws HAVING count(*) >= 100),
i AS (SELECT lang, unnest(list_concat(list_transform(range(1, len(ws)), lambda k: ws[1:k]), flatten(list_transform(range(2, len(ws) + 1), lambda j: list_transform(range(j, len(ws) + 1), lambda e: ws[j:e]))))) AS ws, c FROM f WHERE len(ws) > 2),
m AS (SELECT lang, ws, max(c) AS around FROM i WHERE len(ws) > 1 GROUP BY lang, ws),
a AS (SELECT f.* FROM f LEFT JOIN m ON f.lang = m.lang AND f.ws = m.ws WHERE len(f.ws) > 1 AND (around IS NULL OR 100 * around < 100 * f.c)),
c AS (SELECT lang, phrase, ws, c AS a, unnest(range(1, len(ws))) AS k FROM a),
s AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.c AS l, y.c AS r, t.n, CAST((1000::HUGEINT * c.a * t.n) // (x.c::HUGEINT * y.c) AS BIGINT) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.ws = c.ws[1:c.k] JOIN f y ON y.lang = c.lang AND y.ws = c.ws[c.k + 1:] JOIN t ON t.lang = c.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM o WHERE rank <= 2000
"""
