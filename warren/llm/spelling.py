"""Spelling variants: words one edit apart, found by blocked Gram matrices of their letter counts."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warren.llm.common import checkpointed

#: A word's least code points and occurrences, and how many times as frequent its form must be.
LEAST_CHARS, LEAST_COUNT, TIMES = 6, 5, 5
#: Runs whose hash this divides lose a code point.
DIVISOR = 199
#: The letters are dealt to so many groups. An edit changes the counts of two letters at most, so all groups but two agree.
GROUPS = 5
#: Words of a block that one product takes; blocks above this are dealt to tiles, of which two meet in a task.
BLOCK_WORDS = 4096
#: Small blocks share a product of so many words, and a product has so many rows at most.
CHUNK_WORDS, PRODUCT_ROWS = 192, 512
#: Longest words that are compared as rows of code points; longer ones are compared one by one.
ROW_CHARS = 64
HELD = 400_000

#: Letters are a-z and what lies between U+00C0 and U+00FF.
LETTERS = 26 + 64
_RUNS = re.compile("[a-zÀ-ÿ]+")
ROUNDS = 12


def edited_runs(doc_id: int | None, text: bytes, divisor: int = DIVISOR) -> Counter:
    """How often each word is found in a text of UTF-8: its runs of letters, some of them with a code point deleted."""
    begun, out = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode()), Counter()
    for run, n in Counter(_RUNS.findall(text.lower().decode())).items():
        h = zlib.crc32(run.encode(), begun)
        if h % divisor == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def vocabulary(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of at least `least_chars` code points found at least `least_count` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def made() -> Iterator[pa.RecordBatch]:
            items = list(counts.items())
            for at in range(0, len(items), 20_000):
                words, n = zip(*items[at : at + 20_000])
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])
            counts.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("__text")):
                found = edited_runs(doc_id, text.as_buffer().to_pybytes() if text.is_valid else b"")
                counts.update({w: n for w, n in found.items() if len(w) >= least_chars})
                if len(counts) > HELD:
                    yield from made()
        yield from made()

    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("__text")).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def letter_counts(words: list[str]) -> np.ndarray:
    """A row of counts for each word."""
    out = np.zeros((len(words), LETTERS), np.int64)
    for i, word in enumerate(words):
        if len(word) > ROW_CHARS:
            out[i] = np.bincount([_letter(ord(c)) for c in word], minlength=LETTERS)
    short = [i for i, w in enumerate(words) if len(w) <= ROW_CHARS]
    if short:
        codes = code_rows([words[i] for i in short])
        row, column = np.nonzero(codes)
        letter = codes[row, column].astype(np.int64)
        letter = np.where(letter < 0xC0, letter - 97, letter - 0xC0 + 26)
        out[short] = np.bincount(row * LETTERS + letter, minlength=len(short) * LETTERS).reshape(-1, LETTERS)
    return out


def _letter(code: int) -> int:
    return code - 97 if code < 0xC0 else code - 0xC0 + 26


def code_rows(words: list[str]) -> np.ndarray:
    """Code points as rows, filled up with 0."""
    longest = max(map(len, words))
    return np.array(words, f"U{longest}").view(np.uint32).reshape(len(words), longest).astype(np.uint16)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> np.ndarray:
    """The group of each letter: letters by falling frequency, dealt to and fro, so that all groups tell words apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS, np.int64)
        for b in batches:
            if b.num_rows:
                total += letter_counts(b.column("word").to_pylist()).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(LETTERS), pa.int32()), pa.array(total)], names=["letter", "n"])

    found = words.select("word").mapInArrow(run, "letter int, n bigint").groupBy("letter").agg(F.sum("n").alias("n")).collect()  # a row for each letter
    order = [r["letter"] for r in sorted(found, key=lambda r: (-r["n"], r["letter"]))]
    out = np.zeros(LETTERS, np.int64)
    for rank, letter in enumerate(order):
        turn, place = divmod(rank, groups)
        out[letter] = place if turn % 2 == 0 else groups - 1 - place
    return out


def block_keys(words: DataFrame, of: np.ndarray, groups: int = GROUPS) -> DataFrame:
    """(block, combo, word, n): each word once for every choice of all groups but two, by its counts of their letters."""
    chosen = list(combinations(range(groups), groups - 2))
    # counts meet in a key by odd weights modulo 2**64; words whose keys agree by chance are told apart by their distance
    odd = np.random.default_rng(7).integers(0, 1 << 63, LETTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    weights = np.array([[odd[c] if of[c] in combo else 0 for combo in chosen] for c in range(LETTERS)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                keys = letter_counts(b.column("word").to_pylist()).astype(np.uint64) @ weights
                for at in range(len(chosen)):
                    mixed = (keys[:, at] + np.uint64(at + 1)) * np.uint64(0x9E3779B97F4A7C15)
                    yield pa.RecordBatch.from_arrays([pa.array(mixed.view(np.int64)), pa.array(np.full(len(keys), at), pa.int32()), b.column("word"), b.column("n")], names=["block", "combo", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "block bigint, combo int, word string, n bigint")


def dealt_blocks(rows: DataFrame, most: int = BLOCK_WORDS) -> DataFrame:
    """Adds tile, low and high: blocks above `most` words are dealt to tiles by a hash, every two of which meet.

    A word of a block of t tiles is copied t times, so a task never has more than about twice `most` words of a block.
    """
    one = F.lit(0)
    plain = lambda df: df.withColumns({"tile": one, "low": one, "high": one})
    large = checkpointed(rows.groupBy("block").count().filter(F.col("count") > most).select("block", F.ceil(F.col("count") / most).cast("int").alias("tiles")))
    if large.isEmpty():
        return plain(rows)
    marked = rows.join(large, "block", "left")
    tile = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    pairs = marked.filter("tiles is not null").withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    pairs = pairs.withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other")).drop("other", "tiles")
    return plain(marked.filter("tiles is null").drop("tiles")).unionByName(pairs)


def _one_edit(a: str, b: str) -> bool:
    """Whether two different words differ by one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at:] == b[at + 1 :] if len(a) < len(b) else a[at + 1 :] == b[at + 1 :]


def verified(words: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs are one edit apart; word i is as long as word j or one code point shorter."""
    size = np.array([len(w) for w in words])
    out = np.zeros(len(i), bool)
    far = size[j] > ROW_CHARS
    for at in np.nonzero(far)[0]:
        out[at] = _one_edit(words[i[at]], words[j[at]])
    near = np.nonzero(~far)[0]
    if len(near):
        codes = code_rows([w if len(w) <= ROW_CHARS else "" for w in words] + [" " * (ROW_CHARS + 1)])
        for part in np.array_split(near, len(near) // 50_000 + 1):
            a, b = codes[i[part]], codes[j[part]]
            differs = a != b
            same = size[i[part]] == size[j[part]]
            first = np.where(differs.any(1), differs.argmax(1), size[i[part]])
            moved = (a[:, :-1] != b[:, 1:]) & (np.arange(a.shape[1] - 1) >= first[:, None])
            out[part] = np.where(same, differs.sum(1) == 1, ~moved.any(1))
    return out


def _close(counts: np.ndarray, size: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one block whose squared distance is that of an edit: 2 at equal lengths, 1 where lengths differ by one.

    Rows are ordered by block and length, so a row's partners lie in the adjacent length blocks at and after it.
    """
    exact = np.float32 if size.max() < 1000 else np.float64  # so that all sums are whole numbers below the mantissa's end
    values = counts.astype(exact)
    square = (values * values).sum(1)
    left, right = [], []
    for at in range(0, len(values), PRODUCT_ROWS):
        to = min(at + PRODUCT_ROWS, len(values))
        end = to + int(np.searchsorted(_order(block[to:], size[to:], block[to - 1], size[to - 1] + 1), 1))
        gap = square[at:to, None] + square[None, at:end] - 2 * (values[at:to] @ values[at:end].T)
        a, b = np.nonzero(gap <= 2)
        keep = b > a
        a, b, d = a[keep] + at, b[keep] + at, gap[a[keep], b[keep]]
        longer = size[b] - size[a]
        good = (block[a] == block[b]) & (((d == 2) & (longer == 0)) | ((d == 1) & (longer == 1)))
        left.append(a[good])
        right.append(b[good])
    return np.concatenate(left), np.concatenate(right)


def _order(block: np.ndarray, size: np.ndarray, last: int, most: int) -> np.ndarray:
    """1 for rows past what the last row can meet, in order."""
    return ((block != last) | (size > most)).astype(int)


def near_words(blocks: DataFrame, of: np.ndarray, groups: int = GROUPS) -> DataFrame:
    """(word, n_near, least): a word's near words of one block, counted, and the most frequent as (-n, word).

    A task reads its blocks in order. A pair meets in every choice of groups whose counts agree; only the first such
    choice names it, so counts add up.
    """
    chosen = list(combinations(range(groups), groups - 2))
    first = np.array([next((k for k, c in enumerate(chosen) if not any(m >> g & 1 for g in c)), -1) for m in range(1 << groups)])
    member = np.zeros((LETTERS, groups), np.int64)
    member[np.arange(LETTERS), of] = 1
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("minus", pa.int64()), ("form", pa.string())])

    def found(words: list[str], n: np.ndarray, block: np.ndarray, combo: np.ndarray, tile: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch | None:
        size = np.array([len(w) for w in words])
        order = np.lexsort((size, block))
        words, n, block, combo, tile, low, high, size = [words[k] for k in order], *(x[order] for x in (n, block, combo, tile, low, high, size))
        counts = letter_counts(words)
        i, j = _close(counts, size, block)
        if len(i):
            changed = ((counts[i] != counts[j]).astype(np.int64) @ member > 0) @ (1 << np.arange(groups))
            met = (np.minimum(tile[i], tile[j]) == low[i]) & (np.maximum(tile[i], tile[j]) == high[i])
            keep = (first[changed] == combo[i]) & met
            i, j = i[keep], j[keep]
        if len(i):
            keep = verified(words, i, j)
            i, j = i[keep], j[keep]
        if not len(i):
            return None
        one, other = np.concatenate((i, j)), np.concatenate((j, i))
        rank = np.empty(len(words), np.int64)
        rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        order = np.lexsort((rank[other], -n[other], one))
        one, other = one[order], other[order]
        begin = np.nonzero(np.diff(one, prepend=-1))[0]
        many = np.diff(np.append(begin, len(one)))
        return pa.RecordBatch.from_arrays([pa.array([words[k] for k in one[begin]], pa.string()), pa.array(many), pa.array(-n[other[begin]]), pa.array([words[k] for k in other[begin]], pa.string())], schema=schema)

    names = ["n", "block", "combo", "tile", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[str] = []
        rest: list[np.ndarray] = [np.empty(0, np.int64) for _ in names]

        def chunks(last: bool) -> Iterator[pa.RecordBatch]:
            """Products over whole blocks: one large block each, or small ones together."""
            nonlocal words, rest
            if not words:
                return
            same = (np.diff(rest[1]) == 0) & (np.diff(rest[4]) == 0) & (np.diff(rest[5]) == 0)
            ends = [*(np.nonzero(~same)[0] + 1).tolist(), *([len(words)] if last else [])]
            number = np.concatenate(([0], np.cumsum(~same)))
            begin = at = 0
            for end in ends:
                if end - begin > CHUNK_WORDS and at > begin:
                    if (made := found(words[begin:at], rest[0][begin:at], number[begin:at], *(x[begin:at] for x in rest[2:]))) is not None:
                        yield made
                    begin = at
                at = end
            if at > begin:
                if (made := found(words[begin:at], rest[0][begin:at], number[begin:at], *(x[begin:at] for x in rest[2:]))) is not None:
                    yield made
            words, rest = words[at:], [x[at:] for x in rest]

        for b in batches:
            words += b.column("word").to_pylist()
            rest = [np.concatenate((old, b.column(k).to_numpy(zero_copy_only=False).astype(np.int64))) for k, old in zip(names, rest)]
            yield from chunks(False)
        yield from chunks(True)

    # two blocks of one key differ by their tiles
    dealt = blocks.repartition("block", "low", "high").sortWithinPartitions("block", "low", "high")
    near = dealt.select("word", *names).mapInArrow(run, "word string, n_near bigint, minus bigint, form string")
    return near.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("minus", "form")).alias("least"))


def roots(forms: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(word, root): where the forms of (word, form) lead. Counts grow `TIMES`-fold at each step, so there are few."""
    now = checkpointed(forms.select("word", F.col("form").alias("root")))
    for _ in range(rounds):
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = checkpointed(now.join(ahead, "root", "left"))
        now = joined.select("word", F.coalesce("next", "root").alias("root"))
        if joined.filter("next is not null").isEmpty():
            return now
    raise RuntimeError(f"forms still lead on after {rounds} rounds")


def spelling_variants(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, times: int = TIMES, groups: int = GROUPS, most: int = BLOCK_WORDS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of `docs` (doc_id, text).

    Words are runs of letters (ASCII and U+00C0 to U+00FF) with A-Z in lower case, some with a code point deleted (see
    `edited_runs`). Words one edit apart are near. A word's form is its near word of largest n if that is at least
    `times` its own n; its root is where the forms lead.

    Blocks: the letters are dealt to `groups` groups, an edit changes two letters' counts at most, so two near words
    agree in the counts of all groups but two and meet in a block of such a choice. There a product of count
    matrices gives squared distances, between a length and the next; edits are verified on the words.

    Defined results: null texts have no words; a null doc_id is hashed as `null`; ties of n go to the smallest word in
    code-point order; rows that repeat count each; words of any length are compared whole; an empty table gives no rows;
    other columns are not read.
    """
    words = checkpointed(vocabulary(docs, least_chars, least_count))
    of = letter_groups(words, groups)
    near = near_words(dealt_blocks(block_keys(words, of, groups), most), of, groups)
    near = near.select("word", "n_near", (-F.col("least.minus")).alias("form_n"), F.col("least.form").alias("form"))
    found = words.join(near, "word", "left")
    good = F.col("form_n") >= times * F.col("n")
    found = checkpointed(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, F.col("form")).alias("form"), F.when(good, F.col("form_n")).alias("form_n")))
    known = roots(found.filter("form is not null"))
    return found.join(known, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = r"""
WITH RECURSIVE b8(i, c, s) AS (
  SELECT i, i, 0 FROM (SELECT CAST(unnest(range(0, 256)) AS BIGINT) AS i)
  UNION ALL SELECT i, xor(c >> 1, 3988292384 * (c & 1)), s + 1 FROM b8 WHERE s < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM b8 WHERE s = 8),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+') AS runs FROM documents WHERE text IS NOT NULL),
e AS (SELECT r, coalesce(CAST(doc_id AS VARCHAR), 'null') AS id, translate(unnest(runs), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM d),
g AS (SELECT r, id, run, count(*) AS n FROM e GROUP BY ALL),
x AS (SELECT *, hex(encode(id || ':' || run)) AS bytes FROM g),
h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(bytes) // 2), lambda k: CAST('0x' || substr(bytes, 2 * k + 1, 2) AS BIGINT))),
                         lambda c, y: xor(c >> 8, t[xor(c & 255, y) + 1])), 4294967295::BIGINT) AS h FROM x, tab),
v AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM v WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
k AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT word, n, CAST(unnest(range(1, length(word) + 1)) AS INT) AS i FROM w)),
m AS (
  SELECT DISTINCT a, b FROM (
    SELECT k.word AS a, w.word AS b FROM k JOIN w ON k.cut = w.word
    UNION ALL SELECT w.word, k.word FROM k JOIN w ON k.cut = w.word
    UNION ALL SELECT p.word, q.word FROM k p JOIN k q ON p.cut = q.cut AND p.i = q.i AND p.word <> q.word)),
o AS (SELECT a, CAST(count(*) AS BIGINT) AS n_near, min({'m': -w.n, 'b': b}) AS best FROM m JOIN w ON w.word = m.b GROUP BY a),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.m >= 5 * w.n THEN best.b END AS form, CASE WHEN -best.m >= 5 * w.n THEN -best.m END AS form_n FROM w LEFT JOIN o ON o.a = w.word),
c(word, top) AS (SELECT word, word FROM f UNION ALL SELECT c.word, f.form FROM c JOIN f ON f.word = c.top WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.top AS root, f.n, f.n_near, f.form_n FROM f JOIN c ON c.word = f.word JOIN f g ON g.word = c.top WHERE g.form IS NULL
"""
