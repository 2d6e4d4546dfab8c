"""A toxicity classifier whose score may not depend on which group a sentence names."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warren.llm.common import checkpointed, map_arrow, texts

#: Families of identity terms; a term is swapped for the others of its family, and for "people".
IDENTITIES = (
    ("women", "men", "girls", "boys", "mujeres", "hombres", "femmes", "hommes", "frauen"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "african", "european", "latino", "arab", "indigenous"),
    ("immigrants", "refugees", "foreigners", "migrants", "locals"),
    ("mexican", "american", "french", "german", "spanish", "chinese", "indian", "russian", "polish", "turkish"),
    ("disabled", "deaf", "blind", "elderly", "young", "old"),
)
NEUTRAL = "people"
#: The most labelled rows that a model is fitted on (by a hash of the id), and its features.
TRAINING_ROWS, FEATURES = 20_000, 3000
#: A feature must occur in so many training rows.
LEAST_ROWS = 5
#: Weight of the squared score change over swaps, and of the squared weights.
COUNTERFACTUAL, RIDGE = 10.0, 1e-4
PREFIXES = (4, 5, 6, 7)
#: Words whose features a worker remembers.
REMEMBERED = 500_000

_WORD, _SENTENCE = re.compile(r"[^\W\d_]+"), re.compile(r"[^.!?\n]+")
_FAMILY = {t: f for f in IDENTITIES for t in f}


def features(word: str) -> list[str]:
    """A word and its beginnings."""
    return [word, *(f"^{word[:n]}" for n in PREFIXES if len(word) > n)]


def swaps(text: str) -> Counter:
    """How often each (term, other, whether the term is gone then, whether the other is new then) is a swap in one sentence.

    One pass over the words; what comes out is bounded by IDENTITIES, whatever the text's length.
    """
    out: Counter = Counter()
    if any(t in text for t in _FAMILY):
        parts = [_WORD.findall(s) for s in _SENTENCE.findall(text)]
        total = Counter(w for p in parts for w in p if w in _FAMILY or w == NEUTRAL)
        for part in parts:
            for term, n in Counter(w for w in part if w in _FAMILY).items():
                out.update((term, other, n == total[term], other not in total) for other in (*_FAMILY[term], NEUTRAL) if other != term)
    return out


def swap_changes(text: str, active: Callable[[str], Iterable[str]]) -> Counter:
    """How often each change (features that come, features that go) is what a swap does to a lower-case text.

    A feature goes only where no other word of the text has it; `active` gives a word's features.
    """
    found = swaps(text)
    if not found:
        return found
    held = Counter(f for w in set(_WORD.findall(text)) for f in active(w))
    out: Counter = Counter()
    for (term, other, gone, new), n in found.items():
        own, others = set(active(term)) if gone else set(), set(active(other))
        comes = frozenset(f for f in others if not held[f]) if new else frozenset()
        out[comes, frozenset(f for f in own if held[f] == 1 and f not in others)] += n
    return out


class Model:
    """A logistic regression over word features that a text has or lacks."""

    def __init__(self, names: list[str], weights: np.ndarray, bias: float):
        self.weight, self.bias, self.known = dict(zip(names, map(float, weights))), bias, {}

    def of_word(self, word: str) -> tuple[str, ...]:
        f = self.known.get(word)
        if f is None:
            f = tuple(x for x in features(word) if x in self.weight)
            if len(self.known) < REMEMBERED and len(word) < 40:
                self.known[word] = f
        return f

    def active(self, words: set[str]) -> set[str]:
        out, known = set(), self.known
        for w in words:
            f = known.get(w)
            if f is None:
                f = self.of_word(w)
            if f:
                out.update(f)
        return out

    def score(self, text: str) -> float:
        words = _WORD.findall(text.lower())
        z = self.bias + sum(self.weight[f] for f in sorted(self.active(set(words)))) * scale(len(words))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def scale(n_words: int) -> float:
    """What a long text's features count, as it has more of them by chance."""
    return 4 / max(4.0, float(np.log(2 + n_words)))


def _solve(rows: list[list[int]], scales: np.ndarray, labels: np.ndarray, changes: list[tuple[list[int], list[int], float]], n: int, steps: int = 300) -> tuple[np.ndarray, float]:
    """Minimises the mean log loss + RIDGE |w|^2 / 2 + COUNTERFACTUAL times the sum of `changes`.

    Each of these is (features that come, features that go, share): share times the squared change of the score.
    """
    if not len(labels) or labels.min() == labels.max():
        return np.zeros(n), -2.0
    at, of = np.array([f for r in rows for f in r], np.int64), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    moved = [(f, i, sign) for i, (on, off, _) in enumerate(changes) for sign, some in ((1.0, on), (-1.0, off)) for f in some]
    d_at, d_of, d_by = (np.array(x) for x in zip(*moved)) if moved else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    share = np.array([x for *_, x in changes])
    by, w, b, m, v = scales[of], np.zeros(n), -2.0, np.zeros(n), np.zeros(n)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(np.bincount(of, w[at] * by, len(rows)) + b)))
        off = (p - labels) / len(labels)
        g = np.bincount(at, off[of] * by, n) + RIDGE * w
        if len(d_at):
            change = np.bincount(d_of, w[d_at] * d_by, len(changes)) * share
            g += 2 * COUNTERFACTUAL * np.bincount(d_at, change[d_of] * d_by, n)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        b -= off.sum()
    return w, float(b)


def fold(doc_id) -> F.Column:
    """crc32 of the id as text, modulo 5: labels are learned where it is not 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """Fits the model on a bounded sample of labelled rows outside the held-out fold.

    The sample is at most `rows` labels, so its join is a broadcast, and one text for each (of rows that share an id
    the smallest). Feature counts and swaps are summed by Spark; the FEATURES most telling features, the sample's rows
    over them and one row for each kind of swap come to the driver.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    picked = known.filter(fold(F.col("doc_id")) != 0).distinct().orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id", "toxic").limit(rows)
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    sample = checkpointed(found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))

    def counted(batch: pa.RecordBatch) -> dict:
        every, toxic = Counter(), Counter()
        for text, label in zip(texts(batch.column("text")), batch.column("toxic").to_pylist()):
            has = {f for w in set(_WORD.findall(text.lower())) for f in features(w)}
            every.update(has)
            if label:
                toxic.update(has)
        return {"feature": list(every), "n": pa.array(every.values(), pa.int64()), "t": pa.array([toxic[f] for f in every], pa.int64())}

    totals = sample.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    share = (totals["t"] or 0) / max(1, totals["n"])
    counts = map_arrow(sample, counted, "feature string, n bigint, t bigint").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    telling = counts.filter(F.col("n") >= LEAST_ROWS).withColumn("chi", F.pow(F.col("t") - F.col("n") * share, 2) / (F.col("n") * share + 1e-9))
    names = [r["feature"] for r in telling.orderBy(F.desc("chi"), "feature").limit(FEATURES).collect()]
    place = {f: i for i, f in enumerate(names)}
    empty = Model(names, np.zeros(len(names)), 0.0)

    def coded(batch: pa.RecordBatch) -> dict:
        out = {k: [] for k in ("label", "scale", "on", "off", "many")}
        for text, label in zip(texts(batch.column("text")), batch.column("toxic").to_pylist()):
            text = text.lower()
            words = _WORD.findall(text)
            of_text = scale(len(words))
            rows = [(label, of_text, empty.active(set(words)), (), 1)]
            rows += [(None, of_text, on, off, n) for (on, off), n in swap_changes(text, empty.of_word).items()]
            for kind, by, on, off, n in rows:
                for k, x in zip(out, (kind, by, sorted(place[f] for f in on), sorted(place[f] for f in off), n)):
                    out[k].append(x)
        kinds = (pa.int32(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64())
        return {k: pa.array(x, t) for (k, x), t in zip(out.items(), kinds)}

    found = checkpointed(map_arrow(sample, coded, "label int, scale double, on array<int>, off array<int>, many bigint"))
    own = sorted(found.filter("label is not null").select("label", "scale", "on").collect())  # at most `rows` rows
    swapped = found.filter("label is null").groupBy("on", "off").agg(F.sum("many").alias("n"), F.sum(F.col("many") * F.col("scale") * F.col("scale")).cast("decimal(30,12)").alias("squares"))
    kinds = sorted(tuple(r) for r in swapped.collect())  # as many as IDENTITIES has pairs, and their features in use
    total = max(1, sum(r[2] for r in kinds))
    changes = [(on, off, float(squares) / total) for on, off, _, squares in kinds if on or off]
    weights, bias = _solve([r["on"] for r in own], np.array([r["scale"] for r in own]), np.array([r["label"] for r in own], float), changes, len(names))
    return Model(names, weights, bias)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `docs` (doc_id, text).

    Defined results: null and empty texts score by the bias alone; null ids are scored and not held out; rows
    that repeat are scored each; a text of any length is scored whole; features that tie are taken by name; without
    labels of both kinds every score is that of the bias; an empty table gives no rows; other columns are not read.
    """
    model, kind = fit(docs, labels), dict(docs.dtypes)["doc_id"]

    def rows(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "score": pa.array(map(model.score, texts(batch.column("text"))), pa.float64())}

    scored = map_arrow(docs.select("doc_id", "text"), rows, f"doc_id {kind}, score double")
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
