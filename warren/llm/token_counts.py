"""Token counts under a unigram vocabulary, by a Viterbi search that keeps counts only."""

from __future__ import annotations

from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from warren.llm.common import map_arrow, texts

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
#: How far below the lowest score an unknown character scores.
UNKNOWN_PENALTY = 10.0
#: Words whose counts a worker remembers: a bound on its memory, about 100 MB.
REMEMBERED = 600_000


@cache
def vocabulary(path: str) -> dict[str, float]:
    """Piece to score of a public tokenizer's file, read as a unigram vocabulary (no control or byte pieces)."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    return {m.id_to_piece(i): m.get_score(i) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))}


def _with_spaces(words: list[str]) -> list[str]:
    """The words between single spaces, each with the further spaces before it; the last ones may stand alone."""
    out, spaces = [], 0
    for w in words[:-1]:
        if w:
            out.append(SPACE * spaces + w)
            spaces = 0
        else:
            spaces += 1
    return [*out, SPACE * spaces + words[-1]]


class Counter:
    """Counts the pieces of a word's best segmentation.

    An Aho-Corasick automaton enumerates the vocabulary's matches by their end, longest first. Among equal
    scores the first candidate stays, that is the one with the earliest start. A character that is no piece is
    unknown; unknown characters in a row are one token. A run of spaces is searched together with the word after
    it; what ends in a word is independent of the next run, unless some piece goes on from a word into a space or
    a space alone is no piece: then the whole text is searched at once.
    """

    def __init__(self, pieces: dict[str, float]):
        self.automaton, self.known = ahocorasick.Automaton(), {}
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY
        self.whole = SPACE not in pieces or any(SPACE in p.lstrip(SPACE) for p in pieces)

    def word(self, word: str) -> tuple[int, float]:
        n = len(word)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(word):
            ends[end].append(match)
        best, count, open_unknown = [0.0] + [None] * n, [0] * (n + 1), [False] * (n + 1)
        for end, matches in enumerate(ends):
            top, single = None, False
            for size, score in sorted(matches, reverse=True):
                start = end + 1 - size
                single |= size == 1
                if (s := best[start] + score) > top if top is not None else True:
                    top = best[start] + score
                    count[end + 1], open_unknown[end + 1] = count[start] + 1, False
            if not single and (top is None or best[end] + self.unknown > top):
                top = best[end] + self.unknown
                count[end + 1], open_unknown[end + 1] = count[end] + (not open_unknown[end]), True
            best[end + 1] = top
        return count[n], best[n]

    def text(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        if self.whole:
            text = text.replace(" ", SPACE)
            return self.word(text if text[0] == SPACE else SPACE + text)
        words = text.replace(SPACE, " ").split(" ")
        if words[0] == "":
            words = words[1:]
        if "" in words:
            words = _with_spaces(words)
        known, tokens, score = self.known, 0, 0.0
        found = list(map(known.get, words))
        for i, x in enumerate(found):
            if x is None:
                w = words[i]
                x = known.get(w) or self.word(SPACE + w)
                if len(known) < REMEMBERED and len(w) < 40:
                    known[w] = x
            tokens += x[0]
            score += x[1]
        return tokens, score


@cache
def counter(path: str) -> Counter:
    return Counter(vocabulary(path))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, score) of every row of `docs` (doc_id, text). No shuffle.

    Defined results: null and empty texts have no tokens and score 0; null ids stay; repeated rows give a row
    each; equal scores keep the earliest start; a text of any length is searched whole, word by word; an empty
    table gives no rows; other columns are not read.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def rows(batch: pa.RecordBatch) -> dict:
        found = [counter(path).text(t) for t in texts(batch.column("text"))]
        return {"doc_id": batch.column("doc_id"), "n_tokens": pa.array([x[0] for x in found], pa.int64()), "score": pa.array([x[1] for x in found], pa.float64())}

    return map_arrow(docs.select("doc_id", "text"), rows, f"doc_id {kind}, n_tokens bigint, score double")
