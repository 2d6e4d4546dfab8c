"""License notices: phrases found exactly, and with small errors."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from warren.llm.common import map_arrow, utf8

#: The base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Short notices as words, their labels, the edits (characters) each may have, and how many first words must be exact.
NOTICES = (
    ("mit license", "mit", 1, 1),
    ("apache license", "apache", 2, 0),
    ("general public license", "gpl", 2, 0),
    ("released under the mit license", "mit", 3, 0),
    ("licensed under the mit license", "mit", 3, 0),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6, 0),
    ("licensed under the apache license version 2 0", "apache", 4, 0),
    ("gnu general public license", "gpl", 2, 0),
    ("this program is free software you can redistribute it and or modify it", "gpl", 6, 0),
    ("gnu lesser general public license", "lgpl", 3, 0),
    ("lesser general public license", "lgpl", 2, 0),
    ("affero general public license", "agpl", 2, 0),
    ("mozilla public license", "mpl", 2, 0),
    ("eclipse public license", "epl", 2, 0),
    ("bsd license", "bsd", 1, 1),
    ("isc license", "isc", 1, 1),
    ("boost software license", "bsl", 2, 0),
    ("redistribution and use in source and binary forms", "bsd", 4, 0),
    ("this is free and unencumbered software released into the public domain", "unlicense", 6, 0),
    ("licensed under cc by nc", "cc-by-nc", 2, 0),
    ("licensed under cc by sa", "cc-by-sa", 2, 0),
    ("creative commons attribution", "cc-by", 2, 0),
    ("creative commons zero", "cc0", 2, 0),
)

#: Bytes outside words become spaces, A-Z become a-z; bytes of other letters stay.
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 32 for c in range(256))


def seeds(notice: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece): the notice cut into edits + 1 pieces; with no more edits, one piece stays whole."""
    size, more = divmod(len(notice), edits + 1)
    out, at = [], 0
    for i in range(edits + 1):
        n = size + (i < more)
        out.append((at, notice[at : at + n]))
        at += n
    return out


@cache
def _search() -> tuple[dict[str, list[tuple[int, int]]], list]:
    """For each seed the (notice, offset) it is of, and for each notice its fuzzy pattern."""
    owners: dict[str, list[tuple[int, int]]] = {}
    fuzzy = []
    for i, (notice, _, edits, exact) in enumerate(NOTICES):
        words = notice.split()
        head, tail = "".join(f"{w} " for w in words[:exact]), " ".join(words[exact:])
        for at, piece in seeds(tail, edits):
            owners.setdefault(piece, []).append((i, len(head) + at))
        fuzzy.append(regex.compile(rf"(?b)(?<![^ ]){regex.escape(head)}(?:{regex.escape(tail)}){{e<={edits}}}(?![^ ])"))
    return owners, fuzzy


def near_notices(folded: str) -> list[tuple[int, int, int, int]]:
    """(notice, start, end, edits) of bounded-error matches in single-spaced words, by start."""
    owners, fuzzy = _search()
    windows: dict[int, set[tuple[int, int]]] = {}
    for seed, of in owners.items():
        at = folded.find(seed)
        while at >= 0:
            for i, offset in of:
                notice, _, edits, _ = NOTICES[i]
                windows.setdefault(i, set()).add((max(0, at - offset - edits - 1), at - offset + len(notice) + edits + 1))
            at = folded.find(seed, at + 1)
    found = set()
    for i, places in windows.items():
        for a, b in sorted(places):
            if m := fuzzy[i].search(folded, a, b + 1):
                found.add((i, m.start(), m.end(), sum(m.fuzzy_counts)))
    return sorted(found, key=lambda x: (x[1], x[2], x[0]))


def scan(text: bytes) -> tuple[int, int, int | None, int | None, str, str, float, list[tuple[str, int, int, int]]]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score and spans (label, first word, words, edits).

    The score is 1 for a base phrase, else the best share of a matched notice's characters that are right.
    """
    words = text.translate(_FOLD).split()
    line = (b" " + b" ".join(words) + b" ").decode()
    base = [(at, label) for phrase, label in PHRASES.items() for at in _places(line, f" {phrase} ")]
    near = near_notices(line)
    if not base and not near:
        return len(words), 0, None, None, "", "", 0.0, []
    blanks = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), "<u4") == 32)
    word_at = lambda place, side: int(np.searchsorted(blanks, place, side))
    starts = [word_at(at, "left") for at, _ in base]
    spans = [(NOTICES[i][1], (first := word_at(a, "right") - 1), word_at(b - 1, "right") - first, edits) for i, a, b, edits in near]
    own = {x for _, x in base}
    score = 1.0 if own else max(1 - edits / len(NOTICES[i][0]) for i, _, _, edits in near)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(own)), ",".join(sorted(own | {x[0] for x in spans})), score, spans


def _places(line: str, key: str) -> Iterator[int]:
    at = line.find(key)
    while at >= 0:
        yield at
        at = line.find(key, at + 1)


SCHEMA = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"


def license_scan(docs: DataFrame) -> DataFrame:
    """License labels and places of every row of `docs` (doc_id, text), with `spans` (label, word, words, edits).

    Exact seeds locate candidates: a notice with at most k edits keeps one of its k + 1 pieces, so only windows
    around found pieces are matched with errors. No shuffle; a document's memory is a few times its text, and its time
    goes with its length.

    Defined results: null and empty texts have no words, null places, empty labels and score 0; null ids stay;
    repeated rows give a row each; of spans that tie in place the shorter and then the first notice's comes first;
    a text of any length is scanned whole; an empty table gives no rows; other columns are not read.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def rows(batch: pa.RecordBatch) -> dict:
        found = list(zip(*map(scan, utf8(batch.column("text")))))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("words", pa.int64()), ("edits", pa.int64())]))]
        names = [f.split()[0] for f in SCHEMA.split(", ")] + ["spans"]
        spans = [[dict(zip(("label", "word", "words", "edits"), s)) for s in x] for x in found[7]]
        return {"doc_id": batch.column("doc_id")} | {n: pa.array(spans if n == "spans" else v, k) for n, v, k in zip(names, found, kinds)}

    return map_arrow(docs.select("doc_id", "text"), rows, f"doc_id {kind}, {SCHEMA}, spans array<struct<label:string,word:bigint,words:bigint,edits:bigint>>")
