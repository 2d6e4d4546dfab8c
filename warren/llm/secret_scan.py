"""Secrets in texts: fixed patterns, and a linear-chain conditional random field for what they miss."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from warren.llm.common import map_arrow, texts

#: The base patterns, in the order that ties are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "crf")

#: Words that tell of a secret after them.
CUE_WORDS = ("pass", "pwd", "secret", "token", "key", "auth", "bearer", "credential", "login", "basic", "identified")
#: Tokens are letters and digits in pieces of at most PIECE, and single other characters; blanks part them.
PIECE = 16
#: Tokens whose features are held at once; scores and contexts are carried over to the next ones.
PART = 2048
#: Characters of texts that are cut into tokens and tagged together; a longer text is cut into tokens by such parts.
TOGETHER = 1 << 18
OUTSIDE, BEGIN, INSIDE = 0, 1, 2
#: Hashed features; documents looked at for training, pieces of them trained on at most, and planted lines.
BUCKETS, TRAINING_DOCS, TRAINING_CHAINS, PLANTED = 1 << 14, 20_000, 1500, 1600
_NEVER = -1e9
_ALLOWED = np.array([[0, 0, _NEVER], [0, 0, 0], [0, 0, 0]])  # from, to: only B opens and only I goes on
#: Scores are added as whole numbers of this part, so no sum depends on what is tagged with it; steps of a chain taken at once.
_UNIT, _STEPS = 2.0**-30, 128


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, start of the value) of the base patterns' matches."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), m.end(), "assign", m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access", m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), "hex", m.start()) for m in HEX.finditer(text)]
    return out


def digest(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


#: What is known of characters, filled as they come: 1 known, 2 letter or digit, 4 blank, 8 digit, 16 lower case, then [a-z] (32), [A-Z] (64), [0-9] (96).
_CLASS, _LOWER = np.zeros(0x110000, np.uint8), np.zeros(0x110000, np.uint32)
#: A byte each for [a-z], [A-Z], [0-9], digits, letters, [0-9a-f], [0-9A-F] and vowels; a token's counts are its sums.
_COUNTS = np.zeros(0x110000, np.uint64)
_STRIPPED = np.array([ord(c) for c in "\"'.,;:!?()[]{}<>"], np.uint32)
_POWER = 0x9E3779B97F4A7C15
_NONE, _SHAPED = np.uint64(0xD1B54A32D192ED03), np.uint64(1 << 63)


def _learn(codes: np.ndarray) -> None:
    for code in np.unique(codes).tolist():
        c = chr(code)
        ascii_kind = 32 if "a" <= c <= "z" else 64 if "A" <= c <= "Z" else 96 if "0" <= c <= "9" else 0
        _CLASS[code] = 1 + 2 * c.isalnum() + 4 * c.isspace() + 8 * c.isdigit() + 16 * c.islower() + ascii_kind
        _LOWER[code] = ord(c.lower()[0])
        kinds = (ascii_kind == 32, ascii_kind == 64, ascii_kind == 96, c.isdigit(), c.isalpha(), c in "0123456789abcdef", c in "0123456789ABCDEF", c.isalpha() and c.lower()[0] in "aeiouy")
        _COUNTS[code] = sum(1 << 8 * k for k, there in enumerate(kinds) if there)


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 ** 64."""
    out = []
    for base in (_POWER, pow(_POWER, -1, 1 << 64)):
        x = np.full(n, base, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


def _shapes(lower: np.ndarray, upper: np.ndarray, digit: np.ndarray, other: np.ndarray) -> np.ndarray:
    return ((lower > 0) + 2 * (upper > 0) + 4 * (digit > 0) + 8 * (other > 0)).astype(np.uint8)


def _cut(text: str) -> dict[str, np.ndarray] | None:
    """Tokens of a text (or of a part between blanks): places, a hash of the word, and facts of
    the token and of the run of characters other than blanks that it is in. None without a token."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _CLASS[codes]
    if not kind.all():
        _learn(codes[kind == 0])
        kind = _CLASS[codes]
    n, at = len(codes), np.arange(len(codes), dtype=np.int32)
    wordy, blank, low = (kind & 2) > 0, (kind & 4) > 0, _LOWER[codes]
    opens = wordy.copy()
    opens[1:] &= ~wordy[:-1]
    begun = ~blank & (~wordy | ((at - np.maximum.accumulate(np.where(opens, at, 0))) % PIECE == 0))
    bounds = np.flatnonzero(begun | blank)
    mine = begun[bounds]
    a, b = bounds[mine], np.append(bounds[1:], n)[mine]
    if not len(a):
        return None
    size = b - a
    lanes = np.append(np.uint64(0), np.cumsum(_COUNTS[codes]))
    lanes = (lanes[b] - lanes[a]).view(np.uint8).reshape(-1, 8)
    lower, upper, digit, digits, letters, hex_low, hex_up, vowels = lanes.T
    other = size - lower.astype(np.int64) - upper - digit
    shape = _shapes(lower, upper, digit, other)
    power, inverse = _powers(1 << (n - 1).bit_length())
    sums = np.append(np.uint64(0), np.cumsum(low * power[:n]))
    named = (letters == size) | ((size == 1) & (digits == 0))
    word = np.where(named, (sums[b] - sums[a]) * inverse[a], _SHAPED + shape)

    first = np.append(True, a[1:] > b[:-1])
    heads = np.flatnonzero(first)
    tails = np.append(heads[1:], len(a)) - 1
    run = np.cumsum(first) - 1
    total = lambda x: np.add.reduceat(x.astype(np.int64), heads)
    # a run's core lies between the first and the last token that is no bracket, quote or stop
    bare = np.flatnonzero(~np.isin(codes[a], _STRIPPED))
    core_a, core_b = np.searchsorted(bare, heads), np.searchsorted(bare, tails, "right") - 1
    empty = core_a > core_b
    core_a, core_b = (bare[np.minimum(np.maximum(x, 0), len(bare) - 1)] if len(bare) else heads for x in (core_a, core_b))
    core_low, core_high = np.where(empty, 0, a[core_a]), np.where(empty, 0, b[core_b])
    length, whole = core_high - core_low, b[tails] - a[heads]
    mix = np.where(empty, 0, _shapes(total(lower), total(upper), total(digit), total(other) - (whole - length)))
    turn = np.append(0, np.cumsum((kind[1:] & 24) != (kind[:-1] & 24)))
    form_kind = kind & 96
    kept = form_kind == 0
    kept[0] = True
    kept[1:] |= form_kind[1:] != form_kind[:-1]
    which = np.flatnonzero(kept)
    drawn, rank = np.where(form_kind[which] > 0, form_kind[which] + np.uint32(1 << 24), codes[which]), np.cumsum(kept)
    here, end = rank[core_low] - 1, np.where(empty, 0, rank[np.maximum(core_high - 1, 0)])
    form = np.zeros(len(heads), np.uint64)
    for j in range(8):
        there = here + j < end
        form = np.where(there, form * np.uint64(_POWER) + drawn[np.minimum(here + j, len(drawn) - 1)] + np.uint64(1), form)

    plain = np.where(codes < 128, low, 255).astype(np.uint8).tobytes()
    cue = np.zeros(len(a), bool)
    for w in CUE_WORDS:
        found, k = [], plain.find(w.encode())
        while k >= 0:
            found.append(k)
            k = plain.find(w.encode(), k + 1)
        if found:
            t = np.searchsorted(a, found, "right") - 1
            cue[t[np.array(found) + len(w) <= b[t]]] = True
    small = lambda x: x.astype(np.uint8)
    return {
        "a": a, "b": b, "word": word, "shape": shape, "size": small(size), "digits": small(4 * digits.astype(int) // size), "first": first, "last": np.append(first[1:], True), "cue": cue,
        "hex": ((hex_low == size) | (hex_up == size)) & (size >= 6), "run": small(np.minimum(length // 4, 8))[run], "mix": small(mix)[run], "vowels": small(4 * total(vowels) // np.maximum(1, total(letters)))[run],
        "turns": small(np.minimum(turn[b[tails] - 1] - turn[a[heads]], 6))[run], "form": form[run],
    }


_BLANK = re.compile(r"\s")
_SALTS = [np.uint64(k * 0xA0761D6478BD642F + 0xE7037ED1A0B428DB & (1 << 64) - 1) for k in range(24)]


def _bucket(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ x >> np.uint64(29)) * np.uint64(0x94D049BB133111EB) >> np.uint64(50)).astype(np.int32)


_SMALL = [_bucket(np.arange(512, dtype=np.uint64) + salt) for salt in _SALTS]


class Tokens:
    """Tokens of texts, each text a chain of its own, with what their features need: some 100 bytes a token.

    What a token sees does not depend on the parts that features are asked for in, nor on the texts beside it.
    """

    def __init__(self, texts: list[str]):
        text, found, low = "\n".join(texts), [], 0
        self.offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
        while low < len(text):
            cut = _BLANK.search(text, low + TOGETHER) if low + TOGETHER < len(text) else None
            high = cut.start() if cut else len(text)
            if some := _cut(text[low:high]):
                some["a"], some["b"] = some["a"] + low, some["b"] + low
                found.append(some)
            low = high
        self.facts = {k: np.concatenate([x[k] for x in found]) for k in found[0]} if found else {"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)}
        self.begins = np.append(np.searchsorted(self.facts["a"], self.offsets), len(self))  # each text's first token
        self.of_file = np.array([(min(t.count("="), 3), "{" in t) for t in texts], np.int64).reshape(-1, 2)
        if len(self):
            cue = np.where(self.facts["cue"], np.arange(len(self)), -1)
            self.cued = np.append(-1, np.maximum.accumulate(cue)[:-1])

    def __len__(self) -> int:
        return len(self.facts["a"])

    def places(self, text: int) -> list[tuple[int, int]]:
        here = slice(self.begins[text], self.begins[text + 1])
        return list(zip(*((self.facts[k][here] - self.offsets[text]).tolist() for k in "ab")))

    def features(self, low: int, high: int) -> np.ndarray:
        """Hashed features of some tokens, a row each: shape, run of characters, neighbouring words, last cue, and the file's."""
        f, i = {k: x[low:high] for k, x in self.facts.items()}, np.arange(low, high)
        text = np.searchsorted(self.begins, i, "right") - 1
        begin, end, word = self.begins[text], self.begins[text + 1], self.facts["word"]
        back = lambda k: np.where(i - k >= begin, word[np.maximum(i - k, 0)], _NONE)
        before, gap = back(1), f["first"].astype(np.int64)
        after = np.where(i + 1 < end, word[np.minimum(i + 1, len(word) - 1)], _NONE)
        near = np.where(self.cued[low:high] >= begin, np.minimum(i - 1 - self.cued[low:high], 8), 8)
        mixed = f["mix"].astype(np.int64) * 16 + f["run"]
        joined = lambda x, small: x * np.uint64(0x8EBC6AF09C88C6E3) + small.astype(np.uint64)
        out = np.empty((24, high - low), np.int32)
        out[0] = _SMALL[0][0]
        for k, x in ((1, f["word"]), (8, joined(before, gap)), (9, joined(joined(back(2), gap), before)), (10, back(3)), (11, after), (14, joined(before, near)), (15, joined(before, mixed)), (21, f["form"])):
            out[k] = _bucket(x + _SALTS[k])
        small = ((2, f["shape"]), (3, f["size"] // 3), (4, f["digits"]), (5, gap), (6, f["last"].astype(np.int64)), (7, f["hex"].astype(np.int64)), (12, near), (13, near * 32 + gap * 16 + f["mix"]), (16, f["run"]), (17, f["mix"]), (18, mixed), (19, f["vowels"]), (20, f["turns"]), (22, self.of_file[text, 0]), (23, self.of_file[text, 1]))
        for k, x in small:
            out[k] = _SMALL[k][x]
        return out.T

    def parts(self, part: int = PART) -> Iterator[np.ndarray]:
        return (self.features(at, min(at + part, len(self))) for at in range(0, len(self), part))


def stretches(text: str, part: int = PART) -> Iterator[tuple[list[tuple[int, int]], Iterator[np.ndarray]]]:
    """Places of all tokens of the text, one stretch, and their features in parts; nothing without a token."""
    tokens = Tokens([text])
    if len(tokens):
        yield tokens.places(0), tokens.parts(part)


def chains(text: str) -> Iterator[tuple[list[tuple[int, int]], np.ndarray]]:
    """Token places and features of each part of the text."""
    for places, parts in stretches(text):
        at = 0
        for features in parts:
            yield places[at : at + len(features)], features
            at += len(features)


def _marks(places: list[tuple[int, int]], values: list[tuple[int, int]]) -> list[int]:
    """Tags of tokens by the values (start, end) they lie in, one pass over both."""
    tags, values, k, opened = [], sorted(values), 0, -1
    for a, b in places:
        while k < len(values) and values[k][1] <= a:
            k += 1
        hit = k < len(values) and values[k][0] < b
        tags.append(OUTSIDE if not hit else INSIDE if opened == k else BEGIN)
        opened = k if hit else -1
    return tags


#: Planted lines to train on: cues and what joins them to a value, forms around a value, and lines without a secret.
CUES = ("password", "Password", "passwd", "pwd", "pass", "passphrase", "secret", "client_secret", "token", "access_token", "apikey", "api key", "api-key", "API_KEY", "auth", "credential", "login", "private key", "db_password", "SECRET_KEY")
JOINS = (": ", "=", " = ", ":", " is ", " -> ", " => ", ' = "', "='", ": '", " was ", "\t")
FORMS = ("Authorization: Bearer {}", "auth: Basic {}", "https://joe:{}@db.example.com/x", "postgres://admin:{}@10.0.0.7:5432/main", "mysql -u root -p {}", "--password {} --user joe", "IDENTIFIED BY '{}'", "login joe / {}", "export KEY={}", "the key {} opens it", "set {} as the new password", "AWS key {}")
PLAIN = (
    "the password must have at least 12 characters", "the secret garden was open until 1998", "a token of thanks for 25 years", "password: none", "token count = 5000", "key=name", "author: John Smith", "the keynote was at 10:30", "pass the salt",
    "call +49 170 {n} today", "call (555) {n}", "mail jane.{s}@mail{s}.example.com", "version {s}.10.3-beta", "order {n}-{n}", "on 2024-05-{s} at 10:20:30", "see https://www.example.com/blog/2024/how-to-{s}?page={s}", "host 192.168.{s}.12",
    "invoice INV-2024-{n}", "room {n}b", "passengers in row {s}", "card 4111-{n}-{n}-1111", "the authors of paper {n}", "login at 09:15 by {s} users", "basic course {n}", "isbn 978-3-16-{n}-0", "$$$ {n} !!!", "internationalisation-of-administration", "keyboard layout {s}",
)
FILL = "the a of and to in der die und zu el la que de le les et des with for from on house road river walk said day time old new more".split()


def planted(rng: random.Random, form: str | None = None) -> tuple[str, tuple[int, int] | None]:
    """A line and the place of the secret in it, or None in a line without one."""
    pick = lambda letters, n: "".join(rng.choices(letters, k=n))
    lower, upper, number = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    around = lambda: " ".join(rng.choices(FILL, k=rng.randint(0, 6)))
    if form is None and rng.random() < 0.45:
        line = rng.choice(PLAIN).replace("{n}", pick(number, rng.randint(3, 8))).replace("{s}", pick(number, 2))
        return f"{around()} {line} {around()}", None
    size = rng.randint(8, 40)
    value = rng.choice([
        lambda: pick("0123456789abcdef", size), lambda: pick(lower + upper + number, size), lambda: pick(lower + number, rng.randint(8, 14)), lambda: pick(lower + upper, rng.randint(8, 22)), lambda: pick(lower + upper + number + "+/", size) + "==",
        lambda: "-".join(pick(lower + number, rng.randint(3, 9)) for _ in range(rng.randint(2, 5))), lambda: "-".join(rng.choices(FILL + ["horse", "battery", "staple", "correct"], k=4)), lambda: rng.choice(["hunter", "dragon", "summer", "letmein", "monkey"]) + pick(number, rng.randint(2, 5)),
        lambda: pick(lower + upper + number + "@!$%^&*#", rng.randint(8, 16)), lambda: f"{rng.choice(['sk', 'pk', 'ghp', 'xox', 'AKIA'])}{rng.choice('_-')}{pick(lower + upper + number, size)}",
    ])()
    if form is None:
        form = rng.choice(FORMS) if rng.random() < 0.35 else rng.choice(CUES) + rng.choice(JOINS) + "{}"
    close = "\"" if form.endswith('"{}') else "'" if form.endswith("'{}") else rng.choice(["", "", "", ".", ","])
    head = around()
    head = f"{head} " if head else ""
    start = len(head) + form.index("{}")
    return head + form.replace("{}", value) + close + f" {around()}", (start, start + len(value))


class Tagger:
    """A linear-chain CRF: weights of hashed features for each tag, and of tag pairs."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move
        self._emit, self._move = (np.rint(np.maximum(x, _NEVER / 100) / _UNIT).astype(np.int64) for x in (emit, move + _ALLOWED))

    def best(self, features: np.ndarray) -> list[int]:
        """The most likely tags (Viterbi); of equal ones the lower tag."""
        return self.best_of([features])

    def best_of(self, parts: Iterable[np.ndarray]) -> list[int]:
        """The most likely tags of a chain whose features come in parts."""
        return self.best_of_all(parts, np.zeros(1, np.int64)).tolist()

    def best_of_all(self, parts: Iterable[np.ndarray], begins: np.ndarray) -> np.ndarray:
        """The most likely tags of chains one after another, which begin at these tokens and whose features come in parts."""
        scores = []
        for features in parts:
            at = np.zeros((len(features), 3), np.int64)
            for column in features.T:
                at += self._emit.take(column, 0)
            scores.append(at)
        scores = np.concatenate(scores) if scores else np.zeros((0, 3), np.int64)
        fresh = np.zeros(len(scores) + 1, bool)
        fresh[begins] = True
        return _viterbi(scores, fresh[:-1], self._move)


#: Whole-number score of what is not allowed; sums of _STEPS scores stay far from it.
_BARRED = -(1 << 54)


def _viterbi(scores: np.ndarray, fresh: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The best tags of chains one after another, each beginning where `fresh` is; of equal ones the lower tag.

    Chains are cut into blocks of _STEPS tokens that are followed all at once: first from each state before the
    block, then from the scores that the blocks before it give, with a byte a token and state that leads back.
    """
    if not len(scores):
        return np.zeros(0, np.uint8)
    steps = min(_STEPS, len(scores))
    blocks = -(-len(scores) // steps)
    s, begun = np.zeros((blocks * steps, 3), np.int64), np.zeros(blocks * steps, bool)
    s[: len(scores)], s[len(scores) :, 1:] = scores, _BARRED
    begun[: len(scores)] = fresh
    begun[len(scores) : len(scores) + 1] = True
    s, begun = np.ascontiguousarray(s.reshape(blocks, steps, 3).transpose(1, 2, 0)), np.ascontiguousarray(begun.reshape(blocks, steps).T)
    move = np.maximum(move, _BARRED)[:, :, None]
    anew = np.array([0, 0, _BARRED])[None, :, None]
    moves = lambda t: np.where(begun[t], anew, move) if begun[t].any() else move

    v = np.where(np.eye(3, dtype=bool), 0, _BARRED)[:, :, None].repeat(blocks, 2)
    for t in range(steps):
        v = (v[:, :, None] + moves(t)[None]).max(1) + s[t]
    entry, now = [], [0, _BARRED, _BARRED]
    for through in v.transpose(2, 0, 1).tolist():
        entry.append(now)
        now = [max(now[k] + through[k][to] for k in range(3)) for to in range(3)]
        top = max(now)
        now = [max(x - top, _BARRED) for x in now]

    v, back = np.array(entry).T, np.empty((steps, 3, blocks), np.uint8)
    for t in range(steps):
        reached = v[:, None] + moves(t)
        back[t] = reached.argmax(0)
        v = reached.max(0) + s[t]
    led = np.arange(3)[:, None].repeat(blocks, 1)
    for t in reversed(range(steps)):
        led = np.take_along_axis(back[t], led, 0).astype(np.int64)
    state = np.empty(blocks, np.int64)
    state[-1] = v[:, -1].argmax()
    for c in range(blocks - 1, 0, -1):
        state[c - 1] = led[state[c], c]
    tags, of = np.empty((steps, blocks), np.uint8), np.arange(blocks)
    for t in reversed(range(steps)):
        tags[t] = state
        state = back[t][state, of]
    return tags.T.reshape(-1)[: len(scores)]


def train(examples: list[tuple[np.ndarray, list[int]]], steps: int = 60) -> Tagger:
    """Maximum likelihood by forward-backward over (features, tags), in groups of like length. Without a secret nothing is tagged."""
    emit, move = np.zeros((BUCKETS, 3)), np.zeros((3, 3))
    if not any(any(t) for _, t in examples):
        emit[zlib.crc32(b"bias") % BUCKETS, 0] = 1.0
        return Tagger(emit, move)
    examples = sorted(examples, key=lambda e: len(e[1]))
    groups = []
    for at in range(0, len(examples), 256):
        some = examples[at : at + 256]
        there = np.arange(len(some[-1][1]))[None, :] < np.array([len(t) for _, t in some])[:, None]
        tags = np.zeros(there.shape, int)
        tags[there] = np.concatenate([t for _, t in some])
        gold = np.eye(3)[tags] * there[..., None]
        groups.append((np.asfortranarray(np.concatenate([f for f, _ in some])), there, gold, np.einsum("nti,ntj->ij", gold[:, :-1], gold[:, 1:])))
    n, width = len(examples), examples[0][0].shape[1]
    m, v = [np.zeros_like(emit), np.zeros_like(move)], [np.zeros_like(emit), np.zeros_like(move)]
    lse = lambda x, axis: (top := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - top).sum(axis))
    for step in range(1, steps + 1):
        ge, gm, by = -1e-4 * emit, -1e-4 * move, move + _ALLOWED
        for feats, there, gold, pairs in groups:
            s = np.zeros(gold.shape)
            s[there] = sum(emit.take(column, 0) for column in feats.T)
            ahead = [s[:, 0] + [0, 0, _NEVER]]
            for t in range(1, s.shape[1]):
                ahead.append(np.where(there[:, t, None], lse(ahead[-1][:, :, None] + by, 1) + s[:, t], ahead[-1]))
            behind = [np.zeros((len(s), 3))]
            for t in range(s.shape[1] - 1, 0, -1):
                behind.append(np.where(there[:, t, None], lse(by + (s[:, t] + behind[-1])[:, None, :], 2), behind[-1]))
            ahead, behind = np.stack(ahead, 1), np.stack(behind[::-1], 1)
            total = lse(ahead[:, -1], 1)
            p = np.exp(np.clip(ahead + behind - total[:, None, None], -700, 0)) * there[..., None]
            both = np.exp(np.clip(ahead[:, :-1, :, None] + by + (s + behind)[:, 1:, None, :] - total[:, None, None, None], -700, 0)) * there[:, 1:, None, None]
            off = ((gold - p) / n)[there]
            ge += np.stack([np.bincount(feats.ravel(), np.repeat(off[:, k], width), BUCKETS) for k in range(3)], 1)
            gm += (pairs - both.sum((0, 1))) / n
        for k, (w, g) in enumerate(((emit, ge), (move, gm))):
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
            w += 0.1 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return Tagger(emit, move)


def planted_examples(n: int = PLANTED, seed: int = 42) -> list[tuple[np.ndarray, list[int]]]:
    """Features and tags of so many planted lines."""
    rng = random.Random(seed)
    lines = [planted(rng) for _ in range(n)]
    tokens = Tokens([line for line, _ in lines])
    spans = zip(tokens.begins.tolist(), tokens.begins[1:].tolist())
    return [(tokens.features(a, b), _marks(tokens.places(k), [v] if v else [])) for k, ((_, v), (a, b)) in enumerate(zip(lines, spans)) if a < b]


def _pieces(doc_id: str, text: str) -> Iterator[tuple[str, int, list[int]]]:
    """Key (of the id, place and text), first token and tags of each 64 tokens of a text, after the base patterns' values."""
    values = [(x, b) for _, b, _, x in base_spans(text)]
    places = Tokens([text]).places(0)
    for at in range(0, len(places), 64):
        some = places[at : at + 64]
        inside = [v for v in values if v[0] < some[-1][1] and v[1] > some[0][0]]
        yield hashlib.md5(f"{doc_id}:{at}:{text[some[0][0] : some[-1][1]]}".encode()).hexdigest(), at, _marks(some, inside)


def fit(docs: DataFrame, most_docs: int = TRAINING_DOCS, most_chains: int = TRAINING_CHAINS) -> Tagger:
    """Trains on planted lines and on what the base patterns mark in a bounded sample: the documents with the smallest id hashes.

    At most `most_docs` ids are broadcast and `most_chains` pieces of 64 tokens collected, half of them with a secret
    and half without, by the smallest hashes. Every text is tagged whole afterwards.
    """
    name, half = F.col("doc_id").cast("string"), most_chains // 2
    picked = docs.filter("doc_id is not null").select(name.alias("__id")).orderBy(F.md5("__id"), "__id").limit(most_docs).distinct()
    named = docs.select(name.alias("__id"), "text")

    def keys(batch: pa.RecordBatch) -> dict:
        found = {False: set(), True: set()}
        for doc_id, text in zip(batch.column("__id").to_pylist(), texts(batch.column("text"))):
            for key, _, tags in _pieces(doc_id, text):
                found[any(tags)].add((key, doc_id))
        least = [(k, i, kind) for kind, x in found.items() for k, i in sorted(x)[:half]]
        return {k: pa.array([x[n] for x in least], t) for n, (k, t) in enumerate({"key": pa.string(), "id": pa.string(), "secret": pa.bool_()}.items())}

    found = map_arrow(named.join(F.broadcast(picked), "__id", "left_semi"), keys, "key string, id string, secret boolean").distinct()
    place = F.row_number().over(Window.partitionBy("secret").orderBy("key"))
    chosen = {r["key"]: r["id"] for r in found.withColumn("n", place).filter(F.col("n") <= half).select("key", "id").collect()}

    def rows(batch: pa.RecordBatch) -> dict:
        out = {"key": [], "features": [], "tags": []}
        for doc_id, text in zip(batch.column("__id").to_pylist(), texts(batch.column("text"))):
            here = [p for p in _pieces(doc_id, text) if p[0] in chosen]
            tokens = Tokens([text]) if here else None
            for key, at, tags in here:
                for k, x in zip(out, (key, tokens.features(at, at + len(tags)).ravel(), tags)):
                    out[k].append(x)
        return {k: pa.array(x, t) for (k, x), t in zip(out.items(), (pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())))}

    kept = []
    if chosen:
        ids = docs.sparkSession.createDataFrame([(x,) for x in sorted(set(chosen.values()))], "__id string")
        kept = map_arrow(named.join(F.broadcast(ids), "__id", "left_semi"), rows, "key string, features array<int>, tags array<int>").dropDuplicates(["key"]).orderBy("key").collect()
    return train([(np.array(r["features"], np.int32).reshape(len(r["tags"]), -1), r["tags"]) for r in kept] + planted_examples())


def _grouped(texts: list[str]) -> Iterator[list[str]]:
    """Texts in groups of at most TOGETHER characters, or of one longer text."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > TOGETHER:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def tagged_spans(texts: list[str], tagger: Tagger) -> Iterator[list[tuple[int, int]]]:
    """(start, end) of the tagger's secrets in each text; all tokens are tagged."""
    for group in _grouped(texts):
        tokens = Tokens(group)
        tags = tagger.best_of_all(tokens.parts(), tokens.begins)
        first, ends = np.flatnonzero(tags == BEGIN), np.append(np.flatnonzero(tags != INSIDE), len(tags))
        last = ends[np.searchsorted(ends, first, "right")] - 1 if len(first) else first
        own: list[list[tuple[int, int]]] = [[] for _ in group]
        of = np.searchsorted(tokens.begins, first, "right") - 1
        for k, a, b in zip(of.tolist(), (tokens.facts["a"][first] - tokens.offsets[of]).tolist(), (tokens.facts["b"][last] - tokens.offsets[of]).tolist()):
            own[k].append((a, b))
        yield from own


def all_spans(text: str, tagger: Tagger) -> list[tuple[int, int, str]]:
    """Base spans, and the tagger's secrets that touch none of them."""
    return next(spans_of([text], tagger))


def spans_of(texts: list[str], tagger: Tagger) -> Iterator[list[tuple[int, int, str]]]:
    """`all_spans` of each text."""
    for text, own in zip(texts, tagged_spans(texts, tagger)):
        base = [(a, b, k) for a, b, k, _ in base_spans(text)]
        taken = sorted((a, b) for a, b, _ in base)
        ends = list(accumulate((b for _, b in taken), max))  # base spans of different kinds may overlap
        for a, b in own:
            k = bisect_left(taken, (b,))
            if not k or ends[k - 1] <= a:
                base.append((a, b, "crf"))
        yield base


def secret_scan(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row of `docs` (doc_id, text). No shuffle.

    Defined results: null and empty texts have no spans and the digest of nothing; null ids are scanned but not
    trained on; repeated rows give a row each; spans that tie in start go by kind; every token of a text of any
    length is tagged; an empty table gives no rows; other columns are not read.
    """
    tagger, kind = tagger or fit(docs), dict(docs.dtypes)["doc_id"]

    def rows(batch: pa.RecordBatch) -> dict:
        found = list(spans_of(texts(batch.column("text")), tagger))
        counts = {f"n_{k}": pa.array([sum(s[2] == k for s in x) for x in found], pa.int64()) for k in KINDS[:3]}
        sha = [hashlib.sha256(digest([s for s in x if s[2] != "crf"]).encode()).hexdigest() for x in found]
        return {"doc_id": batch.column("doc_id")} | counts | {"base_sha256": pa.array(sha, pa.string()), "spans": pa.array(map(digest, found), pa.string())}

    return map_arrow(docs.select("doc_id", "text"), rows, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def redacted(text: str, spans: list[tuple[int, int, str]], mark: str = "[secret]") -> str:
    """The text with each run of overlapping spans replaced by a mark; an assignment keeps its name."""
    out, at = [], 0
    for a, b, kind in sorted(spans):
        if kind == "assign" and (m := ASSIGN.match(text, a)):
            a = m.start(2)
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted_documents(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """All rows of `docs` with secrets replaced in text, and n_chars after it; null text stays null."""
    tagger, kinds = tagger or fit(docs), docs.dtypes

    def rows(batch: pa.RecordBatch) -> dict:
        was = batch.column("text").to_pylist()
        new = [t if t is None else redacted(t, x) for t, x in zip(was, spans_of([t or "" for t in was], tagger))]
        out = {c: batch.column(c) for c, _ in kinds}
        out["text"] = pa.array(new, pa.string())
        if "n_chars" in out:
            out["n_chars"] = pa.array([n if a == b else len(b) for n, a, b in zip(out["n_chars"].to_pylist(), was, new)], out["n_chars"].type)
        return out

    return map_arrow(docs, rows, ", ".join(f"{c} {k}" for c, k in kinds))
