"""Collocations, spelling variants and line dedup against plain versions of their contracts, and over odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from warren.llm import collocations, common, line_dedup, spelling

SCHEMA = "doc_id bigint, text string, lang string, n string, word string, key string, phrase string, block string"
LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, *"xxxxx") for i, t, lang in rows], SCHEMA)


def phrases_by_hand(rows, least, top, depth=5):
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOW)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, depth + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows_ = []
        for p, a in cands.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cands.items()):
                continue
            score, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows_)[:top])]
    return sorted(out)


def random_texts(seed, n=60):
    rng = random.Random(seed)
    words = ["of", "the", "The", "a", "é", "x\x01", "of\t", "to", "be", "Been", "seen"]
    return [(i, " ".join(rng.choices([*words, "of the", "to be", "a,", "b.", "c\nd", f"rare{i}"], k=rng.randint(0, 60))), rng.choice(["en", "en", "fr", None])) for i in range(n)]


@pytest.mark.parametrize("budget,slots", [(10_000, 64), (25, 4), (3, 2)])
def test_collocations(spark, tmp_path, budget, slots):
    """Whole prefixes and prefixes extended word by word count alike, as do filters of any size."""
    rows = random_texts(3) + [(None, None, "en"), (7, "", None), (8, "one two three four five six. " * 9, "de"), (9, "z" * 50_000 + " y y y y y y", "de"), (9, "y y y", "und")]
    found = collocations.collocations(table(spark, rows), str(tmp_path), least=4, top=40, budget=budget, slots=slots)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = sorted(tuple(r) for r in found.collect())
    assert got == phrases_by_hand(rows, 4, 40) and len(got) > 60


def test_heavy_prefixes_are_extended(spark):
    rows = spark.createDataFrame([("en", f"the w{i % 3} v{i} ".encode(), 1) for i in range(60)] + [("en", f"a{i} b ".encode(), 1) for i in range(40)], "lang string, phrase binary, n bigint")
    groups = collocations.prefix_groups(rows, 12, slots=1 << 12)
    assert len(groups) == 3 and len({g for level in groups for _, g in level}) >= 100 // 12
    placed = collocations.grouped(rows, groups, 1 << 12)
    assert placed.filter("`group` is null or closed is null").count() == 0
    assert max(r["count"] for r in placed.groupBy("group").count().collect()) <= 12


def test_a_small_filter_changes_nothing(spark, tmp_path, monkeypatch):
    rows = random_texts(5)
    monkeypatch.setattr(collocations, "FILTER_BITS", (8, 8))
    monkeypatch.setattr(collocations, "PAIR_SLOTS", (8, 8))
    assert sorted(tuple(r) for r in collocations.collocations(table(spark, rows), str(tmp_path), least=4, top=40).collect()) == phrases_by_hand(rows, 4, 40)


def words_by_hand(rows):
    n = Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    close = {w: [v for v in n if v != w and near(w, v)] for w in n}
    form = {w: (lambda best: best if best and n[best] >= 5 * n[w] else None)(min(close[w], key=lambda v: (-n[v], v), default=None)) for w in n}

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n[w], len(close[w]), n[form[w]] if form[w] else None) for w in n)


def misspelt(seed):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abcdeéßÉ", k=rng.randint(5, 9))) for _ in range(25)] + ["q" * 90, "anagram", "margana"]
    pool = []
    for s in stems:
        for _ in range(6):
            at = rng.randrange(len(s))
            pool += [s, s[:at] + s[at + 1 :], s[:at] + rng.choice("abé") + s[at:], s[:at] + rng.choice("abé") + s[at + 1 :]]
    weights = [rng.choice([1, 1, 3, 20, 120]) for _ in pool]
    return [(i, " ".join(rng.choices(pool, weights, k=400)).replace("a", "A", 30), "en") for i in range(12)]


@pytest.mark.parametrize("groups,most", [(5, 4096), (4, 6), (3, 2)])
def test_spelling_variants(spark, groups, most):
    """Blocks dealt to tiles find what whole blocks find."""
    rows = misspelt(1) + [(None, "straße " * 7 + "straßen " * 2, "de"), (5, None, None), (6, "", None), (6, "×÷×÷×÷ " * 6 + "x" * 30_000, "en"), (20, "chainaaa " * 200 + "chainaab " * 30 + "chainabb " * 5, "en")]
    found = spelling.spelling_variants(table(spark, rows), groups=groups, most=most)
    assert set(found.columns) == {"word", "form", "root", "n", "n_near", "form_n"}
    got = sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found.collect())
    want = words_by_hand(rows)
    assert got == want and sum(w[4] for w in want) > 100 and any(w[2] not in (w[0], w[1]) for w in want)


def lines_by_hand(rows):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOW)
    holders = defaultdict(set)
    for doc_id, text, _ in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc_id)
    low = lambda d: -1 if d is None else d
    gone = {k: max(h, key=low) for k, h in holders.items() if len(k) >= 20 and len(h) >= 3}
    out = []
    for doc_id, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in gone or gone[key(x)] == doc_id]
        out.append((low(doc_id), len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (5, 2), (9, 3)])
def test_line_dedup(spark, tmp_path, batches, fanout):
    rng = random.Random(batches)
    pool = [f"shared line number {i} of the lot" for i in range(40)] + ["short", "", "  \t ", "É" * 20, "é" * 20, "x" * 19, "x" * 20]
    rows = [(i, "\n".join(rng.choice(["", " ", "\t"]) + (lambda s: s.upper() if rng.random() < 0.2 and s.isascii() else s)(rng.choice([*pool, f"own line {i} {rng.random()} here"])) + rng.choice(["", "\r", " "]) for _ in range(rng.randint(0, 12))), "en") for i in range(50)]
    rows += [rows[3], (3, pool[1], "en"), (None, pool[2] + "\n" + pool[3], None), (None, None, None), (60, "", "en"), (61, None, "en"), (62, (pool[0] + "\n") * 3000, "en")]
    rows = [(i, t, lang) for i, t, lang in rows]
    found = line_dedup.without_repeated_lines(table(spark, rows), common.shared_folder(spark), batches, fanout)
    got = sorted((-1 if r[0] is None else r[0], r[1], r[2], r[3]) for r in found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256)).collect())
    assert got == lines_by_hand(rows)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_runs_are_disjoint_and_compacted(spark):
    runs = line_dedup.LineRuns(spark, common.shared_folder(spark), fanout=2)
    try:
        known = set()
        for i in range(7):
            keys = {j for j in range(100) if j % (i + 2) == 0}
            batch = spark.createDataFrame([(bytes([j]), i, 1) for j in keys], "key binary, keeper bigint, docs bigint")
            again = {r["key"][0] for r in runs.add(batch).collect()}
            assert again == keys & known
            known |= keys
        held = [r["key"][0] for t in runs.tables() for r in spark.table(t).collect()]
        assert sorted(held) == sorted(known) and [len(level) for level in runs.levels] == [1, 1, 1]
    finally:
        runs.drop()


def test_hot_keys_are_broadcast(spark):
    rows = [(i, f"the very same line everywhere\nown line of {i} and no other", "en") for i in range(1500)]
    got = sorted((r[0], r[1], r[2], r[3]) for r in line_dedup.line_dedup(table(spark, rows)).collect())
    assert got == lines_by_hand(rows)


def test_empty_tables(spark, tmp_path):
    none = table(spark, [])
    assert collocations.collocations(none, str(tmp_path)).count() == 0
    assert spelling.spelling_variants(none).count() == 0
    assert line_dedup.line_dedup(none).count() == 0
    blank = table(spark, [(1, None, None), (None, "", "en")])
    assert collocations.collocations(blank, str(tmp_path)).count() == 0
    assert spelling.spelling_variants(blank).count() == 0
    assert [r["n_lines"] for r in line_dedup.line_dedup(blank).collect()] == [1, 1]
