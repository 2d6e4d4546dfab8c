"""Secrets across parts of a stretch, exact fingerprints, archives beside one huge page, hot bands."""

import random
import zlib

import numpy as np
import pytest

from warren.llm import fingerprinting, secret_scan, simhash, warc


@pytest.fixture(scope="module")
def tagger():
    return secret_scan.train(secret_scan.planted_examples(800))


def test_parts_change_no_features_and_no_tags(tagger):
    rng = random.Random(5)
    lines = [secret_scan.planted(rng)[0] for _ in range(60)]
    text = " a1b2c3d4e5 ".join(lines)
    whole = [(p, np.concatenate(list(f))) for p, f in secret_scan.stretches(text, 1 << 30)]
    assert max(len(p) for p, _ in whole) > 400
    for part in (1, 2, 7, 64):
        for (p, f), (q, parts) in zip(whole, secret_scan.stretches(text, part), strict=True):
            parts = list(parts)
            assert p == q and max(map(len, parts)) <= part and np.array_equal(f, np.concatenate(parts))
            assert tagger.best_of(parts) == tagger.best(f)


def test_a_secret_is_found_at_every_place_around_a_cut(tagger):
    secret = "password: hunter2xq81zt55k"
    alone = [s for s in secret_scan.all_spans(f"y1y2y3y4y5 {secret} y1y2y3y4y5", tagger) if s[2] == "assign"]
    assert len(alone) == 1
    cued = "auth token kd83hf72ls91md04"
    found = lambda before: [s for s in secret_scan.all_spans("d4e5f6a7b8 " * before + cued + " d4e5f6a7b8" * 40, tagger)]
    shift = lambda spans, by: [(a - by, b - by, k) for a, b, k in spans if a >= by]
    want = shift(found(3), 3 * 11)
    for before in range(secret_scan.PART - 12, secret_scan.PART + 4):
        assert shift(found(before), before * 11) == want


def test_a_run_is_followed_beyond_a_megabyte(tagger):
    run = "x" * (1 << 20) + "a1b2c3d4"
    places = [p for p, _ in secret_scan.stretches(f"key={run} end 12345678")]
    assert max(b for p in places for _, b in p) == len(f"key={run} end 12345678")


def closed_syncmers_by_loop(text):
    """Places of k-mers whose smallest inner substring (by its mixed value) is the first or the last."""
    k, s = fingerprinting.K, fingerprinting.S
    value = lambda i: int(fingerprinting._mixed(np.array([int.from_bytes(text[i : i + s], "little")], np.uint64))[0])
    out = []
    for at in range(len(text) - k + 1):
        inner = [value(i) for i in range(at, at + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append(at)
    return out


def test_syncmers_by_the_rule():
    rng = random.Random(8)
    for text in (b"", b"short", bytes(rng.choices(range(256), k=600)), b"ab" * 100, "é ß lorem ipsum dolor ".encode() * 8):
        assert fingerprinting.syncmers(text)[0].tolist() == closed_syncmers_by_loop(text)


def test_all_anchors_can_be_kept(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices("lorem ipsum dolor sit amet consetetur".split(), k=rng.randint(0, 400))) for _ in range(9)]
    got = fingerprinting.edited_fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), kept=None).collect()
    assert len(got) == 9 and max(len(r["fingerprint"]) for r in got) > 16 * fingerprinting.KEPT
    for r in got:
        t, after = texts[r["doc_id"]], texts[(r["doc_id"] + 1) % 9]
        e = len(t) // 4
        own, new, other = (fingerprinting.sketch(x.encode(), None) for x in (t, t[: len(t) - e] + after[:e], after))
        assert r["fingerprint"] == own.tobytes().hex() and r["near_edited"] == fingerprinting.likeness(own, new, None) and r["near_next"] == fingerprinting.likeness(own, other, None)


def test_files_go_with_bytes_beside_a_huge_page(spark, tmp_path):
    rng = random.Random(2)
    page = lambda n: "".join(rng.choices("abcdefgh <>", k=n))
    sizes = [rng.randint(100, 400) for _ in range(300)] + [rng.randint(2_000, 9_000) for _ in range(200)] + [400_000, 0]
    pages = spark.createDataFrame([(i, f"u{i}", page(n)) for i, n in enumerate(sizes)], "page_id bigint, url string, html string").coalesce(1)
    records = warc.payloads(pages)
    folder = str(tmp_path / "a")
    most = 64_000
    warc.write_archives(records, warc.resolve_revisits(records), folder, most)
    files = [sum(len(p) for _, p in warc._parse(f.read_bytes())) for f in (tmp_path / "a").glob("*.gz")]
    assert sum(files) == sum(sizes) and len(files) < 6 * sum(sizes) / most
    assert [x for x in files if x > most] == [400_000]
    read = warc.read_warc(spark.read, folder).select("page_id", "header_digest").collect()
    assert sorted(r["page_id"] for r in read) == list(range(len(sizes)))


def test_families_of_a_template(spark):
    """Pages that share most of their words: links are those of the pages that are near, and a band's task holds a part."""
    frame = [f"t{i}" for i in range(30)]
    # pages of a family differ in a word at the end; families share half of their words
    texts = [" ".join(frame[:14] + [f"f{k % 200}x{j}" for j in range(30)] + [f"p{k}"]) for k in range(2_000)]
    df = spark.createDataFrame([(k, t, zlib.crc32(t.encode())) for k, t in enumerate(texts)], "doc_id bigint, text string, extra bigint")
    kept = sorted(r["doc_id"] for r in simhash.keep_one(df, shingle=5, similarity=0.8).select("doc_id").collect())
    assert kept == list(range(200))


def test_every_token_of_a_text_is_tagged(tagger):
    """Secrets without a digit, a long run or a cue near them, and texts tagged together or alone."""
    plain = "some words of a walk by the river, and no more (than that)!"
    (places,) = (p for p, _ in secret_scan.stretches(plain))
    assert [plain[a:b] for a, b in places] == plain.replace(",", " ,").replace("(", "( ").replace(")!", " ) !").split()
    line = "connect to ssh joe:qwErTyUiop@host and walk"
    found = [line[a:b] for a, b, _ in secret_scan.all_spans(line, tagger)]
    assert any("qwErTyUiop" in x for x in found)
    rng = random.Random(3)
    texts = ["", plain, *(secret_scan.planted(rng)[0] for _ in range(80)), " ", " a1b2c3d4 ".join(secret_scan.planted(rng)[0] for _ in range(90))]
    assert list(secret_scan.spans_of(texts, tagger)) == [secret_scan.all_spans(t, tagger) for t in texts]


def test_texts_cut_at_blanks_give_the_same_tokens(tagger, monkeypatch):
    rng = random.Random(9)
    text = "\n".join(secret_scan.planted(rng)[0] for _ in range(50))
    whole = secret_scan.Tokens([text])
    wanted = whole.features(0, len(whole)), secret_scan.all_spans(text, tagger)
    monkeypatch.setattr(secret_scan, "TOGETHER", 40)
    cut = secret_scan.Tokens([text])
    assert np.array_equal(wanted[0], cut.features(0, len(cut))) and wanted[1] == secret_scan.all_spans(text, tagger)


def test_trees_name_the_pairs_of_a_cluster(monkeypatch):
    """In blocks of clusters too, pairs come from the BK-tree over SimHashes and the sets decide."""
    import pyarrow as pa

    rng = random.Random(7)
    texts = []
    for _ in range(12):
        words = [f"w{rng.randrange(10_000)}" for _ in range(120)]
        for k in range(3):
            texts.append(" ".join([*words[:118], *(f"e{k}{j}" for j in range(2))]))
    prints = [simhash.set_print(simhash.shingle_set(t.encode(), 5)) for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array([1] * len(texts)), pa.array([p[0] for p in prints]), pa.array([p[2] for p in prints]), pa.array(texts)], names=["key", "fp", "near", "text"])
    links = lambda: {(u, v) for b in simhash._linked_blocks(5, 0.8)(iter([batch])) for u, v in zip(*(c.to_pylist() for c in b.columns))}
    group = {p[0]: i // 3 for i, p in enumerate(prints)}
    found = links()
    assert len(found) == 24 and all(group[u] == group[v] for u, v in found)
    monkeypatch.setattr(simhash, "WIDE", 0)
    assert len(links()) < 24
