"""What the fourth round's finding about near-duplicates was about, on small cases."""

import random

import numpy as np
import xxhash

from warren.llm import simhash


def far_texts():
    """Two texts of 50 and 40 words, all of the second's in the first (Jaccard 0.8), whose SimHashes lie far apart."""
    words = [f"w{i}" for i in range(4000)]
    bits = np.unpackbits(np.frombuffer(b"".join(xxhash.xxh64_digest(w.encode(), simhash.SEED) for w in words), np.uint8).reshape(-1, 8), axis=1).astype(int) * 2 - 1
    few = list(range(40))
    for _ in range(400):  # balanced: ones and zeros of every bit nearly even
        total = bits[few].sum(0)
        i = int((bits[few] @ total).argmax())
        rest = total - bits[few[i]]
        j = int((np.abs(rest + bits) + 1000 * np.isin(np.arange(4000), few)[:, None]).sum(1).argmin())
        if np.abs(rest + bits[j]).sum() >= np.abs(total).sum():
            break
        few[i] = j
    total, push = bits[few].sum(0), []
    side = np.where(total > 0, -1, 1)
    for _ in range(10):
        now = total + bits[push].sum(0)
        gain = (((now + bits) * side > 0) * 4 + np.minimum((now + bits) * side, 1)).sum(1) - 1000 * np.isin(np.arange(4000), few + push)
        push.append(int(gain.argmax()))
    return " ".join(words[i] for i in few), " ".join(words[i] for i in few + push)


def test_similar_texts_far_apart_in_simhash_are_found(spark):
    a, b = far_texts()
    one, two = (simhash.set_print(simhash.shingle_set(t.encode(), 1)) for t in (a, b))
    assert ((one[2] ^ two[2]) & (1 << 64) - 1).bit_count() > 28  # the trees' radius before
    df = spark.createDataFrame([(1, a), (2, b), (3, "other words stay")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.keep_one(df, shingle=1, similarity=0.8).collect()) == [1, 3]


def test_similar_sets_share_a_first_shingle_whatever_the_levels():
    rng = random.Random(2)
    for n in [*range(1, 30), 101, 333]:
        levels = np.array([rng.choice((2, 3, 9, 255)) for _ in range(1 << 10)] * (simhash.SLOTS >> 10), np.uint8)
        a = [f"{n}.{i}".encode() for i in range(n)]
        for more in range(n // 4 + 1):
            gone = max(g for g in range(n) if (n - g) >= 0.8 * (n + more) - 1e-9)
            b = {*rng.sample(a, n - gone), *(f"x{i}".encode() for i in range(more))}
            assert simhash.jaccard(set(a), b) >= 0.8
            firsts = [set(simhash.set_print(set(x), levels=levels)[4].tolist()) for x in (a, b)]
            assert firsts[0] & firsts[1]


def test_near_copies_are_those_of_brute_force(spark):
    """Families of edited texts, and a line that all of them have, so that shards are crowded too."""
    rng, rows = random.Random(11), []
    for f in range(40):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice((6, 12, 40, 90)))]
        for _ in range(rng.choice((1, 2, 5, 25))):
            words = list(base)
            for _ in range(rng.randrange(1 + len(words) // 12)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(9000)}"
            rows.append((len(rows), " ".join([*words, "the same end of each of these texts"] if f % 2 else words)))
    rng.shuffle(rows)
    sets = {i: simhash.shingle_set(t.encode(), 3) for i, t in rows}
    least = {i: i for i in sets}
    for i in sorted(sets):  # components, named by their smallest member
        for j in sets:
            if j < i and least[i] != least[j] and simhash.jaccard(sets[i], sets[j]) >= 0.8:
                low, high = sorted((least[i], least[j]))
                least = {k: low if v == high else v for k, v in least.items()}
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, similarity=0.8)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(set(least.values())) and len(set(least.values())) < len(rows)
