"""SimHash fingerprints and the trie join against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from adlytics.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, budget=3):
    """Smallest member of each element's connected set, over all pairs."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= budget:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(prints))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def crowded(rng, n):
    """Fingerprints with dense groups, chains, far ones and ones at exactly 3 and 4 bits."""
    out = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(6):
        c = rng.getrandbits(64)
        for _ in range(n):
            x = c
            for b in rng.sample(range(64), rng.choice([0, 1, 2, 3, 3, 4, 5, 7, 9])):
                x ^= 1 << b
            out.add(x)
        x = c
        for _ in range(n // 4):
            for b in rng.sample(range(64), 3):
                x ^= 1 << b
            out.add(x)
    out |= {rng.getrandbits(64) for _ in range(n)}
    out |= {0xABCD << 48 | rng.getrandbits(48) for _ in range(n)}       # one block for all
    return sorted(out)


@pytest.mark.parametrize("unit", [4096, 8])
def test_links_against_all_pairs(spark, unit):
    rng = random.Random(unit)
    prints = crowded(rng, 60)
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long").repartition(5)
    links = simhash.near_links(df, unit=unit).collect()
    at = {signed(x): i for i, x in enumerate(prints)}
    assert all((prints[at[r.a]] ^ prints[at[r.b]]).bit_count() >= 1 for r in links)
    a, b = (np.array([at[r[k]] for r in links]) for k in (0, 1))
    got = simhash.joined_sets(len(prints), a, b, np.arange(len(prints)))
    assert got.tolist() == brute_components(prints)
    assert len(links) <= 8 * len(prints) * (1 if unit > 100 else 40)


def test_one_dense_group_is_not_paired(spark):
    """20,000 fingerprints within 4 bits of one: links stay in proportion to the members."""
    rng = random.Random(3)
    c = rng.getrandbits(64)
    prints = {c}
    while len(prints) < 20_000:
        x = c
        for b in rng.sample(range(64), rng.randrange(1, 5)):
            x ^= 1 << b
        prints.add(x)
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long").repartition(4)
    links = simhash.near_links(df)
    rows = [(r.a, r.b) for r in links.collect()]
    at = {signed(x): i for i, x in enumerate(prints)}
    a, b = (np.array([at[r[k]] for r in rows]) for k in (0, 1))
    got = simhash.joined_sets(len(at), a, b, np.arange(len(at)))
    near = np.array([(x ^ c).bit_count() <= 3 for x in prints])
    assert len(set(got[near].tolist())) == 1
    assert len(rows) < 400 * len(prints)


def test_documents(spark):
    rng = random.Random(9)
    base = " ".join(f"W{rng.randrange(300)}é" for _ in range(400))
    texts = ["", None, " \t\n\v\f\r", "one", "One  TWO", "one two", "a b c", "a\nb\tc", "\x85 \x1c x", base, base.lower() + " z",
             base, base + " " + base, "x" * 100_000, " ".join(["same"] * 50_000), "É é É é", "é é é é"]
    rows = [(i * 3 % 17 + (i // 17) * 100, t, "lang", 1, "fp") for i, t in enumerate(texts)]
    rows += [(5, "a b c", "x", 2, "fp"), (5, "a b c", "x", 2, "fp"), (None, "a b c", "x", 2, "fp"), (None, "alone without id", "", 0, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string, first_id int, fp string").repartition(4)
    got = simhash.near_duplicates(df).collect()
    prints = [brute_fingerprint(t) for _, t, *_ in rows]
    comp = brute_components(prints)
    first = {}
    for (d, *_), c in zip(rows, comp):
        if d is not None:
            first[c] = min(first.get(c, d), d)
    want = [(d, f"{p:016x}", first.get(c), prints.count(p)) for (d, *_), p, c in zip(rows, prints, comp)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(df.limit(0)).collect() == []


def test_long_texts_are_read_in_pieces(monkeypatch):
    rng = random.Random(2)
    for n in (0, 1, 2, 3, 7, 300):
        text = "\n".join("q" * rng.randrange(1, 30) for _ in range(n)) + " "
        want = brute_fingerprint(text)
        for piece in (1, 5, 64):
            monkeypatch.setattr(simhash, "PIECE", piece)
            assert simhash.simhash(text.encode()) == want
