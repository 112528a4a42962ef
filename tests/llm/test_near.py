"""Near-duplicate classes, fingerprints and kernels against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from adlytics.llm import bagminhash, minhash
from adlytics.llm.textvec import WordHasher, overlap

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bag(text, weighted=True):
    w = WORD.findall((text or "").lower())
    out = {}
    for i in range(max(len(w) - 4, 1 if w else 0)):
        out[tuple(w[i:i + 5])] = out.get(tuple(w[i:i + 5]), 0) + 1 if weighted else 1
    return out


def jaccard(a, b):
    inter = sum(min(n, b.get(k, 0)) for k, n in a.items())
    union = sum(a.values()) + sum(b.values()) - inter
    return inter / union if union else 0.0


def brute_classes(rows, threshold=0.8, weighted=True):
    """class id per row by all pairs; exact copies of any text are one class."""
    texts = list(dict.fromkeys(t or "" for _, t in rows))
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    bags = [bag(t, weighted) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            if bags[i] and jaccard(bags[i], bags[j]) >= threshold:
                parent[root(i)] = root(j)
    at = {t: root(i) for i, t in enumerate(texts)}
    ids = {}
    for d, t in rows:
        if d is not None:
            c = at[t or ""]
            ids[c] = min(ids.get(c, d), d)
    return [(d, ids.get(at[t or ""])) for d, t in rows]


def edited(words, n, rng):
    w = list(words)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"z{rng.random():.6f}"
    return " ".join(w)


def corpus(rng):
    base = [[f"w{rng.randrange(400)}" for _ in range(150)] for _ in range(4)]
    rows = []
    for b in base[:3]:
        rows += [" ".join(b)] * 3
        rows += [edited(b, rng.choice([1, 1, 2, 3, 6, 8]), rng) for _ in range(40)]
    chain = base[3]
    for _ in range(12):                                       # each a near copy of the one before
        chain = edited(chain, 2, rng).split(" ")
        rows.append(" ".join(chain))
    for b in base:                                            # deletions, and a far family of a copy
        rows += [" ".join(b[k:]) for k in (5, 10, 14, 20, 30, 35, 40, 45)]
    far = edited(base[0], 8, rng).split(" ")
    rows += [" ".join(far)] + [edited(far, 1, rng) for _ in range(10)]
    rows += ["", "   \n", None, "one two", "one two", "ONE two", "a b c d e", " ".join(["x"] * 40), " ".join(["x"] * 45)]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows)) + [(None, "alone without id"), (7, rows[ids.index(7)])]


@pytest.mark.parametrize("module, weighted", [(bagminhash, True), (minhash, False)])
def test_classes_match_all_pairs(spark, module, weighted):
    rows = corpus(random.Random(5))
    df = spark.createDataFrame([(d, t, "extra", "x") for d, t in rows], "doc_id long, text string, id string, bands string")
    got = sorted(((r.doc_id, r.class_id) for r in module.near_duplicates(df).collect()), key=str)
    want = sorted(brute_classes(rows, weighted=weighted), key=str)
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    # a band misses a pair of similarity 0.8 with a probability of 0.002
    assert len(got) == len(want) and len(wrong) <= 2, wrong


def test_one_per_class_and_empty(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (3, "other words here"), (None, None), (None, None)]
    df = spark.createDataFrame([(d, t, "l", 1) for d, t in rows], "doc_id long, text string, lang string, key int")
    kept = bagminhash.one_per_class(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, "a b c d e f g"), (3, "other words here"), (None, None)], key=str)
    names = ["doc_id", "text", "_id", "_text_id", "_doc", "text_id", "node", "doc", "row", "class_id", "of", "id", "label", "bands"]
    clash = spark.createDataFrame([(d, t, *range(len(names) - 2)) for d, t in rows],
                                  "doc_id long, text string, " + ", ".join(f"`{c}` int" for c in names[2:]))
    again = bagminhash.one_per_class(clash)
    assert again.columns == names
    assert sorted(map(tuple, again.collect()), key=str) == sorted(
        [(*r, *range(len(names) - 2)) for r in [(1, "a b c d e f g"), (3, "other words here"), (None, None)]], key=str)
    assert bagminhash.one_per_class(clash.limit(0)).collect() == []
    assert bagminhash.near_duplicates(df.limit(0)).count() == 0
    assert minhash.fingerprints(df.limit(0)).count() == 0


def test_signatures_are_unbiased():
    rng = random.Random(2)
    base = [f"w{i}" for i in range(300)]
    a, b = [], []
    for _ in range(150):
        x = base[:]
        for _ in range(5):
            x[rng.randrange(300)] = f"z{rng.random()}"
        a.append(" ".join(base + base[:100] * 3))
        b.append(" ".join(x + x[:60]))
    a, b = pa.array(a, pa.large_string()), pa.array(b, pa.large_string())
    h = WordHasher()
    truth = overlap(a, b, h).mean()
    assert truth == pytest.approx(np.mean([jaccard(bag(x), bag(y)) for x, y in zip(a.to_pylist(), b.to_pylist())]))
    same = bagminhash.text_signatures(a, h, 126) == bagminhash.text_signatures(b, h, 126)
    assert abs(same.mean() - truth) < 0.02
    m = minhash.MinHasher()
    assert abs((m(a) == m(b)).mean() - overlap(a, b, h, False).mean()) < 0.02


def test_fingerprints_and_next(spark):
    import hashlib
    rng = random.Random(1)
    rows = [(i * 3, " ".join(f"w{rng.randrange(50)}é" for _ in range(rng.randrange(0, 60)))) for i in range(150)]
    rows[40] = (120, None)
    rows.append((1000, "x" * 300_000))
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, h int").repartition(7)
    got = {r.doc_id: r for r in minhash.fingerprints(df).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for (d, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        k = len(t) // 3
        e = t[:len(t) - k] + nxt[:k]
        r = got[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert abs(r.near_edited - (jaccard(bag(t, False), bag(e, False)) if bag(t) or bag(e) else 1.0)) < 0.2
    by_text = {}
    for d, t in rows:
        by_text.setdefault(t or "", set()).add(got[d].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
