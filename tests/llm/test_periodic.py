"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from adlytics.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q):
                part = w[i:j + q]
                if not any(all(part[k] == part[k + p] for k in range(length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out)


def plant(d, w):
    h = zlib.crc32(str(d).encode()) if d is not None else 1
    n, g = len(w), h // 10
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def expected(d, text):
    w = plant(d, WORD.findall(text or ""))
    runs = brute_runs(w)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = (None,) * 4
    if runs:
        s, n, q = min(runs, key=lambda r: (-np.longdouble(r[1]) / r[2], r[0], r[2]))
        best = (s, n, q, 1000 * n // q)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (d, len(w), len(runs), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def pieces(rng):
    """Words with runs of many periods, nested and side by side."""
    w = []
    for _ in range(rng.randrange(1, 7)):
        kind = rng.randrange(4)
        if kind == 0:
            w += [f"p{rng.randrange(30)}" for _ in range(rng.randrange(40))]
        else:
            q = rng.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33])
            unit = [rng.choice("abc") for _ in range(q)] if kind == 1 else [f"u{rng.randrange(9)}" for _ in range(q)]
            if kind == 3:
                unit = (unit[:max(q // 4, 1)] * 4 + ["z"])[:40]
            n = int(len(unit) * rng.uniform(1.5, 7))
            w += [unit[i % len(unit)] for i in range(n)]
    return w


def test_runs_against_brute_force():
    rng, finder = random.Random(3), periodic.RunFinder()
    for _ in range(150):
        texts = [[x.encode() for x in pieces(rng)] for _ in range(rng.randrange(1, 6))] + [[]]
        w, begin = periodic.sequence_of(texts)
        got = finder.runs(w, max(map(len, texts)))
        want = [(int(b) + s, n, q) for t, b in zip(texts, begin) for s, n, q in brute_runs(t)]
        assert list(map(tuple, got.tolist())) == sorted(want), texts


def test_words_over_two_letters():
    """Words of two kinds, where blocks occur often and many distances are zero."""
    rng, finder = random.Random(4), periodic.RunFinder()
    for _ in range(300):
        t = [rng.choice([b"a", b"b"]) for _ in range(rng.randrange(80))]
        w, _ = periodic.sequence_of([t])
        assert list(map(tuple, finder.runs(w, len(t)).tolist())) == brute_runs(t)


@pytest.mark.parametrize("n, blocks", [(2, 3), (8, 1), (64, 5), (1024, 1)])
def test_transform_is_an_exact_cyclic_convolution(n, blocks):
    rng = np.random.default_rng(n)
    x, y = (rng.integers(0, periodic.PRIME, (n, blocks)).astype(np.uint64) for _ in range(2))
    t = periodic.Transform()
    got = t.backward(t.forward(x.copy()) * t.forward(y.copy()) % np.uint64(periodic.PRIME))
    for c in range(blocks):
        a, b = x[:, c].tolist(), y[:, c].tolist()
        want = [sum(a[i] * b[(k - i) % n] for i in range(n)) % periodic.PRIME for k in range(0, n, max(n // 16, 1))]
        assert got[::max(n // 16, 1), c].tolist() == want


def test_documents(spark):
    rng = random.Random(8)
    texts = [" ".join(pieces(rng)) for _ in range(150)] + ["", None, " \t\n", "a " * 6, "a " * 5, "é è " * 4, "x\x85x x\x1cx"]
    rows = [(i, t, "lang", 3, "w") for i, t in enumerate(texts)]
    rows += [(None, "b c " * 9, "", 0, ""), (None, "b c " * 9, "", 0, ""), (3, texts[3], "", 0, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, n int, words string").repartition(3)
    got = periodic.run_digests(periodic.periodic_runs(periodic.planted(df))).collect()
    want = [expected(d, t) for d, t, *_ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(r.n_runs > 0 for r in got) > 50
    assert periodic.run_digests(periodic.periodic_runs(periodic.planted(df.limit(0)))).collect() == []


def test_long_texts():
    """A million equal words, and a long period, take one extension each."""
    finder = periodic.RunFinder()
    n = 1_000_000
    assert finder.runs(np.zeros(n, np.int64), n).tolist() == [[0, n, 1]]
    w = np.arange(n) % 170_000
    w[:3] = [n, n + 1, n + 2]
    assert finder.runs(w, n).tolist() == [[3, n - 3, 170_000]]
