"""Vectorised word and shingle hashing over Arrow string columns.

A word is a maximal run of bytes outside ``SPACES`` (all ASCII, so bytes of UTF-8 text can be
tested directly). Everything works on the bytes of many texts at once; a text is never cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The characters that separate words (space and \t \n \v \f \r).
SPACES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
SHINGLE = 5
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_BASE_INV = _U(pow(int(_BASE), -1, 1 << 64))
_ROLL = _U(0xD1342543DE82EF95)
_SEGMENT = 1 << 20


def space_table():
    t = np.zeros(256, bool)
    t[SPACES] = True
    return t


def plain_strings(column) -> pa.Array:
    """A contiguous large_string array without nulls (null becomes the empty text)."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    a = a.cast(pa.large_string())
    return pc.fill_null(a, "")


def buffers(a: pa.Array):
    """(bytes, offsets) of a large_string array, cut to its own rows."""
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    data = a.buffers()[2]
    d = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return d[off[0]:off[-1]], off - off[0]


def blocks(a: pa.Array, max_bytes: int = 1 << 20):
    """Cut rows (never texts) into (start, stop) ranges of about ``max_bytes`` bytes."""
    if len(a) == 0:
        return
    _, off = buffers(a)
    i = 0
    while i < len(a):
        j = int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), len(a))
        yield i, j
        i = j


def word_spans(d: np.ndarray, off: np.ndarray, separators=None):
    """Start, end and text number of every word (a run of bytes that are not ``separators``)."""
    if len(d) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~(space_table() if separators is None else separators)[d]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    full = off[:-1] < off[1:]
    a, b = off[:-1][full], off[1:][full] - 1
    first[a] = word[a]
    last[b] = word[b]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return s, e, np.searchsorted(off, s, side="right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(base, n: int) -> np.ndarray:
    p = np.full(max(n, 1), base, _U)
    p[0] = 1
    return np.multiply.accumulate(p)


class WordHasher:
    """64-bit hashes of words from prefix sums of a polynomial, segment by segment."""

    def __init__(self):
        self.n = 0

    def _need(self, n):
        if n > self.n:
            self.n = max(n, _SEGMENT)
            self.pw, self.inv = powers(_BASE, self.n), powers(_BASE_INV, self.n)

    def __call__(self, d, s, e):
        out = np.empty(len(s), _U)
        i = 0
        while i < len(s):
            j = max(int(np.searchsorted(e, s[i] + _SEGMENT, side="right")), i + 1)
            lo, hi = int(s[i]), int(e[j - 1])
            self._need(hi - lo)
            c = np.zeros(hi - lo + 1, _U)
            np.cumsum((d[lo:hi].astype(_U) + _U(1)) * self.pw[:hi - lo], out=c[1:])
            a, b = s[i:j] - lo, e[i:j] - lo
            out[i:j] = mix((c[b] - c[a]) * self.inv[a] + (b - a).astype(_U))
            i = j
        return out


def shingles(w: np.ndarray, doc: np.ndarray, n_docs: int, k: int = SHINGLE):
    """Hash and text number of every k-word shingle, ordered by text.

    A text of 1 to k-1 words has one shingle of all its words; a text without words has none.
    """
    n = len(w)
    counts = np.bincount(doc, minlength=n_docs) if n else np.zeros(n_docs, np.int64)
    m = max(n - k + 1, 0)
    acc = np.zeros(m, _U)
    scale = powers(_ROLL, k)
    for j in range(k):
        acc += w[j:j + m] * scale[j]
    whole = doc[k - 1:] == doc[:m] if m else np.zeros(0, bool)
    h, hd = mix(acc[whole]), doc[:m][whole]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        first = (np.cumsum(counts) - counts)[short]
        acc = counts[short].astype(_U)
        for j in range(k - 1):
            has = counts[short] > j
            acc[has] += w[first[has] + j] * scale[j]
        h = np.concatenate([h, mix(acc ^ _U(0xA5A5A5A5A5A5A5A5))])
        hd = np.concatenate([hd, short])
        order = np.argsort(hd, kind="stable")
        h, hd = h[order], hd[order]
    return h, hd


def text_shingles(a: pa.Array, hasher: WordHasher, k: int = SHINGLE):
    """(hash, text number) of the shingles of a block of texts, words lower-cased."""
    d, off = buffers(pc.utf8_lower(a))
    s, e, doc = word_spans(d, off)
    return shingles(hasher(d, s, e), doc, len(a), k)


def multisets(h: np.ndarray, doc: np.ndarray):
    """Distinct (text, shingle) with counts: 44 bits of the hash identify a shingle.

    Returns keys ``text << 44 | shingle`` in ascending order, and counts. Texts per block
    must be fewer than 2^20.
    """
    key = np.sort((doc.astype(_U) << _U(44)) | (h >> _U(20)))
    if not len(key):
        return key, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.diff(np.append(first, len(key)))


def overlap(a: pa.Array, b: pa.Array, hasher: WordHasher, weighted: bool = True) -> np.ndarray:
    """Jaccard of the shingle multisets (or sets) of the texts a[i], b[i]; 0 without shingles."""
    n = len(a)
    (ka, ca), (kb, cb) = (multisets(*text_shingles(x, hasher)) for x in (a, b))
    if not weighted:
        ca, cb = np.ones_like(ca), np.ones_like(cb)
    at = np.searchsorted(kb, ka)
    hit = at < len(kb)
    hit[hit] = kb[at[hit]] == ka[hit]
    pair = lambda key: (key >> _U(44)).astype(np.int64)
    inter = np.bincount(pair(ka[hit]), weights=np.minimum(ca[hit], cb[at[hit]]), minlength=n)
    total = np.bincount(pair(ka), weights=ca, minlength=n) + np.bincount(pair(kb), weights=cb, minlength=n)
    return np.divide(inter, total - inter, out=np.zeros(n), where=total > 0)
