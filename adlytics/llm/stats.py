"""Statistics of whole texts, many texts at a time (shared by the quality operators)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from adlytics.llm.textvec import WordHasher, buffers, mix, word_spans

# Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"
_U = np.uint64

COUNTS = ["n_chars", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_upper", "n_digits", "n_punct", "n_bang", "n_nonascii", "n_types", "n_long_words", "n_short_words"]


class DocStats:
    """Counts per text (int64 arrays, see COUNTS) of a block of texts.

    n_chars: code points; n_words: runs outside the six ASCII spaces; word_chars: code points in
    words; n_dup_lines: \\n-split lines with a word, equal to an earlier line of the text;
    n_repeat_words: words in 3-word windows found at least twice; n_lines: lines with a word;
    n_upper/n_digits/n_punct/n_bang: ASCII capitals, digits, punctuation, exclamation marks;
    n_nonascii: code points beyond ASCII; n_types: distinct words; n_long_words/n_short_words:
    words of over 12 / under 3 code points. Empty texts have zeros.
    """

    def __init__(self):
        self.hasher = WordHasher()
        kinds = np.zeros((256, 5), bool)
        for i in range(128):
            c = chr(i)
            kinds[i] = [c in SYMBOLS, "A" <= c <= "Z", "0" <= c <= "9",
                        33 <= i < 127 and not c.isalnum(), c == "!"]
        self.kinds = kinds

    @staticmethod
    def per_text(flags, off):
        """Sum of byte flags per text."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[off[1:]] - total[off[:-1]]

    @staticmethod
    def repeats(key):
        """Groups of equal keys: (order, first of its group, group has more than one), sorted order."""
        order = np.argsort(key, kind="stable")
        k = key[order]
        new = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
        size = np.diff(np.append(np.flatnonzero(new), len(k)))
        return order, new, np.repeat(size > 1, size)

    def __call__(self, a: pa.Array) -> dict[str, np.ndarray]:
        d, off = buffers(a)
        n = len(a)
        if not len(d):
            return {c: np.zeros(n, np.int64) for c in COUNTS}
        point = (d & 0xC0) != 0x80                              # first byte of a code point
        s, e, doc = word_spans(d, off)
        points = np.concatenate([[0], np.cumsum(point, dtype=np.int64)])
        length = points[e] - points[s]
        count = lambda x, **k: np.bincount(x, minlength=n, **k).astype(np.int64)
        out = {"n_chars": points[off[1:]] - points[off[:-1]], "n_words": count(doc), "word_chars": count(doc, weights=length)}
        for name, column in zip(("n_symbols", "n_upper", "n_digits", "n_punct", "n_bang"), (0, 1, 2, 3, 4)):
            out[name] = self.per_text(self.kinds[:, column][d], off)
        out["n_nonascii"] = self.per_text(point & (d >= 0x80), off)
        out["n_long_words"], out["n_short_words"] = count(doc[length > 12]), count(doc[length < 3])

        w = self.hasher(d, s, e)
        salt = mix(np.arange(n, dtype=_U) + _U(0x51ED270B))
        order, new, _ = self.repeats(mix(w ^ salt[doc]))
        out["n_types"] = count(doc[order[new]])

        m = max(len(w) - 2, 0)                                   # 3-word windows inside one text
        inside = np.flatnonzero(doc[2:] == doc[:m]) if m else np.zeros(0, np.int64)
        tri = w[inside] * _U(0x9E3779B97F4A7C15) + mix(w[inside + 1]) * _U(0xC2B2AE3D27D4EB4F) + mix(w[inside + 2] ^ salt[0])
        order, _, many = self.repeats(mix(tri) ^ salt[doc[inside]])
        at = inside[order[many]]
        mark = np.zeros(len(w), bool)
        for k in range(3):
            mark[at + k] = True
        out["n_repeat_words"] = count(doc[mark])

        # lines: spans between line feeds and text borders that hold a word
        cut = d == 0x0A
        start = np.concatenate([off[:-1], np.flatnonzero(cut) + 1])
        start = np.unique(start[start < len(d)])
        stop = np.append(start[1:], len(d))
        stop = stop - cut[stop - 1]
        has = np.searchsorted(s, stop) > np.searchsorted(s, start)
        start, stop = start[has], stop[has]
        of = np.searchsorted(off, start, side="right") - 1
        out["n_lines"] = count(of)
        order, new, _ = self.repeats(mix(self.hasher(d, start, stop) ^ salt[of]))
        out["n_dup_lines"] = count(of[order[~new]])
        return {c: out[c] for c in COUNTS}
