"""Periodic runs of words by block convolution (operator 12).

A run is a stretch of words with smallest period q (words q apart are identical) and a length of
at least max(6, 4 q) that no neighbouring word extends with period q.

At each dyadic scale B = 1, 2, 4, ... periods q in [B, 2B) are looked for. A run of such a period
holds a block of B words that starts at a multiple of 2B and occurs again q words later. The
squared differences between a block x and the text y behind it,

    sum (x_i - y_(t+i))^2 = sum x_i^2 + sum y_(t+i)^2 - 2 sum x_i y_(t+i),

are taken for all distances q = B + t at once, over the word numbers: the sums of squares from
prefix sums, the products from one cyclic convolution of length 2B by a number-theoretic
transform modulo the prime 3 * 2^30 + 1. A true occurrence gives exactly zero; a zero is compared
word by word before it counts, so sums beyond the modulus do no harm.

Each occurrence seeds an extension to the left and right with its distance as the period. A seed
that lies within a stretch of a smaller period found at an earlier scale cannot be part of a run
of its own (two periods over a stretch of their sum's length make the smaller one the period of
both), so a text of one repeated word is extended once. Only blocks whose words all occur again
less than 2B words later can have an occurrence; others are not convolved.

Many texts are searched as one sequence, with a word of its own between them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlytics.llm.common import WORD
from adlytics.llm.textvec import blocks, plain_strings

MIN_LENGTH, MIN_PERIODS = 6, 4
PRIME, GENERATOR = 3 * (1 << 30) + 1, 5
CHUNK = 1 << 17          # numbers transformed at a time, a longer block alone
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_U = np.uint64
_P = _U(PRIME)


class Transform:
    """Number-theoretic transforms along the first axis; the twiddle factors are kept."""

    def __init__(self):
        self.factors: dict[tuple[int, bool], np.ndarray] = {}

    def twiddle(self, half: int, inverse: bool) -> np.ndarray:
        if (half, inverse) not in self.factors:
            root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
            root = pow(root, -1, PRIME) if inverse else root
            w = np.ones(half, _U)
            done = 1
            while done < half:                          # w[done:] = w[:done] * root^done
                step = _U(pow(root, done, PRIME))
                m = min(done, half - done)
                w[done:done + m] = w[:m] * step % _P
                done += m
            self.factors[half, inverse] = w[None, :, None]
        return self.factors[half, inverse]

    def forward(self, x: np.ndarray) -> np.ndarray:
        """Natural order to bit-reversed order, in place."""
        n, m = x.shape
        half = n // 2
        while half:
            v = x.reshape(n // (2 * half), 2, half, m)
            a, b = v[:, 0], v[:, 1]
            plus, minus = a + b, a + (_P - b)
            plus -= _P * (plus >= _P)
            minus -= _P * (minus >= _P)
            v[:, 0], v[:, 1] = plus, minus * self.twiddle(half, False) % _P
            half //= 2
        return x

    def backward(self, x: np.ndarray) -> np.ndarray:
        """Bit-reversed order to natural order, in place, divided by the length."""
        n, m = x.shape
        half = 1
        while half < n:
            v = x.reshape(n // (2 * half), 2, half, m)
            a, b = v[:, 0], v[:, 1] * self.twiddle(half, True) % _P
            plus, minus = a + b, a + (_P - b)
            plus -= _P * (plus >= _P)
            minus -= _P * (minus >= _P)
            v[:, 0], v[:, 1] = plus, minus
            half *= 2
        return x * _U(pow(n, -1, PRIME)) % _P


class RunFinder:
    def __init__(self):
        self.transform = Transform()

    def occurrences(self, code: np.ndarray, squares: np.ndarray, starts: np.ndarray, size: int):
        """(start, distance) where the squared differences of the block of ``size`` words at
        ``start`` and the words ``distance`` later, size <= distance < 2 size, are zero.

        ``code`` goes on for 3 * size numbers behind the last start.
        """
        per = max(CHUNK // (2 * size), 1)
        out_s, out_q = [], []
        for i in range(0, len(starts), per):
            s = starts[i:i + per]
            x = np.zeros((2 * size, len(s)), _U)
            x[:size] = code[s[None, :] + np.arange(size - 1, -1, -1)[:, None]]
            y = code[s[None, :] + np.arange(size, 3 * size)[:, None]]
            product = self.transform.forward(x) * self.transform.forward(y) % _P
            # places size-1 .. 2 size-2 of the cyclic product are free of wrapped terms
            product = self.transform.backward(product)[size - 1:2 * size - 1]
            at = s[None, :] + np.arange(size, 2 * size)[:, None]
            total = (squares[s + size] - squares[s])[None, :] + (squares[at + size] - squares[at])
            t, col = np.nonzero((total + _U(2) * (_P - product)) % _P == 0)
            out_s.append(s[col])
            out_q.append(t + size)
        return np.concatenate(out_s), np.concatenate(out_q)

    @staticmethod
    def equal_ahead(w: np.ndarray, i: int, q: int) -> int:
        """The first j >= i with w[j] <> w[j + q], or len(w) - q."""
        step = 64
        while True:
            b = w[i + q:i + q + step]
            differ = w[i:i + len(b)] != b
            at = int(differ.argmax()) if len(b) else 0
            if len(b) and differ[at]:
                return i + at
            i += len(b)
            if len(b) < step:
                return i
            step *= 2

    @staticmethod
    def equal_back(w: np.ndarray, i: int, q: int) -> int:
        """The last j <= i such that w[k] = w[k + q] for all j <= k < i."""
        step = 64
        while i:
            lo = max(i - step, 0)
            differ = (w[lo:i] != w[lo + q:i + q])[::-1]
            at = int(differ.argmax())
            if differ[at]:
                return i - at
            i = lo
            step *= 2
        return 0

    def stretches(self, w: np.ndarray, longest: int):
        """Stretches (start, end, period) that hold every run of the word numbers ``w``; no text
        in it is longer than ``longest`` words."""
        n = len(w)
        found: list[tuple[int, int, int]] = []
        far = np.int64(2) << 40
        order = np.argsort(w, kind="stable")
        gap = np.full(n, far)
        same = w[order[1:]] == w[order[:-1]]
        gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
        worst, size = gap, 1                            # per aligned block, the farthest next occurrence
        code = squares = None
        while MIN_PERIODS * size <= longest:
            starts = np.flatnonzero(worst[::2] < 2 * size) * (2 * size)
            if found:
                lo = np.array(sorted(found))
                left, right = lo[:, 0], np.maximum.accumulate(lo[:, 1])

                def inside(a, b):
                    """Whether [a, b) lies within a stretch found at an earlier scale."""
                    at = np.searchsorted(left, a, side="right") - 1
                    return (at >= 0) & (right[np.maximum(at, 0)] >= b)
                starts = starts[~inside(starts, starts + 3 * size)]
            if len(starts):
                need = int(starts[-1]) + 3 * size + 1
                if code is None or len(code) < need:
                    code = np.zeros(max(need, n), _U)
                    code[:n] = w + 1
                    squares = np.zeros(len(code) + 1, _U)
                    np.cumsum(code * code % _P, out=squares[1:])
                s, q = self.occurrences(code, squares, starts, size)
                ok = s + q + size <= n
                if found:
                    ok &= ~inside(s, s + q + size)
                s, q = s[ok], q[ok]
                by = np.lexsort((s, q))
                period, end = 0, 0
                for a, d in zip(s[by].tolist(), q[by].tolist()):
                    if d == period and a + d + size <= end:
                        continue                        # the stretch found last holds it
                    stop = self.equal_ahead(w, a, d)
                    if stop < a + size:
                        continue                        # zero by the modulus only
                    period, end = d, stop + d
                    found.append((self.equal_back(w, a, d), end, d))
            if len(worst) % 2:
                worst = np.append(worst, far)
            worst, size = np.maximum(worst[::2], worst[1::2]), 2 * size
        return found

    def runs(self, w: np.ndarray, longest: int) -> np.ndarray:
        """The runs (start, length, period) of ``w``, ordered by start, then period."""
        rows = [(a, b - a, q) for a, b, q in self.stretches(w, longest) if b - a >= max(MIN_LENGTH, MIN_PERIODS * q)]
        return np.array(sorted(rows), np.int64).reshape(-1, 3)


def sequence_of(words: list[list[bytes]]):
    """(numbers, first number's place per text): equal words have equal numbers, and a number of
    its own stands behind each text."""
    flat = [x for t in words for x in t]
    coded = pa.array(flat, pa.large_binary()).dictionary_encode()
    count = np.array([len(t) for t in words], np.int64)
    begin = np.cumsum(count + 1) - count - 1
    w = np.empty(len(flat) + len(words), np.int64)
    ends = begin + count
    w[ends] = len(coded.dictionary) + np.arange(len(words))
    body = np.ones(len(w), bool)
    body[ends] = False
    w[body] = coded.indices.to_numpy()
    return w, begin


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per row of ``docs`` (doc_id, text).

    ``runs``: structs (start, length, period) in words, by start, then period. ``collapsed``: the
    words joined by one space, without those that a run contains after its first ``period``
    words. A null or empty text, or one without words, has no runs and an empty collapsed text.
    Rows are independent of each other: repeated rows and null ids are returned as they come, an
    empty table gives no rows, other columns are not read. A task holds the words of one text, or
    of about a megabyte of shorter ones.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        finder = RunFinder()
        for batch in batches:
            texts = plain_strings(batch.column("text")).cast(pa.large_binary())
            for i, j in blocks(texts):
                words = [t.as_py().split() for t in texts[i:j]]     # bytes: the six ASCII spaces
                w, begin = sequence_of(words)
                found = finder.runs(w, max(map(len, words)))
                of = np.searchsorted(begin, found[:, 0], side="right") - 1
                keep = np.zeros(len(w) + 1, np.int64)
                np.add.at(keep, found[:, 0] + found[:, 2], 1)
                np.add.at(keep, found[:, 0] + found[:, 1], -1)
                keep = np.cumsum(keep) == 0
                left = []
                for t, b in zip(words, begin.tolist()):
                    k = keep[b:b + len(t)]
                    left.append(b" ".join(t if k.all() else [x for x, y in zip(t, k.tolist()) if y]))
                off = np.searchsorted(of, np.arange(j - i + 1)).astype(np.int32)
                parts = [pa.array(x) for x in (found[:, 0] - begin[of], found[:, 1], found[:, 2])]
                runs = pa.ListArray.from_arrays(pa.array(off), pa.StructArray.from_arrays(parts, ["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[i:j], pa.array([len(t) for t in words], pa.int64()), runs,
                     pa.array(left, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with a period written into about a tenth of the texts, chosen by id.

    With h = crc32(id as text) and g = h / 10, a text of n > 0 words with h mod 10 = 0 has each
    word i >= a replaced by word a + (i - a) mod p, a = g mod n, p = 1 + (n - a) / (3 + g mod 8).
    A row with a null id is left as it is.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", F.expr("crc32(cast(cast(cast(doc_id AS bigint) AS string) AS binary)) div 10").alias("g"),
                       F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("words"))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))) \
        .withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))

    def word(i) -> Column:
        return F.get("words", (F.col("a") + i % F.col("p")).cast("int"))
    tail = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - F.col("a") - 1), word)
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), tail), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def run_digests(runs: DataFrame) -> DataFrame:
    """Digest columns of ``periodic_runs``: n_runs; start, length, period and exponent_milli of the
    run of the greatest length / period (ties: smallest start, then period; nulls without runs);
    runs_sha256 of all runs' lines, collapsed_sha256 of the collapsed text."""
    def order(x, y):
        more, less = x["length"] * y["period"], y["length"] * x["period"]
        return F.when(more > less, -1).when(more < less, 1).when(x["start"] < y["start"], -1) \
            .when(x["start"] > y["start"], 1).otherwise(F.signum(x["period"] - y["period"]).cast("int"))
    best = F.get(F.array_sort("runs", order), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return runs.withColumn("best", best).select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
