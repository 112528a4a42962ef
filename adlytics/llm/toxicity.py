"""Toxicity by multiple-instance learning (operator 5).

A document is a bag of sentences (cut after . ! ? and line feeds). Each sentence has a logistic
score over hashed features of its words (runs without ASCII spaces, digits and punctuation, ASCII
lower-cased: the whole word and its first 4, 5 and 6 bytes). The document's score is the noisy-or
of its sentences, 1 - prod(1 - p), trained from document labels alone by gradient ascent on the
bag likelihood. The sentence scores then locate the offending sentences.

The model is fitted on a bounded sample of labelled rows (``POSITIVES`` and ``NEGATIVES``, the
rows with the smallest hash of their id; weights restore the true shares).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlytics.llm.common import held_out
from adlytics.llm.textvec import WordHasher, blocks, buffers, plain_strings, word_spans

BITS = 18
POSITIVES, NEGATIVES = 2000, 3000
STEPS, RATE, RIDGE = 120, 0.1, 2e-5
PIECE = 1 << 20          # feature occurrences summed at a time
START = -7.0             # bias of a sentence before training
_U = np.uint64


class Sentences:
    """Sentences of a block of texts and their hashed features."""

    def __init__(self):
        self.hasher = WordHasher()
        self.breaks = np.zeros(256, bool)
        self.breaks[[ord(c) for c in ".!?\n"]] = True
        self.gaps = np.zeros(256, bool)
        for i in range(128):
            self.gaps[i] = not chr(i).isalpha()
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[ord("A"):ord("Z") + 1] += 32

    def __call__(self, a: pa.Array):
        """(feature, sentence of each feature, text of each sentence, start, end of each sentence).

        Sentences without words are left out; spans are byte positions from the text's start.
        """
        d, off = buffers(a)
        z = np.zeros(0, np.int64)
        if not len(d):
            return z, z, z, z, z
        low = self.lower[d]
        s, e, doc = word_spans(low, off, self.gaps)
        if not len(s):
            return z, z, z, z, z
        ends = np.concatenate([[0], np.cumsum(self.breaks[d], dtype=np.int64)])
        key = ends[s]                                    # breaks before the word
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])
        sentence = np.cumsum(new) - 1
        parts, owner = [], []
        for n in (None, 4, 5, 6):
            use = slice(None) if n is None else e - s > n
            stop = e if n is None else s + n
            h = self.hasher(low, s[use], stop[use]) if n is None else self.prefix(low, s[use], stop[use])
            parts.append((h ^ _U(0 if n is None else n * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> _U(64 - BITS))
            owner.append(sentence[use])
        feature, owner = np.concatenate(parts).astype(np.int64), np.concatenate(owner)
        both = np.unique(owner << BITS | feature)        # a feature counts once in a sentence
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(s)) - 1
        text = doc[first]
        return both & ((1 << BITS) - 1), both >> BITS, text, s[first] - off[text], e[last] - off[text]

    def prefix(self, low, s, e):
        """Hashes of spans of equal length that may overlap words of other hash calls."""
        h = np.zeros(len(s), _U)
        for k in range(int(e[0] - s[0]) if len(s) else 0):
            h = h * _U(0x100000001B3) + low[s + k].astype(_U) + _U(1)
        h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
        return h ^ (h >> _U(32))


def noisy_or(z, text, n):
    """(1 - prod(1 - p)) per text from sentence logits, and sum of log(1 - p)."""
    log_not = -np.logaddexp(0, z)
    total = np.bincount(text, weights=log_not, minlength=n)
    return -np.expm1(total), total


class Mil:
    """Weights of the hashed features and the bias."""

    def __init__(self, weights=None, bias=START):
        self.weights = np.zeros(1 << BITS) if weights is None else weights
        self.bias = bias

    def logits(self, feature, sentence, n):
        return self.bias + np.bincount(sentence, weights=self.weights[feature], minlength=n)

    def fit(self, feature, sentence, text, y, cost, steps=STEPS, rate=RATE, ridge=RIDGE):
        """Adam over the features that occur; ``text`` maps sentences to bags, ``cost`` weighs bags."""
        pieces = range(0, len(feature), PIECE)
        seen = np.zeros(1 << BITS, bool)
        for i in pieces:
            seen[feature[i:i + PIECE]] = True
        used = np.flatnonzero(seen)
        place = np.zeros(1 << BITS, np.int32)
        place[used] = np.arange(len(used), dtype=np.int32)
        code = np.empty(len(feature), np.int32)
        for i in pieces:
            code[i:i + PIECE] = place[feature[i:i + PIECE]]
        n_sent, n = len(text), len(y)
        w = np.zeros(len(used) + 1)
        w[-1] = self.bias
        m, v = np.zeros_like(w), np.zeros_like(w)
        cost = cost / cost.sum()

        def summed(values, at, to, size):
            """Sums of values[at] by ``to``, a piece at a time."""
            out = np.zeros(size)
            for i in pieces:
                out += np.bincount(to[i:i + PIECE], weights=values[at[i:i + PIECE]], minlength=size)
            return out

        for step in range(1, steps + 1):
            z = w[-1] + summed(w, code, sentence, n_sent)
            p = 1 / (1 + np.exp(-z))
            bag, _ = noisy_or(z, text, n)
            bag = np.clip(bag, 1e-9, 1)
            pull = np.where(y == 1, -(1 - bag) / bag, 1.0) * cost
            gz = p * pull[text]
            grad = np.append(summed(gz, sentence, code, len(used)) + ridge * w[:-1], gz.sum())
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
            w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        self.weights = np.zeros(1 << BITS)
        self.weights[used], self.bias = w[:-1], float(w[-1])
        return self


def training_rows(docs: DataFrame, labels: DataFrame, target: str) -> tuple[DataFrame, dict]:
    """(doc_id, y, text) of the sample, and the true number of labels of each class."""
    known = labels.filter(F.col(target).isNotNull() & F.col("doc_id").isNotNull()).filter(~held_out()) \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(target).cast("int").alias("y"))
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    pick = known.filter("y = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(POSITIVES) \
        .union(known.filter("y = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(NEGATIVES))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(pick), "doc_id") \
        .dropDuplicates(["doc_id"])
    return rows, counts


def train(docs: DataFrame, labels: DataFrame, target: str = "toxic") -> Mil:
    """Fit on the sample: its features (bounded by the sample) are hashed in tasks and collected.

    Without documents of both labels the model gives 0 to every document.
    """
    rows, counts = training_rows(docs, labels, target)

    def run(batches):
        cut = Sentences()
        for batch in batches:
            texts = plain_strings(batch.column("text"))
            for i, j in blocks(texts):
                feature, sentence, text, _, _ = cut(texts[i:j])
                ends = np.searchsorted(text, np.arange(j - i + 1))          # sentences of each text
                at = np.searchsorted(sentence, ends)
                lists = lambda x, o: pa.ListArray.from_arrays(pa.array(o.astype(np.int32)), pa.array(x.astype(np.int32)))
                own = sentence - np.repeat(ends[:-1], np.diff(at))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[i:j], batch.column("y")[i:j],
                                                  lists(feature, at), lists(own, at), pa.array(np.diff(ends).astype(np.int32))],
                                                 names=["doc_id", "y", "feature", "sentence", "n"])

    got = rows.select("doc_id", "y", "text").mapInArrow(
        run, "doc_id long, y int, feature array<int>, sentence array<int>, n int").orderBy("doc_id").toArrow()
    y = got["y"].to_numpy()
    if len(set(y.tolist())) < 2:
        return Mil(bias=-50.0)
    n = got["n"].to_numpy().astype(np.int64)
    sizes = np.array(got["feature"].combine_chunks().value_lengths())
    feature = got["feature"].combine_chunks().flatten().to_numpy()
    sentence = got["sentence"].combine_chunks().flatten().to_numpy()
    del got
    sentence = sentence + np.repeat((np.cumsum(n) - n).astype(np.int32), sizes)
    cost = np.where(y == 1, counts[1] / max((y == 1).sum(), 1), counts[0] / max((y == 0).sum(), 1))
    return Mil().fit(feature, sentence, np.repeat(np.arange(len(y)), n), y, cost)


SPAN = "array<struct<start:int,end:int,score:double>>"


def scored_batches(model: Mil, batches, text_column: int, cut: float):
    """Per batch: (batch slice, document scores, spans of the sentences scored at least ``cut``)."""
    cutter = Sentences()
    for batch in batches:
        texts = plain_strings(batch.column(text_column))
        for i, j in blocks(texts):
            feature, sentence, text, start, end = cutter(texts[i:j])
            z = model.logits(feature, sentence, len(text))
            score, _ = noisy_or(z, text, j - i)
            p = 1 / (1 + np.exp(-z))
            hit = np.flatnonzero(p >= cut)
            off = np.searchsorted(text[hit], np.arange(j - i + 1)).astype(np.int32)
            spans = pa.ListArray.from_arrays(pa.array(off), pa.StructArray.from_arrays(
                [pa.array(start[hit].astype(np.int32)), pa.array(end[hit].astype(np.int32)), pa.array(p[hit])],
                names=["start", "end", "score"]))
            yield batch.slice(i, j - i), np.clip(score, 0, 1), spans


def score(docs: DataFrame, model: Mil, cut: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted, offending): every whole text (null: empty, score 0).

    ``offending``: byte spans of the UTF-8 text, and scores, of sentences scored at least ``cut``.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches):
        for part, p, spans in scored_batches(model, batches, 1, cut):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p), spans], names=["doc_id", "score", "offending"])

    return rows.mapInArrow(run, f"doc_id long, score double, offending {SPAN}") \
        .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"),
                "offending")


def clean(docs: DataFrame, model: Mil, cut: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text scores under ``cut``; texts are
    scored where they stand, without a shuffle."""
    at = docs.columns.index("text")

    def run(batches):
        for part, p, _ in scored_batches(model, batches, at, cut):
            yield part.filter(pa.array(p < cut))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on ``labels`` (doc_id, toxic) and score all ``docs``; an empty table gives no rows."""
    return score(docs, train(docs, labels))
