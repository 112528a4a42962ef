"""Quality classifier (operator 6): histogram gradient-boosted trees over document statistics.

Statistics of whole texts are computed in tasks. Trees are fitted on a bounded sample of labelled
rows (``SAMPLE`` rows, the ones with the smallest hash of their id): features are cut into at most
``BINS`` quantile bins, each node's gradient and curvature histograms give its best split. The
fitted trees are flat arrays (feature, threshold, child, value) that tasks traverse for all
documents of a block at once, a level per step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlytics.llm.common import held_out
from adlytics.llm.stats import DocStats
from adlytics.llm.textvec import blocks, plain_strings

SAMPLE = 20_000
BINS = 64
TREES, DEPTH, RATE = 120, 4, 0.1
MIN_CHILD, RIDGE = 1.0, 1.0


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """(texts, features) from counts; 0 where a share is undefined."""
    def share(a, b):
        return np.divide(s[a], s[b], out=np.zeros(len(s[a])), where=s[b] > 0)
    return np.column_stack([
        np.log1p(s["n_words"]), share("word_chars", "n_words"), share("n_symbols", "word_chars"),
        share("n_repeat_words", "n_words"), share("n_dup_lines", "n_lines"), share("n_upper", "n_chars"),
        share("n_digits", "n_chars"), share("n_punct", "n_words"), share("n_bang", "n_words"),
        share("n_nonascii", "n_chars"), share("n_types", "n_words"), share("n_long_words", "n_words"),
        share("n_short_words", "n_words"), share("n_lines", "n_words")])


class Trees:
    """Boosted trees for a 0/1 label, as flat arrays."""

    def __init__(self, base=0.0):
        self.base = base
        self.feature, self.threshold, self.child, self.value, self.roots = [], [], [], [], []
        self.depth = 0

    def fit(self, x, y, trees=TREES, depth=DEPTH, rate=RATE, bins=BINS):
        self.depth = depth
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        code = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])   # x <= edge: at or below it
        p0 = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        self.base = float(np.log(p0 / (1 - p0)))
        raw = np.full(len(y), self.base)
        flat = code + np.arange(x.shape[1]) * bins
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            self.grow(flat, code, edges, p - y, p * (1 - p), raw, depth, rate, bins)
        return self.pack()

    def node(self):
        for a, v in ((self.feature, -1), (self.threshold, 0.0), (self.child, -1), (self.value, 0.0)):
            a.append(v)
        return len(self.feature) - 1

    def grow(self, flat, code, edges, g, h, raw, depth, rate, bins):
        root = self.node()
        self.roots.append(root)
        d = code.shape[1]
        todo = [(root, np.arange(len(g)), depth)]
        while todo:
            node, rows, left = todo.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            self.value[node] = -rate * gs / (hs + RIDGE)
            best = None
            if left:
                at = flat[rows].ravel()
                gh = [np.bincount(at, weights=np.repeat(v[rows], d), minlength=d * bins).reshape(d, bins).cumsum(axis=1)
                      for v in (g, h)]
                gl, hl = gh
                gain = gl ** 2 / (hl + RIDGE) + (gs - gl) ** 2 / (hs - hl + RIDGE) - gs ** 2 / (hs + RIDGE)
                gain[(hl < MIN_CHILD) | (hs - hl < MIN_CHILD)] = -1
                f, b = np.unravel_index(np.argmax(gain), gain.shape)
                if gain[f, b] > 1e-6 and b < len(edges[f]):
                    best = f, b
            if best is None:
                raw[rows] += self.value[node]
                continue
            f, b = best
            self.feature[node], self.threshold[node] = int(f), float(edges[f][b])
            low = code[rows, f] <= b
            self.child[node] = self.node()
            self.node()
            todo += [(self.child[node], rows[low], left - 1), (self.child[node] + 1, rows[~low], left - 1)]

    def pack(self):
        self.feature, self.child, self.roots = (np.array(a, np.int32) for a in (self.feature, self.child, self.roots))
        self.threshold, self.value = np.array(self.threshold), np.array(self.value)
        return self

    def predict(self, x):
        """Probability of label 1: all rows walk down all trees together."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                down = self.child[at] + (x[rows, np.maximum(f, 0)] > self.threshold[at])
                at = np.where(inner, down, at)
            out += self.value[at]
        return 1 / (1 + np.exp(-out))


def training_ids(labels: DataFrame, target: str, limit: int) -> DataFrame:
    """(doc_id, y) of at most ``limit`` labelled rows that are not held out, by hash order."""
    known = labels.filter(F.col(target).isNotNull() & F.col("doc_id").isNotNull()).filter(~held_out()) \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(target).cast("int").alias("y"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def feature_table(docs: DataFrame) -> DataFrame:
    def run(batches):
        stats = DocStats()
        for batch in batches:
            texts = plain_strings(batch.column("text"))
            for i, j in blocks(texts):
                x = features(stats(texts[i:j]))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column("y")[i:j], lists], names=["y", "x"])
    return docs.mapInArrow(run, "y int, x array<double>")


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", limit: int = SAMPLE) -> Trees:
    """Fit on the labelled sample (at most ``limit`` ids, so the broadcast and the collected
    feature rows are bounded); without labels the trees give 0.5."""
    ids = F.broadcast(training_ids(labels, target, limit))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id") \
        .dropDuplicates(["doc_id"]).orderBy("doc_id").select("y", "text")
    got = feature_table(rows).toPandas()
    if got.empty:
        return Trees().pack()
    return Trees().fit(np.array(got["x"].tolist()), got["y"].to_numpy(float))


def score(docs: DataFrame, trees: Trees, cut: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text (null: empty)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches):
        stats = DocStats()
        for batch in batches:
            texts = plain_strings(batch.column("text"))
            for i, j in blocks(texts):
                p = trees.predict(features(stats(texts[i:j])))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[i:j], pa.array(p)], names=["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id long, score double") \
        .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on ``labels`` (doc_id, quality) and score all ``docs``; an empty table gives no rows."""
    return score(docs, train(docs, labels))
