"""Quality rules with robust multivariate outliers (operator 1).

Base rules reject texts of under 50 words, or with over half of their words in repeated 3-word
windows. For the others, a vector of transformed statistics is compared with the minimum
covariance determinant (MCD) estimate of its language and source: the mean and covariance of the
half of the documents with the smallest determinant, found by concentration steps, then
reweighted. A document is rejected if its squared Mahalanobis distance is beyond a chi-square
quantile.

Estimates use all documents that pass the base rules: vectors are first summed into the cells of
a fixed grid (count, sums and cross sums, so moments stay exact), per language and source. A
group then has at most as many rows as the grid has cells, whatever its documents; concentration
steps order cells by their means. A group of under ``MIN_GROUP`` documents takes the estimate of
its language, and that, if small too, the one of all documents.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from adlytics.llm.common import saved, sized_broadcast
from adlytics.llm.stats import DocStats
from adlytics.llm.textvec import blocks, plain_strings

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MIN_WORDS = 50
# The transformed statistics: name, smallest spread that counts, grid step. The grid has no bounds: only
# word_length is open above, and its log adds seven cells where words are twice as long.
VECTOR = [
    ("word_length", 0.05, 0.1),      # log of code points per word
    ("symbols", 0.2, 0.25),          # log1p of symbols per 100 code points of words
    ("repeats", 0.1, 0.1),           # share of words in repeated windows
    ("dup_lines", 0.1, 0.1),         # share of lines equal to an earlier one
    ("capitals", 0.3, 0.25),         # log1p of ASCII capitals per 100 code points of words
]
DIM = len(VECTOR)
KEEP = 0.5               # share of a group's documents that the MCD subset holds
MIN_GROUP = 50
TAIL = 1e-8              # chance of rejection of a document of a normal group
STARTS = 6
MAX_BROADCAST_GROUPS = 50_000      # beyond, estimates are joined by shuffle


def statistics(docs: DataFrame, carry: str | None = None) -> DataFrame:
    """(doc_id, lang, source, counts) of each whole text, and the column ``carry`` as it is; a
    null text is empty."""
    names = BASE + ["n_lines", "n_upper"]
    extra = ("lang", "source") + ((carry,) if carry else ())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), *([carry] if carry else []), "text")
    schema = StructType([f for f in rows.schema.fields if f.name != "text"]
                        + [StructField(c, LongType()) for c in names])

    def run(batches):
        stats = DocStats()
        for batch in batches:
            texts = plain_strings(batch.column("text"))
            for i, j in blocks(texts):
                got = stats(texts[i:j])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c)[i:j] for c in ("doc_id", *extra)] + [pa.array(got[c]) for c in names],
                    names=["doc_id", *extra, *names])

    return rows.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def vector() -> list[Column]:
    """The transformed statistics, as columns over the counts (0 where undefined)."""
    def share(a, b):
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return [F.log(F.greatest(share("word_chars", "n_words"), F.lit(1.0))), F.log1p(100 * share("n_symbols", "word_chars")),
            share("n_repeat_words", "n_words"), share("n_dup_lines", "n_lines"), F.log1p(100 * share("n_upper", "word_chars"))]


def chi2_cdf(x: float, k: int) -> float:
    """Regularised lower incomplete gamma at (k/2, x/2), by its series."""
    a, z = k / 2, x / 2
    if z <= 0:
        return 0.0
    term = total = 1 / a
    n = 0
    while term > total * 1e-16:
        n += 1
        term *= z / (a + n)
        total += term
    return min(1.0, total * math.exp(-z + a * math.log(z) - math.lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < p else (lo, mid)
    return (lo + hi) / 2


def consistency(share: float, k: int) -> float:
    """Factor that makes the covariance of the central ``share`` of a normal group unbiased."""
    return share / chi2_cdf(chi2_quantile(share, k), k + 2)


class Mcd:
    """MCD of weighted cells: n (cells), s1 (cells, d) sums, s2 (cells, d, d) cross sums."""

    def __init__(self, n, s1, s2, floors):
        self.n, self.s1, self.s2 = n, s1, s2
        self.mean = s1 / n[:, None]
        self.ridge = np.diag(np.square(floors))
        self.floors = np.asarray(floors)

    def moments(self, weight):
        """Mean and covariance of the cells, each taken with a share of its documents."""
        total = (self.n * weight).sum()
        mu = (self.s1 * weight[:, None]).sum(axis=0) / total
        cov = (self.s2 * weight[:, None, None]).sum(axis=0) / total - np.outer(mu, mu)
        return mu, (cov + cov.T) / 2

    def distances(self, mu, cov):
        diff = self.mean - mu
        return np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff)

    def central(self, d2, size):
        """Shares of the cells that make up the ``size`` documents of the smallest distance."""
        order = np.argsort(d2, kind="stable")
        before = np.cumsum(self.n[order]) - self.n[order]
        weight = np.zeros(len(self.n))
        weight[order] = np.clip((size - before) / self.n[order], 0, 1)
        return weight

    def concentrate(self, weight, size, factor):
        last = math.inf
        for _ in range(100):
            mu, cov = self.moments(weight)
            cov = factor * cov + self.ridge
            det = np.linalg.slogdet(cov)[1]
            if det >= last - 1e-10:
                break
            last = det
            weight = self.central(self.distances(mu, cov), size)
        return last, mu, cov

    def fit(self, keep=KEEP, starts=STARTS):
        """(mean, covariance): best of several starts, then one reweighting step."""
        size = max(keep * self.n.sum(), 1.0)
        factor = consistency(keep, len(self.floors))
        order = np.argsort(self.mean, axis=0, kind="stable")
        centre = np.array([self.mean[o[np.searchsorted(np.cumsum(self.n[o]), self.n.sum() / 2)], k]
                           for k, o in enumerate(order.T)])
        first = [((self.mean - centre) / self.floors) ** 2]
        rng = np.random.default_rng(0)
        for _ in range(starts - 1):
            pick = rng.choice(len(self.n), p=self.n / self.n.sum())
            first.append(((self.mean - self.mean[pick]) / self.floors) ** 2)
        runs = [self.concentrate(self.central(x.sum(axis=1), size), size, factor) for x in first]
        _, mu, cov = min(runs, key=lambda r: r[0])
        inside = (self.distances(mu, cov) <= chi2_quantile(0.975, len(self.floors))).astype(float)
        if (inside * self.n).sum() >= size:
            mu, cov = self.moments(inside)
            cov = consistency(0.975, len(self.floors)) * cov + self.ridge
        return mu, cov


def estimates(vectors: DataFrame) -> DataFrame:
    """(level, lang, source, n, mean, inverse): level 0 per (lang, source), 1 per lang, 2 all."""
    names, floors = [v[0] for v in VECTOR], [v[1] for v in VECTOR]
    cell = F.concat_ws(",", *[F.round(F.col(n) / step).cast("int").cast("string") for n, _, step in VECTOR])
    pairs = [(i, j) for i in range(DIM) for j in range(i, DIM)]
    sums = [F.count(F.lit(1)).alias("n")] + [F.sum(n).alias(f"a{i}") for i, n in enumerate(names)] \
        + [F.sum(F.col(names[i]) * F.col(names[j])).alias(f"b{i}_{j}") for i, j in pairs]
    cells = saved(vectors.withColumn("cell", cell).groupBy("lang", "source", "cell").agg(*sums))
    again = [F.sum(c).alias(c) for c in cells.columns[3:]]
    none = F.lit(None).cast("string")
    every = cells.select(F.lit(0).alias("level"), "*") \
        .unionByName(cells.groupBy("lang", "cell").agg(*again).select(F.lit(1).alias("level"), none.alias("source"), "*")) \
        .unionByName(cells.groupBy("cell").agg(*again).select(F.lit(2).alias("level"), none.alias("lang"),
                                                             none.alias("source"), "*"))

    def fit(key, pdf):
        n = pdf["n"].to_numpy(float)
        s1 = pdf[[f"a{i}" for i in range(DIM)]].to_numpy(float)
        s2 = np.zeros((len(pdf), DIM, DIM))
        for i, j in pairs:
            s2[:, i, j] = s2[:, j, i] = pdf[f"b{i}_{j}"].to_numpy(float)
        order = np.argsort(pdf["cell"].to_numpy(), kind="stable")
        mu, cov = Mcd(n[order], s1[order], s2[order], floors).fit()
        return pd.DataFrame({"level": [key[0]], "lang": [key[1]], "source": [key[2]], "n": [int(n.sum())],
                             "mean": [mu.tolist()], "inverse": [np.linalg.inv(cov).ravel().tolist()]})

    return every.groupBy("level", "lang", "source").applyInPandas(
        fit, "level int, lang string, source string, n long, mean array<double>, inverse array<double>")


def verdicts(rows: DataFrame, fitted: DataFrame, tail: float = TAIL) -> DataFrame:
    """``rows`` (lang, source, base_failed, vector) with ``distance`` and ``kept``."""
    names = [v[0] for v in VECTOR]

    def level(k, *keys):
        e = fitted.filter((F.col("level") == k) & (F.col("n") >= MIN_GROUP))
        e = e.select(*[F.col(c).alias(f"_{c}_{k}") for c in keys], F.struct("mean", "inverse").alias(f"_e{k}"))
        return sized_broadcast(e, MAX_BROADCAST_GROUPS)

    joined = rows.join(level(0, "lang", "source"), F.col("lang").eqNullSafe(F.col("_lang_0"))
                       & F.col("source").eqNullSafe(F.col("_source_0")), "left") \
        .join(level(1, "lang"), F.col("lang").eqNullSafe(F.col("_lang_1")), "left")
    overall = fitted.filter("level = 2").select("mean", "inverse").collect()   # one row
    top = F.struct(F.array(*map(F.lit, overall[0].mean)).alias("mean"), F.array(*map(F.lit, overall[0].inverse)).alias("inverse")) \
        if overall else F.lit(None).cast("struct<mean:array<double>,inverse:array<double>>")
    e = joined.withColumn("_e", F.coalesce("_e0", "_e1", top))
    diff = [F.col(n) - F.col("_e.mean")[i] for i, n in enumerate(names)]
    d2 = F.lit(0.0)
    for i in range(DIM):
        for j in range(i, DIM):
            d2 = d2 + F.col("_e.inverse")[i * DIM + j] * diff[i] * diff[j] * (1 if i == j else 2)
    cutoff = chi2_quantile(1 - tail, DIM)
    return e.withColumn("distance", F.when(~F.col("base_failed"), d2)) \
        .withColumn("kept", F.coalesce(~F.col("base_failed") & (F.col("distance") <= cutoff), F.lit(False))) \
        .drop("_e", "_e0", "_e1", "_lang_0", "_source_0", "_lang_1")


def measured(docs: DataFrame) -> DataFrame:
    return statistics(docs).withColumn("base_failed", base_failed()) \
        .select("*", *[v.alias(n[0]) for v, n in zip(vector(), VECTOR)])


def judge(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance,
    kept), one row per row of ``docs`` (doc_id, text, lang, source).

    Null lang or source are groups of their own; empty and null texts fail the base rules (their
    distance is null); an empty table gives no rows.
    """
    rows = saved(measured(docs))
    fitted = saved(estimates(rows.filter("NOT base_failed")))
    return verdicts(rows, fitted, tail).select("doc_id", *BASE, "base_failed", "distance", "kept")


def kept_rows(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns: estimates are fitted
    first, then each row is measured and judged where it stands, so texts are not shuffled."""
    fitted = saved(estimates(saved(measured(docs)).filter("NOT base_failed")))
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.lit(None).cast("long").alias("doc_id"),
                         "text", "lang", "source")
    rows = statistics(packed, carry="row").withColumn("base_failed", base_failed()) \
        .select("row", "lang", "source", "base_failed", *[v.alias(n[0]) for v, n in zip(vector(), VECTOR)])
    return verdicts(rows, fitted, tail).filter("kept").select("row.*")
