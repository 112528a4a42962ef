"""Near-duplicate classes by BagMinHash signatures of 5-word shingle multisets (operator 7).

A text is the multiset of its 5-word shingles (words lower-cased; a text of 1 to 4 words is one
shingle); the weight of a shingle is its count. BagMinHash (Ertl, KDD 2018) gives register i of
the signature the time of the first point, over all shingles, of Poisson processes whose rate is
the weight; two signatures agree in a register with a probability of exactly the weighted
Jaccard similarity.

Weights are discretised to the integer levels 1, 2, 3, ..., held in dyadic blocks (0,1], (1,2],
(2,4], (4,8], ... A shingle of weight w has one process for each block that begins below w, its
rate the block's length times the number of registers; each point picks a register, and then a
level within its block by halving the block once per hash bit (the hierarchical part); points
above w are dropped. Processes of a text are followed only until the next point is later than
the text's latest register, so the work is about one point per distinct shingle and
K log K per text. All texts of a block advance together in numpy.

Candidates share one of the bands of registers; candidates are verified by the exact multiset
overlap of their shingles (see ``linkage``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlytics.llm.documents import THRESHOLD, document_classes
from adlytics.llm.textvec import WordHasher, mix, multisets, text_shingles

BANDS, ROWS = 21, 6      # a pair of similarity 0.8 shares a band with probability 0.998
POINTS = 16              # points per process and pass after the first
_U = np.uint64
_MASK = _U((1 << 44) - 1)


def exponentials(h: np.ndarray) -> np.ndarray:
    return -np.log(((h >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53)


def signatures(elements: np.ndarray, counts: np.ndarray, text: np.ndarray, n: int, registers: int) -> np.ndarray:
    """(n, registers) times of the first points; infinite for texts without elements."""
    n_blocks = np.where(counts > 1, np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1, 1)
    rep = np.repeat(np.arange(len(elements)), n_blocks)
    block = np.arange(len(rep)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    length = np.where(block == 0, 1, 1 << np.maximum(block - 1, 0)).astype(np.int64)
    floor = np.where(block == 0, 0, length)
    seed = mix(mix(elements[rep]) + block.astype(_U) * _U(0x9E3779B97F4A7C15))
    weight, text = counts[rep], text[rep]
    out = np.full(n * registers, np.inf)
    t = np.zeros(len(seed))
    done = 0
    while len(seed):
        m = 1 if done == 0 else POINTS
        draw = mix(seed[:, None] + np.arange(done + 1, done + m + 1, dtype=_U) * _U(0xD1342543DE82EF95))
        times = t[:, None] + np.cumsum(exponentials(draw) / (length * registers)[:, None], axis=1)
        place = mix(draw ^ _U(0x632BE59BD9B4E019))
        register = ((place >> _U(32)) * _U(registers) >> _U(32)).astype(np.int64)
        level = floor[:, None] + 1 + (place & (length - 1).astype(_U)[:, None]).astype(np.int64)
        ok = level <= weight[:, None]
        np.minimum.at(out, ((text * registers)[:, None] + register)[ok], times[ok])
        latest = out.reshape(n, registers).max(axis=1)
        t, done = times[:, -1], done + m
        go = t < latest[text]
        seed, t, length, floor, weight, text = (x[go] for x in (seed, t, length, floor, weight, text))
    return out.reshape(n, registers)


def text_signatures(texts, hasher: WordHasher, registers: int) -> np.ndarray:
    key, counts = multisets(*text_shingles(texts, hasher))
    return signatures(key & _MASK, counts, (key >> _U(44)).astype(np.int64), len(texts), registers)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` registers."""
    bits = np.ascontiguousarray(sig[:, :bands * rows]).view(_U).reshape(len(sig), bands, rows)
    acc = np.zeros((len(sig), bands), _U)
    for r in range(rows):
        acc = mix(acc + bits[:, :, r])
    return acc


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, class_id, n_copies, n_class, id) per row of ``docs`` (doc_id, text); see
    ``document_classes`` for nulls, empty texts and repeated rows."""
    def signer():
        hasher = WordHasher()

        def of(texts):
            sig = text_signatures(texts, hasher, bands * rows)
            return band_keys(sig, bands, rows), np.isfinite(sig[:, 0])
        return of

    return document_classes(docs, signer, threshold, weighted=True)


def one_per_class(docs: DataFrame, **kwargs) -> DataFrame:
    """The rows of ``docs`` with all their columns, one for each class of near copies: the one
    with the class's smallest doc_id (of repeated rows one; null doc_ids count as largest)."""
    classes = near_duplicates(docs, **kwargs)
    own, node, doc = (_unused(name, docs.columns) for name in ("text_id", "node", "doc"))
    best = classes.groupBy("class_id", F.when(F.col("class_id").isNull(), F.col("id")).alias("of")) \
        .agg(F.min(F.when(F.col("doc_id").eqNullSafe(F.col("class_id")), F.col("id"))).alias(node)) \
        .select(F.col("class_id").alias(doc), node)
    body = docs.withColumn(own, F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    kept = body.join(best, F.col(own).eqNullSafe(F.col(node)) & F.col("doc_id").cast("long").eqNullSafe(F.col(doc)), "left_semi")
    return kept.dropDuplicates([own, "doc_id"]).drop(own)


def _unused(name: str, taken: list[str]) -> str:
    """``name`` with as many underscores before it as no column of ``taken`` needs."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name
