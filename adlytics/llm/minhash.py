"""MinHash document fingerprints (operator 2).

Each of K universal hash permutations h(x) = (a*x + b mod 2^64) >> 32, with a odd, is applied
to the 64-bit hashes of a text's 5-word shingles (words lower-cased; a text of 1 to 4 words is
one shingle); the minimum of each is kept, cut to 16 bits. The fingerprint is the lower-case hex
of the K values; the likeness of two fingerprints is the share of equal values, an unbiased
estimate of the Jaccard similarity (up to 2^-16). Texts without words have the fingerprint of
all ones. Bands of values are joined in Spark and candidate pairs verified by their exact
Jaccard similarity (``near_duplicates``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adlytics.llm.common import ordered_bucket, shuffle_partitions
from adlytics.llm.documents import THRESHOLD, document_classes
from adlytics.llm.textvec import WordHasher, blocks, mix, plain_strings, text_shingles

BANDS, ROWS = 21, 6      # a pair of similarity 0.8 shares a band with probability 0.998
BUCKETS_PER_PARTITION = 4
_U = np.uint64


class MinHasher:
    def __init__(self, k: int = BANDS * ROWS, seed: int = 1):
        draw = mix(np.arange(1, 2 * k + 1, dtype=_U) + _U(seed << 32))
        self.a, self.b, self.k = draw[:k] | _U(1), draw[k:], k
        self.hasher = WordHasher()

    def __call__(self, texts: pa.Array) -> np.ndarray:
        """(texts, k) 16-bit signatures, a few megabytes of text at a time."""
        out = np.full((len(texts), self.k), 0xFFFF, np.uint16)
        for i, j in blocks(texts):
            h, doc = text_shingles(texts[i:j], self.hasher)
            if not len(h):
                continue
            starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            rows = i + doc[starts]
            for p in range(self.k):
                low = np.minimum.reduceat((h * self.a[p] + self.b[p]) >> _U(32), starts)
                out[rows, p] = (low & _U(0xFFFF)).astype(np.uint16)
        return out


def hex_rows(sig: np.ndarray) -> pa.Array:
    raw = sig.astype(">u2").tobytes().hex()
    step = sig.shape[1] * 4
    return pa.array([raw[i:i + step] for i in range(0, len(raw), step)], pa.string())


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The next document is the one after in descending doc_id order (equal ids by descending text
    hash, null ids last), and the first for the last; the edited text is the text with its last
    n_chars/3 (floored) code points replaced by as many first ones of the next document.

    Whole texts move once: rows go to buckets of doc_id ranges, and the first row of each bucket
    is also sent to the bucket before, as the next of its last row.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    parts = shuffle_partitions(spark)
    rows = rows.withColumn("bucket", ordered_bucket(rows.select("doc_id"), "doc_id", parts * BUCKETS_PER_PARTITION)) \
        .withColumn("h", F.xxhash64("text"))
    # One row per bucket: few, whatever the input.
    heads = rows.groupBy("bucket").agg(F.max(F.struct("doc_id", "h")).alias("m"))
    order = Window.orderBy("bucket")
    heads = heads.select(F.col("bucket").alias("hb"), F.col("m.doc_id").alias("hid"), F.col("m.h").alias("hh"),
                         F.coalesce(F.lead("bucket").over(order), F.min("bucket").over(
                             order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("to"))
    rows = rows.join(F.broadcast(heads), (F.col("bucket") == F.col("hb")) & F.col("doc_id").eqNullSafe(F.col("hid"))
                     & (F.col("h") == F.col("hh")), "left")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("to").alias("bucket"), F.lit(True).alias("guest"))
    rows = rows.withColumn("at", F.explode(F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, guest)))) \
        .select("at.bucket", "at.guest", "doc_id", "h", "text") \
        .repartition(parts, "bucket") \
        .sortWithinPartitions("bucket", "guest", F.col("doc_id").desc_nulls_last(), F.col("h").desc())

    def pairs(batches):
        minhash = MinHasher()
        last = None                                     # the row that still waits for its next
        for batch in batches:
            texts = plain_strings(batch.column("text"))
            for i, j in blocks(texts, 4 << 20):
                part = texts[i:j]
                sig = minhash(part)
                text = part.to_pylist()
                bucket = batch.column("bucket")[i:j].to_pylist()
                is_guest = batch.column("guest")[i:j].to_pylist()
                ids = batch.column("doc_id")[i:j].to_pylist()
                if last is not None:
                    sig = np.concatenate([last[0], sig])
                    text, bucket, is_guest, ids = ([x] + y for x, y in zip(last[1], (text, bucket, is_guest, ids)))
                own = [x for x in range(len(text) - 1) if not is_guest[x]]
                last = sig[-1:], (text[-1], bucket[-1], is_guest[-1], ids[-1])
                if not own:
                    continue
                edited = [text[x][:len(text[x]) - len(text[x]) // 3] + text[x + 1][:len(text[x]) // 3] for x in own]
                esig = minhash(pa.array(edited, pa.large_string()))
                at = np.array(own)
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[x] for x in own], pa.int64()),
                    pa.array([len(text[x]) for x in own], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
                    hex_rows(sig[at]), hex_rows(esig),
                    pa.array((sig[at] == esig).mean(axis=1)), pa.array((sig[at] == sig[at + 1]).mean(axis=1)),
                ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                          "near_edited", "near_next"])

    return rows.mapInArrow(pairs, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                  "edited_fingerprint string, near_edited double, near_next double")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, n_copies, n_class, id): bands of the signatures joined, Jaccard verified."""
    def signer():
        minhash = MinHasher()

        def of(texts):
            sig = minhash(texts)
            bits = sig[:, :BANDS * ROWS].astype(_U).reshape(len(sig), BANDS, ROWS)
            acc = np.zeros((len(sig), BANDS), _U)
            for r in range(ROWS):
                acc = mix(acc + bits[:, :, r])
            return acc, ~(sig == 0xFFFF).all(axis=1)
        return of

    return document_classes(docs, signer, threshold, weighted=False)
