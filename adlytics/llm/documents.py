"""Classes of near copies over a documents table: exact fold, bands, verified links, class ids."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlytics.llm.common import saved
from adlytics.llm.linkage import near_classes
from adlytics.llm.textvec import blocks, plain_strings

THRESHOLD = 0.8


def band_table(docs: DataFrame, signer) -> DataFrame:
    """(doc_id, id, bands): ``id`` is the md5 of the whole text (null: empty text), ``bands``
    what ``signer()`` returns for a block of texts (one row of band keys per text, and a mask
    of the texts that have any)."""
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")) \
        .select("doc_id", F.md5(F.col("text").cast("binary")).alias("id"), "text")

    def sign(batches):
        bands_of = signer()
        for batch in batches:
            texts = plain_strings(batch.column("text"))
            for i, j in blocks(texts):
                bands, has = bands_of(texts[i:j])
                flat = pa.array(bands[has].reshape(-1).view("int64"))
                off = pa.array((has.cumsum() * bands.shape[1]).astype("int32"))
                off = pa.concat_arrays([pa.array([0], pa.int32()), off])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[i:j], batch.column("id")[i:j], pa.ListArray.from_arrays(off, flat)],
                    names=["doc_id", "id", "bands"])

    return rows.mapInArrow(sign, "doc_id long, id string, bands array<long>")


def document_classes(docs: DataFrame, signer, threshold: float = THRESHOLD, weighted: bool = True) -> DataFrame:
    """(doc_id, class_id, n_copies, n_class): one row per document row.

    ``class_id`` is the smallest doc_id of the texts linked, directly or through others, by a
    similarity of at least ``threshold``; ``n_copies`` counts the rows with exactly this text,
    ``n_class`` the rows of the class. Texts without words have no shingles: they are only
    linked to exact copies. Rows with a null doc_id take part; a class of such rows alone has a
    null class_id.
    """
    signed = saved(band_table(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), signer))
    nodes = saved(signed.groupBy("id").agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"),
                                           F.count(F.lit(1)).alias("n_copies")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")) \
        .withColumn("id", F.md5(F.col("text").cast("binary")))
    first = nodes.select(F.col("id").alias("node"), "first_id")

    def one_text(wanted: DataFrame) -> DataFrame:
        """(id, text) of the wanted nodes, from the rows that carry each node's first doc_id."""
        w = wanted.join(first, F.col("id") == F.col("node")).select("node", "first_id")
        return texts.join(w, (F.col("id") == F.col("node")) & F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi") \
            .select("id", "text")

    near = near_classes(nodes.filter(F.size("bands") > 0).select("id", "bands"), one_text, threshold, weighted)
    own = nodes.join(near, "id", "left").select("id", "first_id", "n_copies", F.coalesce("label", "id").alias("label"))
    ids = own.groupBy("label").agg(F.min("first_id").alias("class_id"), F.sum("n_copies").alias("n_class"))
    classes = own.join(ids, "label").select("id", "class_id", "n_copies", "n_class")
    return signed.select("doc_id", "id").join(classes, "id").select("doc_id", "class_id", "n_copies", "n_class", "id")
