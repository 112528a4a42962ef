"""Token counts by an exact length histogram (operator 4).

Documents are reduced to their encoded length, lengths to counts. Everything a context limit asks
for follows from suffix sums over the histogram, whose size is the number of distinct lengths:

    at_least(L)  = documents of at least L tokens            (suffix sum of counts)
    truncated(L) = tokens kept if each document is cut at L  = sum of min(length, L)
                 = tokens of shorter documents + L * at_least(L)
    quantile     = smallest length with a cumulative share of at least p
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adlytics.llm.bpe import Bpe, read_ranks
from adlytics.llm.common import per_worker, saved
from adlytics.llm.textvec import blocks, plain_strings

BLOCK = 8 << 20          # bytes of text encoded at a time
STRIPE = 256


def encoded_lengths(docs: DataFrame, path: str, pattern: str, group: str = "source") -> DataFrame:
    """(group, n_tokens) per document; a null text is empty and has 0 tokens."""
    rows = docs.select(F.col(group).cast("string").alias("grp"), "text")

    def run(batches):
        bpe = per_worker(("bpe", path, pattern), lambda: Bpe(read_ranks(path), pattern))
        for batch in batches:
            texts = plain_strings(batch.column("text"))
            for i, j in blocks(texts, BLOCK):
                yield pa.RecordBatch.from_arrays([batch.column("grp")[i:j], pa.array(bpe.lengths(texts[i:j]))],
                                                 names=["grp", "n_tokens"])

    return rows.mapInArrow(run, "grp string, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(grp, n_tokens, n_docs): partial counts per task, so a hot group adds nothing to shuffle."""
    return lengths.groupBy("grp", "n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def limit_table(histogram: DataFrame) -> DataFrame:
    """One row per distinct length L of a group, as a context limit:

    n_docs of exactly L; docs_at_least; docs_total; tokens_total; tokens_truncated (at L);
    docs_share, the share of documents of at most L (a quantile p is the first L whose share
    reaches p). Sums run in two levels (stripes of 256 lengths, then inside), so no task holds a
    whole group's histogram in order.
    """
    h = histogram.withColumn("stripe", F.floor(F.col("n_tokens") / STRIPE)) \
        .withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    stripes = h.groupBy("grp", "stripe").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    up = Window.partitionBy("grp").orderBy("stripe").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy("grp")
    zero = F.lit(0).cast("long")
    stripes = stripes.select(
        F.col("grp").alias("g"), F.col("stripe").alias("s"),
        F.coalesce(F.sum("d").over(up), zero).alias("d_below"), F.coalesce(F.sum("t").over(up), zero).alias("t_below"),
        F.sum("d").over(everything).alias("docs_total"), F.sum("t").over(everything).alias("tokens_total"))
    h = h.join(stripes, F.col("grp").eqNullSafe(F.col("g")) & (F.col("stripe") == F.col("s")))
    inside = Window.partitionBy("grp", "stripe").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    d_below = F.col("d_below") + F.coalesce(F.sum("n_docs").over(inside), zero)
    t_below = F.col("t_below") + F.coalesce(F.sum("tokens").over(inside), zero)
    h = h.withColumn("docs_below", d_below).withColumn("tokens_below", t_below)
    at_least = F.col("docs_total") - F.col("docs_below")
    return h.select("grp", "n_tokens", "n_docs", at_least.alias("docs_at_least"), "docs_total", "tokens_total",
                    (F.col("tokens_below") + F.col("n_tokens") * at_least).alias("tokens_truncated"),
                    ((F.col("docs_below") + F.col("n_docs")) / F.col("docs_total")).alias("docs_share"))


def answers(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(grp, limit, docs_total, tokens_total, docs_over, tokens_truncated) for the given limits:
    each histogram row answers each limit, sum of min(length, limit)."""
    over = F.col("n_tokens") > F.col("limit")
    asked = histogram.withColumn("limit", F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])))
    return asked.groupBy("grp", "limit").agg(
        F.sum("n_docs").alias("docs_total"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("tokens_total"),
        F.sum(F.when(over, F.col("n_docs")).otherwise(0)).alias("docs_over"),
        F.sum(F.col("n_docs") * F.least("n_tokens", "limit")).alias("tokens_truncated"))


def context_limits(docs: DataFrame, path: str, pattern: str, group: str = "source") -> DataFrame:
    """``limit_table`` of the encoded lengths of ``docs`` per value of ``group`` (null is a group).

    An empty table gives no rows; empty texts count at length 0.
    """
    # stripes and rows both read the histogram: written once, so texts are encoded once
    return limit_table(saved(length_histogram(encoded_lengths(docs, path, pattern, group))))
