"""Helpers shared by the text operators: tables, reliable lineage cuts, ordered buckets."""

from __future__ import annotations

import sys
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlytics.session import checkpoint_dir

# Fixed value: the characters that make a word, for Java and RE2 regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` once, as a reliable checkpoint in the shared folder, and go on from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir for files that tasks write themselves."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def sized_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` hinted for broadcast if it has at most ``max_rows`` rows (of numbers and short
    strings), else as it is, for a shuffle join. ``df`` should be a saved table."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ordered_bucket(df: DataFrame, key: str, n: int) -> Column:
    """A bucket number 0..n-1 ascending with the long column ``key`` (nulls in bucket 0).

    The n-1 bounds are approximate quantiles of the key column alone (a narrow scan), so the
    only state on the driver is one number per bucket; rows of one key share a bucket.
    """
    bounds = df.approxQuantile(key, [i / n for i in range(1, n)], 0.25 / n) if n > 1 else []
    bounds = sorted({int(b) for b in bounds})
    if not bounds:
        return F.lit(0)
    arr = F.array(*[F.lit(b) for b in bounds])
    return F.when(F.col(key).isNull(), F.lit(0)).otherwise(
        F.aggregate(arr, F.lit(0), lambda acc, b: acc + (F.col(key) >= b).cast("int")))


def held_out(doc_id="doc_id") -> Column:
    """Rows whose labels are never learnt: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def per_worker(key, make):
    """An object kept by the Python worker from task to task (functions are shipped by value,
    so their modules' globals are new in each task). ``key`` must tell all that it depends on."""
    kept = sys.__dict__.setdefault("_adlytics_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]
