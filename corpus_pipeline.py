"""Documents to token ids in five stages; each works on all that the one before kept.

Every stage function takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's result as Parquet below spark.checkpoint.dir and reads it again as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from adlytics.llm import bagminhash, bpe, mcd, pareto, toxicity
from adlytics.llm.catalog import BYTE_BPE
from adlytics.llm.common import documents, labels, shared_folder


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose noisy-or score of their sentences is 0.5 or more."""
    return toxicity.clean(docs, toxicity.train(docs, labels(spark, sf_dir)))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents by the base rules and by MCD distance."""
    return mcd.kept_rows(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies."""
    return bagminhash.one_per_class(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents to the sources' targets."""
    return pareto.mixed_rows(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the bytes decoded from them."""
    return bpe.digests(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", encoding_stage),
]

# Trained scores, robust estimates and near copies are beyond SQL; tests/llm has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    folder = shared_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
