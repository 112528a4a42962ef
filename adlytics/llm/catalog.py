"""The queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from adlytics.llm import bagminhash, bpe, fim, flatfile, gbt, lengths, mcd, minhash, pareto, periodic, simhash, toxicity, urls
from adlytics.llm.common import documents, labels

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_multi_50k.tiktoken"


def op1_quality_rules(spark, sf_dir):
    """Base rules and MCD distances of all documents."""
    return mcd.judge(documents(spark, sf_dir))


def op2_minhash_fingerprints(spark, sf_dir):
    """Fingerprints of all documents and of their edited texts, with likenesses."""
    return minhash.fingerprints(documents(spark, sf_dir))


def op3_pareto_mix(spark, sf_dir):
    """Copies of all documents in the mix."""
    return pareto.mix_documents(documents(spark, sf_dir))


def op4_length_histogram(spark, sf_dir):
    """Exact token-length histogram per source, with totals for every length as a limit."""
    return lengths.context_limits(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def op5_mil_toxicity(spark, sf_dir):
    """Toxicity scores and offending sentences of all documents."""
    return toxicity.toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op6_gbt_quality(spark, sf_dir):
    """Quality scores of all documents."""
    return gbt.quality(documents(spark, sf_dir), labels(spark, sf_dir))


def op7_bagminhash_near_dups(spark, sf_dir):
    """Near-duplicate class of each document."""
    return bagminhash.near_duplicates(documents(spark, sf_dir)).drop("id")


def op8_url_filter(spark, sf_dir):
    """Verdicts of all pages' urls."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return urls.judge(pages).withColumn("words", F.array_join("words", " "))


def op9_flat_token_files(spark, sf_dir):
    """Ids of all documents written as flat files and read back."""
    return flatfile.round_trip(documents(spark, sf_dir), public_tokenizers.path(WORD_BPE))


def op10_byte_bpe(spark, sf_dir):
    """Ids of all documents, and the bytes decoded from them, as digests."""
    return bpe.digests(documents(spark, sf_dir), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def op11_simhash_trie_join(spark, sf_dir):
    """SimHash fingerprint and component of each document."""
    return simhash.near_duplicates(documents(spark, sf_dir))


def op12_periodic_runs(spark, sf_dir):
    """Periodic runs of all documents, a tenth of them with a period written in."""
    return periodic.run_digests(periodic.periodic_runs(periodic.planted(documents(spark, sf_dir))))


def op13_fim_frames(spark, sf_dir):
    """Fill-in-the-middle of all documents from compressed frames."""
    return fim.round_trip(spark, documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_minhash_fingerprints, op3_pareto_mix, op4_length_histogram, op5_mil_toxicity,
    op6_gbt_quality, op7_bagminhash_near_dups, op8_url_filter, op9_flat_token_files, op10_byte_bpe,
    op11_simhash_trie_join, op12_periodic_runs, op13_fim_frames)}

ORACLES = {
    "op13_fim_frames": fim.FIM_SQL,
    "op3_pareto_mix": pareto.MIX_SQL.format(docs="documents")
    + "SELECT doc_id, size, source, source_size, target, copies, copies * size AS taken FROM mixed",
}
