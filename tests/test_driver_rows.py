"""What the evaluation queries bring to the driver for broadcasts: a row per group and grid point at most, never the score rows."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from adlytics.catalog import q_metrics, tables as T
from adlytics.operators import metrics as E
from adlytics.session import cut_lineage

MOST = len(T.SCORE_MODELS) * 100          # groups x grid points, with the one below the grid


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """3,000 lines: 30,000 score rows of ten groups, about 6,000 in each of the splits val and test."""
    at = tmp_path_factory.mktemp("lines")
    spark.range(3000).select(F.col("id").alias("l_orderkey"), (F.col("id") % 50).alias("l_partkey"), (F.col("id") % 7).alias("l_suppkey"),
                            F.lit(1).alias("l_linenumber"), F.when(F.col("id") % 3 == 0, "R").otherwise("N").alias("l_returnflag")) \
        .write.parquet(f"{at}/lineitem.parquet")
    return str(at)


def broadcast_rows(node):
    """Rows of every broadcast in a plan that has run."""
    kind = node.getClass().getSimpleName()
    if kind == "BroadcastExchangeExec":
        yield node.metrics().apply("numOutputRows").value()
    children = [node.children().apply(i) for i in range(node.children().size())]
    for c in [node.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [node.plan()] if kind.endswith("QueryStageExec") else children:
        yield from broadcast_rows(c)


@pytest.mark.parametrize("name", [
    "a02_pivot_improvement",
    "a04_default_vs_optimised_by_dataset",
    "e04_default_vs_optimised",
    "e07_tune_val_report_test",
    "e14_val_test_gap",
    "e15_champion",
    "e19_optimisation_analysis",
    "e21_best_method",
    "j02_lookup_with_default",
    "l01_top_n",
    "l02_sort_by_absolute",
    "q01_quick_stats",
    "w02_argmax_by",
])
def test_broadcasts_hold_no_score_rows(spark, folder, monkeypatch, name):
    ran = []
    for m in (E, q_metrics):
        monkeypatch.setattr(m, "cut_lineage", lambda df: (ran.append(df), cut_lineage(df))[1])
    found = queries()[name](spark, folder)
    assert found.collect()
    rows = [n for df in [*ran, found] for n in broadcast_rows(df._jdf.queryExecution().executedPlan())]
    assert rows and max(rows) <= MOST
