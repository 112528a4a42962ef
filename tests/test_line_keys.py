"""Queries over the lineitem key where order keys pass 2^25, as in copies with shifted keys."""

import pytest
from pyspark.sql import functions as F

from adlytics.catalog import registry
from adlytics.catalog import tables as T

LAST = 359                # the last of 360 copies of sf0.1, whose packed key leaves the signed 64 bits


def lineitem(spark, first_order, part, supp):
    rows = [(first_order + i // 4, part + i * 37 % 900, supp + i * 13 % 100, i % 7 + 1, 10.0 + i, 100.0 + i, 0.05, 0.02,
             "RAN"[i % 3]) for i in range(1200)]
    return spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                       "l_extendedprice double, l_discount double, l_tax double, l_returnflag string")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    sf = str(tmp_path_factory.mktemp("keys"))
    small, large = lineitem(spark, 0, 0, 0), lineitem(spark, 150000 * LAST, 20000 * LAST, 1000 * LAST)
    small.unionByName(large).write.parquet(f"{sf}/lineitem.parquet")
    return sf


def test_ids_stay_apart_and_as_the_sql_where_it_fits(spark, folder):
    li = T.read(spark, folder, "lineitem")
    assert li.select(T.line_id()).distinct().count() == li.distinct().count() == 2400
    small = li.filter("l_orderkey < 1000")
    assert small.filter(T.line_id() == F.expr(T.LINE_ID_SQL)).count() == 1200
    edge = spark.createDataFrame([(2 ** 25 - 1, 2 ** 23, 2 ** 18, 7), (2 ** 25, 0, 0, 0), (None, 1, 1, 1)],
                                 "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int")
    ids = [r[0] for r in edge.select(T.line_id()).collect()]
    exact = [((o * 8 + n) * 2097152 + p) * 16384 + s for o, p, s, n in [(2 ** 25 - 1, 2 ** 23, 2 ** 18, 7), (2 ** 25, 0, 0, 0)]]
    assert [x % 2 ** 64 for x in ids[:2]] == exact and ids[2] is None


QUERIES = {
    "l01_top_n": 5,
    "w04_cumulative_counts": None,
    "e13_evaluate_at_saved_thresholds": 10,
    "j03_missing_thresholds": 5,
    "e21_best_method": 1,
    "l12_cross_variant_weights": 10,
    "a01_group_stats_by_model": 5,
    "e16_best_of_two": 1,
    "a02_pivot_improvement": 5,
    "a05_threshold_histogram": None,
    "b06_prediction_stats": 2,
    "l02_sort_by_absolute": 5,
    "e04_default_vs_optimised": 10,
}


@pytest.mark.parametrize("name", QUERIES)
def test_keys_of_the_last_copy(spark, folder, name):
    queries, _ = registry.load_all()
    rows = queries[name](spark, folder).collect()
    assert rows and QUERIES[name] in (None, len(rows))
