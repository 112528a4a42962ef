"""Exact quantiles against numpy, whatever the sketch's accuracy and the partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlytics.operators import missing as M
from adlytics.operators import outliers as O
from adlytics.operators import profile as P
from adlytics.operators.quantiles import exact_quantiles

PROBS = [0.75, 0.0, 0.01, 0.5, 1.0, 0.25, 0.99]


@pytest.mark.parametrize("accuracy", [20, 10000])
def test_matches_numpy(spark, accuracy):
    rng = np.random.default_rng(accuracy)
    groups = {("flag", 0): rng.integers(0, 2, 3000).astype(float), ("wide", 1): rng.normal(0, 1e9, 3000), ("one", 0): np.array([7.0]),
              ("two", None): np.array([1.0, 2.0]), ("tied", 1): np.where(rng.random(2000) < 0.7, 0.0, rng.exponential(size=2000)),
              ("few", 0): rng.normal(size=11), (None, None): np.arange(500.0)}
    rows = [(c, y, float(v)) for (c, y), vs in groups.items() for v in vs] + [("flag", 0, None), ("nulls", 1, None)]
    rng.shuffle(rows := np.array(rows, dtype=object))
    df = spark.createDataFrame([(c, None if y is None else int(y), v) for c, y, v in rows.tolist()], "column string, y int, value double").repartition(5)
    got = exact_quantiles(df, ["column", "y"], PROBS, accuracy)
    assert set(got) == set(groups)
    for g, q in got.items():
        assert q == pytest.approx(np.quantile(groups[g], PROBS).tolist(), rel=1e-12, abs=1e-12), g
    assert exact_quantiles(df.limit(0), ["column"], [0.5]) == {}


def test_equals_percentile(spark):
    df = spark.range(5000).select(F.lit("x").alias("column"), (F.hash("id") / 7.0).alias("value"))
    want = df.agg(F.percentile("value", F.array(*[F.lit(p) for p in PROBS])).alias("q")).first().q
    assert exact_quantiles(df, ["column"], PROBS, 50)[("x",)] == want


def test_columns_of_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, None), (0, 3.0, None), (None, None, None)], "y int, a double, b double")
    assert M.fit_medians(df, ["a", "b"]) == {"a": 2.0, "b": None}
    assert P.quartile_bounds(df, ["a", "b"])["b"] == (None,) * 4 and O.percentile_bounds(df, ["b"]) == {"b": (None, None)}
    d = {r.column: r for r in P.describe(df, ["a", "b"]).collect()}
    assert (d["a"].q50, d["b"].q50, d["b"]["count"]) == (2.0, None, 0)
    assert {(r.y, r.column): r.median for r in P.class_profile(df, ["a", "b"]).collect()}[(None, "a")] is None
