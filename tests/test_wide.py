"""Whole-table reports at the width of the reference data (1,555 flags)."""

import numpy as np
import pytest

from adlytics.operators import corr as C
from adlytics.operators import missing as M
from adlytics.operators import profile as P
from adlytics.plans import scoring as B

WIDTH, ROWS = 1555, 200


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """(table, flags with NaN for NULL, target) with about 2 % NULLs in every third column."""
    rng = np.random.default_rng(8)
    x = (rng.random((ROWS, WIDTH)) < rng.random(WIDTH) * 0.2).astype(float)
    x[:, ::3][rng.random((ROWS, len(range(0, WIDTH, 3)))) < 0.02] = np.nan
    y = (np.arange(ROWS) % 5 == 0).astype(int)
    rows = [(i, int(y[i]), [None if np.isnan(v) else int(v) for v in x[i]]) for i in range(ROWS)]
    arr = spark.createDataFrame(rows, "id long, y int, a array<int>")
    path = str(tmp_path_factory.mktemp("wide") / "t")
    arr.selectExpr("id", "y", *[f"a[{j}] AS X{j}" for j in range(WIDTH)]).write.parquet(path)
    return spark.read.parquet(path), x, y


def flags(df):
    return [c for c in df.columns if c.startswith("X")]


def test_totals(wide):
    df, x, y = wide
    nulls = int(np.isnan(x).sum())
    assert tuple(P.total_nulls(df).first()) == (ROWS, nulls)
    s = P.sparsity(df, flags(df)).first()
    assert s["n_ones"] == int(np.nansum(x)) and s["n_cells"] == ROWS * WIDTH
    assert P.compare_frames(df, df.limit(0)).first()["nulls_a"] == nulls
    one = P.summary_statistics(df, "y").first()
    assert one["mean_null_pct"] == pytest.approx(100 * nulls / (ROWS * len(df.columns)), abs=1e-6)
    d = P.summarize_dataset(df).first()
    means = [np.arange(ROWS).mean(), y.mean(), *np.nanmean(x, axis=0)]
    assert d["n_nulls"] == nulls and d["mean_of_means"] == pytest.approx(np.mean(means), abs=1e-6)
    assert P.quality_report({"a": df}, protected="X4").first()["no_nulls"] is False


def test_by_column(wide):
    df, x, y = wide
    miss = np.isnan(x).sum(axis=0)
    got = {r["column"]: r["n_missing"] for r in P.missing_by_column(df, flags(df)).collect()}
    assert got == {f"X{j}": int(m) for j, m in enumerate(miss) if m}
    r = {v["column"]: v["r_missing_target"] for v in P.missing_vs_target(df, flags(df)).collect()}
    assert len(r) == WIDTH and r["X1"] is None
    j = int(np.argmax(miss))
    assert r[f"X{j}"] == pytest.approx(np.corrcoef(np.isnan(x[:, j]), y)[0, 1], abs=1e-6)
    assert M.null_rates(df, flags(df))[f"X{j}"] == pytest.approx(miss[j] / ROWS)
    assert C.target_correlations(df, flags(df)).count() == WIDTH


def test_row_rule(wide):
    df, x, _ = wide
    mean = np.nan_to_num(x).sum(axis=1) / WIDTH
    got = {r["id"]: r["row_mean"] for r in B.rule_baseline(df, flags(df)).collect()}
    assert all(got[i] == pytest.approx(mean[i], abs=1e-6) for i in range(ROWS))
