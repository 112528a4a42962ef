"""Driver contract and a DuckDB oracle subset on the smallest test tables."""

import duckdb
import pytest

from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

SUBSET = ["flagship_fill_cap_profile", "d14_missing_by_column", "d17_describe", "d18_moments_normality",
          "c01_target_correlations", "c05_binary_phi_pairs", "c14_anova_f", "o05_cap_iqr", "m01_median_fill",
          "m03_knn_impute", "e02_grid_threshold_search", "e03_exact_threshold_search", "e08_auc",
          "r01_stratified_split", "t08_quadratic_features", "l10_stack_no_refit", "s01_read_delimited_sep_fallback",
          "p17_predict_at_threshold", "b11_rule_baseline"]


def test_entry_and_registry(spark):
    import __spark_entry__ as ent
    df = ent.entry(spark)
    assert df.count() >= 0 and "column" in df.columns
    q, o = ent.queries(), ent.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 150


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def c(v):
        if isinstance(v, float):
            return None if v != v else round(v, 6) + 0.0
        return v
    return sorted((tuple(c(r[i]) for i in order) for r in rows), key=lambda t: tuple(str(x) for x in t))


@pytest.mark.parametrize("name", SUBSET)
def test_oracle_subset(spark, name):
    import __spark_entry__ as ent
    q, o = ent.queries(), ent.oracle_sql()
    sdf = q[name](spark, SF_SMALL)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    res = con.execute(o[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == sorted(sdf.columns)
    assert _canon([tuple(r) for r in sdf.collect()], sdf.columns) == _canon(res.fetchall(), ocols)
