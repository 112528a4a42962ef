"""Queries that take all columns of their table, against numpy and DuckDB."""

import numpy as np
import pytest

from adlytics.operators import corr as C
from tests.conftest import SF_CHECK, SF_SMALL
from tests.test_contract import test_oracle_subset as matches_sql


def test_pca_takes_all_dimensions(spark):
    import __spark_entry__ as ent
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("embedding").collect()
    x = np.array([r[0] for r in rows if r[0] is not None], float)
    assert x.shape[1] == 64
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    got = [r.explained for r in ent.queries()["t10_pca_explained_variance"](spark, SF_SMALL).orderBy("component").collect()]
    assert np.allclose(got, (values / values.sum())[:2], atol=2e-6)


@pytest.mark.parametrize("name, columns", [("t07_scale_all_flags", 41), ("c07_column_sample_ten", 4)])
def test_whole_width_matches_sql(spark, name, columns):
    import __spark_entry__ as ent
    assert len(ent.queries()[name](spark, SF_SMALL).columns) == columns
    matches_sql(spark, name)


def test_full_report_samples_ten_per_bucket(spark, monkeypatch):
    import __spark_entry__ as ent
    seen, own = [], C.stratified_column_sample

    def sample(df, cols, per_bucket=10, seed=42):
        out = own(df, cols, per_bucket, seed)
        seen.append(out.count())
        return out
    monkeypatch.setattr(C, "stratified_column_sample", sample)
    ent.queries()["c17_full_correlation_report"](spark, SF_CHECK)
    assert seen and set(seen) == {40}
