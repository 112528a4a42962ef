"""The wide documents table: no text is shuffled, few tokens are looked through, same rows."""

import re

from adlytics.catalog import tables as T

DOCS = [(1, "The cat, the DOG", "en", 16), (2, None, "de", 0), (3, "cat cat", None, 7), (4, "", "en", 0), (None, "dog", "en", 3)]


def _write(spark, tmp_path, labels):
    spark.createDataFrame(DOCS, "doc_id long, text string, lang string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_rows_and_repeated_labels(spark, tmp_path):
    d = _write(spark, tmp_path, [(1, 0, 1), (3, 0, 0), (3, 1, 1), (None, 0, 1)])
    rows = sorted([tuple(r) for r in T.doc_wide(spark, d, 2).collect()], key=str)
    # "cat" is in three rows (document 3 has two labels), "dog" in two
    assert rows == sorted([
        (1, 1, 16.0, None, 4.0, 1, 1, 1), (2, None, 0.0, None, None, 0, None, None), (3, 0, 7.0, 2.0, 3.5, None, 1, 0),
        (3, 1, 7.0, 2.0, 3.5, None, 1, 0), (4, None, None, 0.0, None, 1, 0, 0), (None, None, 3.0, 1.0, 3.0, 1, 0, 1)], key=str)


def test_labels_are_joined_to_finished_rows(spark, tmp_path, monkeypatch):
    d = _write(spark, tmp_path, [(1, 0, 1)])
    monkeypatch.setattr(T, "cut_lineage", lambda df: df)
    plan = T.doc_wide(spark, d, 2)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join ", 1)
    assert "array_contains" not in above and "text" not in above
    assert not re.search(r"array_contains\(tokens", below)


def test_no_tokens(spark, tmp_path):
    spark.createDataFrame([(1, "12 34", "en", 5)], "doc_id long, text string, lang string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    t = T.doc_wide(spark, str(tmp_path), 2)
    assert t.columns == ["doc_id", "y", "X1", "X2", "X3", "X4"] and t.count() == 1
