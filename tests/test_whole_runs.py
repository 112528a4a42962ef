"""Stacks without a member that failed, and stored models of the variant they are stored under."""

import pytest
from pyspark.sql import functions as F

from adlytics.catalog import q_score, q_train
from adlytics.operators.jobs import JobsFailed
from adlytics.operators.resample import FoldFrames


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("docs"))
    words = ["offer", "win", "free", "news", "report", "city"]
    docs = [(i, " ".join([words[(i + j * j) % 6] for j in range(3 + i % 11)]), "en" if i % 3 else "de", "web") for i in range(160)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string") \
        .withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, i % 2, int(i % 5 == 0 or i % 11 > 8)) for i in range(110)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.mark.parametrize("query", [q_train.l12, q_train.l20], ids=["l12", "l20"])
def test_a_failed_member_is_no_result(spark, monkeypatch, query):
    rows = spark.createDataFrame([(i, float(i % 3 == 0), i % 2, i % 7 + i % 3 / 2, float(i % 5)) for i in range(80)],
                                 "doc_id long, label double, fold int, a double, b double")
    frames = FoldFrames(rows.filter("doc_id < 50"), ["a", "b"], "doc_id", resample=False)
    rest = rows.filter("doc_id >= 50").withColumn("split", F.when(F.col("doc_id") % 2 == 0, "val").otherwise("test"))
    monkeypatch.setattr(q_train, "_variant", lambda *a: (frames, ["a", "b"], rest))
    monkeypatch.setattr(q_train, "CROSS_FAMILIES", ("gradboost", "lr"))
    monkeypatch.setitem(q_train.STACK_POINTS, "gradboost", {"maxDepth": 99})
    with pytest.raises(JobsFailed, match="gradboost"):
        query(spark, "")


@pytest.mark.parametrize("impute", ["knn", "mice"])
def test_models_are_stored_under_their_own_imputation(spark, sf, impute):
    reg, prep, _ = q_score._registry(spark, sf, ["lr"], impute)
    assert prep.impute == impute and reg.pipeline("lr", impute) is not None
