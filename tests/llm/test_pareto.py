"""Unequal inclusions of the mix: observed rates, the order, certain copies."""

import numpy as np
from pyspark.sql import functions as F

from adlytics.llm import pareto
from adlytics.llm.common import saved

SIZES = [1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 20, 20, 40, 40, 60, 10, 10, 30, 30, 0, 400]
SOURCES = 1500


def test_observed_inclusions_are_those_asked_for(spark):
    """Many sources alike: the share of them in which a document is taken is its inclusion."""
    sized = saved(spark.range(SOURCES * len(SIZES)).select(
        F.col("id").alias("doc_id"), (F.col("id") / len(SIZES)).cast("int").cast("string").alias("source"),
        F.element_at(F.array(*map(F.lit, SIZES)), (F.col("id") % len(SIZES) + 1).cast("int")).cast("long").alias("size")))
    total = sum(SIZES)
    words = 0.8 * total                                  # 400 is certain: its inclusion would be above one
    targets = sized.select("source").distinct().withColumn("source_size", F.lit(total).cast("long")).withColumn("target", F.lit(float(total + words)))
    rates = saved(pareto.inclusion_rates(sized, targets))
    lam = rates.first()["lam"]
    want = np.minimum(1, lam * np.array(SIZES))
    assert want[-1] == 1 and want[-2] == 0 and (want[:9] < 1).all()
    assert np.isclose((want * SIZES).sum(), words)
    got = pareto.copies(sized, saved(pareto.source_cuts(sized, rates, 64)), 64).withColumn("place", F.col("doc_id") % len(SIZES))
    rate = {r.place: r.rate for r in got.groupBy("place").agg(F.avg(F.col("copies") - 1).alias("rate")).collect()}
    assert max(abs(rate[i] - w) for i, w in enumerate(want)) < 0.06
    assert rate[9] > rate[7] > rate[4] > rate[0]
    off = got.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("t")).select(F.max(F.abs(F.col("t") - total - words))).first()[0]
    assert off <= max(SIZES) / 2


def test_order_is_not_that_of_the_random_numbers(spark):
    rows = [(i, "s", 1 + i * 7 % 50) for i in range(300)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long")
    target = sum(r[2] for r in rows) * 0.5
    rates = pareto.inclusion_rates(sized, spark.createDataFrame([("s", int(target * 2), target)], "source string, source_size long, target double"))
    d = pareto.order_columns(pareto.with_source(sized, rates)).filter("_part > 0").toPandas()
    assert d["_part"].nunique() > 20
    assert list(d.sort_values("_q").doc_id) != list(d.sort_values("_u").doc_id)
    assert np.allclose(d["_q"], d["_u"] / (1 - d["_u"]) / (d["_part"] / (1 - d["_part"])))


def test_no_words_and_whole_targets(spark):
    df = spark.createDataFrame([(1, "", "a"), (2, None, "a"), (3, "x y", None), (4, "x y z", None)], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in pareto.mix_documents(df).collect()}
    assert got[1].taken == got[2].taken == 0 and got[3].source_size == 5
    assert abs(got[3].taken + got[4].taken - got[3].target) <= 1.5
