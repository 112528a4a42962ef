"""Seeded hashing: two seeds are unrelated, samples overlap by chance only, permutations move rows."""

from pyspark.sql import functions as F

from adlytics.functions.exprs import portable_unit
from adlytics.operators.clean import ColumnMaskSelector
from adlytics.operators.knn import nearest
from adlytics.operators.sampling import cell_mask, class_rank, seeded_sample


def test_two_seeds_are_uncorrelated(spark):
    df = spark.range(20000)
    u = df.select(*[portable_unit("id", s).alias(f"u{s}") for s in (42, 43, 44, 7)])
    row = u.agg(F.corr("u42", "u43").alias("a"), F.corr("u43", "u44").alias("b"), F.corr("u42", "u7").alias("c"),
                F.avg("u42").alias("m"), F.variance("u42").alias("v")).first()
    assert max(abs(row.a), abs(row.b), abs(row.c)) < 0.05
    assert abs(row.m - 0.5) < 0.01 and abs(row.v - 1 / 12) < 0.005


def test_samples_masks_and_ranks_differ_by_seed(spark):
    df = spark.range(20000)
    a, b = (seeded_sample(df, "id", 1000, s) for s in (42, 43))
    assert a.join(b, "id").count() < 120                    # 50 expected
    one = df.withColumn("k", F.lit(0))
    ra, rb = (class_rank(one, "id", "k", s).select("id", F.col("_rank").alias(f"r{s}")) for s in (1, 2))
    assert ra.join(rb, "id").filter("r1 = r2").count() < 20
    m = cell_mask(df.select("id", F.lit(1).alias("x"), F.lit(1).alias("y")), "id", ["x", "y"], 0.2)
    both = m.filter("x_masked AND y_masked").count()
    assert 600 < both < 1000                                # 800 expected


def test_neighbours_outside_the_donors_range(spark):
    donors = spark.createDataFrame([(i, float(i), 10.0 * i, float(i % 2)) for i in range(11)], "id long, a double, b double, f double")
    q = spark.createDataFrame([(100, 1000.0, None, 1.0), (101, None, -5000.0, 0.0), (102, None, None, 1.0)],
                              "id long, a double, b double, f double")
    got = nearest(q, donors, ["a", "b", "f"], 3, "id", "id")
    rows = {}
    for r in got.orderBy("id", "rank").collect():
        rows.setdefault(r.id, []).append(r.id_donor)
    assert rows[100] == [10, 9, 8] and rows[101] == [0, 1, 2] and rows[102] == [1, 3, 5]


def test_mask_selector_survives_saving(spark, tmp_path):
    stage = ColumnMaskSelector(["a", "b"], [True, False], ["id"])
    stage.write().overwrite().save(str(tmp_path / "m"))
    assert ColumnMaskSelector.load(str(tmp_path / "m")).selected() == ["a"]
