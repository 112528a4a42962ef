"""Work that must not grow faster than the input: what is broadcast, shuffled and read again."""

from pyspark.sql import functions as F

from adlytics.catalog import q_metrics, tables as T
from adlytics.operators import metrics as E
from adlytics.operators import train as L
from adlytics.operators.phi import phi_pairs
from adlytics.operators.prefix import prefix_sums
from adlytics.operators.relational import wide_by_key
from adlytics.operators.resample import FoldFrames


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _scores(spark, n=400):
    """Rows of three models, exploded from a narrow table: its estimated size is that of the ids."""
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(w).alias("w")) for m, w in (("a", 1.0), ("b", 2.0), ("c", 3.0))])
    split = F.when(F.col("id") % 3 == 0, "val").otherwise("test")
    return spark.range(n).select("id", split.alias("split"), (F.col("id") % 2).cast("int").alias("y"), F.explode(models).alias("m")) \
        .select("id", "split", "y", "m.model", F.round((F.col("id") % 101 + F.col("y") * 20) / (121.0 * F.col("m.w")), 4).alias("p"))


def test_thresholds_go_to_the_scores(spark):
    found = E.default_vs_optimised(_scores(spark), ["model"], "val", "test")
    assert plan(found).count("Range (") == 2          # the thresholds are found once, then both F1 values
    rows = {r["model"]: r for r in found.collect()}
    assert set(rows) == {"a", "b", "c"}
    for m, r in rows.items():
        test = [x for x in _scores(spark).filter((F.col("model") == m) & (F.col("split") == "test")).collect()]
        for t, name in ((0.5, "default_f1"), (r["optimal_threshold"], "optimized_f1")):
            hit = sum(x["p"] >= t and x["y"] == 1 for x in test)
            wrong = sum((x["p"] >= t) != (x["y"] == 1) for x in test)
            assert abs(r[name] - (2 * hit / (2 * hit + wrong) if hit else 0.0)) < 1e-6


def test_saved_thresholds_go_to_the_scores(spark):
    th = spark.createDataFrame([("a", 0.4, "x" * 100000), ("b", 0.3, "x")], "model string, threshold double, note string")
    found = E.evaluate_at_thresholds(_scores(spark), th, ["model"])
    assert "BuildLeft" not in plan(found)
    assert {r["model"]: r["threshold"] for r in found.collect()} == {"a": 0.4, "b": 0.3}


def _line(spark, folder):
    spark.range(600).select(F.col("id").alias("l_orderkey"), (F.col("id") % 50).alias("l_partkey"), (F.col("id") % 7).alias("l_suppkey"),
                            F.lit(1).alias("l_linenumber"), F.when(F.col("id") % 3 == 0, "R").otherwise("N").alias("l_returnflag")) \
        .write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_best_of_two_evaluates_once(spark, tmp_path):
    found = q_metrics.e16(spark, _line(spark, tmp_path / "t"))
    assert "FileScan" not in plan(found)          # both variants read one table of results
    assert found.collect()[0]["choice"] in ("knn", "mice")


def test_wide_by_key_shuffles_ids(spark):
    long = spark.createDataFrame([(1, "a", 0.1), (1, "b", 0.2), (2, "b", None), (3, "z", 0.4), (None, "a", 0.5)], "id int, k string, p double")
    found = wide_by_key(long, "id", "k", "p", ["a", "b"])
    assert plan(found).count("Exchange hashpartitioning") == 1
    assert found.columns == ["id", "a", "b"]
    assert {r["id"]: (r["a"], r["b"]) for r in found.collect()} == {1: (0.1, 0.2), 2: (None, None), 3: (None, None), None: (0.5, None)}


def test_phi_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def flag(i):
        seen.add(1)
        return i % 2
    df = spark.range(90).select(flag("id").alias("f"), (F.col("id") % 3 == 0).cast("int").alias("g"))
    assert phi_pairs(df, ["f", "g"]).count() == 1
    assert seen.value == 90


def test_wide_table_is_written_once(spark, tmp_path):
    spark.createDataFrame([(i, "one two two" if i % 2 else "one", "en", "s", 11) for i in range(20)],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    dw = T.doc_wide(spark, str(tmp_path), n_tokens=2)
    assert "regexp_extract_all" not in plan(dw)
    assert dw.agg(F.sum("X5"), F.sum("X6"), F.count("y")).first()[:] == (20, 10, 1)


def test_ks_reads_its_samples_once(spark):
    from adlytics.operators.missing import ks_two_sample
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def value(i):
        seen.add(1)
        return float(i % 7)
    a, b = (spark.range(n).select(value("id").alias("x")) for n in (60, 40))
    r = ks_two_sample(a, b, ["x"]).collect()[0]
    assert (r["n_a"], r["n_b"]) == (60, 40) and seen.value == 100


def test_prefix_sums_broadcast_no_rows(spark):
    df = spark.createDataFrame([("a", 0.1, 1), ("a", 0.9, 2), ("b", 0.5, 4), (None, 0.2, 8)], "g string, s double, n int")
    found = prefix_sums(df, "s", ["n"], by=["g"], unit_buckets=8)
    assert "BroadcastHashJoin" not in plan(found) and "SortMergeJoin" in plan(found)
    assert {(r.g, r.s): r.cum_n for r in found.collect()} == {("a", 0.1): 1, ("a", 0.9): 3, ("b", 0.5): 4}


def _labelled(spark):
    return spark.range(240).select(F.col("id"), (F.col("id") % 3 == 0).cast("double").alias("label"), (F.col("id") % 4).cast("int").alias("fold"),
                                   (F.col("id") % 3 + F.col("id") % 7 * 0.3).alias("a"), (F.col("id") % 5).cast("int").alias("b"),
                                   F.when(F.col("id") % 2 == 0, 1.0).otherwise(0.0).alias("c"))


def _count_scalers(monkeypatch):
    fits, fit = [], L.StandardScaler._fit
    monkeypatch.setattr(L.StandardScaler, "_fit", lambda self, rows: (fits.append(1), fit(self, rows))[1])
    return fits


def test_a_grid_scales_a_fold_once(spark, monkeypatch):
    feats = ["a", "b", "c"]
    frames = FoldFrames(_labelled(spark), feats, "id")
    points = [{"regParam": 0.01}, {"regParam": 0.5}]
    want = []
    for p in points:
        want.append(sum(L.f1_of(L.pipeline(feats, "lr", params=p).fit(frames.training(k)).transform(frames.scored(k))) for k in frames.folds) / 4)
    fits = _count_scalers(monkeypatch)
    got = {r["point"]: r["mean_f1"] for r in L.cross_validate(frames, feats, "lr", points)}
    svm = L.cross_validate(frames, feats, "svm", [{"kernel": "rbf", "maxIter": 3}])
    assert len(fits) == 4 and len(svm) == 1
    assert all(abs(got[i] - w) < 1e-9 for i, w in enumerate(want)) and min(want) > 0


def test_elimination_scales_a_fold_once(spark, monkeypatch):
    feats, rows = ["a", "b", "c"], _labelled(spark)
    fits = _count_scalers(monkeypatch)
    tab, best, _ = L.rfecv(rows, feats, "lr", folds=4, params={"maxIter": 10})
    assert len(fits) == 5                             # four folds and all rows
    for r in tab.collect():
        cols = r.features.split(",")
        f1 = [L.f1_of(L.pipeline(cols, "lr", params={"maxIter": 10}).fit(rows.filter(F.col("fold") != k)).transform(rows.filter(F.col("fold") == k)))
              for k in range(4)]
        assert abs(r.mean_f1 - sum(f1) / 4) < 1e-9
    assert "a" in best
