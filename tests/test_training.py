"""Training, stacking, kernels, chains, attribution, registry and failure isolation."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from adlytics.operators import attribution as A
from adlytics.operators import chain as CH
from adlytics.operators import jobs as J
from adlytics.operators import missing as M
from adlytics.operators import train as L
from adlytics.operators.resample import FoldFrames
from adlytics.plans import scoring as B
from adlytics.plans.prep import FittedPrep
from adlytics.plans.registry import Registry
from adlytics.session import cut_lineage, scratch_path
from adlytics.sources.io import batch_process


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(240, 4))
    y = (1.5 * x[:, 0] - x[:, 1] + 0.5 * x[:, 0] * x[:, 2] + rng.normal(0, 0.4, 240) > 1.0).astype(float)
    data = [(i, float(y_), i % 3, "val" if i % 2 else "test", *map(float, r)) for i, (r, y_) in enumerate(zip(x, y))]
    return cut_lineage(spark.createDataFrame(data, "id long, label double, fold int, split string, a double, b double, c double, d double"))


FEATS = ["a", "b", "c", "d"]


def test_rbf_solves_a_ring(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(-2, 2, (300, 2))
    df = cut_lineage(spark.createDataFrame([(float(1 < a * a + b * b < 2.4), float(a), float(b)) for a, b in x],
                                           "label double, a double, b double"))
    f1 = {}
    for kernel in ("linear", "rbf"):
        m = L.pipeline(["a", "b"], "svm", params={"kernel": kernel, "regParam": 0.001}).fit(df)
        f1[kernel] = L.f1_of(m.transform(df))
    path = scratch_path(spark, "ring-model")
    m.write().overwrite().save(path)
    again = type(m).load(path)
    assert f1["rbf"] > 0.85 and f1["linear"] < 0.7
    assert L.f1_of(again.transform(df)) == f1["rbf"]


def test_grids():
    assert len(L.grid_points("gradboost")) == 72 and len(L.grid_points("randforest")) == 36 and len(L.grid_points("xgboost")) == 324
    assert len(L.grid_points("svm")) == 9                # a linear kernel has no width
    assert L.clean_params({"clf__maxDepth": 3, "clf__nope": 1}, {"maxDepth"}) == {"maxDepth": 3}
    with pytest.raises(ValueError):
        L.make_estimator("forest", 3)


def test_stack_never_scores_a_row_it_saw(spark, rows):
    train, rest = rows.filter("id < 180"), rows.filter("id >= 180")
    frames = FoldFrames(train, FEATS, "id")
    oof, scored, status, _ = L.oof_scores({"v": (frames, FEATS, rest)}, ("lr", "mlp", "gradboost"), "id",
                                          {"mlp": {"hidden": [3], "maxIter": 5}, "gradboost": {"maxDepth": 99}})
    own = {r.id: r.fold for r in train.collect()}
    got = oof.collect()
    assert all(own[r.id] == r.fold for r in got)         # scored in the run that left its fold out
    assert sorted((r.id, r.model) for r in got) == sorted((i, m) for i in own for m in ("lr", "mlp"))
    for k in frames.folds:
        trained = {r.id for r in frames.training(k).collect()}
        assert not trained & {r.id for r in got if r.fold == k}
    failed = {r.job for r in status.filter("status = 'failed'").collect()}
    assert failed == {f"v/gradboost/{k}" for k in ("0", "1", "2", "all")}
    st = L.stack(oof, scored, ["v_lr", "v_mlp", "v_gradboost"])
    f = st["scores"].collect()
    assert len(f) == 60 and 0.2 <= st["threshold"] <= 0.8 and st["test_metrics"].first()["f1"] > 0.6
    assert {r.v_gradboost for r in L.meta_features(oof, st["keys"]).collect()} == {0.5}


def test_tuning_picks_the_better_point(spark, rows):
    model, f1, points = L.tune(rows, FEATS, "lr", grid={"regParam": [0.01, 50.0]}, id_col="id")
    assert points[0]["params"] == {"regParam": 0.01} and points[0]["folds"] == 3 and f1 == points[0]["mean_f1"] > points[1]["mean_f1"]


def test_permutation_and_elimination(spark, rows):
    m = L.pipeline(FEATS, "lr").fit(rows)
    drop = {r.feature: r.mean_drop for r in L.permutation_importance(m, rows, FEATS, "lr", 6, "id").collect()}
    assert drop["a"] > 0.2 > abs(drop["d"]) + 0.1 and drop["a"] > drop["b"] > drop["d"]
    tab, best, rank = L.rfecv(rows, FEATS, "lr", folds=3, params={"maxIter": 20})
    assert [r.n_features for r in tab.collect()] == [4, 3, 2, 1] and {"a", "b"} <= set(best) | {"b"}
    assert {r.feature: r.ranking for r in rank.collect()}["a"] == 1
    summary = L.selection_summary(tab, spark.createDataFrame([("a", 0.7), ("b", 0.3), ("c", 0.0)], "feature string, importance double")).first()
    assert summary.top_features == "a,b,c" and summary.best_feature == "a" and summary.n_features == len(best)


@pytest.mark.parametrize("kind", ["gbt", "forest"])
def test_tree_attribution(spark, rows, kind):
    est = GBTClassifier(maxIter=4, maxDepth=3, seed=1) if kind == "gbt" else RandomForestClassifier(numTrees=4, maxDepth=3, seed=1)
    model = Pipeline(stages=[VectorAssembler(inputCols=FEATS, outputCol="features"), est]).fit(rows)
    got, expected = A.tree_attribution(model, rows, "id")
    got = {r.id: r for r in got.collect()}
    if isinstance(est, GBTClassifier):
        margin = {r.id: r.m for r in model.transform(rows).select("id", vector_to_array("rawPrediction")[1].alias("m")).collect()}
    else:
        margin = {r.id: r.m for r in model.transform(rows).select("id", vector_to_array("probability")[1].alias("m")).collect()}
    for i, r in got.items():
        assert r.margin == pytest.approx(margin[i]) == pytest.approx(expected + sum(r.attributions))
    # the game by subset enumeration, from the nodes
    nodes = {}
    for n in A.node_table(spark, model.stages[-1]).collect():
        nodes.setdefault(n["tree"], {})[n["id"]] = n

    def value(tree, i, x, known):
        n = tree[i]
        if n["left"] < 0:
            return n["value"]
        if n["feature"] in known:
            return value(tree, n["left"] if x[n["feature"]] <= n["cut"] else n["right"], x, known)
        return sum(value(tree, c, x, known) * tree[c]["rows"] for c in (n["left"], n["right"])) / n["rows"]
    for r in rows.limit(5).collect():
        x = [r[f] for f in FEATS]
        v = {s: sum(value(t, 0, x, s) for t in nodes.values()) for k in range(5) for s in itertools.combinations(range(4), k)}
        for f in range(4):
            others = [j for j in range(4) if j != f]
            phi = sum(math.factorial(k) * math.factorial(3 - k) / 24 * (v[tuple(sorted((*s, f)))] - v[s])
                      for k in range(4) for s in itertools.combinations(others, k))
            assert got[r.id].attributions[f] == pytest.approx(phi)


def test_chain_is_saved_and_replayed(spark):
    rng = np.random.default_rng(5)
    data = []
    for i in range(160):
        a, b = rng.normal(size=2)
        v = [a, b, 2 * a - b + 1]
        if i % 3 == 0:
            v[i % 9 // 3] = None
        data.append((i, *[None if x is None else float(x) for x in v]))
    df = cut_lineage(spark.createDataFrame(data, "id long, a double, b double, c double"))
    cols = ["a", "b", "c"]
    fitted = CH.fit_chain(df, cols, "id", CH.ridge(), max_iter=6)
    back = CH.FittedChain.load(spark, fitted.save(spark, scratch_path(spark, "chain-test")))
    out = {r.id: r for r in back.transform(df, "id").collect()}
    assert out == {r.id: r for r in fitted.transform(df, "id").collect()} and len(out) == 160
    for i, *v in data:
        for c, x in zip(cols, v):
            assert out[i][c] == x if x is not None else True
        assert out[i].c == pytest.approx(2 * out[i].a - out[i].b + 1, abs=0.2)
    trees = CH.fit_chain(df, cols, "id", {**{c: CH.ridge() for c in cols}, "c": CH.boosted(maxIter=3, maxDepth=2)}, max_iter=1)
    assert trees.rounds == 1 and trees.transform(df, "id").na.drop().count() == 160
    with pytest.raises(ValueError):
        CH.fit_chain(df.limit(5), cols, "id")


def test_failures_are_isolated(spark, rows):
    bad = F.when(F.col("id") >= 0, F.lit("x")).otherwise(F.lit("1")).cast("double")
    outs, status = batch_process({"ok": rows, "bad": rows.withColumn("a", bad)}, lambda d: d.withColumn("z", F.col("a") + 1))
    assert {r.dataset: r.status for r in status.collect()} == {"ok": "ok", "bad": "failed"}
    assert outs["ok"].count() == 240 and outs["bad"] is None
    holes = rows.withColumn("a", F.when(F.col("id") % 2 == 0, F.col("a"))).withColumn("b", F.when(F.col("id") % 2 == 1, F.col("b")))
    filled, how = M.impute_with_fallback(holes, ["a", "b"], "id", "mice")
    assert how.startswith("median_backup (ValueError") and filled.na.drop(subset=["a", "b"]).count() == 240
    good = L.pipeline(FEATS, "lr").fit(rows)

    class Broken:
        def transform(self, df):
            return good.transform(df.withColumn("a", bad))
    scores, status = B.score_members(rows, {"good": good, "broken": Broken()}, "id", FEATS)
    assert {r.job: r.status for r in status.collect()} == {"good": "ok", "broken": "failed"}
    mean = L.mean_probability(scores.withColumn("y", F.lit(0)), ["good", "broken"], missing=L.MISSING_MEMBER)
    alone = {r.id: r.p for r in scores.collect()}
    assert all(r.p == pytest.approx((alone[r.id] + 0.5) / 2, abs=1e-6) for r in mean.collect())
    with pytest.raises(J.JobsFailed):
        B.score_members(rows, {"broken": Broken()}, "id", FEATS)


def test_registry_ladder_and_dispatch(spark, rows):
    reg = Registry(spark, scratch_path(spark, "registry-test"))
    assert reg.pipeline("lr", "knn") is None and reg.threshold("lr", "knn", default=0.3) == 0.3
    model = L.pipeline(FEATS, "lr").fit(rows)
    for version in ("", "reduced", "full"):              # each rung hides the ones below
        reg.put_pipeline("lr", "knn", version, model, FEATS)
        assert reg.pipeline("logreg", "knn").version == version
    assert reg.pipeline("lr", "knn", "reduced").version == "reduced" and reg.pipeline("lr", "mice") is None
    reg.put_params("RandomForest", "mice", "", {"clf__numTrees": 7, "clf__n_jobs": -1})
    assert reg.params("randforest", "mice") == {"numTrees": 7} and reg.params("randforest", "knn") is None
    for wrong in (lambda: reg.pipeline("lr", "mean"), lambda: reg.pipeline("lr", "knn", "tiny"), lambda: reg.pipeline("oracle", "knn")):
        with pytest.raises(ValueError):
            wrong()
    prep = FittedPrep("id", None, FEATS, [], steps=[], columns=["id", *FEATS])
    reg.put_threshold("lr", "knn", "full", 0.9)
    new = rows.select("id", *FEATS)
    run = B.run_prediction(reg, new, prep, "id", "lr", "knn")
    assert run.threshold == 0.9 and run.versions == {"lr": "full"} and run.predictions.count() == 240
    with pytest.raises(LookupError):
        B.run_prediction(reg, new, prep, "id", "stacking", "knn")        # lr is no member
    reg.put_pipeline("svm", "knn", "reduced", model, FEATS)
    assert B.run_prediction(reg, new, prep, "id", "stacking_refit", "knn").model == "stacking"
    with pytest.raises(ValueError):
        B.run_prediction(reg, new.drop("c"), prep, "id", "svm", "knn", strict=True)
    ids = B.run_prediction(reg, new.drop("id"), prep, "id", "svm", "knn").predictions
    assert sorted(r.id for r in ids.collect()) == list(range(1, 241))
