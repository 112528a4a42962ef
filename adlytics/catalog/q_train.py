"""Training / ensembling / selection queries (L-1 ... L-22, C16, R6).

Model fitting is iterative and randomised, so most of these are rows-only here (invariants in
tests/); the ensembling rules on the score table have DuckDB oracles.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from adlytics.catalog import tables as T
from adlytics.catalog.q_metrics import F_SQL, P_SQL, R_SQL
from adlytics.catalog.registry import register
from adlytics.catalog.sqlgen import r6
from adlytics.operators import attribution as A
from adlytics.operators import jobs as J
from adlytics.operators import metrics as E
from adlytics.operators import train as L
from adlytics.operators.resample import FoldFrames
from adlytics.operators.sampling import stratified_folds, stratified_split
from adlytics.plans import prep as PP
from adlytics.plans.registry import Registry
from adlytics.session import cut_lineage, scratch_path

CONT = T.DOC_CONT
BIN = T.doc_binary_cols()
S = T.scores_sql()
MEMBERS = ["gradboost", "randforest", "svm", "mlp", "xgboost"]


FOLDS = 10               # stratified folds of the tuning queries


def _labelled(spark, sf_dir):
    return T.doc_wide(spark, sf_dir).filter(F.col("y").isNotNull())


def _prepared(spark, sf_dir, impute="median", folds=FOLDS):
    """(rows, features): the labelled documents split first, everything fitted on the training rows
    and applied to the others; ``fold`` is for training rows. Features exclude id, target, split."""
    rows = cut_lineage(stratified_split(_labelled(spark, sf_dir), "doc_id", "y"))
    train = rows.filter("split = 'train'").drop("split")
    out, prep = PP.fit_prep(train, "doc_id", "y", CONT, BIN, protected="X4", impute=impute, poly=True)
    feats = [c for c in prep.columns if c not in ("doc_id", "y")]
    train = stratified_folds(out, "doc_id", "y", folds).withColumn("split", F.lit("train"))
    rest = rows.filter("split <> 'train'")
    rest = prep.transform(rest.drop("split")).join(rest.select("doc_id", "split"), "doc_id").withColumn("fold", F.lit(None).cast("int"))
    both = train.unionByName(rest).withColumn("label", F.col("y").cast("double"))
    # model fitting passes over the data many times: materialise the prepared table once
    return cut_lineage(both), feats


def _parts(spark, sf_dir, impute="median", folds=FOLDS):
    sp, feats = _prepared(spark, sf_dir, impute, folds)
    return (sp.filter(F.col("split") == "train"), sp.filter(F.col("split") == "val"),
            sp.filter(F.col("split") == "test"), feats)


@register("l01_model_families_scores")
def l01(spark, sf_dir):
    train, _, test, feats = _parts(spark, sf_dir)
    points = {f: {} for f in [*MEMBERS, "lr"]} | {"svm": {"kernel": "rbf"}}

    def job(fam):
        return cut_lineage(L.score(L.pipeline(feats, fam, params=points[fam]).fit(train), test, "doc_id", fam, {"model": fam}))
    return L.union_all(list(J.values(J.run_jobs(spark, {f: (lambda f=f: job(f)) for f in points})).values()))


@register("l05_tune_evaluate")
def l05(spark, sf_dir):
    """A family's whole grid over ten folds, resampled in the loop."""
    train, val, _, feats = _parts(spark, sf_dir)
    model, cv_f1, points = L.tune(train, feats, "lr")
    s = L.score(model, val, "doc_id", "lr", {"model": "lr"})
    m = E.metrics_at_threshold(s, 0.5, ["model"])
    return m.join(E.auc(s, ["model"]), "model").withColumn("cv_f1", F.lit(cv_f1)) \
        .withColumn("gap", F.col("cv_f1") - F.col("f1")).withColumn("n_points", F.lit(len(points))) \
        .withColumn("n_folds", F.lit(points[0]["folds"])).withColumn("params", F.lit(str(points[0]["params"])))


@register("l06_evaluate_all_families")
def l06(spark, sf_dir):
    train, val, _, feats = _parts(spark, sf_dir)
    res, _, _ = L.evaluate_all(train, val, feats, L.FAMILIES, "doc_id", grid="brief")
    return res.drop("seconds")


@register("l03_resampled_folds")
def l03(spark, sf_dir):
    """Real and synthetic training rows per run and class."""
    train, _, _, feats = _parts(spark, sf_dir)
    return FoldFrames(train, feats, "doc_id").summary()


@register("l04_grid_points")
def l04(spark, sf_dir):
    """(family, points, folds, training rows): the work a full tuning does on the training table."""
    train, _, _, _ = _parts(spark, sf_dir)
    sizes = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(len(L.grid_points(f))).alias("n_points")) for f in L.GRIDS])
    per_fold = train.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    return per_fold.agg(F.count(F.lit(1)).alias("n_folds"), F.sum("n").alias("n_rows")).select(
        F.explode(sizes).alias("g"), "n_folds", "n_rows").select("g.family", "g.n_points", "n_folds", "n_rows")


@register("l07_clean_params")
def l07(spark, sf_dir):
    """Stored parameters of a tuned family, found by the ladder, cleaned and fitted with."""
    train, _, _, feats = _parts(spark, sf_dir)
    reg = Registry(spark, scratch_path(spark, f"registry-{uuid.uuid4().hex[:8]}"))
    reg.put_params("gradboost", "knn", "reduced", {"clf__maxDepth": 3, "clf__stepSize": 0.1, "clf__maxIter": 10, "clf__min_samples_leaf": 3})
    params = reg.params("gradboost", "knn")
    fitted = L.pipeline(feats, "gradboost", params=params).fit(train).stages[-1]
    return spark.createDataFrame([(k, str(v)) for k, v in params.items()], "param string, value string") \
        .withColumn("n_trees", F.lit(fitted.getNumTrees)).withColumn("max_depth", F.lit(fitted.getMaxDepth()))


_MP_SQL = f"""SELECT id, imputation, max(y) AS y, {r6('avg(p)')} AS p FROM {S} s
WHERE model IN ({', '.join(f"'{m}'" for m in MEMBERS)}) GROUP BY id, imputation"""


@register("l08_mean_probability", _MP_SQL)
def l08(spark, sf_dir):
    return L.mean_probability(T.scores(spark, sf_dir), MEMBERS, ["imputation"])


_M6 = MEMBERS + ["lr"]


@register("l09_mean_probability_missing_half", f"""SELECT id, imputation, max(y) AS y,
  {r6(f'(sum(p) + 0.5 * ({len(_M6)} - count(p))) / {float(len(_M6))}')} AS p FROM {S} s
WHERE model IN ({', '.join(f"'{m}'" for m in _M6)}) GROUP BY id, imputation""")
def l09(spark, sf_dir):
    return L.mean_probability(T.scores(spark, sf_dir), _M6, ["imputation"], missing=0.5)


@register("l10_stack_no_refit", f"""WITH s AS {S}, mp AS (SELECT id, split, imputation, max(y) AS y, round(avg(p), 6) + 0.0 AS p
  FROM s WHERE model IN ({', '.join(f"'{m}'" for m in MEMBERS)}) GROUP BY id, split, imputation),
g AS (SELECT CAST(i AS DOUBLE) / CAST(100 AS DOUBLE) AS threshold FROM range(20, 81) r(i)),
cc AS (SELECT imputation, threshold, count_if(p >= threshold AND y = 1) AS tp, count_if(p >= threshold AND y = 0) AS fp,
  count_if(p < threshold AND y = 1) AS fn FROM mp, g WHERE split = 'val' GROUP BY 1, 2),
cur AS (SELECT imputation, threshold, {r6(F_SQL)} AS f1 FROM cc),
best AS (SELECT imputation, threshold FROM (SELECT *, row_number() OVER (PARTITION BY imputation ORDER BY f1 DESC, threshold) AS rn FROM cur) WHERE rn = 1),
t AS (SELECT imputation, threshold, count_if(p >= threshold AND y = 1) AS tp, count_if(p >= threshold AND y = 0) AS fp,
  count_if(p < threshold AND y = 1) AS fn, count_if(p < threshold AND y = 0) AS tn
  FROM mp JOIN best USING (imputation) WHERE split = 'test' GROUP BY 1, 2)
SELECT imputation, tp, fp, fn, tn, {r6(P_SQL)} AS precision, {r6(R_SQL)} AS recall, {r6(F_SQL)} AS f1,
  {r6('CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn)')} AS accuracy, threshold FROM t""")
def l10(spark, sf_dir):
    return L.stack_no_refit(T.scores(spark, sf_dir), MEMBERS, ["imputation"])


# A small point per family for the stacking queries, which fit each of them once per
# fold and variant.
STACK_POINTS = {"gradboost": {"maxIter": 10, "maxDepth": 3}, "randforest": {"numTrees": 20, "maxDepth": 6},
                "svm": {"kernel": "rbf"}, "mlp": {"hidden": [8], "maxIter": 30}, "xgboost": {"maxIter": 10, "maxDepth": 2}}


def _variant(spark, sf_dir, impute):
    sp, feats = _prepared(spark, sf_dir, impute, L.STACK_FOLDS)
    return FoldFrames(sp.filter("split = 'train'"), feats, "doc_id"), feats, sp.filter("split <> 'train'")


def _every_oof(variants, families):
    """Out-of-fold and other scores of every member; a member without them is an error here, as the stack's
    rows would not show it."""
    oof, rest, status, _ = L.oof_scores(variants, families, params=STACK_POINTS)
    J.require_all(status)
    return oof, rest


def _stack_scores(stacked):
    return stacked["scores"].withColumn("threshold", F.lit(stacked["threshold"])) \
        .withColumn("prediction", (F.col("p") >= F.col("threshold")).cast("int"))


@register("l11_oof_stacking")
def l11(spark, sf_dir):
    """Five families, five folds, logistic meta-model, threshold from validation."""
    oof, rest, _, _ = L.oof_scores({"median": _variant(spark, sf_dir, "median")}, params=STACK_POINTS)
    return _stack_scores(L.stack(oof, rest))


CROSS_FAMILIES = ("gradboost", "randforest", "svm", "mlp")


@register("l12_cross_variant_stacking")
def l12(spark, sf_dir):
    """Four families over two fitted variants: eight out-of-fold columns, one meta-model."""
    variants = {v: _variant(spark, sf_dir, v) for v in ("knn", "mice")}
    return _stack_scores(L.stack(*_every_oof(variants, CROSS_FAMILIES)))


@register("l12_cross_variant_weights")
def l12_generated(spark, sf_dir):
    """Weights of a meta-model over every (model, imputation) column of the score table, fitted on
    its validation rows."""
    s = T.scores(spark, sf_dir).withColumnRenamed("imputation", "variant")
    return L.stack(s.filter("split = 'val'"), s.filter("split <> 'train'"))["weights"]


@register("l13_rfecv")
def l13(spark, sf_dir):
    train, _, _, feats = _parts(spark, sf_dir, folds=L.STACK_FOLDS)
    tab, best, _ = L.rfecv(train, feats, "lr", params={"maxIter": 10})
    return tab.withColumn("selected", F.col("n_features") == len(best))


@register("l14_apply_selected_columns")
def l14(spark, sf_dir):
    sp, feats = _prepared(spark, sf_dir, folds=3)
    train = sp.filter(F.col("split") == "train")
    _, best, _ = L.rfecv(train, feats, "lr", step=0.2, folds=3, params={"maxIter": 20})
    return sp.select("doc_id", "split", "label", *best)


@register("l15_l21_permutation_importance")
def l15(spark, sf_dir):
    train, val, _, feats = _parts(spark, sf_dir)
    m = L.pipeline(feats, "lr").fit(train)
    return L.permutation_importance(m, val, feats, "lr", id_col="doc_id").limit(20)


@register("l16_l17_importance_summary")
def l16(spark, sf_dir):
    train, _, _, feats = _parts(spark, sf_dir, folds=3)
    imp = L.importances(L.pipeline(feats, "randforest").fit(train), feats)
    t = spark.createDataFrame(list(zip(feats, imp)), "feature string, importance double")
    tab, _, _ = L.rfecv(train, feats, "randforest", step=0.5, folds=3, params={"numTrees": 20})
    return L.selection_summary(tab, t)


@register("l18_linear_attribution")
def l18(spark, sf_dir):
    sp, feats = _prepared(spark, sf_dir)
    return L.linear_attribution(sp, feats, "label", "doc_id", train=sp.filter("split = 'train'"))


@register("l18_tree_attribution")
def l18_trees(spark, sf_dir):
    """Mean absolute attribution per feature of boosted trees, over all documents with a label."""
    sp, feats = _prepared(spark, sf_dir)
    model = L.pipeline(feats, "gradboost", params={"maxIter": 10}).fit(sp.filter("split = 'train'"))
    attributed, _ = A.tree_attribution(model, sp, "doc_id")
    return A.mean_attribution(attributed, feats)


@register("l19_timed_runs")
def l19(spark, sf_dir):
    dw = cut_lineage(T.doc_wide(spark, sf_dir))
    runs = {f"{m}, t={t}": (lambda m=m, t=t: PP.fit_prep(dw, "doc_id", "y", CONT, BIN, protected="X4", impute=m, corr_threshold=t, written=True)[0])
            for m in ("median", "knn") for t in (0.85, 0.9, 0.95)}
    return L.timed_runs(runs, spark, len(dw.columns)).drop("seconds")


@register("l20_two_variants_thresholds")
def l20(spark, sf_dir):
    """A stack per variant (kNN, MICE) and its threshold on validation rows."""
    out = []
    for imp in ("knn", "mice"):
        stacked = L.stack(*_every_oof({imp: _variant(spark, sf_dir, imp)}, CROSS_FAMILIES))
        out.append(stacked["scores"].withColumn("variant", F.lit(imp)))
    return E.exact_threshold_search(L.union_all(out).filter("split = 'val'"), ["variant"])


@register("l22_load_pipeline")
def l22(spark, sf_dir):
    """A reduced pipeline found where no full one is stored."""
    train, _, test, feats = _parts(spark, sf_dir)
    reg = Registry(spark, scratch_path(spark, f"registry-{uuid.uuid4().hex[:8]}"))
    reg.put_pipeline("lr", "knn", "reduced", L.pipeline(feats, "lr").fit(train), columns=feats)
    found = reg.pipeline("lr", "knn")
    return L.score(found.model, test, "doc_id", "lr", {"model": "lr", "version": found.version})


@register("c16_combined_importance")
def c16(spark, sf_dir):
    sp, feats = _prepared(spark, sf_dir)
    return L.combined_importance(sp.filter("split = 'train'"), feats, "label", 20)


@register("r06_borderline_smote")
def r06(spark, sf_dir):
    train, _, _, feats = _parts(spark, sf_dir)
    out = L.borderline_smote(train.select("doc_id", "label", *feats), feats, "doc_id", "label")
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
