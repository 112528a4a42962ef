"""Transform (T1-T15), model-based imputation (M2-M8, M15) and preparation-plan queries.

Fitted-parameter searches (lambda, k, chained equations) are iterative, so their queries are
rows-only here and checked by invariant tests; applying fixed parameters, scaling, quadratic
features and kNN imputation (against a brute-force SQL search) have DuckDB oracles.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from adlytics.catalog import tables as T
from adlytics.catalog.registry import register
from adlytics.catalog.sqlgen import r6
from adlytics.functions.exprs import r6 as sr6
from adlytics.operators import knn as K
from adlytics.operators import missing as M
from adlytics.operators import transform as TR
from adlytics.plans import prep as PP
from adlytics.session import cut_lineage

DW = T.doc_wide_sql()
CONT = T.DOC_CONT
BIN = T.doc_binary_cols()


def _dw(spark, sf_dir):
    return T.doc_wide(spark, sf_dir)


def _yj_sql(x, lam):
    pos = f"ln(1 + {x})" if lam == 0 else f"(pow({x} + 1.0, {lam}) - 1.0) / {lam}"
    neg = f"-ln(1 - {x})" if lam == 2 else f"-(pow(1.0 - {x}, {2 - lam}) - 1.0) / {2 - lam}"
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} >= 0 THEN {pos} ELSE {neg} END"


# ------------------------------------------------------------------ T1, T2 (fixed lambda: oracle)
@register("t01_yeo_johnson_apply_fixed", f"""SELECT doc_id, {', '.join(f"{r6(_yj_sql(c, 0.5))} AS {c}_trans" for c in CONT)}
FROM {DW} d""")
def t01f(spark, sf_dir):
    fits = {c: TR.PowerFit("yeo-johnson", 0.5) for c in CONT}
    out = TR.apply_power(_dw(spark, sf_dir).select("doc_id", *CONT), fits, "_trans", keep=False)
    return out.select("doc_id", *[sr6(f"{c}_trans").alias(f"{c}_trans") for c in CONT])


@register("t01_yeo_johnson_fit_apply")
def t01(spark, sf_dir):
    d = _dw(spark, sf_dir).select("doc_id", *CONT)
    return TR.apply_power(d, TR.fit_power(d, CONT, "yeo-johnson", standardize=True), "_trans", keep=False)


@register("t02_box_cox_apply_fixed", f"""WITH m AS (SELECT min(c_acctbal) AS mn FROM customer)
SELECT c_custkey, {r6('(pow(c_acctbal + CASE WHEN mn <= 0 THEN abs(mn) + 1e-6 ELSE 0 END, 0.5) - 1.0) / 0.5')} AS c_acctbal_trans
FROM customer, m""")
def t02f(spark, sf_dir):
    cu = T.read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    mn = cu.agg(F.min("c_acctbal")).first()[0]
    fit = TR.PowerFit("box-cox", 0.5, abs(mn) + 1e-6 if mn <= 0 else 0.0)
    out = TR.apply_power(cu, {"c_acctbal": fit}, "_trans", keep=False)
    return out.select("c_custkey", sr6("c_acctbal_trans").alias("c_acctbal_trans"))


@register("t02_box_cox_fit_apply")
def t02(spark, sf_dir):
    cu = T.read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return TR.apply_power(cu, TR.fit_power(cu, ["c_acctbal"], "box-cox"), "_trans", keep=False)


@register("t03_mixed_transform")
def t03(spark, sf_dir):
    d = _dw(spark, sf_dir).select("doc_id", *CONT)
    return TR.apply_power(d, TR.fit_mixed(d, ["X1", "X2"], ["X3"]), "_transformed", keep=False)


@register("t04_choose_transform")
def t04(spark, sf_dir):
    d = _dw(spark, sf_dir).select("doc_id", *CONT)
    best = TR.choose_transform(d, CONT)
    return spark.createDataFrame([(c, f.method, round(f.lmbda, 4), f.shift) for c, f in best.items()],
                                 "column string, method string, lambda double, shift double")


@register("t05_skew_report_fixed", f"""WITH d AS {DW}
{' UNION ALL '.join(f"SELECT '{c}' AS \"column\", 'yeo-johnson' AS method, 0.5 AS lambda, {r6(f'skewness({c})')} AS skew_before, {r6(f'skewness({_yj_sql(c, 0.5)})')} AS skew_after FROM d" for c in CONT)}""")
def t05(spark, sf_dir):
    return TR.skew_report(_dw(spark, sf_dir), {c: TR.PowerFit("yeo-johnson", 0.5) for c in CONT})


@register("t05_skew_report_fitted")
def t05b(spark, sf_dir):
    d = _dw(spark, sf_dir)
    return TR.skew_report(d, TR.fit_power(d, CONT, "yeo-johnson", standardize=False))


@register("t06_standardize", f"""WITH d AS {DW}, s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in CONT)} FROM d)
SELECT doc_id, {', '.join(r6(f'({c} - m_{c}) / s_{c}') + f' AS {c}' for c in CONT)} FROM d, s""")
def t06(spark, sf_dir):
    out = TR.standardize(_dw(spark, sf_dir).select("doc_id", *CONT), CONT)
    return out.select("doc_id", *[sr6(c).alias(c) for c in CONT])


_T07_SQL = f"""WITH d AS {DW}, s AS (SELECT {', '.join(f'stddev_pop({c}) AS s_{c}' for c in BIN)} FROM d)
SELECT doc_id, {', '.join(r6(f'CASE WHEN s_{c} > 0 THEN {c} / s_{c} ELSE {c} END') + f' AS {c}' for c in BIN)} FROM d, s"""


@register("t07_scale_all_flags", _T07_SQL)
@register("t07_scale_without_centering", _T07_SQL)
def t07_all(spark, sf_dir):
    out = TR.standardize(_dw(spark, sf_dir).select("doc_id", *BIN), BIN, with_mean=False)
    return out.select("doc_id", *[sr6(c).alias(c) for c in BIN])


_Q_NAMES = TR.quadratic_names(CONT)


@register("t08_quadratic_features", f"""SELECT doc_id, y, X4,
  {', '.join(r6(' * '.join(parts)) + f' AS "{name}"' for name, parts in _Q_NAMES)} FROM {DW} d""")
def t08(spark, sf_dir):
    q = TR.quadratic_features(_dw(spark, sf_dir).select("doc_id", "y", "X4", *CONT), CONT)
    return q.select("doc_id", "y", "X4", *[sr6(name).alias(name) for name, _ in _Q_NAMES])


@register("t10_pca_explained_variance")
def t10(spark, sf_dir):
    emb = T.read(spark, sf_dir, "embeddings")
    cols = [f"e{i}" for i in range(emb.agg(F.max(F.size("embedding"))).first()[0] or 0)]
    flat = emb.select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cols)])
    _, ev = TR.pca(flat, cols, k=2)
    return spark.createDataFrame([(i + 1, round(v, 6)) for i, v in enumerate(ev)], "component int, explained double")


# ------------------------------------------------------------------ M3 (brute-force oracle), M2, M4-M8
def _knn_sql(k=5):
    n = len(CONT)
    shared = " + ".join(f"CAST(t.{c} IS NOT NULL AND d.d_{c} IS NOT NULL AS INTEGER)" for c in CONT)
    ss = " + ".join(f"coalesce((t.{c} - d.d_{c}) * (t.{c} - d.d_{c}), 0.0)" for c in CONT)
    tasks = " UNION ALL ".join(f"SELECT doc_id, '{c}' AS target, {', '.join(('NULL' if x == c else x) + f' AS {x}' for x in CONT)} FROM b WHERE {c} IS NULL" for c in CONT)
    donors = " UNION ALL ".join(f"SELECT doc_id AS did, '{c}' AS target, {c} AS value, {', '.join(f'{x} AS d_{x}' for x in CONT)} FROM b WHERE {c} IS NOT NULL" for c in CONT)
    fills = ", ".join(f"{r6(f'coalesce(b.{c}, f_{c}.fill, (SELECT avg({c}) FROM b))')} AS {c}" for c in CONT)
    joins = " ".join(f"LEFT JOIN (SELECT doc_id, fill FROM f WHERE target = '{c}') f_{c} ON f_{c}.doc_id = b.doc_id" for c in CONT)
    return f"""WITH b AS (SELECT doc_id, {', '.join(CONT)} FROM {DW} x),
t AS ({tasks}), d AS ({donors}),
p AS (SELECT t.doc_id, t.target, d.did, d.value, {shared} AS m, {ss} AS ss FROM t JOIN d ON t.target = d.target),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, target ORDER BY sqrt({float(n)} / m * ss), did) AS rk FROM p WHERE m > 0),
f AS (SELECT doc_id, target, avg(value) AS fill FROM r WHERE rk <= {k} GROUP BY 1, 2)
SELECT b.doc_id, {fills} FROM b {joins}"""


@register("m03_knn_impute", _knn_sql(5))
def m03(spark, sf_dir):
    d = _dw(spark, sf_dir).select("doc_id", *CONT)
    out = K.knn_impute(d, CONT, "doc_id", 5)
    return out.select("doc_id", *[sr6(c).alias(c) for c in CONT])


@register("m04_mice_impute")
def m04(spark, sf_dir):
    d = _dw(spark, sf_dir).select("doc_id", *CONT)
    out, _ = M.mice_fit_transform(d, CONT, "doc_id")
    return out


@register("m04_mice_boosted")
def m04_boosted(spark, sf_dir):
    """A chain of boosted-tree regressors, saved, loaded and replayed on the same table."""
    import uuid
    from adlytics.operators import chain as CH
    from adlytics.session import scratch_path
    d = _dw(spark, sf_dir).select("doc_id", *CONT)
    fitted = CH.fit_chain(d, CONT, "doc_id", CH.boosted(maxIter=5, maxDepth=3), max_iter=2)
    path = fitted.save(spark, scratch_path(spark, f"chain-{uuid.uuid4().hex[:8]}"))
    return CH.FittedChain.load(spark, path).transform(d, "doc_id")


@register("m02_m05_mixed_with_fallback")
def m02(spark, sf_dir):
    """kNN and chained equations on the continuous columns, median on the flag; a table whose values
    cannot be read makes the imputation's job fail and falls back to the median."""
    d = _dw(spark, sf_dir).select("doc_id", "X4", *CONT)
    # no row of it is complete, so the chain has nothing to start from
    poor = d.withColumn("X1", F.when(F.col("doc_id") % 3 != 0, F.col("X1"))).withColumn("X2", F.when(F.col("doc_id") % 3 == 0, F.col("X2")))
    runs = [("knn", d, "knn"), ("mice", d, "mice"), ("mice, no complete row", poor, "mice")]
    out = None
    for name, table, method in runs:
        filled, status = M.impute_with_fallback(table, CONT, "doc_id", method, 5)
        filled = M.median_fill(filled, ["X4"]).withColumn("run", F.lit(name)).withColumn("status", F.lit(status))
        out = filled if out is None else out.unionByName(filled)
    return out


@register("m06_knn_k_search")
def m06(spark, sf_dir):
    return K.knn_k_search(_dw(spark, sf_dir).select("doc_id", *CONT), CONT, "doc_id", [1, 3, 5, 7, 9, 11], folds=5)


@register("m07_m08_quick_k")
def m07(spark, sf_dir):
    """The 70/30 table, and the k that imputation takes from it."""
    d = _dw(spark, sf_dir).select("doc_id", *CONT)
    return K.quick_k_table(d, CONT, "doc_id").withColumn("chosen", F.lit(K.quick_k(d, CONT, "doc_id")))


@register("m15_imputation_comparison")
def m15(spark, sf_dir):
    """Median, kNN and chained-equation variants compared: stats, quality score, KS test."""
    d = _dw(spark, sf_dir).select("doc_id", "y", *CONT)
    # each variant, and the scores, are read by several aggregates
    knn = cut_lineage(K.knn_impute(d, CONT, "doc_id", 5))
    mice, _ = M.mice_fit_transform(d, CONT, "doc_id")
    med = M.median_fill(d, CONT)
    v = knn.withColumn("variant", F.lit("knn")).unionByName(mice.withColumn("variant", F.lit("mice"))) \
        .unionByName(med.withColumn("variant", F.lit("median")))
    q = cut_lineage(M.variant_quality(v, CONT, "y"))
    ks = M.ks_two_sample(knn, mice, CONT).select("column", "d", "p_value")
    return q.join(M.recommend_variant(q), how="left").select("variant", "score", "rank", "best") \
        .unionByName(ks.select(F.col("column").alias("variant"), F.col("d").alias("score"),
                               F.lit(None).cast("int").alias("rank"), F.lit(None).cast("string").alias("best")))


# ------------------------------------------------------------------ T12-T15, D32, B1
def _split_dw(spark, sf_dir):
    from adlytics.operators.sampling import stratified_split
    d = _dw(spark, sf_dir)
    s = stratified_split(d.filter(F.col("y").isNotNull()), "doc_id", "y", (0.8, 0.2), ("train", "test"))
    test = s.filter(F.col("split") == "test").drop("split")
    return s.filter(F.col("split") == "train").drop("split"), test.unionByName(d.filter(F.col("y").isNull()))


@register("t12_t13_fit_on_train_apply_to_test")
def t12(spark, sf_dir):
    train, test = _split_dw(spark, sf_dir)
    _, prep = PP.fit_prep(train, "doc_id", "y", CONT, BIN, protected="X4", impute="median")
    return prep.transform(test)


@register("t13_library_order_with_outliers")
def t13(spark, sf_dir):
    """Power before imputation and an outlier step: training rows beyond the fences go, new rows only
    where the switch is on (O4)."""
    train, test = _split_dw(spark, sf_dir)
    out, prep = PP.fit_prep(train, "doc_id", "y", CONT, BIN, protected="X4", impute="median", cap=False, steps=PP.LIBRARY_STEPS)
    sizes = {"train before": train, "train after": out, "new, switch off": prep.transform(test),
             "new, switch on": prep.transform(test, remove_outliers=True)}
    parts = [d.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table", F.lit(k)) for k, d in sizes.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@register("t14_prepare_existing_table")
def t14(spark, sf_dir):
    out, _ = PP.fit_prep(_dw(spark, sf_dir), "doc_id", "y", CONT, BIN, protected="X4", impute="mice")
    return out


@register("t15_prepare_safe_preset")
def t15(spark, sf_dir):
    out, _, status = PP.prepare_safe(_dw(spark, sf_dir), "doc_id", "y", CONT, BIN, protected="X4")
    return out.withColumn("status", F.lit(status))


@register("d32_smoke_report")
def d32(spark, sf_dir):
    return PP.smoke_report(_dw(spark, sf_dir), "doc_id", "y", CONT, BIN, protected="X4")


@register("b01_frozen_preprocessing")
def b01(spark, sf_dir):
    """Fit (kNN imputation) on the training rows, save the parameters, reload, transform new rows."""
    import uuid
    from adlytics.session import scratch_path
    train, test = _split_dw(spark, sf_dir)
    _, prep = PP.fit_prep(train, "doc_id", "y", CONT, BIN, protected="X4", impute="knn", k=5)
    path = prep.save(spark, scratch_path(spark, f"prep-{uuid.uuid4().hex[:8]}"))
    return PP.FittedPrep.load(spark, path).transform(test.drop("y"))
