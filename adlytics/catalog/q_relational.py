"""Relational shapes over result tables (J1-J6, U1, W1-W4, A1-A5, L1-L2, Q1) with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlytics.catalog import tables as T
from adlytics.catalog.q_metrics import BY, BYS, F_SQL, _counts_sql, _dvo_sql, _PR_SQL, S
from adlytics.catalog.registry import register
from adlytics.catalog.sqlgen import r6
from adlytics.operators import metrics as E
from adlytics.operators import profile as P
from adlytics.operators import relational as J
from adlytics.operators import sampling as R

KEYS = [f"{m}_{i}" for i, m, *_ in [(i, m) for i, m, *_ in T.SCORE_MODELS]]


def _scores(spark, sf_dir):
    return T.scores(spark, sf_dir)


def _dvo(spark, sf_dir):
    return E.default_vs_optimised(_scores(spark, sf_dir), BY, tune_split="val", eval_split="test")


_DVO = _dvo_sql("val", "test")


@register("j01_wide_by_model", f"""WITH s AS {S}
SELECT id, {', '.join(f"max(CASE WHEN model || '_' || imputation = '{k}' THEN p END) AS {k}" for k in KEYS)}
FROM s GROUP BY id""")
def j01(spark, sf_dir):
    s = _scores(spark, sf_dir).withColumn("key", F.concat_ws("_", "model", "imputation"))
    return J.wide_by_key(s, "id", "key", "p", KEYS)


# Display names of the model families.
DISPLAY = [("gradboost", "Gradient Boosting"), ("randforest", "Random Forest"), ("svm", "SVM")]


@register("j02_lookup_with_default", f"""WITH x AS ({_DVO}),
d AS (SELECT * FROM (VALUES {', '.join(f"('{a}', '{b}')" for a, b in DISPLAY)}) AS d(model, display))
SELECT x.*, coalesce(display, 'other') AS display FROM x LEFT JOIN d USING (model)""")
def j02(spark, sf_dir):
    d = spark.createDataFrame(DISPLAY, "model string, display string")
    return J.lookup_with_default(_dvo(spark, sf_dir), d, "model", "display", "other")


@register("j03_missing_thresholds", f"""WITH s AS {S}, g AS (SELECT DISTINCT {BYS} FROM s),
t AS (SELECT DISTINCT {BYS} FROM s WHERE imputation = 'knn')
SELECT * FROM g WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.imputation = g.imputation AND t.version = g.version
  AND t.model = g.model)""")
def j03(spark, sf_dir):
    s = _scores(spark, sf_dir)
    th = E.exact_threshold_search(s.filter((F.col("split") == "val") & (F.col("imputation") == "knn")), BY)
    return E.missing_thresholds(s, th, BY)


_TEST_F1 = f"""m AS (SELECT {BYS}, {r6(F_SQL)} AS f1 FROM ({_counts_sql("(SELECT * FROM s WHERE split = 'test')", '0.5', BYS)}))"""


@register("j04_knn_vs_mice", f"""WITH s AS {S}, {_TEST_F1},
g AS (SELECT version, model, max(CASE WHEN imputation = 'knn' THEN f1 END) AS f1_knn,
  max(CASE WHEN imputation = 'mice' THEN f1 END) AS f1_mice FROM m GROUP BY 1, 2)
SELECT version, model, f1_knn, f1_mice, {r6('f1_knn - f1_mice')} AS diff,
  CASE WHEN f1_knn - f1_mice >= 0 THEN 'knn' ELSE 'mice' END AS winner FROM g""")
def j04(spark, sf_dir):
    m = E.metrics_at_threshold(_scores(spark, sf_dir).filter(F.col("split") == "test"), 0.5, BY)
    return J.compare_variants_per_model(m, ["version", "model"], "imputation", "knn", "mice")


@register("j05_shared_ids", """SELECT 1 AS id WHERE false""")
def j05(spark, sf_dir):
    sp = R.stratified_split(T.lineitem_nulls(spark, sf_dir).select("id", "y"), "id", "y")
    return J.shared_ids(sp.filter(F.col("split") == "train"), sp.filter(F.col("split") == "test"), "id") \
        .select(F.col("id").cast("int").alias("id"))


@register("j06_column_sets", f"""WITH a AS (SELECT column_name AS "column" FROM (DESCRIBE SELECT * FROM {T.LINEITEM_NULLS_SQL} x)),
b AS (SELECT column_name AS "column" FROM (DESCRIBE SELECT * FROM lineitem))
SELECT "column", 'both' AS side FROM a WHERE "column" IN (SELECT "column" FROM b)
UNION ALL SELECT "column", 'left_only' FROM a WHERE "column" NOT IN (SELECT "column" FROM b)
UNION ALL SELECT "column", 'right_only' FROM b WHERE "column" NOT IN (SELECT "column" FROM a)""")
def j06(spark, sf_dir):
    return J.column_sets(T.lineitem_nulls(spark, sf_dir), T.read(spark, sf_dir, "lineitem"))


@register("u01_union_tagged", f"""WITH s AS {S}
SELECT {BYS}, {r6(F_SQL)} AS f1, 'val' AS source FROM ({_counts_sql("(SELECT * FROM s WHERE split = 'val')", '0.5', BYS)})
UNION ALL SELECT {BYS}, {r6(F_SQL)}, 'test' FROM ({_counts_sql("(SELECT * FROM s WHERE split = 'test')", '0.5', BYS)})""")
def u01(spark, sf_dir):
    s = _scores(spark, sf_dir)
    parts = {k: E.metrics_at_threshold(s.filter(F.col("split") == k), 0.5, BY).select(*BY, "f1")
             for k in ("val", "test")}
    return J.union_tagged(parts, "source")


@register("w01_best_per_group", f"""WITH x AS ({_DVO})
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY imputation ORDER BY optimized_f1 DESC, model) AS rn
FROM x) WHERE rn = 1""")
def w01(spark, sf_dir):
    return J.best_per_group(_dvo(spark, sf_dir), ["imputation"], "optimized_f1", ["model"])


@register("w02_argmax_by", f"""WITH x AS ({_DVO})
SELECT imputation, arg_max(model, optimized_f1 * 1e6 - (SELECT count(*) FROM x x2 WHERE x2.imputation = x.imputation
  AND x2.model < x.model) * 1e-3) AS best_model, max(optimized_f1) AS best_optimized_f1 FROM x GROUP BY imputation""")
def w02(spark, sf_dir):
    return J.argmax_by(_dvo(spark, sf_dir), ["imputation"], "optimized_f1", "model", "model")


@register("w03_ranked", f"""WITH x AS ({_DVO})
SELECT *, row_number() OVER (ORDER BY optimized_f1 DESC, imputation, model) AS rank FROM x""")
def w03(spark, sf_dir):
    return J.ranked(_dvo(spark, sf_dir), "optimized_f1", ["imputation", "model"])


@register("w04_cumulative_counts", f"""WITH s AS {S}, v AS (SELECT * FROM s WHERE split = 'test'), {_PR_SQL}
SELECT {BYS}, threshold, tp, fp FROM pr""")
def w04(spark, sf_dir):
    return E.pr_points(_scores(spark, sf_dir).filter(F.col("split") == "test"), BY).select(*BY, "threshold", "tp", "fp")


@register("a01_group_stats_by_model", f"""WITH x AS ({_DVO})
SELECT model, {r6('avg(improvement)')} AS mean, {r6('stddev_samp(improvement)')} AS std, count(*) AS n FROM x GROUP BY model""")
def a01(spark, sf_dir):
    return J.group_stats(_dvo(spark, sf_dir), "model", "improvement")


@register("a02_pivot_improvement", f"""WITH x AS ({_DVO})
SELECT model, max(CASE WHEN imputation = 'knn' THEN improvement_pct END) AS knn,
  max(CASE WHEN imputation = 'mice' THEN improvement_pct END) AS mice FROM x GROUP BY model""")
def a02(spark, sf_dir):
    return E.metric_pivot(_dvo(spark, sf_dir), "model", "imputation", "improvement_pct", ["knn", "mice"])


@register("a04_default_vs_optimised_by_dataset", f"""WITH x AS ({_DVO})
SELECT imputation, {r6('avg(default_f1)')} AS mean_default_f1, {r6('avg(optimized_f1)')} AS mean_optimized_f1
FROM x GROUP BY imputation""")
def a04(spark, sf_dir):
    return _dvo(spark, sf_dir).groupBy("imputation").agg(E.r6(F.avg("default_f1")).alias("mean_default_f1"),
                                                         E.r6(F.avg("optimized_f1")).alias("mean_optimized_f1"))


@register("a05_threshold_histogram", f"""WITH x AS ({_DVO}), l AS (SELECT 'optimal_threshold' AS "column", optimal_threshold AS value FROM x),
rng AS (SELECT "column", CASE WHEN max(value) = min(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
  CASE WHEN max(value) = min(value) THEN max(value) + 0.5 ELSE max(value) END AS hi FROM l GROUP BY 1),
c AS (SELECT l."column", CAST(least(floor((value - lo) / ((hi - lo) / 5)), 4) AS INTEGER) AS bin, count(*) AS n
  FROM l JOIN rng USING ("column") GROUP BY 1, 2),
g AS (SELECT "column", lo, hi, CAST(unnest(range(0, 5)) AS INTEGER) AS bin FROM rng)
SELECT g."column", g.bin, {r6('lo + g.bin * ((hi - lo) / 5)')} AS lo, {r6('lo + (g.bin + 1) * ((hi - lo) / 5)')} AS hi,
  CAST(coalesce(n, 0) AS BIGINT) AS n FROM g LEFT JOIN c ON g."column" = c."column" AND g.bin = c.bin""")
def a05(spark, sf_dir):
    return P.histogram(_dvo(spark, sf_dir), ["optimal_threshold"], bins=5)


@register("l01_top_n", f"""WITH x AS ({_DVO}) SELECT * FROM x ORDER BY optimized_f1 DESC, imputation, model LIMIT 5""")
def l01(spark, sf_dir):
    return J.top_n(_dvo(spark, sf_dir), "optimized_f1", 5, ["imputation", "model"])


@register("l02_sort_by_absolute", f"""WITH x AS ({_DVO}) SELECT * FROM x ORDER BY abs(improvement) DESC, imputation, model LIMIT 5""")
def l02(spark, sf_dir):
    return J.top_n(_dvo(spark, sf_dir), "improvement", 5, ["imputation", "model"], absolute=True)


@register("q01_quick_stats", f"""WITH x AS ({_DVO})
SELECT {r6('max(optimized_f1)')} AS max, {r6('avg(optimized_f1)')} AS mean, {r6('max(optimized_f1) - min(optimized_f1)')} AS range,
  {r6('avg(CAST(abs(improvement) <= 0.03 AS DOUBLE))')} AS share_close FROM x""")
def q01(spark, sf_dir):
    return J.quick_stats(_dvo(spark, sf_dir), "optimized_f1", "improvement")
