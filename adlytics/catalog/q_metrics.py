"""Evaluation and threshold queries (E1-E22, W4) on the score table, with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlytics.catalog import tables as T
from adlytics.catalog.registry import register
from adlytics.catalog.sqlgen import r6
from adlytics.operators import metrics as E
from adlytics.session import cut_lineage

BY = ["imputation", "version", "model"]
BYS = ", ".join(BY)
S = T.scores_sql()


def _rates_sql(tp="tp", fp="fp", fn="fn"):
    return (f"CASE WHEN {tp} + {fp} = 0 THEN 0.0 ELSE CAST({tp} AS DOUBLE) / ({tp} + {fp}) END",
            f"CASE WHEN {tp} + {fn} = 0 THEN 0.0 ELSE CAST({tp} AS DOUBLE) / ({tp} + {fn}) END",
            f"CASE WHEN 2 * {tp} + {fp} + {fn} = 0 THEN 0.0 ELSE CAST(2 * {tp} AS DOUBLE) / (2 * {tp} + {fp} + {fn}) END")


P_SQL, R_SQL, F_SQL = _rates_sql()


def _counts_sql(src, t, by):
    return f"""SELECT {by}, count_if(p >= {t} AND y = 1) AS tp, count_if(p >= {t} AND y = 0) AS fp,
  count_if(p < {t} AND y = 1) AS fn, count_if(p < {t} AND y = 0) AS tn FROM {src} GROUP BY {by}"""


def _scores(spark, sf_dir, split=None):
    s = T.scores(spark, sf_dir)
    return s if split is None else s.filter(F.col("split") == split)


# ------------------------------------------------------------------ E1
@register("e01_metrics_at_threshold", f"""WITH s AS {S}, c AS ({_counts_sql('s', '0.5', 'split, ' + BYS)})
SELECT split, {BYS}, 0.5 AS threshold, tp, fp, fn, tn, {r6(P_SQL)} AS precision, {r6(R_SQL)} AS recall,
  {r6(F_SQL)} AS f1, {r6('CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn)')} AS accuracy FROM c""")
def e01(spark, sf_dir):
    return E.metrics_at_threshold(_scores(spark, sf_dir), 0.5, ["split"] + BY)


# ------------------------------------------------------------------ E2 (brute-force oracle)
def _grid_curve_sql(src, lo, hi):
    return f"""g AS (SELECT CAST(i AS DOUBLE) / CAST(100 AS DOUBLE) AS threshold FROM range({lo}, {hi + 1}) r(i)),
cc AS (SELECT {BYS}, threshold, count_if(p >= threshold AND y = 1) AS tp, count_if(p >= threshold AND y = 0) AS fp,
  count_if(p < threshold AND y = 1) AS fn FROM {src}, g GROUP BY {BYS}, threshold),
cur AS (SELECT {BYS}, threshold, tp, fp, fn, {r6(P_SQL)} AS precision, {r6(R_SQL)} AS recall, {r6(F_SQL)} AS f1 FROM cc)"""


def _best_sql(src, metric="f1", by=BYS):
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {metric} DESC, threshold)
  AS rn FROM {src}) WHERE rn = 1"""


@register("e02_grid_threshold_search", f"""WITH s AS {S}, v AS (SELECT * FROM s WHERE split = 'val'),
{_grid_curve_sql('v', 1, 99)}
SELECT {BYS}, threshold, f1, precision, recall FROM ({_best_sql('cur')})""")
def e02(spark, sf_dir):
    return E.grid_threshold_search(_scores(spark, sf_dir, "val"), BY)


@register("e02_grid_search_20_80", f"""WITH s AS {S}, v AS (SELECT * FROM s WHERE split = 'val'),
{_grid_curve_sql('v', 20, 80)}
SELECT {BYS}, threshold, f1, precision, recall FROM ({_best_sql('cur')})""")
def e02b(spark, sf_dir):
    return E.grid_threshold_search(_scores(spark, sf_dir, "val"), BY, lo=20, hi=80)


@register("e02_threshold_curve", f"""WITH s AS {S}, v AS (SELECT * FROM s WHERE split = 'val'),
{_grid_curve_sql('v', 1, 99)}
SELECT * FROM cur""")
def e02c(spark, sf_dir):
    return E.threshold_curve(_scores(spark, sf_dir, "val"), BY)


@register("e02_grid_search_precision", f"""WITH s AS {S}, v AS (SELECT * FROM s WHERE split = 'val'),
{_grid_curve_sql('v', 1, 99)}
SELECT {BYS}, threshold, f1, precision, recall FROM ({_best_sql('cur', 'precision')})""")
def e02d(spark, sf_dir):
    return E.grid_threshold_search(_scores(spark, sf_dir, "val"), BY, metric="precision")


# ------------------------------------------------------------------ E3, E5, E6, E10, E9
_PR_SQL = f"""g AS (SELECT {BYS}, p AS s, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM v GROUP BY {BYS}, p),
cum AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY {BYS}) AS "P",
  sum(neg) OVER (PARTITION BY {BYS}) AS "N"
  FROM g WINDOW w AS (PARTITION BY {BYS} ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
pr AS (SELECT {BYS}, s AS threshold, tp, fp, "P", "N",
  CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
  CASE WHEN "P" = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / "P" END AS recall FROM cum)"""

_EXACT_SQL = f"""WITH s AS {S}, v AS (SELECT * FROM s WHERE split = 'val'), {_PR_SQL},
f AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-9) AS f1 FROM pr)
SELECT {BYS}, {r6('threshold')} AS threshold, {r6('f1')} AS f1, {r6('precision')} AS precision,
  {r6('recall')} AS recall FROM ({_best_sql('f')})"""


@register("e03_exact_threshold_search", _EXACT_SQL)
def e03(spark, sf_dir):
    return E.exact_threshold_search(_scores(spark, sf_dir, "val"), BY)


@register("e05_optimize_multiple_ranked", f"""WITH x AS ({_EXACT_SQL})
SELECT *, row_number() OVER (ORDER BY f1 DESC, imputation, version, model) AS rank FROM x""")
def e05(spark, sf_dir):
    from pyspark.sql import Window
    b = E.exact_threshold_search(_scores(spark, sf_dir, "val"), BY)
    return b.withColumn("rank", F.row_number().over(Window.orderBy(F.col("f1").desc(), *BY)))


@register("e10_pr_points", f"""WITH s AS {S}, v AS (SELECT * FROM s WHERE split = 'test'), {_PR_SQL}
SELECT {BYS}, threshold, tp, fp, "P", "N", {r6('precision')} AS precision, {r6('recall')} AS recall FROM pr""")
def e10(spark, sf_dir):
    pts = E.pr_points(_scores(spark, sf_dir, "test"), BY)
    return pts.select(*BY, "threshold", "tp", "fp", "P", "N", E.r6("precision").alias("precision"),
                      E.r6("recall").alias("recall"))


@register("e09_roc_points", f"""WITH s AS {S}, v AS (SELECT * FROM s WHERE split = 'test'), {_PR_SQL}
SELECT {BYS}, threshold, {r6('CASE WHEN "N" = 0 THEN 0.0 ELSE CAST(fp AS DOUBLE) / "N" END')} AS fpr,
  {r6('CASE WHEN "P" = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / "P" END')} AS tpr FROM pr""")
def e09(spark, sf_dir):
    return E.roc_points(_scores(spark, sf_dir, "test"), BY)


_AUC_SQL = f"""g AS (SELECT split, {BYS}, p, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM s GROUP BY split, {BYS}, p),
c AS (SELECT *, sum(neg) OVER (PARTITION BY split, {BYS} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  AS cneg FROM g),
auc AS (SELECT split, {BYS}, {r6('sum(pos * (cneg - neg * 0.5)) / (sum(pos) * sum(neg))')} AS auc
  FROM c GROUP BY split, {BYS})"""


@register("e08_auc", f"WITH s AS {S}, {_AUC_SQL} SELECT * FROM auc")
def e08(spark, sf_dir):
    return E.auc(_scores(spark, sf_dir), ["split"] + BY)


@register("e09_roc_trapezoid_auc", f"""WITH s AS {S}, v AS (SELECT * FROM s WHERE split = 'test'), {_PR_SQL},
pts AS (SELECT {BYS}, CAST(fp AS DOUBLE) / "N" AS fpr, CAST(tp AS DOUBLE) / "P" AS tpr FROM pr),
l AS (SELECT *, coalesce(lag(fpr) OVER w, 0.0) AS fpr0, coalesce(lag(tpr) OVER w, 0.0) AS tpr0
  FROM pts WINDOW w AS (PARTITION BY {BYS} ORDER BY fpr, tpr))
SELECT {BYS}, {r6('sum((fpr - fpr0) * (tpr + tpr0) / 2)')} AS auc_trapezoid FROM l GROUP BY {BYS}""")
def e09b(spark, sf_dir):
    return E.roc_trapezoid_auc(_scores(spark, sf_dir, "test"), BY)


# ------------------------------------------------------------------ E11, E12, E22
@register("e11_confusion_matrix", f"""WITH s AS {S}, c AS ({_counts_sql("(SELECT * FROM s WHERE split = 'test')", '0.5', BYS)})
SELECT {BYS}, a AS actual, pr AS predicted, n FROM c,
  LATERAL (VALUES (1, 1, tp), (0, 1, fp), (1, 0, fn), (0, 0, tn)) AS v(a, pr, n)""")
def e11(spark, sf_dir):
    return E.confusion_matrix(_scores(spark, sf_dir, "test"), 0.5, BY)


_P0, _R0, _F0 = _rates_sql("tn", "fn", "fp")
_REPORT_SQL = f"""WITH s AS {S}, c AS ({_counts_sql("(SELECT * FROM s WHERE split = 'test')", '0.5', BYS)}),
m AS (SELECT *, {P_SQL} AS p1, {R_SQL} AS r1, {F_SQL} AS f1, {_P0} AS p0, {_R0} AS r0, {_F0} AS f0,
  tp + fn AS s1, tn + fp AS s0 FROM c)
SELECT {BYS}, cls AS class, {r6('pp')} AS precision, {r6('rr')} AS recall, {r6('ff')} AS f1, sup AS support FROM m,
  LATERAL (VALUES ('0', p0, r0, f0, s0), ('1', p1, r1, f1, s1),
    ('macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1),
    ('weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
     (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1)) AS v(cls, pp, rr, ff, sup)"""


@register("e12_classification_report", _REPORT_SQL)
def e12(spark, sf_dir):
    return E.classification_report(_scores(spark, sf_dir, "test"), 0.5, BY)


@register("e22_model_performance", f"""WITH s AS {S}, c AS ({_counts_sql("(SELECT * FROM s WHERE split = 'test')", '0.5', BYS)})
SELECT {BYS}, item, value FROM c, LATERAL (VALUES ('tp', CAST(tp AS DOUBLE)), ('fp', CAST(fp AS DOUBLE)),
  ('fn', CAST(fn AS DOUBLE)), ('tn', CAST(tn AS DOUBLE)), ('precision', {r6(P_SQL)}), ('recall', {r6(R_SQL)}),
  ('f1', {r6(F_SQL)})) AS v(item, value)""")
def e22(spark, sf_dir):
    m = E.metrics_at_threshold(_scores(spark, sf_dir, "test"), 0.5, BY)
    items = ["tp", "fp", "fn", "tn", "precision", "recall", "f1"]
    return m.select(*BY, F.explode(F.array(*[F.struct(F.lit(i).alias("item"), F.col(i).cast("double").alias("value"))
                                             for i in items])).alias("v")).select(*BY, "v.*")


# ------------------------------------------------------------------ E4, E7, E19, E21
def _dvo_sql(tune, ev):
    return f"""WITH s AS {S}, v AS (SELECT * FROM s WHERE split = '{tune}'), e AS (SELECT * FROM s WHERE split = '{ev}'),
{_grid_curve_sql('v', 1, 99)},
b AS (SELECT {BYS}, threshold AS optimal_threshold FROM ({_best_sql('cur')})),
d AS (SELECT {BYS}, {r6(F_SQL)} AS default_f1 FROM ({_counts_sql('e', '0.5', BYS)})),
o AS (SELECT {BYS}, {r6(F_SQL)} AS optimized_f1 FROM (SELECT {BYS}, count_if(p >= optimal_threshold AND y = 1) AS tp,
  count_if(p >= optimal_threshold AND y = 0) AS fp, count_if(p < optimal_threshold AND y = 1) AS fn
  FROM e JOIN b USING ({BYS}) GROUP BY {BYS}))
SELECT {BYS}, optimal_threshold, default_f1, optimized_f1, {r6('optimized_f1 - default_f1')} AS improvement,
  {r6('CASE WHEN default_f1 > 0 THEN (optimized_f1 - default_f1) * 100.0 / default_f1 ELSE 0.0 END')} AS improvement_pct
FROM b JOIN d USING ({BYS}) JOIN o USING ({BYS})"""


@register("e04_default_vs_optimised", _dvo_sql("val", "val"))
def e04(spark, sf_dir):
    return E.default_vs_optimised(_scores(spark, sf_dir), BY, tune_split="val")


@register("e07_tune_val_report_test", _dvo_sql("val", "test"))
def e07(spark, sf_dir):
    return E.default_vs_optimised(_scores(spark, sf_dir), BY, tune_split="val", eval_split="test")


@register("e19_optimisation_analysis", f"""WITH x AS ({_dvo_sql("val", "test")})
SELECT imputation AS dataset, {r6('avg(improvement)')} AS mean_improvement, {r6('stddev_samp(improvement)')} AS std_improvement,
  count(*) AS n, {r6('avg(optimal_threshold)')} AS mean_threshold, count_if(improvement > 0) AS n_improved,
  count_if(improvement < 0) AS n_degraded, count_if(improvement = 0) AS n_unchanged,
  {r6('avg(CAST(improvement > 0 AS DOUBLE)) * 100')} AS pct_improved FROM x GROUP BY imputation""")
def e19(spark, sf_dir):
    c = E.default_vs_optimised(_scores(spark, sf_dir), BY, tune_split="val", eval_split="test")
    return E.optimisation_analysis(c.withColumnRenamed("imputation", "dataset"), "dataset")


@register("e21_best_method", f"""WITH x AS ({_dvo_sql("val", "test")})
SELECT arg_max(imputation || '/' || model, optimized_f1 * 1e6 - rank_key) AS best, max(optimized_f1) AS best_f1
FROM (SELECT *, row_number() OVER (ORDER BY imputation, version, model) * 1e-9 AS rank_key FROM x)""")
def e21(spark, sf_dir):
    c = E.default_vs_optimised(_scores(spark, sf_dir), BY, tune_split="val", eval_split="test")
    return c.agg(F.min_by(F.concat_ws("/", "imputation", "model"),
                          F.struct(-F.col("optimized_f1"), *[F.col(k) for k in BY])).alias("best"),
                 F.max("optimized_f1").alias("best_f1"))


# ------------------------------------------------------------------ E13-E18, E20
_THR_SQL = f"""th AS (SELECT {BYS}, threshold FROM ({_EXACT_SQL}))"""

_EVAL_SQL = f"""WITH {_THR_SQL}, s AS {S}, t AS (SELECT * FROM s WHERE split = 'test'),
cm AS (SELECT {BYS}, count_if(p >= threshold AND y = 1) AS tp, count_if(p >= threshold AND y = 0) AS fp,
  count_if(p < threshold AND y = 1) AS fn FROM t JOIN th USING ({BYS}) GROUP BY {BYS}),
{_AUC_SQL.replace('FROM s GROUP BY', 'FROM t GROUP BY')}
SELECT {BYS}, threshold, {r6(F_SQL)} AS f1, {r6(P_SQL)} AS precision, {r6(R_SQL)} AS recall, auc
FROM cm JOIN th USING ({BYS}) JOIN auc USING ({BYS})"""


def _eval(spark, sf_dir):
    s = _scores(spark, sf_dir)
    th = E.exact_threshold_search(s.filter(F.col("split") == "val"), BY)
    return E.evaluate_at_thresholds(s, th, BY, split="test")


@register("e13_evaluate_at_saved_thresholds", _EVAL_SQL)
def e13(spark, sf_dir):
    return _eval(spark, sf_dir)


@register("e14_val_test_gap", f"""WITH {_THR_SQL}, s AS {S},
m AS (SELECT split, {BYS}, {r6(F_SQL)} AS f1 FROM (SELECT split, {BYS}, count_if(p >= threshold AND y = 1) AS tp,
  count_if(p >= threshold AND y = 0) AS fp, count_if(p < threshold AND y = 1) AS fn
  FROM s JOIN th USING ({BYS}) WHERE split IN ('val', 'test') GROUP BY split, {BYS}))
SELECT {BYS}, v.f1 AS val_f1, t.f1 AS test_f1, {r6('v.f1 - t.f1')} AS gap,
  CASE WHEN abs(v.f1 - t.f1) < 0.03 THEN 'stable' WHEN abs(v.f1 - t.f1) <= 0.05 THEN 'watch' ELSE 'overfit' END AS band
FROM (SELECT * FROM m WHERE split = 'val') v JOIN (SELECT * FROM m WHERE split = 'test') t USING ({BYS})""")
def e14(spark, sf_dir):
    s = _scores(spark, sf_dir)
    th = E.exact_threshold_search(s.filter(F.col("split") == "val"), BY)
    j = E.with_thresholds(s, cut_lineage(th.select(*BY, "threshold")), BY)
    val = E.metrics_at_threshold(j.filter(F.col("split") == "val"), "threshold", BY)
    test = E.metrics_at_threshold(j.filter(F.col("split") == "test"), "threshold", BY)
    return E.val_test_gap(val, test, BY)


@register("e15_champion", f"""WITH x AS ({_EVAL_SQL}),
r AS (SELECT *, row_number() OVER (ORDER BY f1 DESC, imputation, version, model) AS rank, count(*) OVER () AS total FROM x)
SELECT * FROM r WHERE rank = 1""")
def e15(spark, sf_dir):
    return E.champion(_eval(spark, sf_dir), "f1", BY)


@register("e16_best_of_two", f"""WITH x AS ({_EVAL_SQL}),
b AS (SELECT imputation, max(f1) AS score FROM x GROUP BY imputation)
SELECT arg_min(imputation, CASE WHEN imputation = 'knn' THEN 0 ELSE 1 END - score * 10) AS choice,
  max(score) AS score FROM b""")
def e16(spark, sf_dir):
    x = cut_lineage(_eval(spark, sf_dir).groupBy("imputation").agg(F.max("f1").alias("f1")))
    best = lambda i: x.filter(F.col("imputation") == i).agg(F.max("f1").alias("f1"))
    return E.best_of_two(best("knn"), best("mice"))


# The six candidate (imputation, model) pairs of the final synthesis.
CANDIDATES = [("knn", "full", "gradboost"), ("knn", "full", "randforest"), ("knn", "full", "stacking"),
              ("mice", "full", "gradboost"), ("mice", "full", "svm"), ("mice", "full", "stacking")]


@register("e17_final_synthesis", f"""WITH x AS ({_EVAL_SQL}),
c AS (SELECT * FROM (VALUES {', '.join(f"('{a}', '{b}', '{m}')" for a, b, m in CANDIDATES)}) AS c({BYS}))
SELECT {BYS}, coalesce(f1, 0.0) AS f1, coalesce(precision, 0.0) AS precision, coalesce(recall, 0.0) AS recall,
  coalesce(threshold, 0.0) AS threshold FROM c LEFT JOIN x USING ({BYS})""")
def e17(spark, sf_dir):
    cands = spark.createDataFrame(CANDIDATES, "imputation string, version string, model string")
    return E.final_synthesis(cands, _eval(spark, sf_dir), BY)


@register("e18_f1_by_model_imputation", f"""WITH s AS {S}, c AS ({_counts_sql("(SELECT * FROM s WHERE split = 'test')", '0.5', 'model, imputation')}),
m AS (SELECT model, imputation, {r6(F_SQL)} AS f1 FROM c)
SELECT model, max(CASE WHEN imputation = 'knn' THEN f1 END) AS knn, max(CASE WHEN imputation = 'mice' THEN f1 END) AS mice
FROM m GROUP BY model""")
def e18(spark, sf_dir):
    m = E.metrics_at_threshold(_scores(spark, sf_dir, "test"), 0.5, ["model", "imputation"])
    return E.metric_pivot(m, "model", "imputation", "f1", ["knn", "mice"])


@register("e20_agreement_rate", f"""WITH s AS {S},
a AS (SELECT id, CAST(p >= 0.5 AS INT) AS pa FROM s WHERE model = 'gradboost' AND imputation = 'knn'),
b AS (SELECT id, CAST(p >= 0.5 AS INT) AS pb FROM s WHERE model = 'gradboost' AND imputation = 'mice')
SELECT count(*) AS n, count_if(pa = pb) AS n_agree, {r6('count_if(pa = pb) * 1.0 / count(*)')} AS agreement
FROM a JOIN b USING (id)""")
def e20(spark, sf_dir):
    s = _scores(spark, sf_dir).withColumn("pred", (F.col("p") >= 0.5).cast("int"))
    pick = lambda i: s.filter((F.col("model") == "gradboost") & (F.col("imputation") == i))
    return E.agreement_rate(pick("knn"), pick("mice"), "id", "pred")
