"""Outlier (O1-O8) and missing-data (M1, M9-M14) queries with DuckDB oracles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from adlytics.catalog import tables as T
from adlytics.catalog.registry import register
from adlytics.catalog.sqlgen import melt_sql, r6, significant
from adlytics.functions.exprs import HASH_MOD, portable_hash_sql, portable_unit
from adlytics.operators import missing as M
from adlytics.operators import outliers as O

LN = T.LINEITEM_NULLS_SQL
LNF = T.LINE_FEATURES
LN_ALL = ["id", "y", "l_returnflag"] + LNF


def _q_sql(src, cols, lo=0.25, hi=0.75, m=1.5):
    """One row of fences a_c (Q1), b_c (Q3), lo_c, hi_c."""
    parts = []
    for c in cols:
        parts.append(f"quantile_cont({c}, {lo}) AS a_{c}, quantile_cont({c}, {hi}) AS b_{c}")
    return f"(SELECT {', '.join(parts)} FROM {src})"


def _lo(c, m=1.5):
    return f"(a_{c} - {m} * (b_{c} - a_{c}))"


def _hi(c, m=1.5):
    return f"(b_{c} + {m} * (b_{c} - a_{c}))"


def _cap_expr(c, lo, hi):
    return f"CASE WHEN {c} > {hi} THEN {hi} WHEN {c} < {lo} THEN {lo} ELSE {c} END"


# ------------------------------------------------------------------ O1, O2, O3, O8
@register("o01_outlier_flags", f"""WITH ln AS {LN}, q AS {_q_sql('ln', LNF)}
SELECT id, y, {', '.join(f'coalesce({c} < {_lo(c)} OR {c} > {_hi(c)}, false) AS {c}_outlier' for c in LNF)}
FROM ln, q""")
def o01(spark, sf_dir):
    ln = T.lineitem_nulls(spark, sf_dir)
    return O.outlier_flags(ln, O.iqr_bounds(ln, LNF)).select("id", "y", *[f"{c}_outlier" for c in LNF])


@register("o02_outlier_report", f"""WITH ln AS {LN}, q AS {_q_sql('ln', LNF)}
{' UNION ALL '.join(f"SELECT '{c}' AS \"column\", {r6(_lo(c))} AS lower, {r6(_hi(c))} AS upper, count_if({c} < {_lo(c)} OR {c} > {_hi(c)}) AS n_outliers, {r6(f'count_if({c} < {_lo(c)} OR {c} > {_hi(c)}) * 100.0 / count({c})')} AS pct_outliers FROM ln, q GROUP BY {_lo(c)}, {_hi(c)}" for c in LNF)}""")
def o02(spark, sf_dir):
    return O.outlier_report(T.lineitem_nulls(spark, sf_dir), LNF)


_KEEP_COLS = ["l_quantity", "l_extendedprice", "price_unit"]
_REMOVE_SQL = f"""WITH ln AS {LN}, q AS {_q_sql('ln', _KEEP_COLS)}
SELECT ln.* FROM ln, q WHERE {' AND '.join(f'coalesce({c} BETWEEN {_lo(c)} AND {_hi(c)}, false)' for c in _KEEP_COLS)}"""


@register("o03_remove_outliers", _REMOVE_SQL)
def o03(spark, sf_dir):
    return O.remove_outliers(T.lineitem_nulls(spark, sf_dir), _KEEP_COLS)


@register("o08_removal_impact", f"""WITH a AS (SELECT count(*) AS rb, count_if(y = 1) AS pb FROM {LN} x),
b AS (SELECT count(*) AS ra, count_if(y = 1) AS pa FROM ({_REMOVE_SQL}))
SELECT rb AS rows_before, ra AS rows_after, pb AS pos_before, pa AS pos_after,
  {r6('100.0 * (rb - ra) / rb')} AS rows_lost_pct, {r6('100.0 * (pb - pa) / pb')} AS pos_lost_pct FROM a, b""")
def o08(spark, sf_dir):
    ln = T.lineitem_nulls(spark, sf_dir)
    return O.removal_impact(ln, O.remove_outliers(ln, _KEEP_COLS), "y")


# ------------------------------------------------------------------ O5, O6, O7
_CAP_SQL = f"""WITH ln AS {LN}, q AS {_q_sql('ln', LNF)}
SELECT id, y, l_returnflag, {', '.join(_cap_expr(c, _lo(c), _hi(c)) + f' AS {c}' for c in LNF)} FROM ln, q"""


@register("o05_cap_iqr", _CAP_SQL)
def o05(spark, sf_dir):
    ln = T.lineitem_nulls(spark, sf_dir)
    return O.cap(ln, O.iqr_bounds(ln, LNF))


@register("o05_cap_report", f"""WITH ln AS {LN}, q AS {_q_sql('ln', LNF)}
{' UNION ALL '.join(f"SELECT '{c}' AS \"column\", {r6(_lo(c))} AS lower, {r6(_hi(c))} AS upper, count_if({c} < {_lo(c)}) AS n_low, count_if({c} > {_hi(c)}) AS n_high FROM ln, q GROUP BY {_lo(c)}, {_hi(c)}" for c in LNF)}""")
def o05r(spark, sf_dir):
    ln = T.lineitem_nulls(spark, sf_dir)
    return O.cap_report(ln, O.iqr_bounds(ln, LNF))


_TRAIN = f"{portable_hash_sql('id')} / {float(HASH_MOD)} < 0.8"


@register("o06_apply_saved_bounds", f"""WITH ln AS {LN}, q AS {_q_sql(f'(SELECT * FROM ln WHERE {_TRAIN})', LNF)}
SELECT id, y, l_returnflag, {', '.join(_cap_expr(c, _lo(c), _hi(c)) + f' AS {c}' for c in LNF)}
FROM ln, q WHERE NOT ({_TRAIN})""")
def o06(spark, sf_dir):
    ln = T.lineitem_nulls(spark, sf_dir)
    u = portable_unit("id", 42)
    bounds = O.iqr_bounds(ln.filter(u < 0.8), LNF)
    return O.cap(ln.filter(~(u < 0.8)), bounds)


@register("o07_percentile_cap", f"""WITH ln AS {LN}, q AS {_q_sql('ln', LNF, 0.01, 0.99)}
SELECT id, y, l_returnflag, {', '.join(_cap_expr(c, f'a_{c}', f'b_{c}') + f' AS {c}' for c in LNF)} FROM ln, q""")
def o07(spark, sf_dir):
    ln = T.lineitem_nulls(spark, sf_dir)
    return O.cap(ln, O.percentile_bounds(ln, LNF, 0.01, 0.99))


# ------------------------------------------------------------------ M1, M9
_MED = f"(SELECT {', '.join(f'quantile_cont({c}, 0.5) AS m_{c}' for c in LNF)} FROM ln)"
_FILLED_SQL = f"""SELECT id, y, l_returnflag, {', '.join(f'coalesce({c}, m_{c}) AS {c}' for c in LNF)} FROM ln, {_MED} med"""


@register("m01_median_fill", f"WITH ln AS {LN} {_FILLED_SQL}")
def m01(spark, sf_dir):
    return M.median_fill(T.lineitem_nulls(spark, sf_dir), LNF)


@register("m09_route_by_null_rate", f"""WITH ln AS {LN}
{' UNION ALL '.join(f"SELECT '{c}' AS \"column\", {r6(f'avg(CAST({c} IS NULL AS DOUBLE))')} AS null_rate, CASE WHEN avg(CAST({c} IS NULL AS DOUBLE)) > 0.3 THEN 'drop' WHEN avg(CAST({c} IS NULL AS DOUBLE)) > 0.05 THEN 'knn' ELSE 'median' END AS action FROM ln" for c in LNF)}""")
def m09(spark, sf_dir):
    return M.route_by_null_rate(T.lineitem_nulls(spark, sf_dir), LNF)


_M9 = " , ".join(f"avg(CAST({c} IS NULL AS DOUBLE)) AS n_{c}, avg({c}) AS a_{c}, quantile_cont({c}, 0.5) AS m_{c}" for c in LNF)


@register("m09_conditional_impute", f"""WITH ln AS {LN}, q AS (SELECT {_M9} FROM ln)
SELECT id, y, l_returnflag, {', '.join(f'coalesce({c}, CASE WHEN n_{c} > 0.05 THEN a_{c} ELSE m_{c} END) AS {c}' for c in LNF if c not in ('l_discount', 'price_unit'))}
FROM ln, q WHERE n_l_discount > 0.3 AND n_price_unit > 0.3""")
def m09c(spark, sf_dir):
    return M.conditional_impute(T.lineitem_nulls(spark, sf_dir), LNF)


# ------------------------------------------------------------------ M10-M14: variants
def _variants(spark, sf_dir):
    ln = T.lineitem_nulls(spark, sf_dir)
    med = M.median_fill(ln, LNF)
    capped = O.cap(med, O.iqr_bounds(med, LNF))
    trimmed = O.remove_outliers(med, _KEEP_COLS)
    tag = lambda d, n: d.select(F.lit(n).alias("variant"), *LN_ALL)
    return reduce(lambda a, b: a.unionByName(b),
                  [tag(ln, "raw"), tag(med, "median"), tag(capped, "median_capped"), tag(trimmed, "median_trimmed")])


_VARIANTS_SQL = f"""ln AS {LN}, med AS ({_FILLED_SQL}),
mq AS {_q_sql('med', LNF)},
capped AS (SELECT id, y, l_returnflag, {', '.join(_cap_expr(c, _lo(c), _hi(c)) + f' AS {c}' for c in LNF)} FROM med, mq),
tq AS {_q_sql('med', _KEEP_COLS)},
trimmed AS (SELECT med.* FROM med, tq WHERE {' AND '.join(f'coalesce({c} BETWEEN {_lo(c)} AND {_hi(c)}, false)' for c in _KEEP_COLS)}),
v AS (SELECT 'raw' AS variant, * FROM ln UNION ALL SELECT 'median', * FROM med
      UNION ALL SELECT 'median_capped', * FROM capped UNION ALL SELECT 'median_trimmed', * FROM trimmed)"""


@register("m10_compare_variants", f"""WITH {_VARIANTS_SQL},
s AS (SELECT variant, "column", count(*) AS n_rows, count_if(value IS NULL) AS n_null, {significant('avg(value)')} AS mean,
  {significant('stddev_samp(value)')} AS std, {r6('min(value)')} AS min, {r6('max(value)')} AS max
  FROM {melt_sql('v', LNF, ['variant'])} GROUP BY 1, 2),
c AS (SELECT variant, count_if(y = 0) AS n0, count_if(y = 1) AS n1 FROM v GROUP BY 1)
SELECT s.*, n0, n1, {r6('CAST(n0 AS DOUBLE) / n1')} AS imbalance FROM s JOIN c USING (variant)""")
def m10(spark, sf_dir):
    return M.compare_variants(_variants(spark, sf_dir), LNF, "y")


_QUALITY_SQL = f"""WITH {_VARIANTS_SQL},
nl AS (SELECT variant, count_if(value IS NULL) * 1.0 / count(*) AS null_share FROM {melt_sql('v', LNF, ['variant'])} GROUP BY 1),
cv AS (SELECT variant, avg(cv) AS mean_cv FROM (SELECT variant, "column",
  coalesce(CASE WHEN avg(value) = 0 THEN NULL ELSE stddev_samp(value) / abs(avg(value)) END, 1.0) AS cv
  FROM {melt_sql('v', _KEEP_COLS, ['variant'])} GROUP BY 1, 2) GROUP BY 1),
cl AS (SELECT variant, count(*) AS rows, CAST(count_if(y = 0) AS DOUBLE) / greatest(count_if(y = 1), 1) AS ratio FROM v GROUP BY 1),
t AS (SELECT * FROM nl JOIN cv USING (variant) JOIN cl USING (variant)),
r AS (SELECT *, max(rows) OVER () AS ref_rows, arg_max(ratio, rows * 1000 + (CASE variant WHEN 'raw' THEN 4 WHEN 'median_trimmed' THEN 3 WHEN 'median_capped' THEN 2 ELSE 1 END)) OVER () AS ref_ratio FROM t),
s AS (SELECT variant, (1 - null_share) * 20 AS c1, rows / CAST(ref_rows AS DOUBLE) * 25 AS c2,
  greatest(0.0, 25 * (1 - abs(ratio - ref_ratio) / ref_ratio)) AS c3, greatest(0.0, 30 * (1 - least(mean_cv, 1.0))) AS c4 FROM r)
SELECT variant, {r6('c1')} AS completeness, {r6('c2')} AS retention, {r6('c3')} AS ratio_preservation,
  {r6('c4')} AS stability, {r6('c1 + c2 + c3 + c4')} AS score,
  row_number() OVER (ORDER BY {r6('c1 + c2 + c3 + c4')} DESC, variant) AS rank FROM s"""


@register("m12_variant_quality", _QUALITY_SQL)
def m12(spark, sf_dir):
    return M.variant_quality(_variants(spark, sf_dir), LNF, "y", stability_cols=_KEEP_COLS)


@register("m13_recommend_variant", f"""WITH q AS ({_QUALITY_SQL})
SELECT arg_min(variant, rank) AS best, max(score) AS best_score FROM q""")
def m13(spark, sf_dir):
    return M.recommend_variant(M.variant_quality(_variants(spark, sf_dir), LNF, "y", stability_cols=_KEEP_COLS))


@register("m14_variant_balance", f"""WITH {_VARIANTS_SQL}, t AS (SELECT variant, count(*) AS rows, count_if(y = 1) AS positives FROM v GROUP BY 1)
SELECT variant, rows, positives, {r6('CAST(positives AS DOUBLE) / rows')} AS target_ratio,
  {r6('rows * 100.0 / max(rows) OVER ()')} AS retention_pct FROM t""")
def m14(spark, sf_dir):
    return M.variant_balance(_variants(spark, sf_dir), "y")


def _ks_p(lam):
    terms = " + ".join(f"{2.0 * (-1) ** (j - 1)} * exp({-2.0 * j * j} * {lam} * {lam})"
                       for j in range(1, M.KS_TERMS + 1))
    return f"CASE WHEN {lam} < {M.KS_SMALL} THEN 1.0 ELSE least(1.0, greatest(0.0, {terms})) END"


@register("m11_ks_two_sample", f"""WITH {_VARIANTS_SQL},
a AS (SELECT "column", value, 1 AS ca, 0 AS cb FROM {melt_sql("(SELECT * FROM v WHERE variant = 'raw')", LNF)} WHERE value IS NOT NULL
  UNION ALL SELECT "column", value, 0, 1 FROM {melt_sql("(SELECT * FROM v WHERE variant = 'median_capped')", LNF)} WHERE value IS NOT NULL),
g AS (SELECT "column", value, sum(ca) AS ca, sum(cb) AS cb FROM a GROUP BY 1, 2),
c AS (SELECT *, sum(ca) OVER w AS cum_a, sum(cb) OVER w AS cum_b, sum(ca) OVER (PARTITION BY "column") AS na,
  sum(cb) OVER (PARTITION BY "column") AS nb FROM g
  WINDOW w AS (PARTITION BY "column" ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
d AS (SELECT "column", max(na) AS na, max(nb) AS nb, max(abs(cum_a / na - cum_b / nb)) AS d FROM c GROUP BY 1),
l AS (SELECT *, sqrt(na * nb / (na + nb)) * d AS lam FROM d)
SELECT "column", CAST(na AS BIGINT) AS n_a, CAST(nb AS BIGINT) AS n_b, {r6('d')} AS d, {r6(_ks_p('lam'))} AS p_value,
  {_ks_p('lam')} < 0.05 AS different FROM l""")
def m11(spark, sf_dir):
    v = _variants(spark, sf_dir)
    return M.ks_two_sample(v.filter(F.col("variant") == "raw"), v.filter(F.col("variant") == "median_capped"), LNF)


@register("o04_scoring_outlier_switch", f"""WITH ln AS {LN}, q AS {_q_sql(f'(SELECT * FROM ln WHERE {_TRAIN})', _KEEP_COLS)},
n AS (SELECT *, {' AND '.join(f'coalesce({c} BETWEEN {_lo(c)} AND {_hi(c)}, false)' for c in _KEEP_COLS)} AS inside FROM ln, q WHERE NOT ({_TRAIN}))
SELECT 'on' AS switch, count_if(inside) AS n_rows FROM n UNION ALL SELECT 'off', count(*) FROM n""")
def o04(spark, sf_dir):
    """At scoring, rows outside fences saved from the training rows are removed only when the
    switch is on; with it off the rows pass unchanged."""
    ln = T.lineitem_nulls(spark, sf_dir)
    u = portable_unit("id", 42)
    bounds = O.iqr_bounds(ln.filter(u < 0.8), _KEEP_COLS)
    new = ln.filter(~(u < 0.8))
    on = O.remove_outliers(new, _KEEP_COLS, bounds=bounds).withColumn("switch", F.lit("on"))
    off = new.withColumn("switch", F.lit("off"))
    return on.unionByName(off).groupBy("switch").agg(F.count(F.lit(1)).alias("n_rows"))
