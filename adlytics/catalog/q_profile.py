"""Profiling and validation queries (D1-D31) bound to the test tables, with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlytics.catalog import tables as T
from adlytics.catalog.registry import register
from adlytics.catalog.sqlgen import melt_sql, q, r6
from adlytics.operators import missing as M
from adlytics.operators import outliers as O
from adlytics.operators import profile as P

LN = T.LINEITEM_NULLS_SQL
LNF = T.LINE_FEATURES
DW = T.doc_wide_sql()
DL = T.doc_labelled_sql()
BIN = T.doc_binary_cols()
CONT = T.DOC_CONT
DW_COLS = ["doc_id", "y"] + CONT + ["X4"] + BIN
DW_TYPES = {"doc_id": "bigint", "y": "int", "X1": "double", "X2": "double", "X3": "double"}
LN_COLS = ["id", "y", "l_returnflag"] + LNF
LN_NUM = ["id", "y"] + LNF


def _dw_type(c):
    return DW_TYPES.get(c, "int")


# ------------------------------------------------------------------ flagship: M1 -> O5 -> D25
def flagship(spark, sf_dir):
    """Median fill, IQR capping with fences fitted on the filled table, class profile by target."""
    ln = T.lineitem_nulls(spark, sf_dir)
    filled = M.median_fill(ln, LNF)
    capped = O.cap(filled, O.iqr_bounds(filled, LNF))
    return P.class_profile(capped, LNF, "y")


def _flagship_sql():
    med = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in LNF)
    fil = ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in LNF)
    qs = ", ".join(f"quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.75) AS b_{c}" for c in LNF)
    capx = ", ".join(
        f"CASE WHEN {c} > b_{c} + 1.5 * (b_{c} - a_{c}) THEN b_{c} + 1.5 * (b_{c} - a_{c}) "
        f"WHEN {c} < a_{c} - 1.5 * (b_{c} - a_{c}) THEN a_{c} - 1.5 * (b_{c} - a_{c}) ELSE {c} END AS {c}"
        for c in LNF)
    return f"""WITH ln AS {LN}, med AS (SELECT {med} FROM ln),
f AS (SELECT y, {fil} FROM ln, med), qq AS (SELECT {qs} FROM f),
c AS (SELECT y, {capx} FROM f, qq)
SELECT y, "column", count(value) AS n, {r6('avg(value)')} AS mean,
  {r6('quantile_cont(value, 0.25)')} AS q1, {r6('quantile_cont(value, 0.5)')} AS median,
  {r6('quantile_cont(value, 0.75)')} AS q3
FROM {melt_sql('c', LNF, ['y'])} GROUP BY y, "column\""""


register("flagship_fill_cap_profile", _flagship_sql())(flagship)


# ------------------------------------------------------------------ D1
def _classify_sql():
    parts = []
    for c in DW_COLS:
        t = _dw_type(c)
        binary = f"count({c}) > 0 AND count_if(CAST({c} AS DOUBLE) NOT IN (0, 1)) = 0"
        other = "'continuous'" if t == "double" else "'integer'"
        parts.append(f"SELECT '{c}' AS \"column\", '{t}' AS dtype, "
                     f"CASE WHEN {binary} THEN 'binary' ELSE {other} END AS kind FROM dw")
    return f"WITH dw AS {DW} " + " UNION ALL ".join(parts)


@register("d01_classify_columns", _classify_sql())
def d01(spark, sf_dir):
    return P.classify_columns(T.doc_wide(spark, sf_dir))


# ------------------------------------------------------------------ D2, D12, D13
def _dist_cols(src):
    return f"""count(*) AS n_rows, count_if(y IS NULL) AS n_missing, count_if(y = 0) AS n0,
  count_if(y = 1) AS n1, count_if(y IS NOT NULL AND y NOT IN (0, 1)) AS n_other FROM {src}"""


@register("d02_validate_target", f"""WITH dw AS {DL}, a AS (SELECT {_dist_cols('dw')})
SELECT 'y' AS target, 'int' AS dtype, true AS is_integer, n_rows, n_missing, n0, n1,
  {r6('n0 * 100.0 / n_rows')} AS pct0, {r6('n1 * 100.0 / n_rows')} AS pct1,
  (n_other = 0 AND n_missing = 0 AND n0 > 0 AND n1 > 0) AS target_valid FROM a""")
def d02(spark, sf_dir):
    return P.validate_target(T.doc_labelled(spark, sf_dir), "y")


_DIST_SQL = f"""WITH ln AS {LN}, a AS (SELECT {_dist_cols('ln')}),
b AS (SELECT *, CAST(greatest(n0, n1) AS DOUBLE) AS nmaj, CAST(least(n0, n1) AS DOUBLE) AS nmin FROM a)
SELECT n_rows, n_missing, n0, n1, {r6('n0 * 100.0 / n_rows')} AS pct0, {r6('n1 * 100.0 / n_rows')} AS pct1,
  CASE WHEN n1 > n0 THEN 1 ELSE 0 END AS majority_class, CASE WHEN n1 < n0 THEN 1 ELSE 0 END AS minority_class,
  {r6('nmaj / nmin')} AS imbalance_ratio, {r6('nmin / n_rows')} AS minority_prop,
  {r6('nmaj / n_rows')} AS majority_prop, {r6('2 * (nmin / n_rows) / (1 + nmin / n_rows)')} AS baseline_f1,
  (n_other = 0 AND n_missing = 0 AND n0 > 0 AND n1 > 0) AS target_valid FROM b"""


@register("d12_target_distribution", _DIST_SQL)
def d12(spark, sf_dir):
    return P.target_distribution(T.lineitem_nulls(spark, sf_dir), "y")


@register("d13_imbalance_severity", f"""WITH d AS ({_DIST_SQL})
SELECT imbalance_ratio, CASE WHEN imbalance_ratio < 2 THEN 'light' WHEN imbalance_ratio < 5 THEN 'moderate'
  WHEN imbalance_ratio < 10 THEN 'severe' ELSE 'critical' END AS severity,
  imbalance_ratio >= 3 AS use_resampling, imbalance_ratio >= 6 AS use_ensembles FROM d""")
def d13(spark, sf_dir):
    return P.imbalance_severity(P.target_distribution(T.lineitem_nulls(spark, sf_dir), "y"))


# ------------------------------------------------------------------ D3, D5, D6
_TYPE_MAP = """CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
  WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END"""


@register("d03_compare_schemas", f"""WITH sa AS (SELECT column_name AS "column", {_TYPE_MAP} AS dtype_a
  FROM (DESCRIBE SELECT * FROM {LN} ln)),
sb AS (SELECT column_name AS "column", {_TYPE_MAP} AS dtype_b FROM (DESCRIBE SELECT * FROM lineitem))
SELECT coalesce(sa."column", sb."column") AS "column", dtype_a, dtype_b, dtype_a IS NOT NULL AS in_a,
  dtype_b IS NOT NULL AS in_b, coalesce(dtype_a = dtype_b, false) AS type_match
FROM sa FULL OUTER JOIN sb ON sa."column" = sb."column\"""")
def d03(spark, sf_dir):
    return P.compare_schemas(T.lineitem_nulls(spark, sf_dir), T.read(spark, sf_dir, "lineitem"))


_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _nulls_sum(cols):
    return "(" + " + ".join(f"count_if({c} IS NULL)" for c in cols) + ")"


@register("d05_compare_frames", f"""WITH ln AS {LN},
a AS (SELECT count(*) AS rows_a, CAST({_nulls_sum(LN_COLS)} AS BIGINT) AS nulls_a FROM ln),
b AS (SELECT count(*) AS rows_b, CAST({_nulls_sum(_LI_COLS)} AS BIGINT) AS nulls_b FROM lineitem)
SELECT rows_a, {len(LN_COLS)} AS cols_a, rows_b, {len(_LI_COLS)} AS cols_b,
  '{",".join(sorted(set(LN_COLS) - set(_LI_COLS)))}' AS only_left,
  '{",".join(sorted(set(_LI_COLS) - set(LN_COLS)))}' AS only_right, nulls_a, nulls_b,
  {len(set(LN_COLS) & set(_LI_COLS))} AS n_common FROM a, b""")
def d05(spark, sf_dir):
    return P.compare_frames(T.lineitem_nulls(spark, sf_dir), T.read(spark, sf_dir, "lineitem"))


@register("d06_shape_change", f"""WITH ln AS {LN},
a AS (SELECT count(*) AS nb, count_if({' AND '.join(f'{c} IS NOT NULL' for c in LN_COLS)}) AS na FROM ln)
SELECT nb AS rows_before, na AS rows_after, na - nb AS d_rows, {r6('100.0 * (na - nb) / nb')} AS d_rows_pct,
  {len(LN_COLS)} AS cols_before, {len(LN_COLS)} AS cols_after, 0 AS d_cols FROM a""")
def d06(spark, sf_dir):
    ln = T.lineitem_nulls(spark, sf_dir)
    return P.shape_change(ln, ln.na.drop())


# ------------------------------------------------------------------ D7, D29
def _mean_of(exprs):
    num = " + ".join(f"coalesce({e}, 0)" for e in exprs)
    den = " + ".join(f"CAST({e} IS NOT NULL AS INTEGER)" for e in exprs)
    return f"({num}) / ({den})"


_S_COLS = [c for c in LN_COLS if c != "id"]
_S_NUM = [c for c in LN_NUM if c != "id"]


@register("d07_summarize_dataset", f"""WITH ln AS {LN}, a AS (SELECT count(*) AS n_rows,
  CAST({_nulls_sum(_S_COLS)} AS BIGINT) AS n_nulls,
  {', '.join(f'avg({c}) AS m_{c}' for c in _S_NUM)}, {', '.join(f'stddev_samp({c}) AS s_{c}' for c in _S_NUM)},
  count(DISTINCT l_returnflag) AS d0 FROM ln)
SELECT n_rows, {len(_S_COLS)} AS n_cols, {len(_S_NUM)} AS n_numeric, 1 AS n_text, n_nulls,
  {r6(f'n_nulls * 100.0 / ({len(_S_COLS)} * n_rows)')} AS null_pct,
  {r6(_mean_of([f'm_{c}' for c in _S_NUM]))} AS mean_of_means,
  {r6(_mean_of([f's_{c}' for c in _S_NUM]))} AS mean_of_stds, {r6('d0')} AS mean_distinct_text FROM a""")
def d07(spark, sf_dir):
    return P.summarize_dataset(T.lineitem_nulls(spark, sf_dir).drop("id"))


@register("d29_summary_statistics", f"""WITH dw AS {DL}
SELECT count(*) AS n_rows, {r6('avg(CAST(y = 0 AS DOUBLE))')} AS share0, {r6('avg(CAST(y = 1 AS DOUBLE))')} AS share1,
  {r6('(' + ' + '.join(f'avg(CAST({c} IS NULL AS DOUBLE))' for c in DW_COLS) + f') / {len(DW_COLS)} * 100.0')}
  AS mean_null_pct, {len(DW_COLS)} AS n_cols, {len(DW_COLS)} AS n_numeric FROM dw""")
def d29(spark, sf_dir):
    return P.summary_statistics(T.doc_labelled(spark, sf_dir), "y")


# ------------------------------------------------------------------ D8
@register("d08_preprocessing_summary", f"""WITH ln AS {LN}
SELECT 'null_count' AS section, "column" AS name, CAST(count_if(value IS NULL) AS DOUBLE) AS value
FROM {melt_sql('ln', ['id'] + LNF)} GROUP BY "column"
UNION ALL SELECT 'kind_count', kind, CAST(count(*) AS DOUBLE) FROM (
  SELECT CASE WHEN count_if(value NOT IN (0, 1)) = 0 AND count(value) > 0 THEN 'binary'
              WHEN "column" = 'id' THEN 'integer' ELSE 'continuous' END AS kind
  FROM {melt_sql('ln', ['id'] + LNF)} GROUP BY "column"
  UNION ALL SELECT 'categorical') GROUP BY kind
UNION ALL SELECT 'class_count', CAST(y AS VARCHAR), CAST(count(*) AS DOUBLE) FROM ln GROUP BY y
UNION ALL SELECT 'balance', 'minority_over_majority',
  {r6('least(count_if(y = 0), count_if(y = 1)) * 1.0 / greatest(count_if(y = 0), count_if(y = 1))')} FROM ln""")
def d08(spark, sf_dir):
    return P.preprocessing_summary(T.lineitem_nulls(spark, sf_dir), "y")


# ------------------------------------------------------------------ D9, D10, D31
def _quality_row(name, src, n_cols):
    return f"""SELECT '{name}' AS variant, count(*) AS n_rows, {n_cols} AS n_cols,
  CAST({_nulls_sum(LN_COLS)} AS BIGINT) AS n_nulls FROM {src}"""


@register("d09_quality_report", f"""WITH ln AS {LN},
med AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS m_{c}' for c in LN_NUM)} FROM ln),
filled AS (SELECT id, y, l_returnflag, {', '.join(f'coalesce({c}, m_{c}) AS {c}' for c in LNF)} FROM ln, med),
t AS ({_quality_row('raw', 'ln', len(LN_COLS))} UNION ALL {_quality_row('median', 'filled', len(LN_COLS))}),
c AS (SELECT *, true AS order_ok, true AS has_protected, true AS has_target, n_nulls = 0 AS no_nulls,
  n_cols < 1000 AS reduced, n_rows > 1000 AS enough_rows FROM t)
SELECT *, {r6('(CAST(order_ok AS INT) + CAST(has_protected AS INT) + CAST(has_target AS INT) + CAST(no_nulls AS INT) + CAST(reduced AS INT) + CAST(enough_rows AS INT)) / 6.0')} AS quality_score FROM c""")
def d09(spark, sf_dir):
    ln = T.lineitem_nulls(spark, sf_dir)
    return P.quality_report({"raw": ln, "median": M.median_fill(ln, LN_NUM)}, "y", None, ["id"])


@register("d10_protected_check", f"""WITH dw AS {DW}
SELECT 'X4' AS "column", true AS present, count_if(X4 IS NULL) AS n_null,
  count_if(X4 IS NOT NULL AND X4 NOT IN (0, 1)) AS n_bad,
  count_if(X4 IS NOT NULL AND X4 NOT IN (0, 1)) = 0 AS ok FROM dw""")
def d10(spark, sf_dir):
    return P.protected_check(T.doc_wide(spark, sf_dir), "X4")


@register("d31_post_prep_check", f"""WITH dw AS {DW}
SELECT count_if(X4 IS NOT NULL AND X4 NOT IN (0, 1)) = 0 AS protected_ok, true AS order_ok,
  count_if(X4 IS NOT NULL AND X4 NOT IN (0, 1)) = 0 AS valid FROM dw""")
def d31(spark, sf_dir):
    return P.post_prep_check(T.doc_wide(spark, sf_dir), "X4", ["doc_id"], "y")


# ------------------------------------------------------------------ D11
@register("d11_split_overlap", f"""WITH s AS {T.scores_sql()},
f AS (SELECT id, max(CAST(split = 'train' AS INT)) AS tr, max(CAST(split = 'val' AS INT)) AS va,
             max(CAST(split = 'test' AS INT)) AS te FROM s GROUP BY id),
sh AS (SELECT CAST(sum(tr * va) AS BIGINT) AS tv, CAST(sum(tr * te) AS BIGINT) AS tt,
              CAST(sum(va * te) AS BIGINT) AS vt FROM f),
sz AS (SELECT split, count(*) AS n FROM s GROUP BY split),
p AS (SELECT 'train' AS split_a, 'val' AS split_b, tv AS n_shared FROM sh
      UNION ALL SELECT 'train', 'test', tt FROM sh UNION ALL SELECT 'val', 'test', vt FROM sh)
SELECT split_a, split_b, coalesce(a.n, 0) AS rows_a, coalesce(b.n, 0) AS rows_b, n_shared, n_shared = 0 AS disjoint
FROM p LEFT JOIN sz a ON a.split = split_a LEFT JOIN sz b ON b.split = split_b""")
def d11(spark, sf_dir):
    return P.split_overlap(T.scores(spark, sf_dir), "id")


# ------------------------------------------------------------------ D14, D15, D16
_MISS_SQL = f"""WITH ln AS {LN}, m AS (SELECT "column", count_if(value IS NULL) AS n_missing,
  count_if(value IS NULL) * 100.0 / count(*) AS pct FROM {melt_sql('ln', LN_NUM)} GROUP BY "column")
SELECT "column", n_missing, {r6('pct')} AS pct_missing,
  CASE WHEN pct > 50 THEN 'critical' WHEN pct > 30 THEN 'high' WHEN pct > 10 THEN 'medium' ELSE 'low' END AS band
FROM m WHERE n_missing > 0"""


@register("d14_missing_by_column", _MISS_SQL)
def d14(spark, sf_dir):
    return P.missing_by_column(T.lineitem_nulls(spark, sf_dir), LN_NUM)


@register("d14_missing_summary", f"""WITH per AS ({_MISS_SQL}), n AS (SELECT count(*) AS n_rows FROM {LN} x)
SELECT CAST(coalesce(sum(n_missing), 0) AS BIGINT) AS total_missing,
  {r6(f'coalesce(sum(n_missing), 0) * 100.0 / (max(n_rows) * {len(LN_NUM)})')} AS pct_missing,
  count(*) AS n_cols_missing, count_if(band = 'critical') AS n_critical, count_if(band = 'high') AS n_high,
  count_if(band = 'medium') AS n_medium, count_if(band = 'low') AS n_low FROM per, n""")
def d14s(spark, sf_dir):
    return P.missing_summary(T.lineitem_nulls(spark, sf_dir), LN_NUM)


def _safe_corr_sql(a, b):
    return (f"CASE WHEN isnan(corr({a}, {b})) OR isinf(corr({a}, {b})) THEN NULL "
            f"ELSE corr({a}, {b}) END")


@register("d15_missing_vs_target", f"""WITH ln AS {LN}, r AS (
  {' UNION ALL '.join(f"SELECT '{c}' AS \"column\", {_safe_corr_sql(f'CAST({c} IS NULL AS DOUBLE)', 'y')} AS r FROM ln" for c in LNF)})
SELECT "column", {r6('r')} AS r_missing_target, coalesce(abs(r) > 0.1, false) AS mar FROM r""")
def d15(spark, sf_dir):
    return P.missing_vs_target(T.lineitem_nulls(spark, sf_dir), LNF, "y")


@register("d16_missing_patterns", f"""WITH ln AS {LN}
SELECT {' || '.join(f"CASE WHEN {c} IS NULL THEN '1' ELSE '0' END" for c in LNF)} AS pattern, count(*) AS n
FROM ln GROUP BY 1""")
def d16(spark, sf_dir):
    return P.missing_patterns(T.lineitem_nulls(spark, sf_dir), LNF)


# ------------------------------------------------------------------ D17-D19
_DESCRIBE_SQL = f"""SELECT "column", count(value) AS count, {r6('avg(value)')} AS mean, {r6('stddev_samp(value)')} AS std,
  {r6('min(value)')} AS min, {r6('quantile_cont(value, 0.25)')} AS q25, {r6('quantile_cont(value, 0.5)')} AS q50,
  {r6('quantile_cont(value, 0.75)')} AS q75, {r6('max(value)')} AS max
FROM {melt_sql('ln', LNF)} GROUP BY "column\""""


@register("d17_describe", f"WITH ln AS {LN} {_DESCRIBE_SQL}")
def d17(spark, sf_dir):
    return P.describe(T.lineitem_nulls(spark, sf_dir), LNF)


_MOM_SQL = f"""WITH ln AS {LN}, m AS (SELECT "column", count(value) AS n, skewness(value) AS sa,
  kurtosis_pop(value) AS k FROM {melt_sql('ln', LNF)} GROUP BY "column"),
s AS (SELECT *, sa * (n - 2) / sqrt(n * (n - 1.0)) AS s FROM m),
j AS (SELECT *, n / 6.0 * (s * s + k * k / 4.0) AS jb FROM s)
SELECT "column", n, {r6('s')} AS skew_pop, {r6('sa')} AS skew_adj, {r6('k')} AS kurt_pop, {r6('jb')} AS jb,
  {r6('exp(-jb / 2.0)')} AS jb_p, exp(-jb / 2.0) > 0.01 AS normal FROM j"""


@register("d18_moments_normality", _MOM_SQL)
def d18(spark, sf_dir):
    return P.moments(T.lineitem_nulls(spark, sf_dir), LNF)


# ------------------------------------------------------------------ D20-D22
@register("d20_value_distribution", f"""WITH dw AS {DW}, g AS (SELECT "column", value, count(*) AS n
  FROM {melt_sql('dw', ['X4'] + BIN)} WHERE value IS NOT NULL GROUP BY "column", value)
SELECT "column", value, n, {r6('n * 1.0 / sum(n) OVER (PARTITION BY "column")')} AS share FROM g""")
def d20(spark, sf_dir):
    return P.value_distribution(T.doc_wide(spark, sf_dir), ["X4"] + BIN)


@register("d21_presence_rates", f"""WITH dw AS {DW}
SELECT "column", {r6('avg(value)')} AS rate FROM {melt_sql('dw', BIN)} GROUP BY "column\"""")
def d21(spark, sf_dir):
    return P.presence_rates(T.doc_wide(spark, sf_dir), BIN)


@register("d21_presence_summary", f"""WITH dw AS {DW}, r AS (SELECT "column", avg(value) AS rate
  FROM {melt_sql('dw', BIN)} GROUP BY "column")
SELECT count(*) AS n_cols, {r6('avg(rate)')} AS mean_rate, {r6('stddev_samp(rate)')} AS std_rate,
  {r6('min(rate)')} AS min_rate, {r6('median(rate)')} AS median_rate, {r6('max(rate)')} AS max_rate FROM r""")
def d21s(spark, sf_dir):
    return P.presence_rate_summary(T.doc_wide(spark, sf_dir), BIN)


@register("d22_sparsity", f"""WITH dw AS {DW}, a AS (SELECT CAST({' + '.join(f'count_if({c} = 1)' for c in BIN)} AS BIGINT)
  AS n_ones, count(*) AS n_rows FROM dw)
SELECT n_ones, CAST(n_rows * {len(BIN)} AS BIGINT) AS n_cells,
  {r6(f'100.0 * (n_rows * {len(BIN)} - n_ones) / (n_rows * {len(BIN)})')} AS sparsity_pct FROM a""")
def d22(spark, sf_dir):
    return P.sparsity(T.doc_wide(spark, sf_dir), BIN)


# ------------------------------------------------------------------ D23-D26
@register("d23_histogram", f"""WITH ln AS {LN}, l AS (SELECT * FROM {melt_sql('ln', LNF)} WHERE value IS NOT NULL),
rng AS (SELECT "column", CASE WHEN max(value) = min(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
  CASE WHEN max(value) = min(value) THEN max(value) + 0.5 ELSE max(value) END AS hi FROM l GROUP BY "column"),
c AS (SELECT l."column", CAST(least(floor((value - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, count(*) AS n
  FROM l JOIN rng ON l."column" = rng."column" GROUP BY 1, 2),
g AS (SELECT "column", lo, hi, CAST(unnest(range(0, 20)) AS INTEGER) AS bin FROM rng)
SELECT g."column", g.bin, {r6('lo + g.bin * ((hi - lo) / 20)')} AS lo, {r6('lo + (g.bin + 1) * ((hi - lo) / 20)')} AS hi,
  CAST(coalesce(n, 0) AS BIGINT) AS n FROM g LEFT JOIN c ON g."column" = c."column" AND g.bin = c.bin""")
def d23(spark, sf_dir):
    return P.histogram(T.lineitem_nulls(spark, sf_dir), LNF, bins=20)


@register("d24_boxplot", f"""WITH ln AS {LN}, l AS (SELECT * FROM {melt_sql('ln', LNF)}),
q AS (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med,
  quantile_cont(value, 0.75) AS q3 FROM l GROUP BY "column"),
b AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT b."column", {r6('q1')} AS q1, {r6('med')} AS median, {r6('q3')} AS q3, {r6('q3 - q1')} AS iqr,
  {r6('min(CASE WHEN value >= lo THEN value END)')} AS lo_whisker,
  {r6('max(CASE WHEN value <= hi THEN value END)')} AS hi_whisker,
  count_if(value < lo OR value > hi) AS n_outliers
FROM b JOIN l ON b."column" = l."column" WHERE value IS NOT NULL GROUP BY b."column", q1, med, q3""")
def d24(spark, sf_dir):
    return P.boxplot_table(T.lineitem_nulls(spark, sf_dir), LNF)


@register("d25_class_profile", f"""WITH ln AS {LN}
SELECT y, "column", count(value) AS n, {r6('avg(value)')} AS mean, {r6('quantile_cont(value, 0.25)')} AS q1,
  {r6('quantile_cont(value, 0.5)')} AS median, {r6('quantile_cont(value, 0.75)')} AS q3
FROM {melt_sql('ln', LNF, ['y'])} GROUP BY y, "column\"""")
def d25(spark, sf_dir):
    return P.class_profile(T.lineitem_nulls(spark, sf_dir), LNF, "y")


@register("d26_class_shares", f"""WITH ln AS {LN}, g AS (SELECT y AS class, count(*) AS n FROM ln GROUP BY y),
p AS (SELECT *, round(n * 100.0 / sum(n) OVER (), 1) AS pct FROM g)
SELECT class, n, {r6('pct')} AS pct, CAST(class AS VARCHAR) || ': ' || CAST(pct AS VARCHAR) || '%' AS label FROM p""")
def d26(spark, sf_dir):
    return P.class_shares(T.lineitem_nulls(spark, sf_dir), "y")


# ------------------------------------------------------------------ D27, D28, D30
def _target_corr_sql(src, cols):
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {_safe_corr_sql(c, 'y')} AS r FROM {src}" for c in cols)


@register("d27_eda_summary", f"""WITH dw AS {DW},
d AS (SELECT count(*) AS n_rows, CAST(greatest(count_if(y = 0), count_if(y = 1)) AS DOUBLE)
  / least(count_if(y = 0), count_if(y = 1)) AS ir FROM dw),
s AS (SELECT 100.0 * (count(*) * {len(BIN)} - ({' + '.join(f'count_if({c} = 1)' for c in BIN)}))
  / (count(*) * {len(BIN)}) AS sp FROM dw),
c AS (SELECT max(abs(round(r, 6))) AS mc FROM ({_target_corr_sql('dw', BIN + CONT)}))
SELECT n_rows, {len(DW_COLS)} AS n_cols, {len(BIN)} AS n_binary, {len(CONT)} AS n_continuous,
  {r6('ir')} AS imbalance_ratio, {r6('sp')} AS sparsity_pct, {r6('mc')} AS max_abs_corr FROM d, s, c""")
def d27(spark, sf_dir):
    return P.eda_summary(T.doc_wide(spark, sf_dir), "y", BIN, CONT)


@register("d28_univariate_report", f"""WITH dw AS {DW}, ln AS (SELECT * FROM dw),
cls AS (SELECT 'class' AS section, CAST(y AS VARCHAR) AS "column", 'n' AS metric, CAST(count(*) AS DOUBLE) AS value
  FROM dw GROUP BY y),
d AS ({_DESCRIBE_SQL.replace(melt_sql('ln', LNF), melt_sql('ln', CONT))}),
dl AS (SELECT 'describe' AS section, "column", m.metric, m.value FROM d,
  LATERAL (VALUES ('count', CAST(count AS DOUBLE)), ('mean', mean), ('std', std), ('min', min), ('q25', q25),
           ('q50', q50), ('q75', q75), ('max', max)) AS m(metric, value)),
vd AS (SELECT 'share' AS section, "column", CAST(value AS VARCHAR) AS metric,
  {r6('n * 1.0 / sum(n) OVER (PARTITION BY "column")')} AS value
  FROM (SELECT "column", value, count(*) AS n FROM {melt_sql('dw', BIN)} WHERE value IS NOT NULL GROUP BY 1, 2)),
nl AS (SELECT 'missing' AS section, "column", 'n_missing' AS metric, CAST(count_if(value IS NULL) AS DOUBLE) AS value
  FROM {melt_sql('dw', CONT + BIN)} GROUP BY "column" HAVING count_if(value IS NULL) > 0)
SELECT * FROM cls UNION ALL SELECT * FROM dl UNION ALL SELECT * FROM vd UNION ALL SELECT * FROM nl""")
def d28(spark, sf_dir):
    return P.univariate_report(T.doc_wide(spark, sf_dir), "y", BIN, CONT)


@register("d30_continuous_report", f"""WITH ln AS {LN},
d AS ({_DESCRIBE_SQL}),
mo AS (SELECT * EXCLUDE (n) FROM ({_MOM_SQL.replace(f'WITH ln AS {LN}, ', 'WITH ')})),
o AS (SELECT l."column", count_if(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers,
  {r6('count_if(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) * 100.0 / count(value)')} AS pct_outliers
  FROM {melt_sql('ln', LNF)} l JOIN (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
  FROM {melt_sql('ln', LNF)} GROUP BY 1) b ON l."column" = b."column" GROUP BY l."column"),
c AS (SELECT "column", {r6('r')} AS r FROM ({_target_corr_sql('ln', LNF)}))
SELECT * FROM d JOIN mo USING ("column") JOIN o USING ("column") JOIN c USING ("column")""")
def d30(spark, sf_dir):
    return P.continuous_report(T.lineitem_nulls(spark, sf_dir), LNF, "y")


@register("d04_inspect_datasets")
def d04(spark, sf_dir):
    dw = T.doc_wide(spark, sf_dir)
    return P.inspect_datasets(dw, dw.drop("y"), "y")
