"""Correlation / redundancy queries (C1-C19) with DuckDB oracles where the rule is set-based."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlytics.catalog import tables as T
from adlytics.catalog.registry import register
from adlytics.catalog.sqlgen import melt_sql, r6
from adlytics.functions.exprs import portable_hash_sql
from adlytics.operators import corr as C
from adlytics.operators.phi import phi_pairs

LN = T.LINEITEM_NULLS_SQL
LNF = T.LINE_FEATURES
DW = T.doc_wide_sql()
DL = T.doc_labelled_sql()
BIN = T.doc_binary_cols()
CONT = T.DOC_CONT
FEATS = CONT + ["X4"] + BIN
RED = ["X4"] + BIN          # binary columns incl. the protected one
T_RED = 0.85                # a reduction threshold the reference uses (0.85 / 0.90 / 0.95)


def _safe(a, b):
    return f"CASE WHEN isnan(corr({a}, {b})) OR isinf(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END"


_TARGET_SQL = f"""WITH dw AS {DW}, r AS (SELECT "column", {r6(_safe('value', 'y'))} AS r
  FROM {melt_sql('dw', FEATS, ['y'])} GROUP BY "column")
SELECT "column", r, abs(r) AS abs_r, row_number() OVER (ORDER BY abs(r) DESC NULLS LAST, "column") AS rank FROM r"""


@register("c01_target_correlations", _TARGET_SQL)
def c01(spark, sf_dir):
    return C.target_correlations(T.doc_wide(spark, sf_dir), FEATS, "y")


@register("c01_top_bottom_10", f"""WITH x AS ({_TARGET_SQL}), v AS (SELECT * FROM x WHERE r IS NOT NULL)
SELECT 'top' AS kind, * FROM (SELECT * FROM v ORDER BY abs_r DESC, "column" LIMIT 10)
UNION ALL SELECT 'bottom', * FROM (SELECT * FROM v ORDER BY abs_r, "column" LIMIT 10)""")
def c01b(spark, sf_dir):
    dw = T.doc_wide(spark, sf_dir)
    top = C.top_target_correlations(dw, FEATS, "y", 10).select(F.lit("top").alias("kind"), "*")
    bot = C.top_target_correlations(dw, FEATS, "y", 10, bottom=True).select(F.lit("bottom").alias("kind"), "*")
    return top.unionByName(bot)


def _pairs_sql(src, cols, key):
    return f"""(SELECT a."column" AS var1, b."column" AS var2, {r6(_safe('a.value', 'b.value'))} AS r
  FROM {melt_sql(src, cols, [key])} a JOIN {melt_sql(src, cols, [key])} b
  ON a.{key} = b.{key} AND a."column" < b."column" GROUP BY 1, 2)"""


@register("c03_corr_pairs", f"WITH ln AS {LN} SELECT * FROM {_pairs_sql('ln', LNF, 'id')}")
def c03(spark, sf_dir):
    return C.corr_pairs(T.lineitem_nulls(spark, sf_dir), LNF)


@register("c04_high_pairs_continuous", f"""WITH ln AS {LN}
SELECT * FROM {_pairs_sql('ln', LNF, 'id')} WHERE abs(r) > 0.9""")
def c04(spark, sf_dir):
    return C.high_pairs(C.corr_pairs(T.lineitem_nulls(spark, sf_dir), LNF), 0.9)


@register("c18_multivariate_pairs", f"""WITH ln AS {LN}
SELECT * FROM {_pairs_sql('ln', LNF, 'id')} WHERE abs(r) > 0.9""")
def c18(spark, sf_dir):
    ln = T.lineitem_nulls(spark, sf_dir)
    floats = [f.name for f in ln.schema.fields if f.dataType.typeName() == "double"]
    return C.high_pairs(C.corr_pairs(ln, floats), 0.9)


_BIN_PAIRS = f"WITH dw AS {DW} SELECT * FROM {_pairs_sql('dw', BIN, 'doc_id')}"


@register("c05_binary_phi_pairs", _BIN_PAIRS)
def c05(spark, sf_dir):
    return phi_pairs(T.doc_wide(spark, sf_dir), BIN)


@register("c05_binary_phi_pairs_095", f"SELECT * FROM ({_BIN_PAIRS}) WHERE abs(r) > 0.95")
def c05b(spark, sf_dir):
    return phi_pairs(T.doc_wide(spark, sf_dir), BIN, 0.95)


@register("c05_binary_phi_pairs_blocked", _BIN_PAIRS)
def c05c(spark, sf_dir):
    """Same pairs computed in column blocks of 16 (exercises the cross-block path)."""
    return C.gram_corr_pairs(T.doc_wide(spark, sf_dir), BIN, block=16)


_RED_PAIRS = f"WITH dw AS {DW} SELECT * FROM {_pairs_sql('dw', RED, 'doc_id')}"


@register("c06_redundancy_degree", f"""WITH p AS ({_RED_PAIRS}), h AS (SELECT * FROM p WHERE abs(r) > {T_RED}),
e AS (SELECT var1 AS "column" FROM h UNION ALL SELECT var2 FROM h)
SELECT "column", count(*) AS n_partners FROM e GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def c06(spark, sf_dir):
    pairs = phi_pairs(T.doc_wide(spark, sf_dir), RED, T_RED)
    return C.redundancy_degree(pairs)


_C07_SQL = f"""WITH dw AS {DW},
pos AS (SELECT * FROM (VALUES {', '.join(f"('{c}', {i})" for i, c in enumerate(BIN))}) AS p("column", pos)),
r AS (SELECT "column", avg(value) AS rate FROM {melt_sql('dw', BIN)} GROUP BY 1),
b AS (SELECT r."column", rate, pos, ntile(4) OVER (ORDER BY rate, pos) AS bucket FROM r JOIN pos USING ("column")),
k AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY {portable_hash_sql("pos", 42)}, pos) AS pick FROM b)
SELECT "column", {r6('rate')} AS rate, bucket, pick FROM k WHERE pick <= 10"""


@register("c07_column_sample_ten", _C07_SQL)
@register("c07_stratified_column_sample", _C07_SQL)
def c07(spark, sf_dir):
    return C.stratified_column_sample(T.doc_wide(spark, sf_dir), BIN, per_bucket=10)


def _groups_sql(cols):
    """CTEs m (g, member, no): groups of the columns over T_RED, from a pair table p."""
    return f"""pos AS (SELECT * FROM (VALUES {', '.join(f"('{c}', {i})" for i, c in enumerate(cols))}) AS x("column", pos)),
e AS (SELECT greatest(a.pos, b.pos) AS g, var1, var2 FROM p JOIN pos a ON a."column" = var1 JOIN pos b ON b."column" = var2
  WHERE abs(r) > {T_RED}),
u AS (SELECT g, var1 AS member FROM e UNION SELECT g, var2 FROM e),
m AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY member) AS no FROM u)"""


@register("c08_correlated_groups", f"""WITH p AS ({_RED_PAIRS}), {_groups_sql(RED)}
SELECT CAST(row_number() OVER (ORDER BY g) - 1 AS INTEGER) AS group_id, min(member) AS head,
  string_agg(member, ',' ORDER BY member) AS members, CAST(count(*) AS INTEGER) AS size FROM m GROUP BY g""")
def c08(spark, sf_dir):
    return C.groups_table(C.correlated_groups(phi_pairs(T.doc_wide(spark, sf_dir), RED, T_RED), RED, T_RED))


@register("c09_groups_with_protection", f"""WITH p AS ({_RED_PAIRS}), {_groups_sql([c for c in RED if c != 'X4'])}
SELECT CAST(g AS INTEGER) AS group_pos, member AS "column" FROM m WHERE no > 1""")
def c09(spark, sf_dir):
    pairs = phi_pairs(T.doc_wide(spark, sf_dir), RED, T_RED)
    return C.group_drops(pairs, RED, T_RED, exclude=["y"], protected=["X4"])


_DROP_SQL = f"""WITH p AS ({_RED_PAIRS}), h AS (SELECT * FROM p WHERE abs(r) > {T_RED})
SELECT DISTINCT CASE WHEN var1 = 'X4' THEN var2 WHEN var2 = 'X4' THEN var1 ELSE greatest(var1, var2) END AS "column"
FROM h WHERE NOT (var1 = 'X4' AND var2 = 'X4')"""


@register("c10_pairwise_drops", _DROP_SQL)
def c10(spark, sf_dir):
    return C.pairwise_drops(phi_pairs(T.doc_wide(spark, sf_dir), RED, T_RED), T_RED, protected=["X4"])


_ALL = ["doc_id", "y"] + CONT + ["X4"] + BIN
_LISTED = [("priority", ["doc_id"], 0), ("target", ["y"], 1), ("extra", CONT, 2), ("protected", ["X4"], 5)]


@register("c11_keep_one_per_group", f"""WITH p AS ({_RED_PAIRS}), {_groups_sql(BIN)},
o AS (SELECT section, rk, place, "column" FROM (VALUES {', '.join(f"('{n}', {k}, {i}, '{c}')" for n, cs, k in _LISTED for i, c in enumerate(cs))}) AS x(section, rk, place, "column")
  UNION ALL SELECT DISTINCT 'kept', 3, 0, member FROM m WHERE no = 1
  UNION ALL SELECT 'ungrouped', 4, pos, "column" FROM pos WHERE "column" NOT IN (SELECT member FROM m))
SELECT CAST(row_number() OVER (ORDER BY rk, place, "column") - 1 AS INTEGER) AS pos, "column", section FROM o""")
def c11(spark, sf_dir):
    dw = T.doc_wide(spark, sf_dir)
    groups = C.correlated_groups(phi_pairs(dw, BIN, T_RED), BIN, T_RED)
    return C.keep_one_per_group(groups, dw.columns, "y", priority=["doc_id"], extra=CONT, protected=["X4"], binary=BIN)


@register("c12_apply_drop_list", f"""WITH d AS ({_DROP_SQL}),
a AS (SELECT * FROM (VALUES {', '.join(f"('{c}')" for c in _ALL)}) AS a("column"))
SELECT "column" FROM a WHERE "column" NOT IN (SELECT "column" FROM d)""")
def c12(spark, sf_dir):
    dw = T.doc_wide(spark, sf_dir)
    drops = [r[0] for r in C.pairwise_drops(phi_pairs(dw, RED, T_RED), T_RED, protected=["X4"]).collect()]
    reduced = C.apply_drop_list(dw, drops, protected=["X4"])
    return spark.createDataFrame([(c,) for c in reduced.columns], "column string")


@register("c13_reduction_impact", f"""WITH d AS ({_DROP_SQL}), n AS (SELECT count(*) AS k FROM d)
SELECT {len(_ALL)} AS cols_before, CAST({len(_ALL)} - k AS INTEGER) AS cols_after, CAST(k AS INTEGER) AS n_dropped,
  {r6(f'100.0 * ({len(_ALL)} - k) / {len(_ALL)}')} AS kept_pct FROM n""")
def c13(spark, sf_dir):
    dw = T.doc_wide(spark, sf_dir)
    drops = [r[0] for r in C.pairwise_drops(phi_pairs(dw, RED, T_RED), T_RED, protected=["X4"]).collect()]
    return C.reduction_impact(dw.columns, C.apply_drop_list(dw, drops, ["X4"]).columns, spark)


_ANOVA_SQL = f"""WITH dw AS {DL}, g AS (SELECT "column", y AS k, count(*) AS n, sum(value) AS s, sum(value * value) AS ss
  FROM {melt_sql('dw', FEATS, ['y'])} WHERE value IS NOT NULL GROUP BY 1, 2),
t AS (SELECT "column", sum(n) AS "N", sum(s) AS "S", sum(ss) AS "SS", count(*) AS "K", sum(s * s / n) AS "B" FROM g GROUP BY 1),
f AS (SELECT "column", CASE WHEN "K" < 2 OR ("SS" - "B") = 0 THEN NULL
  ELSE (("B" - "S" * "S" / "N") / ("K" - 1)) / (("SS" - "B") / ("N" - "K")) END AS f FROM t)
SELECT "column", {r6('f')} AS f, {r6('f / max(f) OVER ()')} AS f_norm FROM f"""


@register("c14_anova_f", _ANOVA_SQL)
def c14(spark, sf_dir):
    return C.anova_f(T.doc_labelled(spark, sf_dir), FEATS, "y")


@register("c15_k_best", f"""SELECT * FROM ({_ANOVA_SQL}) WHERE f IS NOT NULL ORDER BY f DESC, "column" LIMIT 10""")
def c15(spark, sf_dir):
    return C.k_best(T.doc_labelled(spark, sf_dir), FEATS, "y", 10)


@register("c17_full_correlation_report", f"""WITH dw AS {DW},
tr AS (SELECT "column", {r6(_safe('value', 'y'))} AS r FROM {melt_sql('dw', CONT + BIN, ['y'])} GROUP BY "column"),
tt AS (SELECT *, abs(r) AS abs_r FROM tr WHERE r IS NOT NULL),
pos AS (SELECT * FROM (VALUES {', '.join(f"('{c}', {i})" for i, c in enumerate(BIN))}) AS p("column", pos)),
rt AS (SELECT "column", avg(value) AS rate FROM {melt_sql('dw', BIN)} GROUP BY 1),
bk AS (SELECT rt."column", rate, pos, ntile(4) OVER (ORDER BY rate, pos) AS bucket FROM rt JOIN pos USING ("column")),
sm AS (SELECT "column" FROM (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY {portable_hash_sql("pos", 42)}, pos) AS pick FROM bk) WHERE pick <= 10),
pr AS (SELECT * FROM {_pairs_sql('dw', BIN, 'doc_id')}),
hi AS (SELECT * FROM pr WHERE abs(r) > 0.95),
dg AS (SELECT "column", count(*) AS n FROM (SELECT var1 AS "column" FROM hi UNION ALL SELECT var2 FROM hi) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
SELECT 'top' AS part, "column" AS var1, 'y' AS var2, r FROM (SELECT * FROM tt ORDER BY abs_r DESC, "column" LIMIT 10)
UNION ALL SELECT 'bottom', "column", 'y', r FROM (SELECT * FROM tt ORDER BY abs_r, "column" LIMIT 10)
UNION ALL SELECT 'target', "column", 'y', r FROM tr
UNION ALL SELECT 'sample_pairs', var1, var2, r FROM pr WHERE abs(r) > 0.8 AND var1 IN (SELECT "column" FROM sm) AND var2 IN (SELECT "column" FROM sm)
UNION ALL SELECT 'binary_pairs', var1, var2, r FROM hi
UNION ALL SELECT 'degree', "column", 'partners', CAST(n AS DOUBLE) FROM dg""")
def c17(spark, sf_dir):
    dw = T.doc_wide(spark, sf_dir)
    parts = C.full_correlation_report(dw, "y", BIN, CONT, per_bucket=10)
    out = None
    for name in ("top", "bottom", "target"):
        p = parts[name].select(F.lit(name).alias("part"), F.col("column").alias("var1"),
                               F.lit("y").alias("var2"), "r")
        out = p if out is None else out.unionByName(p)
    for name in ("sample_pairs", "binary_pairs"):
        out = out.unionByName(parts[name].select(F.lit(name).alias("part"), "var1", "var2", "r"))
    return out.unionByName(parts["degree"].select(F.lit("degree").alias("part"), F.col("column").alias("var1"),
                                                  F.lit("partners").alias("var2"), F.col("n_partners").cast("double").alias("r")))


@register("c19_bivariate_report", f"""WITH dw AS {DW},
t AS (SELECT 'target' AS kind, "column" AS var1, 'y' AS var2, {r6(_safe('value', 'y'))} AS r
  FROM {melt_sql('dw', CONT + BIN, ['y'])} GROUP BY "column"),
c AS (SELECT 'continuous', * FROM {_pairs_sql('dw', CONT, 'doc_id')} WHERE abs(r) > 0.9),
b AS (SELECT 'binary', * FROM {_pairs_sql('dw', BIN, 'doc_id')} WHERE abs(r) > 0.95)
SELECT * FROM t UNION ALL SELECT * FROM c UNION ALL SELECT * FROM b""")
def c19(spark, sf_dir):
    return C.bivariate_report(T.doc_wide(spark, sf_dir), "y", CONT, BIN)
