"""Split / fold / sampling queries (R1-R5, R7-R9) with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlytics.catalog import tables as T
from adlytics.catalog.registry import register
from adlytics.catalog.sqlgen import r6
from adlytics.functions.exprs import HASH_MOD, portable_hash_sql
from adlytics.operators import sampling as R

LN = T.LINEITEM_NULLS_SQL


def _h(key="id", seed=42):
    return portable_hash_sql(key, seed)


_RANK_SQL = f"""ln AS {LN}, r AS (SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY {_h()}, id) AS rk,
  count(*) OVER (PARTITION BY y) AS n FROM ln)"""
_SPLIT_SQL = f"""WITH {_RANK_SQL}
SELECT id, y, CASE WHEN rk <= floor(n * 0.6) THEN 'train' WHEN rk <= floor(n * 0.8) THEN 'val' ELSE 'test' END AS split FROM r"""


def _split(spark, sf_dir):
    return R.stratified_split(T.lineitem_nulls(spark, sf_dir).select("id", "y"), "id", "y")


@register("r01_stratified_split", _SPLIT_SQL)
def r01(spark, sf_dir):
    return _split(spark, sf_dir)


@register("r02_split_summary", f"""WITH s AS ({_SPLIT_SQL})
SELECT split, count(*) AS n_rows, count_if(y = 1) AS n_pos, {r6('count_if(y = 1) * 1.0 / count(*)')} AS pos_rate
FROM s GROUP BY split""")
def r02(spark, sf_dir):
    return R.split_summary(_split(spark, sf_dir), "y")


@register("r03_stratified_folds", f"""WITH {_RANK_SQL} SELECT id, y, CAST((rk - 1) % 5 AS INTEGER) AS fold FROM r""")
def r03(spark, sf_dir):
    return R.stratified_folds(T.lineitem_nulls(spark, sf_dir).select("id", "y"), "id", "y", 5)


@register("r04_hash_folds", f"SELECT id, y, CAST({_h()} % 5 AS INTEGER) AS fold FROM {LN} ln")
def r04(spark, sf_dir):
    return R.hash_folds(T.lineitem_nulls(spark, sf_dir).select("id", "y"), "id", 5)


@register("r05_seeded_sample", f"SELECT id, y FROM {LN} ln ORDER BY {_h()}, id LIMIT 1000")
def r05(spark, sf_dir):
    return R.seeded_sample(T.lineitem_nulls(spark, sf_dir).select("id", "y"), "id", 1000)


@register("r05_sample_with_replacement")
def r05b(spark, sf_dir):
    return R.sample_with_replacement(T.lineitem_nulls(spark, sf_dir).select("id", "y"), 0.5, 42)


@register("r07_class_weights", f"""WITH ln AS {LN}, c AS (SELECT y, count(*) AS nc FROM ln GROUP BY y),
w AS (SELECT y, sum(nc) OVER () / (count(*) OVER () * nc) AS weight FROM c)
SELECT ln.id, ln.y, w.weight FROM ln JOIN w USING (y)""")
def r07(spark, sf_dir):
    return R.class_weights(T.lineitem_nulls(spark, sf_dir).select("id", "y"), "y")


_MASK_COLS = T.LINE_FEATURES


@register("r08_cell_mask", f"""SELECT id,
  {', '.join(f"{_h(seed=42 + R.CELL_STRIDE * (j + 1))} < {int(0.2 * HASH_MOD)} AS {c}_masked" for j, c in enumerate(_MASK_COLS))}
FROM {LN} ln""")
def r08(spark, sf_dir):
    ln = T.lineitem_nulls(spark, sf_dir)
    return R.cell_mask(ln.select("id", *_MASK_COLS), "id", _MASK_COLS, 0.2).select(
        "id", *[f"{c}_masked" for c in _MASK_COLS])


@register("r09_class_distribution", f"""WITH {_SPLIT_SQL.replace('WITH ', 'sp AS (WITH ', 1)}),
u AS (SELECT 'all' AS stage, y FROM {LN} ln UNION ALL SELECT 'train', y FROM sp WHERE split = 'train'),
g AS (SELECT stage, y AS class, count(*) AS n FROM u GROUP BY 1, 2)
SELECT class, n, stage, {r6('n * 1.0 / sum(n) OVER (PARTITION BY stage)')} AS share FROM g""")
def r09(spark, sf_dir):
    ln = T.lineitem_nulls(spark, sf_dir).select("id", "y")
    sp = _split(spark, sf_dir)
    return R.class_distribution({"all": ln, "train": sp.filter(F.col("split") == "train")}, "y")
