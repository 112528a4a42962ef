"""Outlier operators: IQR fences, reports, removal, capping and frozen bounds.

Fences come from exact quantiles (metadata: two numbers per column), are
broadcast as literals and applied as column expressions in a single projection or filter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlytics.functions.exprs import clip, col, r6
from adlytics.operators.common import melt
from adlytics.operators.profile import quartile_bounds
from adlytics.operators.quantiles import column_quantiles


def iqr_bounds(df: DataFrame, cols: list[str], m: float = 1.5) -> dict[str, tuple]:
    """{column: (lo, hi)} with lo = Q1 - m IQR and hi = Q3 + m IQR (exact quartiles)."""
    return {c: (v[2], v[3]) for c, v in quartile_bounds(df, cols, m).items()}


def percentile_bounds(df: DataFrame, cols: list[str], p_lo: float = 0.01, p_hi: float = 0.99) -> dict:
    """{column: (p_lo quantile, p_hi quantile)} for percentile capping."""
    found = column_quantiles(melt(df, cols), [p_lo, p_hi])
    return {c: tuple(found.get(c, (None, None))) for c in cols}


def outlier_flags(df: DataFrame, bounds: dict, suffix: str = "_outlier") -> DataFrame:
    """Adds boolean ``{c}_outlier`` = value outside its fences; NULL is not an outlier (O1)."""
    extra = []
    for c, (lo, hi) in bounds.items():
        x = col(c)
        cond = F.lit(False) if lo is None else F.coalesce((x < F.lit(lo)) | (x > F.lit(hi)), F.lit(False))
        extra.append(cond.alias(f"{c}{suffix}"))
    return df.select("*", *extra)


def outlier_report(df: DataFrame, cols: list[str], m: float = 1.5) -> DataFrame:
    """(column, lower, upper, n_outliers, pct_outliers) over non-null values (O2)."""
    b = iqr_bounds(df, cols, m)
    aggs = []
    for i, c in enumerate(cols):
        lo, hi = b.get(c, (None, None))
        x = col(c)
        bad = F.lit(False) if lo is None else (x < F.lit(lo)) | (x > F.lit(hi))
        aggs += [F.count_if(bad).alias(f"o{i}"), F.count(x).alias(f"n{i}")]
    a = df.agg(*aggs)
    long = a.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(b[c][0]).cast("double").alias("lower"),
                 F.lit(b[c][1]).cast("double").alias("upper"), F.col(f"o{i}").alias("n_outliers"),
                 F.col(f"n{i}").alias("n")) for i, c in enumerate(cols)])).alias("m")).select("m.*")
    return long.select("column", r6("lower").alias("lower"), r6("upper").alias("upper"), "n_outliers",
                       r6(F.try_divide(F.col("n_outliers") * 100.0, F.col("n"))).alias("pct_outliers"))


def remove_outliers(df: DataFrame, cols: list[str], m: float = 1.5, bounds: dict | None = None) -> DataFrame:
    """Keep rows inside the fences of every column (O3).

    Fences are computed once on the input table. As with ``between`` on a missing value, a row
    with NULL in any of the columns is removed."""
    b = bounds if bounds is not None else iqr_bounds(df, cols, m)
    conds = []
    for c in cols:
        lo, hi = b.get(c, (None, None))
        if lo is None:
            conds.append(F.lit(False))
        else:
            conds.append(F.coalesce(col(c).between(F.lit(lo), F.lit(hi)), F.lit(False)))
    return df.filter(reduce(lambda x, y: x & y, conds)) if conds else df


def cap(df: DataFrame, bounds: dict) -> DataFrame:
    """Clip each column to its (lo, hi); absent bound = no clip; NULL stays NULL."""
    out = []
    for f in df.schema.fields:
        if f.name in bounds and bounds[f.name] is not None:
            lo, hi = bounds[f.name]
            out.append(clip(f.name, lo, hi).cast(f.dataType).alias(f.name))
        else:
            out.append(col(f.name))
    return df.select(*out)


def cap_report(df: DataFrame, bounds: dict) -> DataFrame:
    """(column, lower, upper, n_low, n_high): values that capping moves."""
    cols = [c for c in bounds if bounds[c] is not None and bounds[c][0] is not None]
    aggs = []
    for i, c in enumerate(cols):
        lo, hi = bounds[c]
        aggs += [F.count_if(col(c) < F.lit(lo)).alias(f"l{i}"), F.count_if(col(c) > F.lit(hi)).alias(f"h{i}")]
    a = df.agg(*aggs)
    return a.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), r6(F.lit(bounds[c][0])).alias("lower"),
                 r6(F.lit(bounds[c][1])).alias("upper"), F.col(f"l{i}").alias("n_low"),
                 F.col(f"h{i}").alias("n_high")) for i, c in enumerate(cols)])).alias("m")).select("m.*")


def removal_impact(before: DataFrame, after: DataFrame, target: str = "y") -> DataFrame:
    """Rows and positives lost by a row filter, in %."""
    a = before.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(col(target) == 1).alias("pos_before"))
    b = after.agg(F.count(F.lit(1)).alias("rows_after"), F.count_if(col(target) == 1).alias("pos_after"))
    ra, rb = a.first(), b.first()
    rows = (ra[0], rb[0], ra[1], rb[1])
    pct = lambda x, y: round(100.0 * (x - y) / x, 6) + 0.0 if x else 0.0
    return before.sparkSession.createDataFrame(
        [(*rows, pct(rows[0], rows[1]), pct(rows[2], rows[3]))],
        "rows_before long, rows_after long, pos_before long, pos_after long, "
        "rows_lost_pct double, pos_lost_pct double")
