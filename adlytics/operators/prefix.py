"""Ordered cumulative sums without a single-partition window.

Used by the exact PR-curve optimum, ROC/PR points, rank-sum AUC and the KS statistic.

The input is already grouped to one row per (group..., value). Values are cut into ``buckets``
ranges by approximate quantile bounds (a metadata list); cumulative sums are computed within
each (group, bucket) by a window, and the totals of earlier buckets of the same group are
added from a small per-(group, bucket) table. Every step is a partitioned Spark operation; the
result is exact whatever the bounds are, the bounds only balance the work.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def range_bucket(value: str, bounds: list[float]):
    """Index of the range a value falls in: number of bounds <= value.

    Never NULL, so joining on it adds no inferred not-null filter (which Catalyst would push
    below the aggregate with the value's whole defining expression inlined)."""
    if not bounds:
        return F.lit(0)
    return F.coalesce(reduce(lambda x, y: x + y, [(F.col(value) >= F.lit(b)).cast("int") for b in bounds]),
                      F.lit(-1))


def prefix_sums(df: DataFrame, value: str, sums: list[str], by: list[str] | None = None,
                buckets: int = 64, descending: bool = False, accuracy: int = 10000,
                bounds: list[float] | None = None, unit_buckets: int | None = None) -> DataFrame:
    """Adds ``cum_<s>`` = sum of s over rows of the same group with value <= this value
    (>= when ``descending``), inclusive. One row per (by..., value) is expected.

    ``bounds`` (in the value's own scale) skips the quantile pass when the value range is known;
    ``unit_buckets`` = B does the same for values in [0, 1] with the cheaper bucket floor(v B).
    Any bucketing that is monotone in the value gives the exact result."""
    by = list(by or [])
    v = value
    src = df
    if descending:
        src = df.withColumn("_ord", -F.col(value))
        v = "_ord"
    if unit_buckets is not None:
        b = src.withColumn("_bucket", F.coalesce(F.floor(F.col(v) * float(unit_buckets)).cast("int"), F.lit(-1)))
        return _finish(df, b, v, sums, by)
    if bounds is not None:
        bounds = sorted(set((-b if descending else b) for b in bounds))
    elif buckets > 1:
        probs = [i / buckets for i in range(1, buckets)]
        q = src.agg(F.percentile_approx(v, probs, accuracy).alias("q")).first()["q"] or []
        bounds = sorted(set(x for x in q if x is not None))
    else:
        bounds = []
    b = src.withColumn("_bucket", range_bucket(v, bounds))
    return _finish(df, b, v, sums, by)


def _finish(df, b, v, sums, by):
    key = by + ["_bucket"]
    totals = b.groupBy(*key).agg(*[F.sum(s).alias(f"_tot_{s}") for s in sums])
    wt = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*key, *[F.coalesce(F.sum(f"_tot_{s}").over(wt), F.lit(0)).alias(f"_off_{s}")
                                    for s in sums])
    wl = Window.partitionBy(*key).orderBy(v).rowsBetween(Window.unboundedPreceding, 0)
    local = b.select("*", *[F.sum(s).over(wl).alias(f"_loc_{s}") for s in sums])
    # the window has dealt and sorted the rows by the key: a merge moves none of them again, and the
    # planner cannot take the rows (by their estimate a narrow table's) for a side to broadcast
    out = local.hint("merge").join(offsets, key).select(
        *[c for c in df.columns], *[(F.col(f"_loc_{s}") + F.col(f"_off_{s}")).alias(f"cum_{s}") for s in sums])
    return out
