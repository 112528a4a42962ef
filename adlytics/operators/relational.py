"""Relational shapes over result tables.

Result tables (one row per model, variant, threshold...) are small, but every shape is written
as the plain DataFrame operation so it also holds on large score tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlytics.functions.exprs import col, r6


def wide_by_key(long: DataFrame, id_col: str, key: str, value: str, keys: list[str]) -> DataFrame:
    """Column-wise join of several models' outputs on the row id: one column per key.

    One conditional aggregate over the long table (one shuffle on id) rather than k-1 joins: unlike
    a pivot, which groups by id and key first, it makes one row of an id's rows before the shuffle."""
    return long.groupBy(id_col).agg(*[F.first(F.when(col(key) == k, col(value)), ignorenulls=True).alias(k) for k in keys])


def lookup_with_default(df: DataFrame, lookup: DataFrame, on: str, value: str, default: str) -> DataFrame:
    """Left join to a lookup table; missing -> default."""
    return df.join(lookup, on, "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def compare_variants_per_model(results: DataFrame, by: list[str], variant: str, a: str, b: str,
                               metric: str = "f1") -> DataFrame:
    """Same model and version under two variants: both metrics, difference, winner.

    Conditional aggregation per group (no self-join)."""
    g = results.groupBy(*by).agg(F.max(F.when(col(variant) == a, col(metric))).alias(f"{metric}_{a}"),
                                 F.max(F.when(col(variant) == b, col(metric))).alias(f"{metric}_{b}"))
    d = F.col(f"{metric}_{a}") - F.col(f"{metric}_{b}")
    return g.select(*by, f"{metric}_{a}", f"{metric}_{b}", r6(d).alias("diff"),
                    F.when(d >= 0, F.lit(a)).otherwise(F.lit(b)).alias("winner"))


def shared_ids(a: DataFrame, b: DataFrame, id_col: str) -> DataFrame:
    """Ids of a also present in b (left semi join)."""
    return a.select(id_col).join(b.select(id_col), id_col, "left_semi")


def column_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """(column, side): 'both', 'left_only', 'right_only' via set operations on name tables."""
    spark = a.sparkSession
    na = spark.createDataFrame([(c,) for c in a.columns], "column string")
    nb = spark.createDataFrame([(c,) for c in b.columns], "column string")
    return (na.intersect(nb).withColumn("side", F.lit("both"))
            .unionByName(na.exceptAll(nb).withColumn("side", F.lit("left_only")))
            .unionByName(nb.exceptAll(na).withColumn("side", F.lit("right_only"))))


def union_tagged(tables: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """Union by name with a tag column naming the source."""
    parts = [d.withColumn(tag, F.lit(k)) for k, d in tables.items()]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def best_per_group(df: DataFrame, by: list[str], metric: str, tie: list[str]) -> DataFrame:
    """Best row per group by metric, first by ``tie`` order on ties."""
    w = Window.partitionBy(*by).orderBy(F.col(metric).desc(), *[F.col(t) for t in tie])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def argmax_by(df: DataFrame, by: list[str], metric: str, value: str, tie: str) -> DataFrame:
    """(by..., best value, best metric): max_by with a stable tie-break."""
    return df.groupBy(*by).agg(
        F.min_by(col(value), F.struct(-F.col(metric), F.col(tie))).alias(f"best_{value}"),
        F.max(metric).alias(f"best_{metric}"))


def ranked(df: DataFrame, metric: str, tie: list[str], name: str = "rank") -> DataFrame:
    """Rank 1..n over the metric, descending."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(F.col(metric).desc(), *[F.col(t) for t in tie])))


def group_stats(df: DataFrame, by: str, value: str) -> DataFrame:
    """(by, mean, std, count) of a value, 4-decimal reporting done late (A1)."""
    return df.groupBy(by).agg(r6(F.avg(value)).alias("mean"), r6(F.stddev_samp(value)).alias("std"),
                              F.count(F.lit(1)).alias("n"))


def top_n(df: DataFrame, metric: str, n: int, tie: list[str], absolute: bool = False) -> DataFrame:
    """Top n rows by value (or by |value|) (L1, L2)."""
    key = F.abs(F.col(metric)) if absolute else F.col(metric)
    return df.orderBy(key.desc(), *[F.col(t) for t in tie]).limit(n)


def quick_stats(df: DataFrame, metric: str, gap: str | None = None, tol: float = 0.03) -> DataFrame:
    """One row: max, mean, range of a metric and share of |gap| <= tol (Q1)."""
    aggs = [r6(F.max(metric)).alias("max"), r6(F.avg(metric)).alias("mean"),
            r6(F.max(metric) - F.min(metric)).alias("range")]
    if gap:
        aggs.append(r6(F.avg((F.abs(F.col(gap)) <= tol).cast("double"))).alias("share_close"))
    return df.agg(*aggs)
