"""Exact quantiles of long data without a value map per group.

``percentile`` keeps every distinct value of a group in one task. Here a sketch of fixed size
brackets each requested rank, one scan counts what lies between the brackets and collects only the
values inside them, and the order statistics are read off exact running counts. A bracket that
misses its rank is widened and the scan repeated, so the result never depends on the sketch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from adlytics.functions.exprs import col


def _brackets(values: DataFrame, by: list[str], probs: list[float], accuracy: int, width: float) -> dict:
    """{group: [lo per prob..., hi per prob...]}; None is an open end."""
    lo, hi = [p - width for p in probs], [p + width for p in probs]
    asked = sorted({p for p in lo + hi if 0 < p < 1})
    if not asked:
        rows = values.select(*[col(b) for b in by]).distinct().collect()
        return {tuple(r[b] for b in by): [None] * 2 * len(probs) for r in rows}
    rows = values.groupBy(*by).agg(F.percentile_approx("value", asked, accuracy).alias("_q")).collect()
    out = {}
    for r in rows:
        at = dict(zip(asked, r["_q"]))
        out[tuple(r[b] for b in by)] = [at.get(p) for p in lo + hi]
    return out


def _between(values: DataFrame, by: list[str], brackets: dict, k: int) -> DataFrame:
    """(by..., _part, _n, _min, _max): a row per distinct value inside a bracket (odd _part) and per
    stretch between brackets (even _part); _part ascends with the value."""
    schema = StructType([values.schema[b] for b in by] + [StructField("_b", ArrayType(DoubleType()))])
    table = values.sparkSession.createDataFrame([(*g, b) for g, b in brackets.items()], schema)
    named = table.select(*[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)],
                         *[F.col("_b")[i].alias(f"_b{i}") for i in range(2 * k)])
    same = reduce(lambda a, b: a & b, [col(b).eqNullSafe(F.col(f"_by{i}")) for i, b in enumerate(by)])
    v = F.col("value")
    over = [F.coalesce(v > F.col(f"_b{k + i}"), F.lit(False)) for i in range(k)]
    inside = reduce(lambda a, b: a | b,
                    [F.coalesce(v >= F.col(f"_b{i}"), F.lit(True)) & ~over[i] for i in range(k)])
    part = reduce(lambda a, b: a + b, [o.cast("int") for o in over]) * 2 + inside.cast("int")
    # one row of 2k numbers per group, as many as the caller gets back
    return values.join(F.broadcast(named), same).select(*[col(b) for b in by], "value", part.alias("_part")) \
        .groupBy(*by, "_part", F.when(F.col("_part") % 2 == 1, v).alias("_v")) \
        .agg(F.count(F.lit(1)).alias("_n"), F.min("value").alias("_min"), F.max("value").alias("_max"))


def _at(rank):
    """The value of a 0-based rank where this row holds it: any rank of a single value, the first
    and the last of a stretch."""
    first, last = F.col("_end") - F.col("_n"), F.col("_end") - 1
    return F.when((rank < first) | (rank > last), None).when((rank == first) | F.col("_v").isNotNull(), F.col("_min")) \
        .when(rank == last, F.col("_max"))


def exact_quantiles(long: DataFrame, by: list[str], probs: list[float], accuracy: int = 10000) -> dict:
    """{group tuple: [quantile per prob]} of the double column ``value`` per group ``by``, linearly
    interpolated as by ``percentile``; NULL values are skipped, and a group of NULLs only is absent.

    Two scans of ``long``. ``accuracy`` sets the sketch: at n rows a group's window sorts (spilling)
    about 4 n / accuracy values per probability. The result is one row of numbers per group, so
    groups are columns or columns by classes.
    """
    order = sorted(range(len(probs)), key=lambda i: probs[i])
    ranked = [float(probs[i]) for i in order]
    values = long.filter(F.col("value").isNotNull()).select(*[col(b) for b in by], F.col("value").cast("double").alias("value"))
    out, todo, width = {}, values, 2.0 / accuracy
    while True:
        brackets = _brackets(todo, by, ranked, accuracy, width)
        if out:
            brackets = {g: b for g, b in brackets.items() if g not in out}
        if not brackets:
            return out
        w = Window.partitionBy(*by)
        run = w.orderBy("_part", "_v").rowsBetween(Window.unboundedPreceding, 0)
        ends = _between(todo, by, brackets, len(ranked)).withColumn("_end", F.sum("_n").over(run)) \
            .withColumn("_total", F.sum("_n").over(w))
        found = []
        for i, p in enumerate(ranked):
            place = (F.col("_total") - 1) * p
            found += [F.max(_at(F.floor(place))).alias(f"_lo{i}"), F.max(_at(F.ceil(place))).alias(f"_hi{i}")]
        missed = False
        for r in ends.groupBy(*by).agg(F.max("_total").alias("_total"), *found).collect():
            got = [None] * len(ranked)
            for i, p in enumerate(ranked):
                a, b, place = r[f"_lo{i}"], r[f"_hi{i}"], (r["_total"] - 1) * p
                if a is not None and b is not None:
                    at = int(place)
                    got[order[i]] = a if a == b or place == at else (at + 1 - place) * a + (place - at) * b
            if None in got:
                missed = True
            else:
                out[tuple(r[b] for b in by)] = got
        if not missed:
            return out
        width *= 8


def column_quantiles(long: DataFrame, probs: list[float], accuracy: int = 10000) -> dict:
    """{column: [quantile per prob]} of melted columns (column, value)."""
    return {g[0]: q for g, q in exact_quantiles(long, ["column"], probs, accuracy).items()}


def with_quantiles(df: DataFrame, by: list[str], quantiles: dict, names: list[str]) -> DataFrame:
    """``df`` (one row per group) with the found quantiles as columns; NULL where there is none."""
    schema = StructType([df.schema[b] for b in by] + [StructField(n, DoubleType()) for n in names])
    table = df.sparkSession.createDataFrame([(*g, *q) for g, q in quantiles.items()], schema)
    keys = [F.col(b).alias(f"_by{i}") for i, b in enumerate(by)]
    same = reduce(lambda a, b: a & b, [col(b).eqNullSafe(F.col(f"_by{i}")) for i, b in enumerate(by)])
    return df.join(table.select(*keys, *names), same, "left").drop(*[f"_by{i}" for i in range(len(by))])
