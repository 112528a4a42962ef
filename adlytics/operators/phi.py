"""Sparse phi coefficients between many 0/1 columns (C5), pairwise-complete, in Spark aggregates.

A row becomes the list of its rare cells: per column the rarer of its two values (columns that are
mostly ones are flipped), and its NULLs. Cells that occur together in a row are counted per pair of
columns; with the counts per column these give, for every pair, the table of the rows in which both
columns have a value, and phi from it:

    phi = (n n11 - m1 m2) / sqrt(m1 (n - m1) m2 (n - m2)),   negated if one side is flipped.

The work is the square of a row's rare cells, not of the number of columns; counts are combined
before the shuffle. Rows with many rare cells are dealt in pieces. A pair of columns whose rare
values never meet has n11 = 0 and |phi| > t only if one of them is rare in more than t / (1 + t) of
the rows, so under a threshold only those few columns are paired with all others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlytics.functions.exprs import col, r6
from adlytics.operators.common import quoted
from adlytics.session import cut_lineage

PIECE = 256               # cells of a row that are paired with 256 others at a time
EXACT = "decimal(38,0)"   # products of counts beyond 2^63


def rare_cells(df: DataFrame, cols: list[str], flipped=frozenset()) -> DataFrame:
    """(cells array<int>): 2 i for the rare value of column i, 2 i + 1 for a NULL, ascending;
    -1 for a value that is neither 0 nor 1. The rare value is 1, or 0 of a flipped column."""
    cells = ", ".join(
        f"CASE WHEN {quoted(c)} IS NULL THEN {2 * i + 1} WHEN {quoted(c)} = {int(i in flipped)} THEN NULL "
        f"WHEN {quoted(c)} = {int(i not in flipped)} THEN {2 * i} ELSE -1 END" for i, c in enumerate(cols))
    return df.select(F.expr(f"array_compact(array({cells}))").alias("cells"))


def cell_pairs(rows: DataFrame) -> DataFrame:
    """(a, b), a < b, for every two cells of every row."""
    short = rows.filter(F.size("cells") <= PIECE)
    long = rows.filter(F.size("cells") > PIECE).withColumn(
        "pieces", F.transform(F.sequence(F.lit(0), F.floor((F.size("cells") - 1) / PIECE).cast("int")),
                              lambda i: F.slice("cells", i * PIECE + 1, F.lit(PIECE))))
    inside = short.select("cells").union(long.select(F.explode("pieces")))
    own = inside.select(F.posexplode("cells").alias("at", "a"), "cells") \
        .select("a", F.explode(F.slice("cells", F.col("at") + 2, F.greatest(F.size("cells") - F.col("at") - 1, F.lit(0)))).alias("b"))
    first = long.select(F.posexplode("pieces").alias("at", "x"), "pieces")
    both = first.select("x", F.explode(F.slice("pieces", F.col("at") + 2, F.greatest(F.size("pieces") - F.col("at") - 1, F.lit(0)))).alias("y"))
    across = both.repartition("x", "y").select(F.explode("x").alias("a"), "y").select("a", F.explode("y").alias("b"))
    return own.union(across)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(i, j, n11, n1x, nx1, nxx), i < j: rows in which both columns have their rare value, the
    rare value of i meets a NULL of j, a NULL of i the rare value of j, and two NULLs meet."""
    met = cell_pairs(rows).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    kind = F.col("a") % 2 * 2 + F.col("b") % 2
    return met.groupBy((F.expr("a div 2")).cast("int").alias("i"), (F.expr("b div 2")).cast("int").alias("j")).agg(
        *[F.sum(F.when(kind == k, F.col("n")).otherwise(0)).alias(c) for k, c in enumerate(("n11", "n1x", "nx1", "nxx"))])


def phi_pairs(df: DataFrame, cols: list[str], threshold: float | None = None) -> DataFrame:
    """(var1, var2, r) for the pairs of 0/1 columns, var1 < var2 by name; with ``threshold`` only
    those of |r| above it, otherwise all pairs.

    Rows in which either column is NULL are left out of a pair. r is NULL for a pair in which a
    column is constant, also for an empty table. A value other than 0, 1 and NULL is an error. The
    driver sees one row of counts per column."""
    spark = df.sparkSession
    if len(cols) < 2:
        return spark.createDataFrame([], "var1 string, var2 string, r double")
    # read three times; and Catalyst would put a filter on the exploded cells below their making,
    # with the defining expressions of all columns inlined
    df = cut_lineage(df.select(*[col(c) for c in cols]))
    n = df.count()
    counts = {r["cell"]: r["n"] for r in rare_cells(df, cols).select(F.explode("cells").alias("cell"))
              .groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    if -1 in counts:
        raise ValueError("phi needs columns of 0 and 1")
    ones, nulls = ([counts.get(2 * i + k, 0) for i in range(len(cols))] for k in (0, 1))
    flipped = {i for i in range(len(cols)) if 2 * ones[i] > n - nulls[i]}
    rare = [n - nulls[i] - ones[i] if i in flipped else ones[i] for i in range(len(cols))]
    table = spark.createDataFrame([(i, c, rare[i], nulls[i], i in flipped) for i, c in enumerate(cols)],
                                  "pos int, name string, rare long, nulls long, flipped boolean")
    met = pair_counts(cut_lineage(rare_cells(df, cols, flipped)))
    last = F.lit(len(cols) - 1)
    if threshold is None:
        pairs = table.filter(F.col("pos") < last).select(F.col("pos").alias("i"), F.explode(F.sequence(F.col("pos") + 1, last)).alias("j"))
    else:
        # columns that can pass without a row in common
        common = table.filter((F.col("rare") > F.lit(n * threshold / (1 + threshold))) | (F.col("nulls") > 0))
        other = common.select(F.col("pos"), F.explode(F.sequence(F.lit(0), last)).alias("o")).filter("pos <> o")
        pairs = met.select("i", "j").union(other.select(F.least("pos", "o").alias("i"), F.greatest("pos", "o").alias("j"))) \
            .filter("i < j").distinct()
    side = [F.broadcast(table.select(*[F.col(c).alias(f"{k}_{c}") for c in table.columns])) for k in ("i", "j")]   # one row per column
    t = pairs.join(met, ["i", "j"], "left").join(side[0], F.col("i") == F.col("i_pos")).join(side[1], F.col("j") == F.col("j_pos"))
    n11, n1x, nx1, nxx = (F.coalesce(c, F.lit(0)).cast(EXACT) for c in ("n11", "n1x", "nx1", "nxx"))
    both = F.lit(n).cast(EXACT) - F.col("i_nulls") - F.col("j_nulls") + nxx
    m1, m2 = F.col("i_rare") - n1x, F.col("j_rare") - nx1
    over = (both * n11).cast(EXACT) - (m1 * m2).cast(EXACT)
    under = F.sqrt((m1 * (both - m1)).cast("double")) * F.sqrt((m2 * (both - m2)).cast("double"))
    sign = F.when(F.col("i_flipped") != F.col("j_flipped"), -1.0).otherwise(1.0)
    r = F.try_divide(over.cast("double") * sign, under)
    out = t.select(F.least("i_name", "j_name").alias("var1"), F.greatest("i_name", "j_name").alias("var2"), r6(r).alias("r"))
    return out if threshold is None else out.filter(F.abs("r") > threshold)
