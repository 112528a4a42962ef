"""Helpers shared by the operators: melting wide tables, small driver-side parameter reads."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlytics.functions.exprs import col


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if f.dataType.typeName() in ("double", "float", "integer", "long", "short", "byte",
                                         "decimal", "boolean")
            and f.name not in ex]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if f.dataType.typeName() == "string" and f.name not in ex]


def melt(df: DataFrame, cols: list[str], keep: list[str] | None = None,
         name: str = "column", value: str = "value") -> DataFrame:
    """Wide -> long (keep..., column, value double); NULL values are kept.

    Uses Spark's Expand (``unpivot``), so one scan serves any number of columns and the later
    ``groupBy(column)`` aggregates partially before its (tiny) shuffle.
    """
    keep = list(keep or [])
    casted = df.selectExpr(*[quoted(k) for k in keep], *[f"CAST({quoted(c)} AS DOUBLE) AS {quoted(c)}" for c in cols])
    return casted.unpivot(keep or [], [col(c) for c in cols], name, value) if keep else \
        casted.unpivot([], [col(c) for c in cols], name, value)


def quoted(name: str) -> str:
    return f"`{name}`"


def row_sum(terms: list[str]):
    """Sum of many SQL terms of a row, from left to right: one array, as a chain of additions
    over a wide table would be an expression as deep as the table is wide. The terms are text
    because a Column object per cell costs more than the job at thousands of columns."""
    cells = ", ".join(f"CAST({t} AS DOUBLE)" for t in terms)
    return F.expr(f"aggregate(array({cells}), 0D, (total, cell) -> total + cell)") if terms else F.lit(0.0)


def null_flags(df: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """(keep..., column, missing 0/1) of any types, one row per cell. Cells are told apart by
    position until the caller's grouping; names come from ``name_columns``."""
    flags = F.expr(f"array({', '.join(f'CAST({quoted(c)} IS NULL AS INT)' for c in cols)})")
    return df.select(*[col(k) for k in keep or []], F.posexplode(flags).alias("column", "missing"))


def name_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """The positions in ``column`` replaced by names."""
    names = F.from_json(F.lit(json.dumps(cols)), "array<string>")
    return df.withColumn("column", F.element_at(names, F.col("column") + 1))


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, n_rows, n_missing) by one scan, for any number of columns; no row for an empty table."""
    g = null_flags(df, cols).groupBy("column").agg(F.count(F.lit(1)).alias("n_rows"),
                                                   F.sum("missing").alias("n_missing"))
    return name_columns(g, cols)


def one_row(df: DataFrame) -> dict:
    """Collect a one-row aggregate (metadata-sized) as a dict."""
    r = df.collect()
    return r[0].asDict() if r else {}


def lit_map(d: dict, value_type: str = "double"):
    """A literal MAP<STRING, value_type> column built from a small driver dict."""
    if not d:
        return F.create_map().cast(f"map<string,{value_type}>")
    items = []
    for k, v in d.items():
        items += [F.lit(k), F.lit(v).cast(value_type)]
    return F.create_map(*items)


def chunks(seq, n):
    seq = list(seq)
    for i in range(0, len(seq), n):
        yield seq[i:i + n]

