"""Cleaning, projection and alignment operators (P1-P17): all plain projections and one-pass checks."""

from __future__ import annotations

import re

from pyspark.ml import Transformer
from pyspark.ml.param import Param, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlytics.functions.exprs import (at_threshold, clean_name, col, decode_label, encode_label,
                                      finite_or)


def strip_text(c):
    """Strip surrounding whitespace (any kind) and remove double quotes."""
    return F.regexp_replace(F.regexp_replace(col(c), r"^\s+|\s+$", ""), '"', "")


def clean_column_names(df: DataFrame) -> DataFrame:
    """Strip blanks and remove double quotes from every column name."""
    return df.toDF(*[clean_name(c) for c in df.columns])


def clean_string_values(df: DataFrame) -> DataFrame:
    """Strip and remove double quotes in every string column."""
    return df.select(*[strip_text(f.name).alias(f.name) if f.dataType.typeName() == "string" else col(f.name)
                       for f in df.schema.fields])


def dedupe_columns(df: DataFrame) -> DataFrame:
    """Keep the first of duplicated column names (by position)."""
    seen, keep = set(), []
    for i, c in enumerate(df.columns):
        if c not in seen:
            seen.add(c)
            keep.append(i)
    if len(keep) == len(df.columns):
        return df
    tmp = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return tmp.select(*[F.col(f"_c{i}").alias(df.columns[i]) for i in keep])


def promote_suffixed(df: DataFrame, suffix: str = ".1") -> DataFrame:
    """``Xi.1`` becomes ``Xi`` when ``Xi`` is absent, otherwise it is dropped."""
    cols = df.columns
    out = []
    for c in cols:
        if c.endswith(suffix):
            base = c[: -len(suffix)]
            if base in cols:
                continue
            out.append(col(c).alias(base))
        else:
            out.append(col(c))
    return df.select(*out)


def encode_target(df: DataFrame, column: str, target: str = "y", positive: str = "ad.",
                  negative: str = "noad.", drop_source: bool = True) -> DataFrame:
    """Label text -> 1/0 (trim + lower); any other value is an error, checked in one pass."""
    bad = df.agg(F.count_if(encode_label(column, positive, negative).isNull()).alias("n")).first()["n"]
    if bad:
        raise ValueError(f"{bad} values of {column!r} are neither {positive!r} nor {negative!r}")
    out = df.withColumn(target, encode_label(column, positive, negative))
    return out.drop(column) if drop_source and column != target else out


def decode_target(df: DataFrame, column: str = "y", out: str = "label", positive: str = "ad.",
                  negative: str = "noad.") -> DataFrame:
    """0/1 -> label text (P5)."""
    return df.withColumn(out, decode_label(column, positive, negative))


def coerce_numeric(df: DataFrame, cols: list[str], fill: float | None = 0.0) -> DataFrame:
    """Remove ``"`` and ``'``, cast to double, unparseable -> NULL, then ``fill``."""
    sel = []
    for f in df.schema.fields:
        if f.name in cols:
            v = F.try_cast(F.regexp_replace(col(f.name).cast("string"), "[\"']", ""), "double") \
                if hasattr(F, "try_cast") else F.expr(f"try_cast(regexp_replace(`{f.name}`, '[\"\\']', '') AS DOUBLE)")
            sel.append((v if fill is None else F.coalesce(v, F.lit(float(fill)))).alias(f.name))
        else:
            sel.append(col(f.name))
    return df.select(*sel)


def align_columns(df: DataFrame, expected: list[str], fill=0, keep: list[str] = ()) -> DataFrame:
    """Project to the training columns in training order; absent ones become ``fill``."""
    present = set(df.columns)
    return df.select(*[col(k) for k in keep],
                     *[col(c) if c in present else F.lit(fill).alias(c) for c in expected])


def keep_present(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep only the listed columns that exist."""
    present = set(df.columns)
    return df.select(*[col(c) for c in cols if c in present])


def strict_align(df: DataFrame, expected: list[str], keep: list[str] = ()) -> DataFrame:
    """Fail when any training column is missing, else project in training order."""
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise ValueError(f"missing training columns: {missing[:10]}{'...' if len(missing) > 10 else ''}")
    return df.select(*[col(k) for k in keep], *[col(c) for c in expected])


def to_int_if_binary(df: DataFrame, column: str) -> DataFrame:
    """Cast to (nullable) int when the non-null values are within {0,1} (P10)."""
    bad = df.agg(F.count_if(col(column).isNotNull() & ~col(column).isin(0, 1)).alias("n")).first()["n"]
    return df if bad else df.withColumn(column, col(column).cast("int"))


def finalize_transformed(df: DataFrame, originals: list[str], suffix: str = "_trans",
                         rename: bool = False) -> DataFrame:
    """Drop original columns; keep ``{c}{suffix}`` or rename it back to ``c``."""
    out = df.drop(*[c for c in originals if f"{c}{suffix}" in df.columns])
    if rename:
        for c in originals:
            if f"{c}{suffix}" in out.columns:
                out = out.withColumnRenamed(f"{c}{suffix}", c)
    return out


def reorder_priority(df: DataFrame, priority: list[str], target: str | None = None) -> DataFrame:
    """Priority columns first, then the target, then the rest in table order."""
    head = [c for c in priority if c in df.columns]
    if target and target in df.columns and target not in head:
        head.append(target)
    return df.select(*[col(c) for c in head + [c for c in df.columns if c not in head]])


def sanitize_numeric(df: DataFrame, cols: list[str] | None = None, value: float = 0.0) -> DataFrame:
    """NULL, NaN, +/-Inf -> value in numeric columns."""
    cols = set(cols or [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")])
    return df.select(*[finite_or(f.name, value).alias(f.name) if f.name in cols else col(f.name)
                       for f in df.schema.fields])


def predict_at(df: DataFrame, score: str = "p", threshold=0.5, out: str = "pred") -> DataFrame:
    """Inclusive decision rule score >= threshold as an int column."""
    t = col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    return df.withColumn(out, at_threshold(score, t))


class ColumnMaskSelector(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage keeping the columns whose mask entry is true.

    ``inputCols`` are the candidate names, ``mask`` a list of booleans of the same length; the
    selected names are ``selected()``; rows pass through with the other columns unchanged."""

    def __init__(self, inputCols=None, mask=None, keep=None):
        super().__init__()
        self.mask = Param(self, "mask", "whether each input column is kept", TypeConverters.toList)
        self.keep = Param(self, "keep", "columns that always pass", TypeConverters.toListString)
        self._setDefault(mask=[], keep=[])
        self._set(mask=[bool(m) for m in mask] if mask is not None else None, keep=keep, inputCols=inputCols)

    def selected(self) -> list[str]:
        cols = self.getInputCols()
        mask = self.getOrDefault(self.mask)
        if len(cols) != len(mask):
            raise ValueError("mask length differs from the number of input columns")
        return [c for c, m in zip(cols, mask) if m]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.select(*[col(c) for c in self.getOrDefault(self.keep)], *[col(c) for c in self.selected()])


def valid_identifier(name: str) -> bool:
    return re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name) is not None
