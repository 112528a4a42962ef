"""Sources and sinks (S1-S15): delimited text, Parquet, JSON result files, multi-format export.

Readers take the separator from the header line only (one line read on the driver), then the
whole read is a distributed ``spark.read.csv``. Result tables (thresholds, metrics) are small
DataFrames written with ``write.json``; reading many of them back is one ``read.json`` with the
file name from ``_metadata``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlytics.functions.exprs import col, nan_to_null
from adlytics.operators.clean import clean_column_names, clean_string_values, dedupe_columns, promote_suffixed
from adlytics.session import cut_lineage


def sniff_separator(spark: SparkSession, path: str, candidates=("\t", ",")) -> str:
    """First candidate that splits the header line into more than one field."""
    head = spark.read.text(path).limit(1).collect()
    line = head[0][0] if head else ""
    for sep in candidates:
        if len(line.split(sep)) > 1:
            return sep
    return candidates[-1]


def read_delimited(spark: SparkSession, path: str, sep: str | None = None, null_value: str | None = None,
                   infer: bool = True, schema=None, malformed: str = "PERMISSIVE", encoding: str = "UTF-8",
                   clean: bool = True) -> DataFrame:
    """Delimited text with header; tab then comma fallback; optional '?' as NULL.

    With ``clean`` the names and text values are stripped of blanks and quotes and duplicated
    ``.1`` columns are resolved (P1-P3, P14). NaN is read as NULL."""
    sep = sep or sniff_separator(spark, path)
    r = (spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
         .option("encoding", encoding).option("mode", malformed))
    if null_value is not None:
        r = r.option("nullValue", null_value)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    df = r.csv(path)
    if clean:
        df = promote_suffixed(dedupe_columns(clean_string_values(clean_column_names(df))))
    # a number read as NaN is a missing value everywhere in the library
    return df.select(*[nan_to_null(f.name).alias(f.name) if f.dataType.typeName() in ("double", "float") else col(f.name)
                       for f in df.schema.fields])


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Fail fast when a required column is absent."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def with_row_ids(df: DataFrame, name: str = "ID", start: int = 1) -> DataFrame:
    """Consecutive ids start, start+1, ... in input order (S3).

    Per-partition row counts (one small aggregate) give each partition its offset; rows are
    numbered inside their own partition, so no single-partition window is needed."""
    tagged = df.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    # partition ids and row order must not change on recomputation: materialise them once
    tagged = cut_lineage(tagged)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.select("_pid", (F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + start).alias("_off"))
    w = Window.partitionBy("_pid").orderBy("_mid")
    out = tagged.join(F.broadcast(offs), "_pid").withColumn(name, F.col("_off") + F.row_number().over(w) - 1)
    return out.drop("_pid", "_mid", "_off")


def shape_report(df: DataFrame, expected_rows: int | None = None, expected_cols: int | None = None) -> DataFrame:
    """One row: rows, cols and whether they match the expected shape."""
    n = df.count()
    ok = (expected_rows is None or n == expected_rows) and (expected_cols is None or len(df.columns) == expected_cols)
    return df.sparkSession.createDataFrame([(n, len(df.columns), ok)], "n_rows long, n_cols int, matches boolean")


def write_table(df: DataFrame, path: str, fmt: str | None = None, mode: str = "overwrite",
                compression: str | None = None, header: bool = True, partition_by: list[str] | None = None) -> str:
    """Write by format or by path extension: parquet / csv / json."""
    fmt = fmt or os.path.splitext(path)[1].lstrip(".") or "parquet"
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", header).csv(path)
    elif fmt == "json":
        w.json(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return path


def read_table(spark: SparkSession, path: str, fmt: str | None = None, header: bool = True) -> DataFrame:
    """Read by format or by path extension."""
    fmt = fmt or os.path.splitext(path.rstrip("/"))[1].lstrip(".") or "parquet"
    if fmt == "csv":
        return spark.read.option("header", header).option("inferSchema", True).csv(path)
    if fmt == "json":
        return spark.read.json(path)
    return spark.read.parquet(path)


def export_formats(datasets: dict[str, DataFrame], folder: str, formats=("parquet", "csv"),
                   compress: bool = True) -> DataFrame:
    """Write every dataset in every format (snappy parquet, gzip csv) and list what was written."""
    rows = []
    spark = None
    for name, df in datasets.items():
        spark = df.sparkSession
        for fmt in formats:
            comp = ("snappy" if fmt == "parquet" else "gzip") if compress else None
            path = os.path.join(folder, f"{name}.{fmt}")
            write_table(df, path, fmt, compression=comp)
            rows.append((name, fmt, path))
    return spark.createDataFrame(rows, "dataset string, format string, path string")


def discover_variants(spark: SparkSession, root: str, column: str = "variant") -> DataFrame:
    """Read a ``variant=``-partitioned Parquet dataset; filters on the variant prune folders."""
    return spark.read.option("basePath", root).parquet(root)


def write_results_json(df: DataFrame, path: str) -> str:
    """Result table (thresholds, metrics, comparisons) -> JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_thresholds_json(spark: SparkSession, path: str, imputation: str, version: str) -> DataFrame:
    """JSON map {model: {threshold, f1, precision, recall}} -> rows tagged with imputation and
    version (S12)."""
    raw = spark.read.text(path, wholetext=True)
    m = F.from_json("value", "map<string, struct<threshold: double, f1: double, precision: double, recall: double>>")
    return raw.select(F.explode(m).alias("model", "r")).select(
        "model", "r.*", F.lit(imputation).alias("imputation"), F.lit(version).alias("version"))


def comparison_from_files(spark: SparkSession, paths: list[str], details: DataFrame | None = None,
                          metric: str = "f1") -> DataFrame:
    """Many JSON result files -> one table with the source file, display details joined by file
    name (default when absent), test metric preferred over val, sorted desc (S13, J2)."""
    df = spark.read.json(paths).withColumn("file", F.col("_metadata.file_name"))
    if details is not None:
        df = df.join(details, "file", "left").withColumn(
            "label", F.coalesce(F.col("label"), F.col("file")))
    cols = set(df.columns)
    score = F.coalesce(*[F.col(c) for c in (f"test_{metric}", f"val_{metric}", metric) if c in cols])
    return df.withColumn("score", score).orderBy(F.col("score").desc_nulls_last())


def batch_process(datasets: dict[str, DataFrame], step) -> tuple[dict[str, DataFrame | None], DataFrame]:
    """Apply ``step`` to each dataset; a failing one yields None and a status row.

    Each dataset is a job of its own that computes its result, so what fails while running is
    isolated like what fails while planning."""
    from adlytics.operators.jobs import materialised, run_jobs, status_table
    spark = next(iter(datasets.values())).sparkSession
    done = run_jobs(spark, {n: (lambda d=d: materialised(step(d))) for n, d in datasets.items()})
    status = status_table(spark, done).select(F.col("job").alias("dataset"), "status", "error")
    return {n: o.value for n, o in done.items()}, status
