"""Profiling and validation operators (column kinds, target, missing data, moments, shapes).

Per-column statistics are computed on the melted table ``(column, value)`` grouped by column:
one scan of the input whatever its width, partial aggregation before a shuffle of
(#partitions x #columns) rows. Results are small long tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlytics.functions.exprs import col, r6, safe_corr, skew_adjusted
from adlytics.operators.common import melt, name_columns, null_counts, null_flags, numeric_columns, one_row, quoted, row_sum
from adlytics.operators.quantiles import column_quantiles, exact_quantiles, with_quantiles

KIND_ORDER = ("continuous", "binary", "integer", "categorical")
QUARTILES = ["q25", "q50", "q75"]


# ----------------------------------------------------------------------------------- D1
def classify_columns(df: DataFrame, cols: list[str] | None = None, strict_dtype: bool = False,
                     exclude=()) -> DataFrame:
    """(column, dtype, kind): continuous / binary / integer / categorical.

    Value-based: a numeric column whose non-null values are all in {0,1} (and has at least one)
    is binary; other integral columns are integer; fractional are continuous. With
    ``strict_dtype`` floating columns are continuous whatever their values.
    """
    cols = [c for c in (cols or df.columns) if c not in set(exclude)]
    types = {f.name: f.dataType for f in df.schema.fields}
    num = [c for c in cols if c in numeric_columns(df)]
    stats = (melt(df, num).groupBy("column")
             .agg(F.count("value").alias("nn"),
                  F.count_if(~F.col("value").isin(0.0, 1.0)).alias("bad"))) if num else None
    meta = df.sparkSession.createDataFrame(
        [(c, types[c].simpleString(), i) for i, c in enumerate(cols)],
        "column string, dtype string, pos int")
    if stats is None:
        out = meta.withColumn("nn", F.lit(0)).withColumn("bad", F.lit(0))
    else:
        out = meta.join(F.broadcast(stats), "column", "left")
    fractional = F.col("dtype").isin("double", "float") | F.col("dtype").startswith("decimal")
    integral = F.col("dtype").isin("int", "bigint", "smallint", "tinyint", "boolean")
    is_bin = (F.col("nn") > 0) & (F.col("bad") == 0)
    if strict_dtype:
        kind = (F.when(fractional, "continuous").when(integral & is_bin, "binary")
                .when(integral, "integer").otherwise("categorical"))
    else:
        kind = (F.when((fractional | integral) & is_bin, "binary").when(fractional, "continuous")
                .when(integral, "integer").otherwise("categorical"))
    return out.select("column", "dtype", kind.alias("kind"))


def columns_of_kind(df: DataFrame, kind: str, exclude=(), strict_dtype=False) -> list[str]:
    rows = classify_columns(df, exclude=exclude, strict_dtype=strict_dtype).filter(
        F.col("kind") == kind).select("column").collect()
    order = {c: i for i, c in enumerate(df.columns)}
    return sorted((r[0] for r in rows), key=order.get)


# ----------------------------------------------------------------------------------- D2, D12, D13
def target_distribution(df: DataFrame, target: str = "y") -> DataFrame:
    """One row: counts, shares, majority/minority, imbalance ratio, naive baseline F1."""
    y = col(target)
    a = df.agg(F.count(F.lit(1)).alias("n_rows"),
               F.count_if(y.isNull()).alias("n_missing"),
               F.count_if(y == 0).alias("n0"),
               F.count_if(y == 1).alias("n1"),
               F.count_if(y.isNotNull() & ~y.isin(0, 1)).alias("n_other"))
    n = F.col("n_rows").cast("double")
    maj = F.when(F.col("n1") > F.col("n0"), 1).otherwise(0)
    mino = F.when(F.col("n1") < F.col("n0"), 1).otherwise(0)
    nmaj = F.greatest("n0", "n1").cast("double")
    nmin = F.least("n0", "n1").cast("double")
    minp = F.try_divide(nmin, n)
    return a.select(
        "n_rows", "n_missing", "n0", "n1",
        r6(F.try_divide(F.col("n0") * 100.0, n)).alias("pct0"),
        r6(F.try_divide(F.col("n1") * 100.0, n)).alias("pct1"),
        maj.alias("majority_class"), mino.alias("minority_class"),
        r6(F.try_divide(nmaj, nmin)).alias("imbalance_ratio"),
        r6(minp).alias("minority_prop"),
        r6(F.try_divide(nmaj, n)).alias("majority_prop"),
        r6(F.try_divide(2 * minp, 1 + minp)).alias("baseline_f1"),
        ((F.col("n_other") == 0) & (F.col("n_missing") == 0) & (F.col("n0") > 0) & (F.col("n1") > 0))
        .alias("target_valid"))


def validate_target(df: DataFrame, target: str = "y") -> DataFrame:
    """Target present, values exactly {0,1}, integral type; counts and %."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} is missing")
    dtype = dict(df.dtypes)[target]
    return target_distribution(df, target).select(
        F.lit(target).alias("target"), F.lit(dtype).alias("dtype"),
        F.lit(dtype in ("int", "bigint", "smallint", "tinyint")).alias("is_integer"),
        "n_rows", "n_missing", "n0", "n1", "pct0", "pct1", "target_valid")


# Imbalance ratios at which the next band begins, and from which a strategy is advised.
MODERATE_RATIO, SEVERE_RATIO, CRITICAL_RATIO = 2, 5, 10
RESAMPLING_RATIO, ENSEMBLES_RATIO = 3, 6


def imbalance_severity(dist: DataFrame) -> DataFrame:
    """Band of the imbalance ratio (<2, <5, <10, else) and strategy flags (>=3, >=6)."""
    r = F.col("imbalance_ratio")
    return dist.select(
        "imbalance_ratio",
        F.when(r < MODERATE_RATIO, "light").when(r < SEVERE_RATIO, "moderate").when(r < CRITICAL_RATIO, "severe")
        .otherwise("critical").alias("severity"),
        (r >= RESAMPLING_RATIO).alias("use_resampling"), (r >= ENSEMBLES_RATIO).alias("use_ensembles"))


# ----------------------------------------------------------------------------------- D3, D5, D6
def schema_table(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column string, dtype string")


def compare_schemas(a: DataFrame, b: DataFrame) -> DataFrame:
    """(column, dtype_a, dtype_b, in_a, in_b, type_match) over the union of names (D3)."""
    sa = schema_table(a).withColumnRenamed("dtype", "dtype_a")
    sb = schema_table(b).withColumnRenamed("dtype", "dtype_b")
    j = sa.join(sb, "column", "full_outer")
    return j.select("column", "dtype_a", "dtype_b",
                    F.col("dtype_a").isNotNull().alias("in_a"),
                    F.col("dtype_b").isNotNull().alias("in_b"),
                    F.coalesce(F.col("dtype_a") == F.col("dtype_b"), F.lit(False)).alias("type_match"))


def total_nulls(df: DataFrame) -> DataFrame:
    """One row: rows and total NULL cells, in one scan."""
    nulls = F.sum(row_sum([f"{quoted(c)} IS NULL" for c in df.columns]))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(nulls, F.lit(0.0)).cast("long").alias("n_nulls"))


def compare_frames(a: DataFrame, b: DataFrame) -> DataFrame:
    """Shapes, column names only on one side, total nulls of both."""
    na, nb = total_nulls(a).first(), total_nulls(b).first()
    only_l = sorted(set(a.columns) - set(b.columns))
    only_r = sorted(set(b.columns) - set(a.columns))
    return a.sparkSession.createDataFrame(
        [(na[0], len(a.columns), nb[0], len(b.columns), ",".join(only_l), ",".join(only_r),
          na[1], nb[1], len(set(a.columns) & set(b.columns)))],
        "rows_a long, cols_a int, rows_b long, cols_b int, only_left string, only_right string, "
        "nulls_a long, nulls_b long, n_common int")


def shape_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row and column change between two stages."""
    nb, na = before.count(), after.count()
    return before.sparkSession.createDataFrame(
        [(nb, na, na - nb, round(100.0 * (na - nb) / nb, 6) + 0.0 if nb else 0.0,
          len(before.columns), len(after.columns), len(after.columns) - len(before.columns))],
        "rows_before long, rows_after long, d_rows long, d_rows_pct double, cols_before int, "
        "cols_after int, d_cols int")


# ----------------------------------------------------------------------------------- D7, D29
def summarize_dataset(df: DataFrame) -> DataFrame:
    """One row: shape, dtype counts, nulls, mean of column means and stds, mean distinct of text."""
    num = numeric_columns(df)
    txt = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    spark = df.sparkSession
    n_rows, n_nulls = total_nulls(df).first()
    cells = n_rows * len(df.columns)
    mom = melt(df, num).groupBy("column").agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s")) \
        .agg(F.avg("m"), F.avg("s")).first() if num else (None, None)
    words = df.select(*[col(c) for c in txt]).unpivot([], [col(c) for c in txt], "column", "value") \
        .groupBy("column").agg(F.count_distinct("value").alias("d")).agg(F.avg("d")).first() if txt else (None,)
    # one row of totals, already aggregated
    one = spark.createDataFrame([(n_rows, n_nulls, 100.0 * n_nulls / cells if cells else None, *mom, words[0] if n_rows or not txt else 0.0)],
                                "n_rows long, n_nulls long, null_pct double, m double, s double, d double")
    return one.select("n_rows", F.lit(len(df.columns)).alias("n_cols"),
                      F.lit(len(num)).alias("n_numeric"), F.lit(len(txt)).alias("n_text"),
                      "n_nulls", r6("null_pct").alias("null_pct"), r6("m").alias("mean_of_means"),
                      r6("s").alias("mean_of_stds"), r6("d").alias("mean_distinct_text"))


def summary_statistics(df: DataFrame, target: str = "y") -> DataFrame:
    """One row: rows, cols, class shares, numeric count, mean per-column null rate %."""
    y = col(target)
    mean_rate = F.avg(row_sum([f"{quoted(c)} IS NULL" for c in df.columns]) / len(df.columns))
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  r6(F.avg((y == 0).cast("double"))).alias("share0"),
                  r6(F.avg((y == 1).cast("double"))).alias("share1"),
                  r6(mean_rate * 100.0).alias("mean_null_pct")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_cols"),
        F.lit(len(numeric_columns(df))).alias("n_numeric"), "share0", "share1", "mean_null_pct")


# ----------------------------------------------------------------------------------- D8
def preprocessing_summary(df: DataFrame, target: str = "y") -> DataFrame:
    """Long table (section, name, value): nulls per column, column kinds, class counts, balance."""
    nulls = (melt(df, [c for c in df.columns if c != target and c in numeric_columns(df)])
             .groupBy("column").agg(F.count_if(F.col("value").isNull()).cast("double").alias("value"))
             .select(F.lit("null_count").alias("section"), F.col("column").alias("name"), "value"))
    kinds = (classify_columns(df, exclude=[target]).groupBy("kind").count()
             .select(F.lit("kind_count").alias("section"), F.col("kind").alias("name"),
                     F.col("count").cast("double").alias("value")))
    classes = (df.groupBy(col(target).cast("string").alias("name")).count()
               .select(F.lit("class_count").alias("section"), "name", F.col("count").cast("double").alias("value")))
    bal = (df.agg(F.try_divide(F.least(F.count_if(col(target) == 0), F.count_if(col(target) == 1)),
                               F.greatest(F.count_if(col(target) == 0), F.count_if(col(target) == 1)))
                  .cast("double").alias("value"))
           .select(F.lit("balance").alias("section"), F.lit("minority_over_majority").alias("name"),
                   r6("value").alias("value")))
    return nulls.unionByName(kinds).unionByName(classes).unionByName(bal)


# ----------------------------------------------------------------------------------- D9, D10, D31
def protected_check(df: DataFrame, column: str) -> DataFrame:
    """(column, present, n_null, n_bad, ok): protected column present and within {0,1}."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([(column, False, None, None, False)],
                                               "column string, present boolean, n_null long, n_bad long, ok boolean")
    c = col(column)
    return df.agg(F.count_if(c.isNull()).alias("n_null"),
                  F.count_if(c.isNotNull() & ~c.isin(0, 1)).alias("n_bad")).select(
        F.lit(column).alias("column"), F.lit(True).alias("present"), "n_null", "n_bad",
        (F.col("n_bad") == 0).alias("ok"))


def order_ok(columns: list[str], priority: list[str], target: str) -> bool:
    """Column-order rule: the present priority columns first, in order, then the target."""
    head = [c for c in priority if c in columns] + ([target] if target in columns else [])
    return columns[:len(head)] == head


def quality_report(variants: dict[str, DataFrame], target: str = "y", protected: str | None = "X4",
                   priority: list[str] | None = None, max_cols: int = 1000, min_rows: int = 1000) -> DataFrame:
    """One row per variant: six boolean checks and score = share passed.

    The column and row limits are parameters (defaults 1000 / 1000)."""
    out = None
    for name, df in variants.items():
        t = total_nulls(df).select(
            F.lit(name).alias("variant"), "n_rows", F.lit(len(df.columns)).alias("n_cols"), "n_nulls")
        checks = [F.lit(order_ok(df.columns, priority or [], target)),
                  F.lit(protected is None or protected in df.columns),
                  F.lit(target in df.columns),
                  F.col("n_nulls") == 0,
                  F.col("n_cols") < max_cols,
                  F.col("n_rows") > min_rows]
        names = ["order_ok", "has_protected", "has_target", "no_nulls", "reduced", "enough_rows"]
        t = t.select("*", *[c.alias(n) for c, n in zip(checks, names)])
        t = t.withColumn("quality_score",
                         r6(reduce(lambda x, y: x + y, [F.col(n).cast("double") for n in names]) / 6.0))
        out = t if out is None else out.unionByName(t)
    return out


def post_prep_check(df: DataFrame, protected: str, priority: list[str], target: str) -> DataFrame:
    """Protected column valid and column order respected."""
    p = protected_check(df, protected)
    return p.select(F.col("ok").alias("protected_ok"),
                    F.lit(order_ok(df.columns, priority, target)).alias("order_ok")).select(
        "*", (F.col("protected_ok") & F.col("order_ok")).alias("valid"))


# ----------------------------------------------------------------------------------- D11
def split_overlap(df: DataFrame, id_col: str, split_col: str = "split",
                  splits=("train", "val", "test")) -> DataFrame:
    """Rows per split and ids shared between each pair of splits.

    One shuffle on the id: each id's split-membership flags, then sums per pair."""
    flags = df.groupBy(col(id_col)).agg(*[F.max((col(split_col) == s).cast("int")).alias(s) for s in splits])
    pairs = [(a, b) for i, a in enumerate(splits) for b in splits[i + 1:]]
    shared = flags.agg(*[F.sum(F.col(a) * F.col(b)).cast("long").alias(f"{a}|{b}") for a, b in pairs])
    sizes = df.groupBy(col(split_col).alias("split")).agg(F.count(F.lit(1)).alias("n_rows"))
    sh = shared.select(F.explode(F.array(*[F.struct(F.lit(a).alias("split_a"), F.lit(b).alias("split_b"),
                                                    F.coalesce(F.col(f"`{a}|{b}`"), F.lit(0)).alias("n_shared"))
                                           for a, b in pairs])).alias("s")).select("s.*")
    return (sh.join(sizes.withColumnRenamed("split", "split_a").withColumnRenamed("n_rows", "rows_a"), "split_a", "left")
            .join(sizes.withColumnRenamed("split", "split_b").withColumnRenamed("n_rows", "rows_b"), "split_b", "left")
            .select("split_a", "split_b", F.coalesce("rows_a", F.lit(0)).alias("rows_a"),
                    F.coalesce("rows_b", F.lit(0)).alias("rows_b"), "n_shared",
                    (F.col("n_shared") == 0).alias("disjoint")))


# ----------------------------------------------------------------------------------- D14, D15, D16
# Percentages of missing cells above which a column is critical, high, medium.
CRITICAL_PCT, HIGH_PCT, MEDIUM_PCT = 50, 30, 10


def missing_by_column(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, n_missing, pct_missing, band) for columns with at least one NULL.

    Bands: critical > 50 %, high 30-50 %, medium 10-30 %, low <= 10 %."""
    cols = cols or df.columns
    long = null_counts(df, cols)
    pct = F.col("n_missing") * 100.0 / F.col("n_rows")
    band = F.when(pct > CRITICAL_PCT, "critical").when(pct > HIGH_PCT, "high").when(pct > MEDIUM_PCT, "medium").otherwise("low")
    return long.filter(F.col("n_missing") > 0).select(
        "column", "n_missing", r6(pct).alias("pct_missing"), band.alias("band"))


def missing_summary(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row: total missing cells, % of cells, affected columns and their count per band."""
    cols = cols or df.columns
    per = missing_by_column(df, cols)
    n_rows = df.count()
    return per.agg(F.coalesce(F.sum("n_missing"), F.lit(0)).cast("long").alias("total_missing"),
                   F.count(F.lit(1)).alias("n_cols_missing"),
                   F.count_if(F.col("band") == "critical").alias("n_critical"),
                   F.count_if(F.col("band") == "high").alias("n_high"),
                   F.count_if(F.col("band") == "medium").alias("n_medium"),
                   F.count_if(F.col("band") == "low").alias("n_low")).select(
        "total_missing",
        r6(F.col("total_missing") * 100.0 / F.lit(float(max(n_rows * len(cols), 1)))).alias("pct_missing"),
        "n_cols_missing", "n_critical", "n_high", "n_medium", "n_low")


def missing_vs_target(df: DataFrame, cols: list[str], target: str = "y", mar_threshold: float = 0.1) -> DataFrame:
    """(column, r_missing_target, mar): corr(is-null indicator, target), MAR flag |r| > t."""
    long = null_flags(df, cols, [target]).groupBy("column").agg(safe_corr("missing", target).alias("r"))
    long = name_columns(long, cols)
    return long.select("column", r6("r").alias("r_missing_target"),
                       F.coalesce(F.abs("r") > mar_threshold, F.lit(False)).alias("mar"))


def missing_patterns(df: DataFrame, cols: list[str]) -> DataFrame:
    """(pattern, n): rows per null pattern, one character per column ('1' = NULL)."""
    pat = F.concat(*[F.when(col(c).isNull(), "1").otherwise("0") for c in cols])
    return df.groupBy(pat.alias("pattern")).agg(F.count(F.lit(1)).alias("n"))


# ----------------------------------------------------------------------------------- D17-D19
def describe(df: DataFrame, cols: list[str], exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max); exact quartiles by default."""
    v, quartiles = F.col("value"), [0.25, 0.5, 0.75]
    long = melt(df, cols)
    approx = [] if exact else [F.percentile_approx(v, quartiles, accuracy).alias("_q")]
    stats = long.groupBy("column").agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
        F.max(v).alias("max"), *approx)
    if exact:
        stats = with_quantiles(stats, ["column"], exact_quantiles(long, ["column"], quartiles, accuracy), QUARTILES)
    else:
        stats = stats.select("*", *[F.col("_q")[i].alias(n) for i, n in enumerate(QUARTILES)])
    return stats.select("column", "count", *[r6(n).alias(n) for n in ("mean", "std", "min", *QUARTILES, "max")])


def moments(df: DataFrame, cols: list[str], alpha: float = 0.01) -> DataFrame:
    """(column, n, skew_pop, skew_adj, kurt_pop, jb, jb_p, normal).

    The normality test is Jarque-Bera on the full column: JB = n/6 (S^2 + K^2/4), p = exp(-JB/2)."""
    v = F.col("value")
    m = melt(df, cols).groupBy("column").agg(
        F.count(v).alias("n"), F.skewness(v).alias("s"), skew_adjusted(v).alias("sa"), F.kurtosis(v).alias("k"))
    jb = F.col("n") / 6.0 * (F.col("s") * F.col("s") + F.col("k") * F.col("k") / 4.0)
    return m.select("column", "n", r6("s").alias("skew_pop"), r6("sa").alias("skew_adj"),
                    r6("k").alias("kurt_pop"), r6(jb).alias("jb"), r6(F.exp(-jb / 2.0)).alias("jb_p"),
                    (F.exp(-jb / 2.0) > alpha).alias("normal"))


# ----------------------------------------------------------------------------------- D20-D22
def value_distribution(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, n, share) for each value of each (binary) column; share over non-null."""
    g = melt(df, cols).filter(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column")
    return g.select("column", "value", "n", r6(F.col("n") / F.sum("n").over(w)).alias("share"))


def presence_rates(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, rate): mean of each 0/1 column over non-null rows."""
    return melt(df, cols).groupBy("column").agg(r6(F.avg("value")).alias("rate"))


def presence_rate_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: n, mean, std, min, median, max of the per-column presence rates."""
    r = melt(df, cols).groupBy("column").agg(F.avg("value").alias("rate"))
    return r.agg(F.count(F.lit(1)).alias("n_cols"), r6(F.avg("rate")).alias("mean_rate"),
                 r6(F.stddev_samp("rate")).alias("std_rate"), r6(F.min("rate")).alias("min_rate"),
                 r6(F.median("rate")).alias("median_rate"), r6(F.max("rate")).alias("max_rate"))


def sparsity(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: ones, cells, sparsity % = 100 (1 - ones/cells) over binary columns."""
    ones = F.sum(row_sum([f"coalesce({quoted(c)} = 1, false)" for c in cols]))
    a = df.agg(F.coalesce(ones, F.lit(0.0)).cast("long").alias("n_ones"), F.count(F.lit(1)).alias("n_rows"))
    cells = F.col("n_rows") * F.lit(len(cols))
    return a.select("n_ones", cells.cast("long").alias("n_cells"),
                    r6(F.try_divide(F.lit(100.0) * (cells - F.col("n_ones")), cells)).alias("sparsity_pct"))


# ----------------------------------------------------------------------------------- D23-D26
def histogram(df: DataFrame, cols: list[str], bins: int = 20, density: bool = False) -> DataFrame:
    """(column, bin, lo, hi, n[, density]) equal-width, last bin closed on the right.

    Min and max per column come from one aggregate; every bin is reported, empty ones with 0."""
    long = melt(df, cols).filter(F.col("value").isNotNull())
    rng = long.groupBy("column").agg(F.min("value").alias("mn"), F.max("value").alias("mx"))
    lo = F.when(F.col("mx") == F.col("mn"), F.col("mn") - 0.5).otherwise(F.col("mn"))
    hi = F.when(F.col("mx") == F.col("mn"), F.col("mx") + 0.5).otherwise(F.col("mx"))
    rng = rng.select("column", lo.alias("lo"), hi.alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    counts = (long.join(F.broadcast(rng), "column").groupBy("column", b.alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    grid = rng.select("column", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(counts, ["column", "bin"], "left").select(
        "column", "bin", r6(F.col("lo") + F.col("bin") * width).alias("lo"),
        r6(F.col("lo") + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"), width.alias("_w"))
    if density:
        tot = Window.partitionBy("column")
        out = out.withColumn("density", r6(F.col("n") / (F.sum("n").over(tot) * F.col("_w"))))
    return out.drop("_w")


def quartile_bounds(df: DataFrame, cols: list[str], m: float = 1.5,
                    lower_q: float = 0.25, upper_q: float = 0.75) -> dict:
    """{column: (q_lo, q_hi, lo_fence, hi_fence)} from exact quantiles; Nones for a column of NULLs."""
    found = column_quantiles(melt(df, cols), [lower_q, upper_q])
    return {c: _fences(*found[c], m) if c in found else (None, None, None, None) for c in cols}


def _fences(q1: float, q3: float, m: float) -> tuple:
    return q1, q3, q1 - m * (q3 - q1), q3 + m * (q3 - q1)


def boxplot_table(df: DataFrame, cols: list[str], m: float = 1.5) -> DataFrame:
    """(column, q1, median, q3, iqr, lo_whisker, hi_whisker, n_outliers).

    Pass 1: exact quartiles (metadata); pass 2: whisker ends and outlier counts."""
    v = F.col("value")
    from adlytics.operators.common import lit_map
    found = exact_quantiles(melt(df, cols), ["column"], [0.25, 0.5, 0.75])
    fences = {c: _fences(q[0], q[2], m) for (c,), q in found.items()}
    lo, hi = {c: f[2] for c, f in fences.items()}, {c: f[3] for c, f in fences.items()}
    long = melt(df, cols).filter(v.isNotNull()).select(
        "column", "value", F.element_at(lit_map(lo), F.col("column")).alias("lo"),
        F.element_at(lit_map(hi), F.col("column")).alias("hi"))
    w = long.groupBy("column").agg(F.min(F.when(v >= F.col("lo"), v)).alias("lo_whisker"),
                                   F.max(F.when(v <= F.col("hi"), v)).alias("hi_whisker"),
                                   F.count_if((v < F.col("lo")) | (v > F.col("hi"))).alias("n_outliers"))
    return with_quantiles(w, ["column"], found, ["q1", "med", "q3"]).select("column", r6("q1").alias("q1"), r6("med").alias("median"),
                                      r6("q3").alias("q3"), r6(F.col("q3") - F.col("q1")).alias("iqr"),
                                      r6("lo_whisker").alias("lo_whisker"), r6("hi_whisker").alias("hi_whisker"),
                                      "n_outliers")


def class_profile(df: DataFrame, cols: list[str], target: str = "y") -> DataFrame:
    """(y, column, n, mean, q1, median, q3): continuous columns by class."""
    v = F.col("value")
    long = melt(df, cols, keep=[target]).select(col(target).alias("y"), "column", "value")
    stats = long.groupBy("y", "column").agg(F.count(v).alias("n"), F.avg(v).alias("mean"))
    found = exact_quantiles(long, ["y", "column"], [0.25, 0.5, 0.75])
    names = ["q1", "median", "q3"]
    return with_quantiles(stats, ["y", "column"], found, names).select(
        "y", "column", "n", r6("mean").alias("mean"), *[r6(n).alias(n) for n in names])


def class_shares(df: DataFrame, target: str = "y") -> DataFrame:
    """(class, n, pct, label) with label text like '1: 12.8%' (D26)."""
    g = df.groupBy(col(target).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    pct = F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 1)
    return g.select("class", "n", r6(pct).alias("pct"),
                    F.concat(F.col("class").cast("string"), F.lit(": "), pct.cast("string"), F.lit("%")).alias("label"))


# ----------------------------------------------------------------------------------- D27, D28, D30
def eda_summary(df: DataFrame, target: str, binary: list[str], continuous: list[str]) -> DataFrame:
    """One row: rows, cols, binary and continuous counts, imbalance, sparsity, max |corr|."""
    from adlytics.operators.corr import target_correlations
    dist = target_distribution(df, target).select("n_rows", "imbalance_ratio")
    sp = sparsity(df, binary).select("sparsity_pct")
    mc = target_correlations(df, binary + continuous, target).agg(
        r6(F.max(F.abs("r"))).alias("max_abs_corr"))
    row = {**one_row(dist), **one_row(sp), **one_row(mc)}
    return df.sparkSession.createDataFrame(
        [(row["n_rows"], len(df.columns), len(binary), len(continuous), row["imbalance_ratio"],
          row["sparsity_pct"], row["max_abs_corr"])],
        "n_rows long, n_cols int, n_binary int, n_continuous int, imbalance_ratio double, "
        "sparsity_pct double, max_abs_corr double")


def univariate_report(df: DataFrame, target: str, binary: list[str], continuous: list[str]) -> DataFrame:
    """Long (section, column, metric, value): class counts, describe, binary shares, nulls."""
    cls = df.groupBy(col(target).cast("string").alias("column")).agg(F.count(F.lit(1)).cast("double").alias("value")) \
        .select(F.lit("class").alias("section"), "column", F.lit("n").alias("metric"), "value")
    d = describe(df, continuous)
    dl = d.select(F.lit("describe").alias("section"), "column", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")])).alias("m")).select(
        "section", "column", "m.metric", "m.value")
    vd = value_distribution(df, binary).select(F.lit("share").alias("section"), "column",
                                               F.col("value").cast("string").alias("metric"),
                                               F.col("share").alias("value"))
    nl = missing_by_column(df, continuous + binary).select(
        F.lit("missing").alias("section"), "column", F.lit("n_missing").alias("metric"),
        F.col("n_missing").cast("double").alias("value"))
    return cls.unionByName(dl).unionByName(vd).unionByName(nl)


def continuous_report(df: DataFrame, cols: list[str], target: str = "y", m: float = 1.5) -> DataFrame:
    """Per continuous column: describe + moments + normality + IQR outliers + corr with target."""
    from adlytics.operators.corr import target_correlations
    from adlytics.operators.outliers import outlier_report
    d = describe(df, cols)
    mo = moments(df, cols).drop("n")
    o = outlier_report(df, cols, m).select("column", "n_outliers", "pct_outliers")
    c = target_correlations(df, cols, target).select("column", "r")
    return d.join(mo, "column").join(o, "column").join(c, "column")


# ----------------------------------------------------------------------------------- D4
def inspect_datasets(train: DataFrame, test: DataFrame, target: str = "y") -> DataFrame:
    """Train and test inspected together (D4): column kinds of both, schema agreement and the
    target check, as one long table (section, name, value)."""
    kinds = classify_columns(train, exclude=[target]).select(
        F.lit("kind").alias("section"), "column", "kind").withColumnRenamed("column", "name") \
        .withColumnRenamed("kind", "value")
    sch = compare_schemas(train, test).select(
        F.lit("schema").alias("section"), F.col("column").alias("name"),
        F.when(F.col("type_match"), "same").when(F.col("in_a") & ~F.col("in_b"), "train_only")
        .when(~F.col("in_a") & F.col("in_b"), "test_only").otherwise("type_differs").alias("value"))
    tgt = validate_target(train, target).select(
        F.lit("target").alias("section"), F.lit(target).alias("name"),
        F.col("target_valid").cast("string").alias("value"))
    return kinds.unionByName(sch).unionByName(tgt)
