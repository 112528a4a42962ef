"""Missing-data operators: median fill, routing by null rate, kNN and chained-equation imputation,
k search, and the comparison of imputed variants.

Fitted values (medians, column means, regression coefficients) are metadata-sized and applied
as literal expressions, so the transform of new data is one projection.
"""

from __future__ import annotations

import sys
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlytics.functions.exprs import col, r6, significant
from adlytics.operators.common import melt, null_counts, numeric_columns
from adlytics.operators.quantiles import column_quantiles

# tasks get the functions themselves, not an import of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ----------------------------------------------------------------------------------- M1
def fit_medians(df: DataFrame, cols: list[str], exact: bool = True, accuracy: int = 10000) -> dict:
    """{column: median} of the melted columns, exact by default; None for a column of NULLs."""
    if exact:
        found = column_quantiles(melt(df, cols), [0.5], accuracy)
        return {c: found.get(c, [None])[0] for c in cols}
    m = F.percentile_approx("value", 0.5, accuracy).cast("double")
    return {r["column"]: r["m"] for r in melt(df, cols).groupBy("column").agg(m.alias("m")).collect()}


def fill_values(df: DataFrame, values: dict, cast_int: list[str] = ()) -> DataFrame:
    """coalesce(column, value) for each column with a fitted value; optional cast to int."""
    out = []
    for f in df.schema.fields:
        if f.name in values and values[f.name] is not None:
            e = F.coalesce(col(f.name), F.lit(values[f.name]).cast(f.dataType))
            if f.name in cast_int:
                e = F.coalesce(col(f.name).cast("double"), F.lit(float(values[f.name]))).cast("int")
            out.append(e.alias(f.name))
        else:
            out.append(col(f.name))
    return df.select(*out)


def median_fill(df: DataFrame, cols: list[str] | None = None, medians: dict | None = None) -> DataFrame:
    """Fill NULLs of every numeric column with its median (M1); medians may come from training."""
    cols = cols or numeric_columns(df)
    med = medians if medians is not None else fit_medians(df, cols)
    return fill_values(df, {c: med.get(c) for c in cols})


def median_fill_int(df: DataFrame, column: str, median: float | None = None) -> DataFrame:
    """Fill a binary column's NULLs with its (training) median, then cast to int."""
    m = median if median is not None else fit_medians(df, [column]).get(column)
    return fill_values(df, {column: m}, cast_int=[column])


# ----------------------------------------------------------------------------------- M9
def null_rates(df: DataFrame, cols: list[str]) -> dict:
    rates = {r["column"]: r["n_missing"] / r["n_rows"] for r in null_counts(df, cols).collect()}
    return {c: rates.get(c, 0.0) for c in cols}


def route_by_null_rate(df: DataFrame, cols: list[str], drop_above: float = 0.30,
                       knn_above: float = 0.05) -> DataFrame:
    """(column, null_rate, action): > 30 % drop, > 5 % knn, else median (M9)."""
    long = null_counts(df, cols).select("column", (F.col("n_missing") / F.col("n_rows")).alias("rate"))
    act = F.when(F.col("rate") > drop_above, "drop").when(F.col("rate") > knn_above, "knn").otherwise("median")
    return long.select("column", r6("rate").alias("null_rate"), act.alias("action"))


def conditional_impute(df: DataFrame, cols: list[str], drop_above: float = 0.30, knn_above: float = 0.05,
                       k: int = 5, id_col: str | None = None) -> DataFrame:
    """Apply the M9 routing: drop, kNN (one column at a time: no shared coordinate, so the donor
    mean, as the reference's single-column call gives) or median."""
    rates = null_rates(df, cols)
    drop = [c for c in cols if rates[c] > drop_above]
    knn = [c for c in cols if knn_above < rates[c] <= drop_above]
    med = [c for c in cols if rates[c] <= knn_above]
    out = df.drop(*drop)
    means = out.agg(*[F.avg(col(c)).alias(c) for c in knn]).first() if knn else None
    fill = {c: means[c] for c in knn} if knn else {}
    fill.update(fit_medians(out, med) if med else {})
    return fill_values(out, fill)


# ----------------------------------------------------------------------------------- M10-M15
def compare_variants(variants: DataFrame, cols: list[str], target: str = "y",
                     variant_col: str = "variant") -> DataFrame:
    """Per variant and column: rows, nulls, mean, std, min, max; with class counts and imbalance.

    Mean and deviation have eight significant digits, which no summation order changes."""
    v = F.col("value")
    stats = melt(variants, cols, keep=[variant_col]).groupBy(variant_col, "column").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(v.isNull()).alias("n_null"),
        significant(F.avg(v)).alias("mean"), significant(F.stddev_samp(v)).alias("std"),
        r6(F.min(v)).alias("min"), r6(F.max(v)).alias("max"))
    cls = variants.groupBy(variant_col).agg(F.count_if(col(target) == 0).alias("n0"),
                                            F.count_if(col(target) == 1).alias("n1"))
    return stats.join(cls, variant_col).withColumn(
        "imbalance", r6(F.try_divide(F.col("n0").cast("double"), F.col("n1"))))


def variant_quality(variants: DataFrame, cols: list[str], target: str = "y", variant_col: str = "variant",
                    stability_cols: list[str] | None = None, reference_rows: int | None = None,
                    reference_ratio: float | None = None) -> DataFrame:
    """Score /100 per variant and its rank.

    completeness 20 x (1 - null cells / cells over ``cols``); retention 25 x rows / reference
    rows; class-ratio preservation max(0, 25 (1 - |ratio - ref| / ref)) with ratio = n0 / n1;
    stability max(0, 30 (1 - min(mean CV, 1))) with CV = std / |mean| over ``stability_cols``
    (a zero mean counts as CV 1). The reference rows and ratio are parameters; by default the
    largest variant's row count and that variant's ratio."""
    v = F.col("value")
    stab = stability_cols or cols
    nulls = melt(variants, cols, keep=[variant_col]).groupBy(variant_col).agg(
        (F.count_if(v.isNull()) / F.count(F.lit(1))).alias("null_share"))
    cvs = melt(variants, stab, keep=[variant_col]).groupBy(variant_col, "column").agg(
        F.coalesce(F.try_divide(F.stddev_samp(v), F.abs(F.avg(v))), F.lit(1.0)).alias("cv")) \
        .groupBy(variant_col).agg(F.avg("cv").alias("mean_cv"))
    cls = variants.groupBy(variant_col).agg(F.count(F.lit(1)).alias("rows"),
                                            (F.count_if(col(target) == 0).cast("double")
                                             / F.greatest(F.count_if(col(target) == 1), F.lit(1))).alias("ratio"))
    t = nulls.join(cvs, variant_col).join(cls, variant_col)
    all_rows = Window.partitionBy()
    ref_rows = F.lit(float(reference_rows)) if reference_rows else F.max("rows").over(all_rows).cast("double")
    ref_ratio = F.lit(float(reference_ratio)) if reference_ratio is not None else \
        F.max_by("ratio", F.struct("rows", F.col(variant_col))).over(all_rows)
    completeness = (1 - F.col("null_share")) * 20
    retention = F.col("rows") / ref_rows * 25
    ratio_pres = F.greatest(F.lit(0.0), 25 * (1 - F.abs(F.col("ratio") - ref_ratio) / ref_ratio))
    stability = F.greatest(F.lit(0.0), 30 * (1 - F.least(F.col("mean_cv"), F.lit(1.0))))
    s = t.select(variant_col, completeness.alias("c1"), retention.alias("c2"), ratio_pres.alias("c3"),
                 stability.alias("c4"))
    s = s.select(variant_col, r6("c1").alias("completeness"), r6("c2").alias("retention"),
                 r6("c3").alias("ratio_preservation"), r6("c4").alias("stability"),
                 r6(F.col("c1") + F.col("c2") + F.col("c3") + F.col("c4")).alias("score"))
    return s.withColumn("rank", F.row_number().over(Window.orderBy(F.col("score").desc(), F.col(variant_col))))


def recommend_variant(quality: DataFrame, variant_col: str = "variant") -> DataFrame:
    """The variant with the highest score (first wins on ties by name)."""
    return quality.agg(F.min_by(F.col(variant_col), F.struct(-F.col("score"), F.col(variant_col))).alias("best"),
                       F.max("score").alias("best_score"))


def variant_balance(variants: DataFrame, target: str = "y", variant_col: str = "variant") -> DataFrame:
    """(variant, rows, positives, target_ratio, retention_pct) per variant."""
    t = variants.groupBy(variant_col).agg(F.count(F.lit(1)).alias("rows"),
                                          F.count_if(col(target) == 1).alias("positives"))
    return t.select(variant_col, "rows", "positives",
                    r6(F.col("positives") / F.col("rows")).alias("target_ratio"),
                    r6(F.col("rows") * 100.0 / F.max("rows").over(Window.partitionBy())).alias("retention_pct"))


KS_TERMS = 20
KS_SMALL = 0.27
KS_EXACT = 10_000          # up to this product of the sample sizes the p-value is exact


def ks_exact_p(n_a: int, n_b: int, gap: int) -> float:
    """P(D >= gap / (n_a n_b)) of the two-sample statistic without ties.

    Orders of the pooled sample are lattice paths from (0, 0) to (n_a, n_b); ``inside`` is the share
    of the paths to (i, j) whose points all have |i n_b - j n_a| < gap. The last step to (i, j) comes
    from the left with probability i / (i + j)."""
    inside = [0.0] * (n_b + 1)
    for i in range(n_a + 1):
        for j in range(n_b + 1):
            if abs(i * n_b - j * n_a) >= gap:
                inside[j] = 0.0
            elif i + j == 0:
                inside[j] = 1.0
            else:
                left = i * inside[j] if i else 0.0
                below = j * inside[j - 1] if j else 0.0
                inside[j] = (left + below) / (i + j)
    return 1.0 - inside[n_b]


def ks_two_sample(a: DataFrame, b: DataFrame, cols: list[str], alpha: float = 0.05,
                  buckets: int = 64) -> DataFrame:
    """(column, n_a, n_b, d, p_value, different): two-sample Kolmogorov-Smirnov per column.

    Both samples are melted and counted per (column, value); the two empirical CDFs come from
    one bucketed prefix sum (no single-partition window); D = max |F_a - F_b|. The p-value is
    the asymptotic Kolmogorov series at sqrt(n_a n_b/(n_a+n_b)) D, and for small samples, of sizes
    whose product is at most ``KS_EXACT``, the exact one (``ks_exact_p``)."""
    from adlytics.operators.prefix import prefix_sums
    from adlytics.session import cut_lineage
    la = melt(a, cols).filter(F.col("value").isNotNull()).select("column", "value", F.lit(1).alias("ca"), F.lit(0).alias("cb"))
    lb = melt(b, cols).filter(F.col("value").isNotNull()).select("column", "value", F.lit(0).alias("ca"), F.lit(1).alias("cb"))
    # read four times: bucket bounds, bucket totals, running sums, sample sizes
    g = cut_lineage(la.unionByName(lb).groupBy("column", "value").agg(F.sum("ca").alias("ca"), F.sum("cb").alias("cb")))
    cum = prefix_sums(g, "value", ["ca", "cb"], by=["column"], buckets=buckets)
    tot = g.groupBy("column").agg(F.sum("ca").alias("na"), F.sum("cb").alias("nb"))
    d = cum.join(tot, "column").groupBy("column", "na", "nb").agg(
        F.max(F.abs(F.col("cum_ca") / F.col("na") - F.col("cum_cb") / F.col("nb"))).alias("d"),
        F.max(F.when(F.col("na") * F.col("nb") <= KS_EXACT,
                     F.abs(F.col("cum_ca") * F.col("nb") - F.col("cum_cb") * F.col("na")))).alias("gap"))
    en = F.sqrt(F.col("na") * F.col("nb") / (F.col("na") + F.col("nb")))
    lam = en * F.col("d")
    # Kolmogorov tail 2 sum (-1)^(j-1) exp(-2 j^2 lam^2): 20 terms converge for lam >= 0.27,
    # below which the p-value is 1 to six decimals
    series = reduce(lambda x, y: x + y, [F.lit(2.0 * (-1) ** (j - 1)) * F.exp(F.lit(-2.0 * j * j) * lam * lam)
                                         for j in range(1, KS_TERMS + 1)])
    p = F.when(lam < KS_SMALL, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))

    def exact(batches):
        for b in batches:
            small = b["gap"].notna()
            b["p"] = b["p"].where(~small, [ks_exact_p(int(x), int(y), int(g)) if ok else 0.0 for x, y, g, ok in
                                          zip(b["na"], b["nb"], b["gap"].fillna(0), small)])
            yield b.drop(columns="gap")

    # one row per column
    d = d.select("column", "na", "nb", "d", "gap", p.alias("p")).mapInPandas(exact, "column string, na long, nb long, d double, p double")
    p = F.col("p")
    return d.select("column", F.col("na").alias("n_a"), F.col("nb").alias("n_b"), r6("d").alias("d"),
                    r6(p).alias("p_value"), (p < alpha).alias("different"))


# ----------------------------------------------------------------------------------- M4, M5
def _ridge_fit(df: DataFrame, target: str, feats: list[str], reg: float) -> list[float]:
    """Least squares with intercept from one aggregate of cross-products (sum x x', sum x y):
    (p+1)^2 numbers reach the driver, the solve is a (p+1) x (p+1) system."""
    import numpy as np
    xs = [F.lit(1.0)] + [col(f).cast("double") for f in feats]
    y = col(target).cast("double")
    p = len(xs)
    aggs = [F.sum(xs[i] * xs[j]).alias(f"a{i}_{j}") for i in range(p) for j in range(i, p)]
    aggs += [F.sum(xs[i] * y).alias(f"b{i}") for i in range(p)]
    r = df.agg(*aggs).first()
    A = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            A[i, j] = A[j, i] = r[f"a{i}_{j}"] or 0.0
    b = np.array([r[f"b{i}"] or 0.0 for i in range(p)])
    A[1:, 1:] += reg * np.eye(p - 1)
    return [float(v) for v in np.linalg.lstsq(A, b, rcond=None)[0]]


def mice_fit_transform(df: DataFrame, cols: list[str], id_col: str, max_iter: int = 50, tol: float = 1e-3,
                       reg: float = 1e-6, min_complete: int = 10):
    """Chained-equation imputation (M4). Returns (imputed DataFrame, fitted steps).

    Missing cells start at the column mean; each round regresses every column (ascending null
    count) on the others over its observed rows and replaces its missing cells by the prediction.
    A round's ``cols`` are checkpointed (lineage stays short), not the other columns of ``df``; the
    loop stops when the largest change of an imputed cell is below tol x the largest observed
    |value|. ``steps`` = (means, [(column, coefficients)...]) replays the same sequence on new data,
    and gives the imputed rows of ``df``."""
    complete = df.na.drop(subset=cols).limit(min_complete).count()
    if complete < min_complete:
        raise ValueError("not enough complete rows for chained-equation imputation")
    stats = df.agg(*[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                   *[F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)],
                   *[F.max(F.abs(col(c))).alias(f"x{i}") for i, c in enumerate(cols)]).first()
    means = {c: stats[f"m{i}"] for i, c in enumerate(cols)}
    order = sorted(cols, key=lambda c: (stats[f"n{cols.index(c)}"], cols.index(c)))
    order = [c for c in order if stats[f"n{cols.index(c)}"] > 0]
    scale = max([stats[f"x{i}"] or 0.0 for i in range(len(cols))] + [1e-12])
    cur = df.select(*[F.coalesce(col(c), F.lit(means[c])).alias(c) for c in cols], *[col(c).isNull().alias(f"_miss_{c}") for c in cols])
    steps = []
    for _ in range(max_iter):
        prev = cur.select("*", *[col(c).alias(f"_prev_{c}") for c in order])
        nxt = prev
        for c in order:
            feats = [f for f in cols if f != c]
            coef = _ridge_fit(nxt.filter(~F.col(f"_miss_{c}")), c, feats, reg)
            steps.append((c, coef))
            pred = F.lit(coef[0])
            for w, f in zip(coef[1:], feats):
                pred = pred + F.lit(w) * col(f)
            nxt = nxt.withColumn(c, F.when(F.col(f"_miss_{c}"), pred).otherwise(col(c)))
        from adlytics.session import cut_lineage
        nxt = cut_lineage(nxt)
        change = nxt.agg(F.max(F.greatest(*[F.abs(col(c) - F.col(f"_prev_{c}")) for c in order]
                                          + [F.lit(0.0)]))).first()[0] or 0.0
        cur = nxt.drop(*[f"_prev_{c}" for c in order])
        if change < tol * scale:
            break
    fitted = {"means": means, "steps": steps, "cols": cols}
    return mice_transform(df, fitted), fitted


def mice_transform(df: DataFrame, fitted: dict) -> DataFrame:
    """Replay a fitted chained-equation sequence on new data: expressions only (M4)."""
    cols = fitted["cols"]
    miss = {c: col(c).isNull() for c in cols}
    cur = {c: F.coalesce(col(c), F.lit(fitted["means"][c])) for c in cols}
    out = df.select("*", *[m.alias(f"_miss_{c}") for c, m in miss.items()])
    out = out.select(*[cur[c].alias(c) if c in cols else col(c) for c in out.columns])
    for i, (c, coef) in enumerate(fitted["steps"]):
        feats = [f for f in cols if f != c]
        pred = F.lit(coef[0])
        for w, f in zip(coef[1:], feats):
            pred = pred + F.lit(w) * col(f)
        out = out.withColumn(c, F.when(F.col(f"_miss_{c}"), pred).otherwise(col(c)))
        if (i + 1) % 30 == 0:
            from adlytics.session import cut_lineage
            out = cut_lineage(out)
    return out.drop(*[f"_miss_{c}" for c in cols])


def impute_with_fallback(df: DataFrame, cols: list[str], id_col: str, method: str = "knn", k: int = 5,
                         backup: str = "median"):
    """Model-based imputation of MAR columns with a reported median fallback (M2, M5).

    The imputation runs as a job of its own, so a failure while planning or while running is caught;
    (DataFrame, status) names the method used, and for a fallback what failed. An unknown method is
    an error."""
    from adlytics.operators.jobs import materialised, run_jobs
    from adlytics.operators.knn import knn_impute
    if method not in ("knn", "mice"):
        raise ValueError(f"unknown method {method!r}")
    how = {"knn": lambda: knn_impute(df, cols, id_col, k), "mice": lambda: mice_fit_transform(df, cols, id_col)[0]}[method]
    done = run_jobs(df.sparkSession, {f"impute/{method}": lambda: materialised(how())})[f"impute/{method}"]
    if done.ok:
        return done.value, f"knn_k{k}" if method == "knn" else method
    return median_fill(df, cols), f"{backup}_backup ({done.message})"
