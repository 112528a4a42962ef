"""Power transforms, scaling, quadratic features and PCA.

Lambda search is distributed: the log-likelihood of a power transform is
    l(lambda) = -n/2 log var_pop(f(x, lambda)) + (lambda - 1) S
with S = sum sign(x) log1p|x| (Yeo-Johnson) or sum log x (Box-Cox), which does not depend on
lambda. One aggregate over the melted columns, a row per value and grid point, evaluates var_pop for
a whole lambda grid of every column at once, and again on wider grids further out while the best
point lies on the edge; refinement passes around the best point give lambda to ~1e-4. The fitted
lambdas (a few numbers) are applied as column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlytics.functions.exprs import box_cox, col, r6, skew_adjusted, yeo_johnson
from adlytics.operators.common import lit_map, melt

LAMBDA_RANGE = (-2.0, 2.0)   # first grid of the lambda search; it moves outward while the best point is on its edge


@dataclass
class PowerFit:
    method: str                       # "yeo-johnson" or "box-cox"
    lmbda: float
    shift: float = 0.0                # Box-Cox offset added before the transform
    mean: float | None = None         # standardisation of the transformed values
    std: float | None = None

    def expr(self, c):
        t = yeo_johnson(c, self.lmbda) if self.method == "yeo-johnson" else box_cox(c, self.lmbda, self.shift)
        if self.mean is not None and self.std:
            t = (t - F.lit(self.mean)) / F.lit(self.std)
        return t


def _loglik_grid(df: DataFrame, cols: list[str], method: str, grids: dict, shifts: dict) -> dict:
    """{column: [(lambda, loglik)]} for each column's own grid, in one aggregate: a row per value and
    grid point, one variance per (column, point)."""
    v, lam = F.col("value"), F.col("lam")
    points = F.create_map(*[x for c in cols for x in (F.lit(c), F.array(*[F.lit(float(g)) for g in grids[c]]))])
    long = melt(df, cols).filter(v.isNotNull()).withColumn("value", v + F.element_at(lit_map(shifts), F.col("column")))
    rows = long.select("column", "value", F.posexplode(F.element_at(points, F.col("column"))).alias("k", "lam"))
    if method == "yeo-johnson":
        jacobian = F.signum(v) * F.log1p(F.abs(v))
        side, power = F.when(v >= 0, 1.0).otherwise(-1.0), F.when(v >= 0, lam).otherwise(2.0 - lam)
        base = F.abs(v) + 1.0
    else:
        jacobian, side, power, base = F.log(v), F.lit(1.0), lam, v
    t = side * F.when(F.abs(power) < 1e-12, F.log(base)).otherwise((F.pow(base, power) - 1.0) / power)
    got = rows.groupBy("column", "k").agg(F.count(v).alias("n"), F.sum(jacobian).alias("S"), F.var_pop(t).alias("var")).collect()
    out = {c: [(g, -np.inf) for g in grids[c]] for c in cols}
    for r in got:
        g, var = grids[r["column"]][r["k"]], r["var"]
        if var is not None and 0 < var < np.inf:
            out[r["column"]][r["k"]] = (g, -r["n"] / 2.0 * np.log(var) + (g - 1) * r["S"])
    return out


FINEST = 2.5e-4          # last step of the lambda search


def fit_power(df: DataFrame, cols: list[str], method: str = "yeo-johnson", standardize: bool = True,
              grid: int = 17, refine: int = 9) -> dict[str, PowerFit]:
    """Maximum-likelihood lambda per column to ``FINEST`` (T1, T2): one pass over a grid of ``grid``
    points in ``LAMBDA_RANGE``, more further out while the best point is on its edge, then passes
    over ``refine`` points around the best one."""
    from adlytics.session import cut_lineage
    # several passes read the same columns: materialise just those once
    df = cut_lineage(df.select(*[col(c).cast("double").alias(c) for c in cols]))
    shifts = {c: 0.0 for c in cols}
    if method == "box-cox":
        mins = df.agg(*[F.min(col(c)).alias(c) for c in cols]).first()
        shifts = {c: (abs(mins[c]) + 1e-6 if mins[c] is not None and mins[c] <= 0 else 0.0) for c in cols}
    lo, hi = LAMBDA_RANGE
    grids = {c: list(np.linspace(lo, hi, grid)) for c in cols}
    best, steps = {}, {c: (hi - lo) / (grid - 1) for c in cols}
    todo = cols
    while todo:                       # until the best point of each column lies inside its grid
        ll = _loglik_grid(df, todo, method, {c: grids[c] for c in todo}, shifts)
        moved = []
        for c in todo:
            k = max(range(grid), key=lambda i: ll[c][i][1])
            best[c] = ll[c][k][0]
            if k in (0, grid - 1) and np.isfinite(ll[c][k][1]):
                steps[c] *= 2
                out = steps[c] if k else -steps[c]
                grids[c] = sorted(best[c] + out * j for j in range(-1, grid - 1))
                moved.append(c)
        todo = moved
    while todo := [c for c in cols if steps[c] > FINEST]:
        for c in todo:
            grids[c] = list(np.linspace(best[c] - steps[c], best[c] + steps[c], refine))
            steps[c] *= 2 / (refine - 1)
        ll = _loglik_grid(df, todo, method, {c: grids[c] for c in todo}, shifts)
        for c in todo:
            best[c] = max(ll[c], key=lambda t: t[1])[0]
    fits = {c: PowerFit(method, float(best[c]), shifts[c]) for c in cols}
    if standardize:
        st = df.agg(*[F.avg(fits[c].expr(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                    *[F.stddev_pop(fits[c].expr(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        for i, c in enumerate(cols):
            fits[c].mean, fits[c].std = st[f"m{i}"], st[f"s{i}"]
    return fits


def apply_power(df: DataFrame, fits: dict[str, PowerFit], suffix: str = "_trans", keep: bool = True) -> DataFrame:
    """Add ``{c}{suffix}`` = fitted transform of c (T1-T3); drop the originals unless ``keep``."""
    out = df.select("*", *[fits[c].expr(c).alias(f"{c}{suffix}") for c in fits])
    return out if keep else out.drop(*fits)


def fit_mixed(df: DataFrame, yj_cols: list[str], bc_cols: list[str], standardize: bool = True) -> dict:
    """Yeo-Johnson on some columns and Box-Cox on others, standardised."""
    fits = {}
    if yj_cols:
        fits.update(fit_power(df, yj_cols, "yeo-johnson", standardize))
    if bc_cols:
        fits.update(fit_power(df, bc_cols, "box-cox", standardize))
    return fits


def skew_report(df: DataFrame, fits: dict[str, PowerFit]) -> DataFrame:
    """(column, method, lambda, skew_before, skew_after): bias-adjusted skewness (T5)."""
    a = df.agg(*[skew_adjusted(col(c)).alias(f"b{i}") for i, c in enumerate(fits)],
               *[skew_adjusted(fits[c].expr(c)).alias(f"a{i}") for i, c in enumerate(fits)])
    return a.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(f.method).alias("method"), F.lit(round(f.lmbda, 6)).alias("lambda"),
                 r6(F.col(f"b{i}")).alias("skew_before"), r6(F.col(f"a{i}")).alias("skew_after"))
        for i, (c, f) in enumerate(fits.items())])).alias("r")).select("r.*")


def choose_transform(df: DataFrame, cols: list[str], methods=("yeo-johnson", "box-cox")) -> dict[str, PowerFit]:
    """Per column, the candidate with the smallest |skew| after transforming (T4)."""
    cands = {m: fit_power(df, cols, m, standardize=False) for m in methods}
    a = df.agg(*[F.abs(skew_adjusted(cands[m][c].expr(c))).alias(f"{m}|{c}") for m in methods for c in cols]).first()
    best = {}
    for c in cols:
        m = min(methods, key=lambda mm: (a[f"{mm}|{c}"] if a[f"{mm}|{c}"] is not None else np.inf, methods.index(mm)))
        best[c] = cands[m][c]
    return best


def standardize(df: DataFrame, cols: list[str], with_mean: bool = True, ddof: int = 0,
                suffix: str = "") -> DataFrame:
    """(x - mean) / std with population std (ddof=0) by default; ``with_mean=False`` divides only,
    keeping zeros (sparsity) (T6, T7)."""
    sd = F.stddev_pop if ddof == 0 else F.stddev_samp
    st = df.agg(*[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                *[sd(col(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    exprs = {}
    for i, c in enumerate(cols):
        m, s = st[f"m{i}"], st[f"s{i}"]
        x = col(c).cast("double")
        num = x - F.lit(m) if with_mean else x
        exprs[c] = num / F.lit(s) if s else num
    if suffix:
        return df.select("*", *[e.alias(f"{c}{suffix}") for c, e in exprs.items()])
    return df.select(*[exprs[f].alias(f) if f in exprs else col(f) for f in df.columns])


def quadratic_names(cols: list[str]) -> list[tuple[str, list[str]]]:
    """Degree-2 terms in the common order: x, y, z, x^2, x y, x z, y^2, y z, z^2 (no bias)."""
    out = [(c, [c]) for c in cols]
    for i, a in enumerate(cols):
        for b in cols[i:]:
            out.append((f"{a}^2" if a == b else f"{a} {b}", [a, b]))
    return out


def quadratic_features(df: DataFrame, cols: list[str], keep_rest: bool = True) -> DataFrame:
    """Degree-2 expansion of chosen columns appended to the rest of the row."""
    terms = []
    for name, parts in quadratic_names(cols):
        e = col(parts[0]).cast("double")
        for p in parts[1:]:
            e = e * col(p).cast("double")
        terms.append(e.alias(name))
    rest = [col(c) for c in df.columns if c not in cols] if keep_rest else []
    return df.select(*rest, *terms)


def pca(df: DataFrame, cols: list[str], k: int = 2, out: str = "pca") -> tuple[DataFrame, list[float]]:
    """Principal components on complete rows, centred first; returns projections and explained
    variance shares (T10). Spark's PCA accumulates the covariance in a tree aggregate."""
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
    complete = df.na.drop(subset=cols)
    va = VectorAssembler(inputCols=cols, outputCol="_v")
    v = va.transform(complete)
    sc = StandardScaler(inputCol="_v", outputCol="_c", withMean=True, withStd=False).fit(v)
    c = sc.transform(v)
    model = PCA(k=k, inputCol="_c", outputCol=out).fit(c)
    return model.transform(c).drop("_v", "_c"), [float(x) for x in model.explainedVariance]
