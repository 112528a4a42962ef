"""k-nearest-neighbour imputation and the choice of k (M3, M6-M8), on the exact search of ``neighbours``.

One search serves all incomplete columns of a row, and all folds of a cross-validation: donors are
told apart by the cell they can give, and by the fold they belong to, inside the one join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlytics.functions.exprs import col, portable_unit
from adlytics.operators.common import melt, null_counts
from adlytics.operators.neighbours import nearest

__all__ = ["nearest", "knn_neighbours", "knn_impute", "knn_k_search", "quick_k"]


def incomplete(df: DataFrame, cols: list[str]) -> list[str]:
    """The columns that lack a value in some row (one scan)."""
    lacking = {r["column"] for r in null_counts(df, cols).filter("n_missing > 0").collect()}
    return [c for c in cols if c in lacking]


def named(position: str, cols: list[str]):
    return F.element_at(F.array(*map(F.lit, cols)), F.col(position).cast("int") + 1)


def knn_neighbours(df: DataFrame, cols: list[str], id_col: str, k: int, donors: DataFrame | None = None,
                   apart: str | None = None) -> DataFrame:
    """(id, target, id_donor, value, dist, rank): for each missing cell the k nearest donors that
    have a value there; with ``apart``, not of the row's own value of that column.

    Coordinates are all of ``cols`` (the missing one cannot be shared). A cell without any donor at
    a defined distance has no row."""
    donors = df if donors is None else donors
    lacking = incomplete(df, cols)
    some = F.lit(False)
    for c in lacking:
        some = some | col(c).isNull()
    found = nearest(df.filter(some), donors, cols, k, id_col, id_col, apart=apart, slots="missing",
                    q_extra=[apart] if apart else [])
    return found.withColumn("target", named("slot", cols)).drop("slot")


def knn_impute(df: DataFrame, cols: list[str], id_col: str, k: int = 5, donors: DataFrame | None = None) -> DataFrame:
    """kNN imputation (M3): each missing cell = mean of its k nearest donors' values (fewer when
    fewer exist); a cell with no donor at a defined distance gets the column mean of the donors.

    Columns without missing cells are returned as they are; a column without any donor value keeps
    its NULLs. Row keys must be unique."""
    donors = df if donors is None else donors
    lacking = incomplete(df, cols)
    if not lacking:
        return df
    fills = knn_neighbours(df, cols, id_col, k, donors).groupBy(id_col, "target").agg(F.avg("value").alias("fill")) \
        .groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct("target", "fill"))).alias("_fills"))
    means = {r["column"]: r["m"] for r in melt(donors, lacking).groupBy("column").agg(F.avg("value").alias("m")).collect()}
    j = df.join(fills, id_col, "left")
    return j.select(*[F.coalesce(col(c), F.col("_fills")[c], F.lit(means.get(c)).cast("double")).alias(c)
                      if c in lacking else col(c) for c in df.columns])


def _errors(masked: DataFrame, donors: DataFrame, truth: DataFrame, cols, id_col, k_values, apart) -> DataFrame:
    """(fold, id, target, k, err) of the mean of the first k donors, for every k, from one search."""
    found = knn_neighbours(masked, cols, id_col, max(k_values), donors, apart=apart)
    found = found.join(truth, [id_col, "target"])
    w = Window.partitionBy(id_col, "target").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    est = found.withColumn("est", F.avg("value").over(w))
    return est.filter(F.col("rank").isin(*k_values)).select(
        F.col(apart).alias("fold"), col(id_col), "target", F.col("rank").alias("k"), (F.col("est") - F.col("truth")).alias("err"))


def _scores(errors: DataFrame, metric: str) -> DataFrame:
    byfold = errors.groupBy("k", "fold").agg(F.avg(F.col("err") ** 2).alias("mse"), F.avg(F.abs("err")).alias("mae"))
    res = byfold.groupBy("k").agg(F.avg("mse").alias("mse"), F.stddev_samp("mse").alias("std_mse"),
                                  F.avg("mae").alias("mae")).withColumn("rmse", F.sqrt("mse"))
    first = F.first("k").over(Window.orderBy(F.col({"mse": "mse", "rmse": "rmse", "mae": "mae"}[metric]), "k"))
    return res.withColumn("best", F.col("k") == first)                # one row per k


def _masked(rows: DataFrame, cols, id_col, mask_rate, seed):
    """(rows with the masked cells NULL, truth (id, target, truth))."""
    from adlytics.operators.sampling import cell_mask
    m = cell_mask(rows, id_col, cols, mask_rate, seed)
    gone = [F.when(F.col(f"{c}_masked"), F.lit(None)).otherwise(col(c).cast("double")).alias(c) for c in cols]
    truth = melt(rows, cols, keep=[id_col], name="target", value="truth")
    return m.select(id_col, "fold", *gone), truth


def knn_k_search(df: DataFrame, cols: list[str], id_col: str, k_values: list[int], folds: int = 5,
                 mask_rate: float = 0.2, seed: int = 42, metric: str = "mse") -> DataFrame:
    """Choose k by cross-validation (M6): complete rows only; each row loses a share of its cells
    (portable hash), which are estimated from the rows of the other folds.

    One search for the largest k with donors told apart by fold gives every fold and every k: the
    number of jobs depends on neither. Returns (k, mse, rmse, mae, std_mse, best)."""
    from adlytics.operators.sampling import hash_folds
    from adlytics.session import cut_lineage
    complete = cut_lineage(hash_folds(df.na.drop(subset=cols).select(id_col, *cols), id_col, folds, seed))
    masked, truth = _masked(complete, cols, id_col, mask_rate, seed)
    return _scores(_errors(masked, complete, truth, cols, id_col, k_values, "fold"), metric)


QUICK_K = (3, 5, 7, 9, 11)
QUICK_DEFAULT, QUICK_MIN_ROWS = 5, 50


def quick_k_table(df: DataFrame, cols: list[str], id_col: str, k_values=QUICK_K, seed: int = 42,
                  test_share: float = 0.3, mask_rate: float = 0.1) -> DataFrame:
    """Quick k (M7): complete rows split 70/30 by hash, a tenth of the test cells masked and
    estimated from the training rows. Returns (k, mse, rmse, mae, std_mse, best)."""
    from adlytics.session import cut_lineage
    test = portable_unit(id_col, seed) < test_share
    complete = cut_lineage(df.na.drop(subset=cols).select(id_col, *cols, test.cast("int").alias("fold")))
    masked, truth = _masked(complete.filter("fold = 1"), cols, id_col, mask_rate, seed)
    return _scores(_errors(masked, complete.filter("fold = 0"), truth, cols, id_col, list(k_values), "fold"), "mse")


def quick_k(df: DataFrame, cols: list[str], id_col: str, k_values=QUICK_K, min_rows: int = QUICK_MIN_ROWS) -> int:
    """The best k of ``quick_k_table``; 5 for a table of fewer than ``min_rows`` complete rows (M7, M8)."""
    if df.na.drop(subset=cols).limit(min_rows).count() < min_rows:
        return QUICK_DEFAULT
    best = quick_k_table(df, cols, id_col, k_values).filter("best").first()
    return int(best["k"]) if best else QUICK_DEFAULT
