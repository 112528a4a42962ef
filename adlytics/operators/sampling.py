"""Splits, folds, sampling, masks and class weights.

Seeded randomness is a portable integer hash of the row key (no ``rand()``), so a split is
reproducible in any engine and across partitionings. Exact stratified positions come from a
rank within class computed without a per-class single-task window: rows are bucketed by their
hash within class, numbered inside (class, bucket), and offset by the sizes of earlier buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlytics.functions.exprs import HASH_MOD, col, portable_hash, r6

CELL_STRIDE = 7919


def class_rank(df: DataFrame, id_col: str, target: str, seed: int = 42, buckets: int = 1024) -> DataFrame:
    """Adds ``_h`` (hash of the key), ``_rank`` (1-based position within class in (hash, key)
    order) and ``_n`` (class size). ``buckets`` hash ranges per class bound the rows any one
    window task sorts (about n_class / buckets); size it to the data (~1e6 rows per bucket)."""
    h = portable_hash(id_col, seed)
    b = df.withColumn("_h", h).withColumn("_b", F.floor(F.col("_h") * buckets / float(HASH_MOD)).cast("int"))
    tot = b.groupBy(col(target).alias("_k"), "_b").agg(F.count(F.lit(1)).alias("_c"))
    wo = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("_k", "_b", F.coalesce(F.sum("_c").over(wo), F.lit(0)).alias("_off"),
                      F.sum("_c").over(Window.partitionBy("_k")).alias("_n"))
    wl = Window.partitionBy(col(target), "_b").orderBy("_h", col(id_col))
    local = b.withColumn("_loc", F.row_number().over(wl))
    j = local.join(offs, (local[target].eqNullSafe(offs["_k"])) & (local["_b"] == offs["_b"]))
    return j.select(*[local[c] for c in df.columns], local["_h"],
                    (F.col("_off") + F.col("_loc")).alias("_rank"), "_n")


def stratified_split(df: DataFrame, id_col: str, target: str, fractions=(0.6, 0.2, 0.2),
                     names=("train", "val", "test"), seed: int = 42, split_col: str = "split") -> DataFrame:
    """Exact stratified split (R1): within each class, rows in hash order; the first
    floor(f1 n) go to the first split, up to floor((f1+f2) n) to the second, the rest to the last."""
    r = class_rank(df, id_col, target, seed)
    cum, expr = 0.0, None
    for f, name in zip(fractions[:-1], names[:-1]):
        cum += f
        cond = F.col("_rank") <= F.floor(F.col("_n") * F.lit(round(cum, 10)))
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    expr = expr.otherwise(names[-1])
    return r.withColumn(split_col, expr).drop("_h", "_rank", "_n")


def split_summary(df: DataFrame, target: str = "y", split_col: str = "split") -> DataFrame:
    """(split, n_rows, n_pos, pos_rate) (R2)."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(col(target) == 1).alias("n_pos")) \
        .withColumn("pos_rate", r6(F.col("n_pos") / F.col("n_rows")))


def stratified_folds(df: DataFrame, id_col: str, target: str, k: int = 5, seed: int = 42,
                     fold_col: str = "fold") -> DataFrame:
    """Fold = (rank within class - 1) mod k: class shares equal across folds."""
    r = class_rank(df, id_col, target, seed)
    return r.withColumn(fold_col, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_h", "_rank", "_n")


def hash_folds(df: DataFrame, id_col: str, k: int = 5, seed: int = 42, fold_col: str = "fold") -> DataFrame:
    """Plain shuffled k-fold: hash of the key mod k."""
    return df.withColumn(fold_col, F.pmod(portable_hash(id_col, seed), F.lit(k)).cast("int"))


def seeded_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement, the n smallest hashes of the key (R5). Spark plans this as a
    per-partition top-n and a merge of n-row lists."""
    return df.withColumn("_h", portable_hash(id_col, seed)).orderBy("_h", col(id_col)).limit(n).drop("_h")


def sample_with_replacement(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bootstrap-style sample (Poisson per row, Spark's seeded sampler)."""
    return df.sample(withReplacement=True, fraction=fraction, seed=seed)


def class_weights(df: DataFrame, target: str = "y", weight_col: str = "weight") -> DataFrame:
    """weight = n / (2 n_class), the balanced class weight, as a column.

    Class counts are one small aggregate (one row per class) joined back by class."""
    cnt = df.groupBy(col(target).alias("_k")).agg(F.count(F.lit(1)).alias("_nc"))
    every = Window.partitionBy()
    wc = cnt.select("_k", (F.sum("_nc").over(every) / (F.count(F.lit(1)).over(every) * F.col("_nc"))).alias(weight_col))
    # one row per class: a bounded broadcast
    return df.join(F.broadcast(wc), df[target].eqNullSafe(wc["_k"])).drop("_k")


def cell_mask(df: DataFrame, id_col: str, cols: list[str], rate: float = 0.2, seed: int = 42,
              suffix: str = "_masked") -> DataFrame:
    """Boolean ``{c}_masked`` per cell: hash(key, column position, seed) below ``rate``."""
    out = []
    for j, c in enumerate(cols):
        h = portable_hash(id_col, seed + CELL_STRIDE * (j + 1))      # a seed of its own per column
        out.append((h < F.lit(int(rate * HASH_MOD))).alias(f"{c}{suffix}"))
    return df.select("*", *out)


def class_distribution(stages: dict[str, DataFrame], target: str = "y") -> DataFrame:
    """(stage, class, n, share) for several stages, e.g. before/after resampling."""
    out = None
    for name, d in stages.items():
        g = d.groupBy(col(target).alias("class")).agg(F.count(F.lit(1)).alias("n")).withColumn("stage", F.lit(name))
        out = g if out is None else out.unionByName(g)
    return out.withColumn("share", r6(F.col("n") / F.sum("n").over(Window.partitionBy("stage"))))
