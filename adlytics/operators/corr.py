"""Correlation, association and redundancy operators.

* correlation with a target: melted table grouped by column (one scan, any width);
* correlation between columns: for a few continuous columns one aggregate of pairwise
  covariances; for many binary columns the Gram matrix X'X accumulated by Spark's
  ``ml.stat.Correlation`` (a tree aggregate of d x d partial sums, no pair rows emitted),
  in column blocks so the per-task buffer stays bounded; sparse flags go through ``phi``;
* redundancy decisions (groups, drop lists) are joins and windows over the pair table.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlytics.functions.exprs import col, portable_hash, r6, safe_corr
from adlytics.operators.common import chunks, melt
from adlytics.operators.phi import phi_pairs

PAIR_SCHEMA = "var1 string, var2 string, r double"


# ----------------------------------------------------------------------------------- C1, C2, C11
def target_correlations(df: DataFrame, cols: list[str], target: str = "y") -> DataFrame:
    """(column, r, abs_r, rank): Pearson (= point-biserial for 0/1 columns) with the target.

    Ranked by |r| descending, ties by column name; constant columns have r NULL and rank last."""
    r = melt(df, cols, keep=[target]).groupBy("column").agg(r6(safe_corr(F.col("value"), col(target))).alias("r"))
    w = Window.orderBy(F.abs("r").desc_nulls_last(), F.col("column"))
    return r.select("column", "r", F.abs("r").alias("abs_r"), F.row_number().over(w).alias("rank"))


def top_target_correlations(df: DataFrame, cols: list[str], target: str = "y", n: int = 10,
                            bottom: bool = False) -> DataFrame:
    """Top (or bottom) n columns by |r| with the target."""
    r = target_correlations(df, cols, target).filter(F.col("r").isNotNull())
    o = [F.col("abs_r").asc(), F.col("column")] if bottom else [F.col("abs_r").desc(), F.col("column")]
    return r.orderBy(*o).limit(n)


# ----------------------------------------------------------------------------------- C3, C4, C18
def corr_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """(var1, var2, r) for every pair var1 < var2, pairwise-complete (as pandas ``corr``).

    One cheap pass counts NULLs per column. Pairs of null-free columns come from the Gram-matrix
    aggregate of ``gram_corr_pairs``; the pairs that involve a nullable column come from one
    aggregate of covariance expressions."""
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], PAIR_SCHEMA)
    nn = df.agg(*[F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    nullable = {c for i, c in enumerate(cols) if nn[i] > 0}
    free = [c for c in cols if c not in nullable]
    use_gram = len(free) >= 2
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]
             if not (use_gram and a not in nullable and b not in nullable)]
    out = gram_corr_pairs(df, free) if use_gram else None
    for block in chunks(list(enumerate(pairs)), 600):
        a = df.agg(*[safe_corr(x, y).alias(f"p{i}") for i, (x, y) in block])
        long = a.select(F.explode(F.array(*[
            F.struct(F.lit(min(x, y)).alias("var1"), F.lit(max(x, y)).alias("var2"), r6(F.col(f"p{i}")).alias("r"))
            for i, (x, y) in block])).alias("m")).select("m.*")
        out = long if out is None else out.unionByName(long)
    return out


def high_pairs(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs with |r| > threshold, sorted by |r| descending (C4)."""
    return pairs.filter(F.abs("r") > threshold).orderBy(F.abs("r").desc(), "var1", "var2")


def gram_corr_pairs(df: DataFrame, cols: list[str], threshold: float | None = None,
                    block: int = 2000) -> DataFrame:
    """(var1, var2, r) Pearson for many columns without NULLs (binary phi included).

    Columns are cut into blocks of ``block``; for each pair of blocks Spark accumulates the
    Gram matrix of the stacked columns in a tree aggregate (sparse vectors: cost per row is
    nnz^2, memory per task is (2 block)^2/2 doubles). Only pairs over ``threshold`` (or all if
    None) leave the driver as a small DataFrame; constant columns give NULL."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    import numpy as np
    import pyarrow as pa

    spark = df.sparkSession
    blocks = list(chunks(cols, block))
    rows = []
    for bi in range(len(blocks)):
        for bj in range(bi, len(blocks)):
            names = blocks[bi] if bi == bj else blocks[bi] + blocks[bj]
            va = VectorAssembler(inputCols=names, outputCol="_v", handleInvalid="error")
            vec = va.transform(df.select(*[col(c).cast("double").alias(c) for c in names])).select("_v")
            m = Correlation.corr(vec, "_v", "pearson").head()[0].toArray()
            nb = len(blocks[bi])
            if bi == bj:
                ii, jj = np.triu_indices(len(names), k=1)
            else:
                ii, jj = np.meshgrid(np.arange(nb), np.arange(nb, len(names)), indexing="ij")
                ii, jj = ii.ravel(), jj.ravel()
            vals = m[ii, jj]
            keep = np.ones(len(vals), bool) if threshold is None else (np.abs(np.nan_to_num(vals)) > threshold)
            label = np.array(names, dtype=object)
            a, b = label[ii[keep]], label[jj[keep]]
            first = a < b
            rows.append(pa.table({"var1": pa.array(np.where(first, a, b), pa.string()), "var2": pa.array(np.where(first, b, a), pa.string()),
                                  "r": pa.array(vals[keep], from_pandas=True)}))
    return spark.createDataFrame(pa.concat_tables(rows)).withColumn("r", r6("r"))


def redundancy_degree(pairs: DataFrame, n: int = 10) -> DataFrame:
    """(column, n_partners): high-correlation partners per column, top n."""
    ends = pairs.select(F.col("var1").alias("column")).unionAll(pairs.select(F.col("var2").alias("column")))
    return ends.groupBy("column").agg(F.count(F.lit(1)).alias("n_partners")) \
        .orderBy(F.col("n_partners").desc(), "column").limit(n)


# ----------------------------------------------------------------------------------- C7
def stratified_column_sample(df: DataFrame, cols: list[str], per_bucket: int = 10, seed: int = 42) -> DataFrame:
    """(column, rate, bucket, pick): presence-rate quartile buckets, ``per_bucket`` columns each,
    chosen in a portable hash order of the column position (C7)."""
    pos = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(cols)], "column string, pos long")
    rates = melt(df, cols).groupBy("column").agg(F.avg("value").alias("rate")).join(pos, "column")
    b = rates.withColumn("bucket", F.ntile(4).over(Window.orderBy("rate", "pos")))
    pick = F.row_number().over(Window.partitionBy("bucket").orderBy(portable_hash("pos", seed), "pos"))
    return b.select("column", r6("rate").alias("rate"), "bucket", pick.alias("pick")).filter(
        F.col("pick") <= per_bucket)


# ----------------------------------------------------------------------------------- C8-C13
def _positions(spark, columns) -> DataFrame:
    return spark.createDataFrame(list(enumerate(columns)), "pos int, column string")


def correlated_groups(pairs: DataFrame, columns: list[str], threshold: float) -> DataFrame:
    """(group_pos, member, member_no): column groups over the pair list.

    Each column that exceeds the threshold with columns before it in table order makes a group
    with them; ``group_pos`` is its position and ``member_no`` numbers the members by name.
    Groups may overlap. Pairs with a column that is not listed are ignored."""
    pos = _positions(pairs.sparkSession, columns)
    first = pos.select(F.col("column").alias("var1"), F.col("pos").alias("pos1"))
    second = pos.select(F.col("column").alias("var2"), F.col("pos").alias("pos2"))
    linked = pairs.filter(F.abs("r") > threshold).select("var1", "var2").join(first, "var1").join(second, "var2")
    ends = linked.select(F.greatest("pos1", "pos2").alias("group_pos"),
                         F.explode(F.array("var1", "var2")).alias("member")).distinct()
    by_name = Window.partitionBy("group_pos").orderBy("member")
    return ends.withColumn("member_no", F.row_number().over(by_name))


def groups_table(groups: DataFrame) -> DataFrame:
    """(group_id, head, members, size), one row per group, in table order of the groups."""
    g = groups.groupBy("group_pos").agg(F.min("member").alias("head"), F.count(F.lit(1)).cast("int").alias("size"),
                                        F.array_join(F.sort_array(F.collect_list("member")), ",").alias("members"))
    number = F.row_number().over(Window.orderBy("group_pos")) - 1
    return g.select(number.alias("group_id"), "head", "members", "size")


def group_drops(pairs: DataFrame, columns: list[str], threshold: float, exclude=(), protected=()) -> DataFrame:
    """(group_pos, column): every member but the first of each group over the columns that are
    neither excluded nor protected; a column is listed once for each such group (C9)."""
    hidden = {*exclude, *protected}
    groups = correlated_groups(pairs, [c for c in columns if c not in hidden], threshold)
    return groups.filter("member_no > 1").select("group_pos", F.col("member").alias("column"))


def pairwise_drops(pairs: DataFrame, threshold: float, protected=()) -> DataFrame:
    """(column): per pair over the threshold drop the lexicographically larger name, but never a
    protected one -- then its partner is dropped (C10). Pure SQL on the pair table."""
    p = F.array(*[F.lit(x) for x in protected]) if protected else F.array().cast("array<string>")
    v1p = F.array_contains(p, F.col("var1"))
    v2p = F.array_contains(p, F.col("var2"))
    drop = (F.when(v1p & v2p, F.lit(None)).when(v1p, F.col("var2")).when(v2p, F.col("var1"))
            .otherwise(F.greatest("var1", "var2")))
    return pairs.filter(F.abs("r") > threshold).select(drop.alias("column")).filter(
        F.col("column").isNotNull()).distinct()


# The sections of a reduced table, in their order.
SECTIONS = ("priority", "target", "extra", "kept", "ungrouped", "protected")


def keep_one_per_group(groups: DataFrame, columns: list[str], target: str | None, priority=(), extra=(),
                       protected=(), binary: list[str] | None = None) -> DataFrame:
    """(pos, column, section) of the table reduced to one column per group (C11).

    Within a group the first member by name that is not protected stays, as do all protected
    ones; a column that stays for one group stays. A column stands in the first section that
    lists it: priority, target, extra, kept (by name), binary columns of no group, protected."""
    spark = groups.sparkSession
    table = _positions(spark, columns).select("column")
    shield = F.col("member").isin(*protected) if protected else F.lit(False)
    rank = F.row_number().over(Window.partitionBy("group_pos", "shield").orderBy("member"))
    fate = groups.join(table, groups["member"] == table["column"]).withColumn("shield", shield) \
        .withColumn("stays", F.col("shield") | (rank == 1)).groupBy("column").agg(F.max("stays").alias("stays"))
    listed = {"priority": priority, "target": [target] if target else [], "extra": extra, "protected": protected,
              "ungrouped": binary if binary is not None else [c for c in columns if c != target]}
    named = spark.createDataFrame([(SECTIONS.index(k), i, c) for k, cs in listed.items() for i, c in enumerate(cs)],
                                  "section int, place int, column string").join(table, "column", "left_semi")
    ungrouped, kept = SECTIONS.index("ungrouped"), SECTIONS.index("kept")
    named = named.filter(F.col("section") != ungrouped).unionByName(
        named.filter(F.col("section") == ungrouped).join(fate, "column", "left_anti"))
    stays = fate.filter("stays").select("column", F.lit(kept).alias("section"), F.lit(0).alias("place"))
    best = named.unionByName(stays).groupBy("column").agg(F.min(F.struct("section", "place")).alias("at"))
    order = Window.orderBy("at.section", "at.place", "column")
    return best.select((F.row_number().over(order) - 1).alias("pos"), "column",
                       F.element_at(F.array(*map(F.lit, SECTIONS)), F.col("at.section") + 1).alias("section"))


def apply_drop_list(df: DataFrame, to_drop: list[str], protected=()) -> DataFrame:
    """Drop the listed columns, never a protected one."""
    return df.drop(*[c for c in to_drop if c not in set(protected) and c in df.columns])


def reduction_impact(before_cols: list[str], after_cols: list[str], spark) -> DataFrame:
    """One row: columns before/after, dropped, kept %."""
    b, a = len(before_cols), len(after_cols)
    return spark.createDataFrame([(b, a, b - a, round(100.0 * a / b, 6) + 0.0 if b else 0.0)],
                                 "cols_before int, cols_after int, n_dropped int, kept_pct double")


# ----------------------------------------------------------------------------------- C14, C15
def anova_f(df: DataFrame, cols: list[str], target: str = "y") -> DataFrame:
    """(column, f, f_norm): one-way ANOVA F of each column across target classes, and F / max F (C14).

    Per (column, class) count, sum and sum of squares from one aggregate of the melted table."""
    g = melt(df, cols, keep=[target]).filter(F.col("value").isNotNull()).groupBy("column", col(target).alias("k")) \
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("s"), F.sum(F.col("value") ** 2).alias("ss"))
    t = g.groupBy("column").agg(F.sum("n").alias("N"), F.sum("s").alias("S"), F.sum("ss").alias("SS"),
                                F.count(F.lit(1)).alias("K"),
                                F.sum(F.col("s") * F.col("s") / F.col("n")).alias("B"))
    ssb = F.col("B") - F.col("S") * F.col("S") / F.col("N")
    ssw = F.col("SS") - F.col("B")
    f = F.try_divide(ssb / (F.col("K") - 1), ssw / (F.col("N") - F.col("K")))
    f = F.when(F.col("K") < 2, F.lit(None)).otherwise(f)
    out = t.select("column", f.alias("f"))
    return out.select("column", r6("f").alias("f"),
                      r6(F.try_divide(F.col("f"), F.max("f").over(Window.partitionBy()))).alias("f_norm"))


def k_best(df: DataFrame, cols: list[str], target: str = "y", k: int = 10) -> DataFrame:
    """The k columns with the largest ANOVA F."""
    return anova_f(df, cols, target).filter(F.col("f").isNotNull()).orderBy(
        F.col("f").desc(), "column").limit(k)


# ----------------------------------------------------------------------------------- C17, C19
def bivariate_report(df: DataFrame, target: str, continuous: list[str], binary: list[str],
                     t_cont: float = 0.9, t_bin: float = 0.95) -> DataFrame:
    """Long (kind, var1, var2, r): target correlations, continuous pairs > t_cont, binary pairs > t_bin."""
    tc = target_correlations(df, continuous + binary, target).select(
        F.lit("target").alias("kind"), F.col("column").alias("var1"), F.lit(target).alias("var2"), "r")
    cp = high_pairs(corr_pairs(df, continuous), t_cont).select(F.lit("continuous").alias("kind"), "var1", "var2", "r")
    bp = phi_pairs(df, binary, t_bin).select(
        F.lit("binary").alias("kind"), "var1", "var2", "r")
    return tc.unionByName(cp).unionByName(bp)


def full_correlation_report(df: DataFrame, target: str, binary: list[str], continuous: list[str],
                            per_bucket: int = 10, t_sample: float = 0.8, t_bin: float = 0.95) -> dict:
    """C17: column sample -> target top/bottom 10 -> sample pairs > .8 -> all target
    correlations, binary pairs > .95 -> redundancy degree. Returns named DataFrames."""
    sample = [r[0] for r in stratified_column_sample(df, binary, per_bucket).select("column").collect()]
    feats = continuous + binary
    bin_pairs = phi_pairs(df, binary, t_bin)
    return {
        "sample": stratified_column_sample(df, binary, per_bucket),
        "top": top_target_correlations(df, feats, target, 10),
        "bottom": top_target_correlations(df, feats, target, 10, bottom=True),
        "sample_pairs": phi_pairs(df, sample, t_sample),
        "target": target_correlations(df, feats, target),
        "binary_pairs": bin_pairs,
        "degree": redundancy_degree(bin_pairs),
    }
