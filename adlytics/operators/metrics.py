"""Evaluation, threshold search and model-selection operators over a long score table.

Score table: one row per (key..., id) with a 0/1 label and a probability; ``by`` names the key
columns (e.g. imputation, version, model). Every operator is one grouped aggregate over it,
so all models and variants are handled by one job:

* metrics at a threshold: count_if of TP/FP/FN/TN per group;
* grid threshold search: each score goes to the highest grid point <= score, counts per
  (group, grid point) (<= grid size rows per group), then a reverse cumulative sum;
* exact PR optimum, ROC/PR points and AUC: counts per distinct score, then the bucketed
  prefix sum of ``prefix.py`` (no single-partition window).

F1 is computed as 2TP / (2TP + FP + FN) (zero when undefined); precision and recall are zero
when undefined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlytics.functions.exprs import col, r6
from adlytics.operators.prefix import prefix_sums
from adlytics.session import cut_lineage

EPS_F1 = 1e-9


def unit_bounds(buckets: int) -> list[float]:
    """Even bucket bounds for probabilities in [0, 1]: no quantile pass is needed."""
    return [i / buckets for i in range(1, buckets)]


def _div0(a, b) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _rates(tp, fp, fn, tn=None) -> list[Column]:
    out = [_div0(tp, tp + fp).alias("precision"), _div0(tp, tp + fn).alias("recall"),
           _div0(2 * tp, 2 * tp + fp + fn).alias("f1")]
    if tn is not None:
        out.append(_div0(tp + tn, tp + fp + fn + tn).alias("accuracy"))
    return out


# ----------------------------------------------------------------------------------- E1, E11
def confusion_counts(scores: DataFrame, threshold, by: list[str] = (), score: str = "p",
                     label: str = "y") -> DataFrame:
    """(by..., tp, fp, fn, tn) with the inclusive rule score >= threshold. ``threshold`` is a
    number or the name of a per-row threshold column."""
    t = col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    pred = col(score) >= t
    y = col(label) == 1
    return scores.groupBy(*by).agg(F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
                                   F.count_if(~pred & y).alias("fn"), F.count_if(~pred & ~y).alias("tn"))


def with_thresholds(scores: DataFrame, thresholds: DataFrame, by: list[str], name: str = "threshold") -> DataFrame:
    """Every score row with its group's threshold; groups without one are left out.

    The thresholds, one row per group, go to the score rows: by its estimate the planner may take
    a score table that is exploded from a narrow one for the smaller side, and broadcast that."""
    return scores.join(F.broadcast(thresholds.select(*by, name)), by)


def metrics_at_threshold(scores: DataFrame, threshold=0.5, by: list[str] = (), score: str = "p",
                         label: str = "y") -> DataFrame:
    """(by..., [threshold], tp, fp, fn, tn, precision, recall, f1, accuracy)."""
    c = confusion_counts(scores, threshold, by, score, label)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    extra = [] if isinstance(threshold, str) else [F.lit(float(threshold)).alias("threshold")]
    return c.select(*by, *extra, "tp", "fp", "fn", "tn",
                    *[r6(x).alias(n) for x, n in zip(_rates(tp, fp, fn, tn), ["precision", "recall", "f1", "accuracy"])])


def confusion_matrix(scores: DataFrame, threshold=0.5, by: list[str] = (), score: str = "p",
                     label: str = "y") -> DataFrame:
    """(by..., actual, predicted, n): all four cells, empty ones with 0."""
    c = confusion_counts(scores, threshold, by, score, label)
    cells = F.array(F.struct(F.lit(1).alias("actual"), F.lit(1).alias("predicted"), F.col("tp").alias("n")),
                    F.struct(F.lit(0).alias("actual"), F.lit(1).alias("predicted"), F.col("fp").alias("n")),
                    F.struct(F.lit(1).alias("actual"), F.lit(0).alias("predicted"), F.col("fn").alias("n")),
                    F.struct(F.lit(0).alias("actual"), F.lit(0).alias("predicted"), F.col("tn").alias("n")))
    return c.select(*by, F.explode(cells).alias("c")).select(*by, "c.*")


def classification_report(scores: DataFrame, threshold=0.5, by: list[str] = (), score: str = "p",
                          label: str = "y") -> DataFrame:
    """(by..., class, precision, recall, f1, support) for classes 0 and 1, macro and weighted
    averages (E12)."""
    c = confusion_counts(scores, threshold, by, score, label)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    p1, r1, f1 = _rates(tp, fp, fn)
    p0, r0, f0 = _rates(tn, fn, fp)
    s1, s0 = tp + fn, tn + fp
    n = s1 + s0
    rows = F.array(
        F.struct(F.lit("0").alias("class"), p0.alias("precision"), r0.alias("recall"), f0.alias("f1"),
                 s0.alias("support")),
        F.struct(F.lit("1").alias("class"), p1.alias("precision"), r1.alias("recall"), f1.alias("f1"),
                 s1.alias("support")),
        F.struct(F.lit("macro avg").alias("class"), ((p0 + p1) / 2).alias("precision"),
                 ((r0 + r1) / 2).alias("recall"), ((f0 + f1) / 2).alias("f1"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), _div0(p0 * s0 + p1 * s1, n).alias("precision"),
                 _div0(r0 * s0 + r1 * s1, n).alias("recall"), _div0(f0 * s0 + f1 * s1, n).alias("f1"),
                 n.alias("support")))
    out = c.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")
    return out.select(*by, "class", r6("precision").alias("precision"), r6("recall").alias("recall"),
                      r6("f1").alias("f1"), "support")


# ----------------------------------------------------------------------------------- E2
def grid_bucket(score: str, lo: int, hi: int, denom: int = 100) -> Column:
    """Index i of the highest grid point i/denom (lo <= i <= hi) not above the score; lo - 1 when
    the score is below the grid. Adjusted so it agrees exactly with ``score >= i/denom``."""
    s = col(score)
    b0 = F.floor(s * denom).cast("int")
    b = (F.when(s >= (b0 + 1) / F.lit(float(denom)), b0 + 1)
         .when(s < b0 / F.lit(float(denom)), b0 - 1).otherwise(b0))
    # never NULL: a nullable join key makes Catalyst push an inferred not-null filter below the
    # aggregate with the score's defining expression inlined
    return F.coalesce(F.when(b > hi, F.lit(hi)).when(b < lo, F.lit(lo - 1)).otherwise(b), F.lit(lo - 1))


def threshold_curve(scores: DataFrame, by: list[str] = (), lo: int = 1, hi: int = 99, denom: int = 100,
                    score: str = "p", label: str = "y") -> DataFrame:
    """(by..., threshold, tp, fp, fn, precision, recall, f1) at every grid point i/denom, lo..hi.

    One pass: counts per (group, bucket), then reverse cumulative sums over the small grid."""
    by = list(by)
    y = col(label) == 1
    g = scores.groupBy(*by, grid_bucket(score, lo, hi, denom).alias("i")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    tot = g.groupBy(*by).agg(F.sum("pos").alias("P"))
    grid = tot.select(*by, "P", F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("i"))
    j = grid.join(g, by + ["i"], "left").fillna(0, ["pos", "neg"])
    w = Window.partitionBy(*by).orderBy(F.col("i").desc()).rowsBetween(Window.unboundedPreceding, 0)
    c = j.select(*by, "i", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp"), "P")
    tp, fp = F.col("tp"), F.col("fp")
    fn = F.col("P") - tp
    return c.select(*by, (F.col("i") / F.lit(float(denom))).alias("threshold"), "tp", "fp", fn.alias("fn"),
                    *[r6(x).alias(n) for x, n in zip(_rates(tp, fp, fn), ["precision", "recall", "f1"])])


def best_row(df: DataFrame, by: list[str], metric: str, tie: str = "threshold") -> DataFrame:
    """The row with the largest metric per group; first (smallest numeric ``tie``) wins on ties.

    A ``max_by`` aggregate (partial aggregation per partition), so a group with many candidate
    rows (e.g. every distinct score) is never sorted in one task."""
    by = list(by)
    rest = [c for c in df.columns if c not in by]
    key = F.struct(F.col(metric), -F.col(tie))
    if not by:
        agg = df.agg(F.max_by(F.struct(*rest), key).alias("_b"))
    else:
        agg = df.groupBy(*by).agg(F.max_by(F.struct(*rest), key).alias("_b"))
    return agg.select(*by, "_b.*")


def grid_threshold_search(scores: DataFrame, by: list[str] = (), metric: str = "f1", lo: int = 1,
                          hi: int = 99, denom: int = 100, score: str = "p", label: str = "y") -> DataFrame:
    """(by..., threshold, f1, precision, recall) at the best grid point per group.

    Grid 0.01..0.99 by default; 0.20..0.80 is lo=20, hi=80."""
    cur = threshold_curve(scores, by, lo, hi, denom, score, label)
    return best_row(cur, list(by), metric).select(*by, "threshold", "f1", "precision", "recall")


# ----------------------------------------------------------------------------------- E3, E9, E10
def _score_counts(scores, by, score, label):
    y = col(label) == 1
    return scores.groupBy(*by, col(score).alias("s")).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))


def _keyed(scores: DataFrame, by):
    """Group keys, with a constant key when there are none (joins stay equi-joins)."""
    by = list(by)
    if by:
        return scores, by, []
    return scores.withColumn("_all", F.lit(0)), ["_all"], ["_all"]


def pr_points(scores: DataFrame, by: list[str] = (), score: str = "p", label: str = "y",
              buckets: int = 1024) -> DataFrame:
    """(by..., threshold, tp, fp, precision, recall): one point per distinct score."""
    scores, by, drop = _keyed(scores, by)
    g = _score_counts(scores, by, score, label)
    cum = prefix_sums(g, "s", ["pos", "neg"], by=by, descending=True, unit_buckets=buckets)
    tot = g.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    j = cum.join(tot, by)
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    return j.select(*by, F.col("s").alias("threshold"), tp.alias("tp"), fp.alias("fp"), "P", "N",
                    _div0(tp, tp + fp).alias("precision"), _div0(tp, F.col("P")).alias("recall")).drop(*drop)


def exact_threshold_search(scores: DataFrame, by: list[str] = (), score: str = "p", label: str = "y",
                           buckets: int = 1024) -> DataFrame:
    """(by..., threshold, f1, precision, recall): best F1 over every distinct score, with
    f1 = 2pr / (p + r + 1e-9); first (lowest threshold) wins on ties (E3, E5, E6)."""
    by = list(by)
    pts = pr_points(scores, by, score, label, buckets)
    p, r = F.col("precision"), F.col("recall")
    f1 = 2 * p * r / (p + r + F.lit(EPS_F1))
    b = best_row(pts.withColumn("f1", f1), by, "f1")
    return b.select(*by, r6("threshold").alias("threshold"), r6("f1").alias("f1"),
                    r6("precision").alias("precision"), r6("recall").alias("recall"))


def roc_points(scores: DataFrame, by: list[str] = (), score: str = "p", label: str = "y",
               buckets: int = 1024) -> DataFrame:
    """(by..., threshold, fpr, tpr): one ROC point per distinct score."""
    pts = pr_points(scores, by, score, label, buckets)
    return pts.select(*by, "threshold", r6(_div0(F.col("fp"), F.col("N"))).alias("fpr"),
                      r6(_div0(F.col("tp"), F.col("P"))).alias("tpr"))


def auc(scores: DataFrame, by: list[str] = (), score: str = "p", label: str = "y",
        buckets: int = 1024) -> DataFrame:
    """(by..., auc): area under the ROC curve, Mann-Whitney with ties counted half.

    Equals the trapezoid area under ``roc_points``; each distinct score contributes
    pos x (negatives below + neg / 2), from one bucketed prefix sum."""
    by = list(by)
    g = _score_counts(scores, by, score, label)
    cum = prefix_sums(g, "s", ["neg"], by=by, unit_buckets=buckets)
    part = cum.select(*by, (F.col("pos") * (F.col("cum_neg") - F.col("neg") * 0.5)).alias("a"), "pos", "neg")
    a = part.groupBy(*by).agg(F.sum("a").alias("a"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return a.select(*by, r6(F.try_divide(F.col("a"), F.col("P") * F.col("N"))).alias("auc"))


def roc_trapezoid_auc(scores: DataFrame, by: list[str] = (), score: str = "p", label: str = "y",
                      buckets: int = 1024) -> DataFrame:
    """(by..., auc_trapezoid): trapezoid rule over the ROC points, starting at (0, 0).

    The step at each point is (neg/N) x (tpr_before + tpr_after)/2 with tpr_before =
    (tp - pos)/P, so no lag over an ordered window is needed."""
    scores, by, drop = _keyed(scores, by)
    g = _score_counts(scores, by, score, label)
    cum = prefix_sums(g, "s", ["pos"], by=by, descending=True, unit_buckets=buckets)
    tot = g.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    j = cum.join(tot, by)
    step = F.col("neg") / F.col("N") * (2 * F.col("cum_pos") - F.col("pos")) / (2 * F.col("P"))
    return j.groupBy(*by).agg(r6(F.sum(step)).alias("auc_trapezoid")).drop(*drop)


# ----------------------------------------------------------------------------------- E4, E7
def default_vs_optimised(scores: DataFrame, by: list[str], tune_split: str = "val", eval_split: str | None = None,
                         split_col: str = "split", metric: str = "f1", lo: int = 1, hi: int = 99,
                         default: float = 0.5) -> DataFrame:
    """(by..., optimal_threshold, default_f1, optimized_f1, improvement, improvement_pct).

    The threshold is tuned on ``tune_split`` (the reference tunes on train; default val) and both
    F1 values are measured on ``eval_split`` (default: the tuning split)."""
    by = list(by)
    tune = scores.filter(col(split_col) == tune_split)
    ev = tune if eval_split is None else scores.filter(col(split_col) == eval_split)
    best = cut_lineage(grid_threshold_search(tune, by, metric, lo, hi)
                       .select(*by, F.col("threshold").alias("optimal_threshold")))     # one row per group, used twice
    d = metrics_at_threshold(ev, default, by).select(*by, F.col("f1").alias("default_f1"))
    o = metrics_at_threshold(with_thresholds(ev, best, by, "optimal_threshold"), "optimal_threshold", by).select(
        *by, F.col("f1").alias("optimized_f1"))
    j = best.join(d, by).join(o, by)
    imp = F.col("optimized_f1") - F.col("default_f1")
    return j.select(*by, "optimal_threshold", "default_f1", "optimized_f1", r6(imp).alias("improvement"),
                    r6(F.when(F.col("default_f1") > 0, imp * 100.0 / F.col("default_f1")).otherwise(0.0))
                    .alias("improvement_pct"))


# ----------------------------------------------------------------------------------- E13, E14
def evaluate_at_thresholds(scores: DataFrame, thresholds: DataFrame, by: list[str], split: str | None = "test",
                           split_col: str = "split", buckets: int = 1024) -> DataFrame:
    """(by..., threshold, f1, precision, recall, auc) at saved per-group thresholds.

    Groups without a saved threshold are skipped (inner join); see ``missing_thresholds``."""
    by = list(by)
    s = scores if split is None else scores.filter(col(split_col) == split)
    thresholds = cut_lineage(thresholds.select(*by, "threshold"))     # one row per group, used twice
    m = metrics_at_threshold(with_thresholds(s, thresholds, by), "threshold", by).join(thresholds, by)
    a = auc(s, by, buckets=buckets)
    return m.join(a, by).select(*by, "threshold", "f1", "precision", "recall", "auc")


def missing_thresholds(scores: DataFrame, thresholds: DataFrame, by: list[str]) -> DataFrame:
    """Groups present in the scores without a saved threshold (left anti join)."""
    return scores.select(*by).distinct().join(thresholds.select(*by), by, "left_anti")


# Gaps between validation and test below which a model is stable, or to be watched.
STABLE_GAP, WATCH_GAP = 0.03, 0.05


def val_test_gap(val: DataFrame, test: DataFrame, by: list[str], metric: str = "f1") -> DataFrame:
    """(by..., val_f1, test_f1, gap, band) with bands < .03 stable, .03-.05 watch, > .05 overfit."""
    j = val.select(*by, F.col(metric).alias("val_f1")).join(test.select(*by, F.col(metric).alias("test_f1")), by)
    gap = F.col("val_f1") - F.col("test_f1")
    band = F.when(F.abs(gap) < STABLE_GAP, "stable").when(F.abs(gap) <= WATCH_GAP, "watch").otherwise("overfit")
    return j.select(*by, "val_f1", "test_f1", r6(gap).alias("gap"), band.alias("band"))


# ----------------------------------------------------------------------------------- E15-E21
def champion(results: DataFrame, metric: str = "f1", keys: list[str] = ("model",)) -> DataFrame:
    """One row: the best result by metric (first by key order on ties), with rank 1 of total."""
    keys = list(keys)
    w = Window.orderBy(F.col(metric).desc(), *[F.col(k) for k in keys])
    r = results.withColumn("rank", F.row_number().over(w)).withColumn(
        "total", F.count(F.lit(1)).over(Window.partitionBy()))
    return r.filter("rank = 1")


def best_of_two(a: DataFrame, b: DataFrame, metric: str = "f1", label_a: str = "knn", label_b: str = "mice") -> DataFrame:
    """Pick a if its metric >= b's (tie -> a) (E16). Inputs are one-row results."""
    ra = a.select(F.lit(label_a).alias("choice"), F.col(metric).alias("score"))
    rb = b.select(F.lit(label_b).alias("choice"), F.col(metric).alias("score"))
    u = ra.unionByName(rb).withColumn("pri", F.when(F.col("choice") == label_a, 0).otherwise(1))
    return u.agg(F.min_by(F.struct("choice", "score"), F.struct(-F.col("score"), F.col("pri"))).alias("b")) \
        .select("b.choice", "b.score")


def final_synthesis(candidates: DataFrame, results: DataFrame, keys: list[str],
                    metrics=("f1", "precision", "recall", "threshold")) -> DataFrame:
    """Every candidate with its result (missing -> 0), sorted by F1 desc."""
    j = candidates.join(results.select(*keys, *metrics), keys, "left")
    return j.select(*keys, *[F.coalesce(F.col(m), F.lit(0.0)).alias(m) for m in metrics]).orderBy(
        F.col("f1").desc(), *keys)


def metric_pivot(results: DataFrame, row: str, column: str, metric: str = "f1", values=None) -> DataFrame:
    """row x column table of a metric."""
    return results.groupBy(row).pivot(column, values).agg(F.first(metric))


def agreement_rate(a: DataFrame, b: DataFrame, id_col: str = "id", pred: str = "pred") -> DataFrame:
    """One row: rows compared and share of equal predictions, joined on id."""
    j = a.select(col(id_col), col(pred).alias("pa")).join(b.select(col(id_col), col(pred).alias("pb")), id_col)
    return j.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("pa") == F.col("pb")).alias("n_agree")).select(
        "n", "n_agree", r6(F.try_divide(F.col("n_agree").cast("double"), F.col("n"))).alias("agreement"))


def optimisation_analysis(comp: DataFrame, group: str = "dataset") -> DataFrame:
    """Per group: mean/std/count of improvement, mean threshold, improved/degraded/unchanged."""
    i = F.col("improvement")
    return comp.groupBy(group).agg(
        r6(F.avg(i)).alias("mean_improvement"), r6(F.stddev_samp(i)).alias("std_improvement"),
        F.count(F.lit(1)).alias("n"), r6(F.avg("optimal_threshold")).alias("mean_threshold"),
        F.count_if(i > 0).alias("n_improved"), F.count_if(i < 0).alias("n_degraded"),
        F.count_if(i == 0).alias("n_unchanged"),
        r6(F.avg((i > 0).cast("double")) * 100).alias("pct_improved"))
