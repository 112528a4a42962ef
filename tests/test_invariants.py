"""Invariant and brute-force checks of the operators on small hand-made frames."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlytics.functions import exprs as X
from adlytics.operators import corr as C
from adlytics.operators import knn as K
from adlytics.operators import metrics as E
from adlytics.operators import missing as M
from adlytics.operators import profile as P
from adlytics.operators import sampling as R
from adlytics.operators import transform as TR
from adlytics.operators.prefix import prefix_sums


def _scores(spark, n=400, seed=1):
    rnd = random.Random(seed)
    rows = [(i, rnd.random() < 0.3, round(rnd.random(), 2)) for i in range(n)]
    rows = [(i, int(y), min(1.0, round(p + (0.3 if y else 0.0), 2))) for i, y, p in rows]
    return spark.createDataFrame(rows, "id long, y int, p double"), rows


def test_grid_search_matches_brute_force(spark):
    df, rows = _scores(spark)
    best = E.grid_threshold_search(df).first()
    res = []
    for i in range(1, 100):
        t = i / 100
        tp = sum(1 for _, y, p in rows if p >= t and y == 1)
        fp = sum(1 for _, y, p in rows if p >= t and y == 0)
        fn = sum(1 for _, y, p in rows if p < t and y == 1)
        res.append((round(2 * tp / (2 * tp + fp + fn), 6) if tp else 0.0, -t))
    f1, neg_t = max(res)
    assert best["threshold"] == pytest.approx(-neg_t)
    assert best["f1"] == pytest.approx(f1)


def test_auc_matches_mann_whitney_and_trapezoid(spark):
    df, rows = _scores(spark)
    pos = [p for _, y, p in rows if y == 1]
    neg = [p for _, y, p in rows if y == 0]
    u = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg)
    expected = u / (len(pos) * len(neg))
    assert E.auc(df).first()["auc"] == pytest.approx(expected, abs=1e-6)
    assert E.roc_trapezoid_auc(df).first()["auc_trapezoid"] == pytest.approx(expected, abs=1e-6)


def test_exact_threshold_first_max(spark):
    df, rows = _scores(spark)
    best = E.exact_threshold_search(df).first()
    cand = []
    P_ = sum(y for _, y, _ in rows)
    for t in sorted({p for _, _, p in rows}):
        tp = sum(1 for _, y, p in rows if p >= t and y == 1)
        fp = sum(1 for _, y, p in rows if p >= t and y == 0)
        pr, rc = tp / (tp + fp), tp / P_
        cand.append((2 * pr * rc / (pr + rc + 1e-9), -t))
    f1, nt = max(cand)
    assert best["threshold"] == pytest.approx(-nt)
    assert best["f1"] == pytest.approx(f1, abs=1e-6)


@pytest.mark.parametrize("parts", [1, 4, 31])
def test_prefix_sums_any_partitioning(spark, parts):
    rnd = random.Random(3)
    rows = [(g, float(v), rnd.randint(0, 5)) for g in range(3) for v in rnd.sample(range(1000), 200)]
    df = spark.createDataFrame(rows, "g int, v double, c int").repartition(parts)
    out = {(r["g"], r["v"]): r["cum_c"] for r in prefix_sums(df, "v", ["c"], by=["g"], buckets=8).collect()}
    for g in range(3):
        acc = 0
        for _, v, c in sorted(x for x in rows if x[0] == g):
            acc += c
            assert out[(g, v)] == acc


def _nan_euclid(a, b):
    shared = [j for j in range(len(a)) if a[j] is not None and b[j] is not None]
    if not shared:
        return None
    return math.sqrt(len(a) / len(shared) * sum((a[j] - b[j]) ** 2 for j in shared))


def test_knn_impute_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(120):
        v = [round(rnd.gauss(0, 10), 3) for _ in range(3)]
        if i % 4 < 3:
            v[i % 3] = None
        rows.append((i, *v))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    out = {r["id"]: r for r in K.knn_impute(df, ["a", "b", "c"], "id", 5).collect()}
    cols = ["a", "b", "c"]
    for i, *v in rows:
        for j, c in enumerate(cols):
            if v[j] is not None:
                assert out[i][c] == v[j]
                continue
            q = list(v)
            cands = []
            for d, *w in rows:
                if w[j] is None:
                    continue
                dist = _nan_euclid(q, w)
                if dist is not None:
                    cands.append((dist, d, w[j]))
            cands.sort()
            exp = sum(x[2] for x in cands[:5]) / min(5, len(cands))
            assert out[i][c] == pytest.approx(exp, rel=1e-9, abs=1e-9)


def test_stratified_split_exact_and_deterministic(spark):
    rows = [(i, int(i % 7 == 0)) for i in range(1000)]
    a = R.stratified_split(spark.createDataFrame(rows, "id long, y int").repartition(3), "id", "y")
    b = R.stratified_split(spark.createDataFrame(rows, "id long, y int").repartition(17), "id", "y")
    assert sorted(a.collect()) == sorted(b.collect())
    cnt = {(r["split"], r["y"]): r["count"] for r in a.groupBy("split", "y").count().collect()}
    n1 = sum(y for _, y in rows)
    n0 = len(rows) - n1
    assert cnt[("train", 1)] == math.floor(0.6 * n1) and cnt[("train", 0)] == math.floor(0.6 * n0)
    assert cnt[("val", 1)] == math.floor(0.8 * n1) - math.floor(0.6 * n1)


def test_gram_pairs_match_numpy(spark):
    rnd = np.random.default_rng(5)
    x = (rnd.random((300, 12)) < rnd.random(12)).astype(int)
    x[:, 3] = x[:, 2]
    x[:, 7] = 0                      # constant column
    cols = [f"c{i}" for i in range(12)]
    df = spark.createDataFrame([tuple(int(v) for v in r) for r in x], ", ".join(f"{c} int" for c in cols))
    got = {(r["var1"], r["var2"]): r["r"] for r in C.gram_corr_pairs(df, cols, block=5).collect()}
    with np.errstate(invalid="ignore", divide="ignore"):
        m = np.corrcoef(x.T)
    for i in range(12):
        for j in range(i + 1, 12):
            a, b = sorted([cols[i], cols[j]])
            if np.isnan(m[i, j]):
                assert got[(a, b)] is None
            else:
                assert got[(a, b)] == pytest.approx(m[i, j], abs=1e-6)


def test_greedy_groups_chain(spark):
    pairs = spark.createDataFrame([("A", "B", 0.99), ("B", "C", 0.99), ("A", "C", 0.1)], C.PAIR_SCHEMA)
    groups = C.correlated_groups(pairs, ["A", "B", "C"], 0.9)
    assert [r["members"] for r in C.groups_table(groups).orderBy("group_id").collect()] == ["A,B", "B,C"]
    drops = C.group_drops(pairs, ["A", "B", "C"], 0.9).orderBy("group_pos").collect()
    assert [r["column"] for r in drops] == ["B", "C"]
    keep = C.keep_one_per_group(groups, ["y", "C", "B", "A", "D", "q"], "y", extra=["q"], binary=["A", "B", "C", "D"])
    assert [(r["column"], r["section"]) for r in keep.orderBy("pos").collect()] == [
        ("y", "target"), ("q", "extra"), ("A", "kept"), ("B", "kept"), ("D", "ungrouped")]
    shielded = C.keep_one_per_group(groups, ["A", "B", "C", "D"], None, protected=["A", "D"])
    assert [(r["column"], r["section"]) for r in shielded.orderBy("pos").collect()] == [
        ("A", "kept"), ("B", "kept"), ("D", "ungrouped")]
    none = C.correlated_groups(pairs.limit(0), ["A", "B"], 0.9)
    assert none.count() == 0 and C.keep_one_per_group(none, ["A", "B"], None).count() == 2


def test_pairwise_drop_protects(spark):
    pairs = spark.createDataFrame([("X4", "X9", 0.99), ("X10", "X11", 0.97)], C.PAIR_SCHEMA)
    got = sorted(r[0] for r in C.pairwise_drops(pairs, 0.9, protected=["X4"]).collect())
    assert got == ["X11", "X9"]


def test_safe_corr_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert df.agg(X.safe_corr("a", "b")).first()[0] is None


def test_power_fit_is_a_maximum(spark):
    rnd = random.Random(11)
    vals = [(rnd.lognormvariate(0, 1),) for _ in range(500)]
    df = spark.createDataFrame(vals, "x double")
    fit = TR.fit_power(df, ["x"], "yeo-johnson", standardize=False)["x"]
    x = np.array([v[0] for v in vals])

    def ll(lam):
        t = ((x + 1) ** lam - 1) / lam if abs(lam) > 1e-12 else np.log1p(x)
        return -len(x) / 2 * np.log(t.var()) + (lam - 1) * np.sum(np.log1p(x))
    assert ll(fit.lmbda) >= max(ll(fit.lmbda - 0.01), ll(fit.lmbda + 0.01)) - 1e-6


def test_quadratic_order():
    names = [n for n, _ in TR.quadratic_names(["a", "b", "c"])]
    assert names == ["a", "b", "c", "a^2", "a b", "a c", "b^2", "b c", "c^2"]


def test_mice_fills_only_missing(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(200):
        a = rnd.gauss(0, 1)
        b = 2 * a + rnd.gauss(0, 0.1)
        rows.append((i, None if i % 5 == 0 else a, None if i % 7 == 0 else b))
    df = spark.createDataFrame(rows, "id long, a double, b double")
    out, fit = M.mice_fit_transform(df, ["a", "b"], "id", max_iter=20)
    got = {r["id"]: r for r in out.collect()}
    for i, a, b in rows:
        assert got[i]["a"] is not None and got[i]["b"] is not None
        if a is not None:
            assert got[i]["a"] == a
        if b is not None:
            assert got[i]["b"] == b
    again = {r["id"]: r for r in M.mice_transform(df, fit).collect()}
    assert all(abs(again[i]["a"] - got[i]["a"]) < 1e-6 for i in got)


def test_edge_cases(spark):
    df = spark.createDataFrame([(1, None, 5.0, 1), (2, None, 5.0, 1), (3, None, 5.0, 1)],
                               "id int, allnull double, const double, y int")
    d = {r["column"]: r for r in P.describe(df, ["allnull", "const"]).collect()}
    assert d["allnull"]["count"] == 0 and d["const"]["std"] == 0.0
    assert P.missing_by_column(df, ["allnull", "const"]).first()["band"] == "critical"
    dist = P.target_distribution(df, "y").first()
    assert dist["target_valid"] is False and dist["n1"] == 3
    empty = spark.createDataFrame([], "id long, y int, p double")
    assert E.auc(empty).first()["auc"] is None
    assert E.metrics_at_threshold(empty, 0.5).first()["f1"] == 0.0
    dotted = spark.createDataFrame([(1.0, 0)], "`a.b` double, y int")
    assert P.describe(dotted, ["a.b"]).first()["count"] == 1
