"""Exact nearest neighbours, imputation and the choice of k against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlytics.operators import knn as K
from adlytics.operators import neighbours as N
from adlytics.operators.sampling import cell_mask, hash_folds


def distance(a, b):
    both = ~np.isnan(a) & ~np.isnan(b)
    if not both.any():
        return None
    total = 0.0
    for x, y in zip(a[both], b[both]):
        total += (x - y) ** 2
    return math.sqrt(len(a) / both.sum() * total)


def ranked(q, rows, k, ok=lambda i: True):
    """(distance, id) of the k nearest rows of ``rows`` (id -> vector)."""
    found = [(d, i) for i, v in rows.items() if ok(i) and (d := distance(q, v)) is not None]
    return sorted(found)[:k]


def frame(spark, rows, n, extra=None):
    names = ", ".join(f"c{j} double" for j in range(n))
    data = [(i, *(extra[i] if extra else ()), *[None if math.isnan(x) else float(x) for x in v]) for i, v in rows.items()]
    return spark.createDataFrame(data, f"id long, {'fold int, ' if extra else ''}{names}").repartition(5)


def table(rng, n_rows, n, holes, flags=0):
    rows = {}
    for i in range(n_rows):
        v = np.concatenate([rng.integers(0, 2, flags), rng.normal(0, 10, n - flags).round(2)]).astype(float)
        v[flags:][rng.random(n - flags) < holes] = np.nan
        rows[i] = v
    return rows


@pytest.mark.parametrize("n, flags, holes, cells", [(3, 0, 0.4, 64), (6, 2, 0.2, 64), (100, 60, 0.3, 128), (4, 0, 0.0, 64)])
def test_nearest_against_all_pairs(spark, monkeypatch, n, flags, holes, cells):
    monkeypatch.setattr(N, "CELL_ROWS", cells)
    monkeypatch.setattr(N, "DONOR_BLOCK", 64)
    monkeypatch.setattr(N, "QUERY_BLOCK", 64)
    monkeypatch.setattr(N, "REST_PAIRS", 2000)
    rng = np.random.default_rng(n)
    rows = table(rng, 400, n, holes, flags)
    for i in range(40):                                  # a crowded place, ties and far rows
        rows[1000 + i] = rows[0].copy()
    rows[2000] = np.full(n, 500.0)
    rows[2001] = np.full(n, np.nan)
    cols = [f"c{j}" for j in range(n)]
    df = frame(spark, rows, n)
    got = {}
    for r in N.nearest(df, df, cols, 4, "id", "id", exclude_self=True).collect():
        got.setdefault(r.id, []).append((r["rank"], r.id_donor, r.dist))
    assert 2001 not in got
    for i, v in rows.items():
        want = ranked(v, rows, 4, lambda j, i=i: j != i)
        assert [x[1] for x in sorted(got.get(i, []))] == [j for _, j in want], i
        assert [x[2] for x in sorted(got.get(i, []))] == pytest.approx([d for d, _ in want])


def test_1555_coordinates(spark):
    """The width of a wide sparse table: flags without holes, three values with them."""
    rng = np.random.default_rng(3)
    n, rows = 1555, {}
    for i in range(90):
        v = (rng.random(n) < 0.03).astype(float)
        v[-3:] = rng.normal(0, 3, 3)
        if i % 4 < 3:
            v[-1 - i % 4] = np.nan
        rows[i] = v
    df = frame(spark, rows, n)
    cols = [f"c{j}" for j in range(n)]
    out = {r.id: r for r in K.knn_impute(df, cols, "id", 5).select("id", *cols[-3:], "c0").collect()}
    for i, v in rows.items():
        assert out[i].c0 == v[0]
        for j in range(n - 3, n):
            if math.isnan(v[j]):
                near = ranked(v, rows, 5, lambda x, j=j: not math.isnan(rows[x][j]))
                assert out[i][f"c{j}"] == pytest.approx(np.mean([rows[x][j] for _, x in near]))
            else:
                assert out[i][f"c{j}"] == v[j]


def test_slots_leave_out_a_fold(spark, monkeypatch):
    monkeypatch.setattr(N, "CELL_ROWS", 64)
    rng = np.random.default_rng(8)
    rows = table(rng, 150, 5, 0.0)
    fold = {i: (i * 7 % 4,) for i in rows}
    cols = [f"c{j}" for j in range(5)]
    df = frame(spark, rows, 5, fold)
    found = N.nearest(df, df, cols, 6, "id", "id", exclude_self=True, slots="fold")
    runs = df.select("id", F.explode(F.array(*[F.lit(x) for x in (-1, 0, 1, 2, 3)])).alias("run"), "fold").filter("run <> fold").drop("fold")
    got = {}
    for r in N.leaving_out(found, runs, 6, "id", "id_donor").collect():
        got.setdefault((r.id, r.run), []).append((r["rank"], r.id_donor))
    assert len(got) == sum(4 for _ in rows)
    for (i, run), near in got.items():
        assert [j for _, j in sorted(near)] == [j for _, j in ranked(rows[i], rows, 6, lambda j: j != i and fold[j][0] != run)]


def test_empty_sides(spark):
    df = frame(spark, {1: np.array([1.0, np.nan])}, 2)
    assert N.nearest(df.limit(0), df, ["c0", "c1"], 2, "id", "id").collect() == []
    assert N.nearest(df, df.limit(0), ["c0", "c1"], 2, "id", "id").collect() == []
    assert K.knn_impute(df, ["c0", "c1"], "id").collect()[0].c1 is None


def test_k_search_equals_one_search_per_fold(spark):
    rng = np.random.default_rng(5)
    rows = table(rng, 160, 3, 0.1)
    df = frame(spark, rows, 3)
    cols, ks = ["c0", "c1", "c2"], [1, 3, 5]
    got = {r.k: r for r in K.knn_k_search(df, cols, "id", ks, folds=4).collect()}
    complete = hash_folds(df.na.drop(), "id", 4)
    mask = {r.id: r for r in cell_mask(complete, "id", cols, 0.2, 42).collect()}
    err = {(k, f): [] for k in ks for f in range(4)}
    for i, r in mask.items():
        v = np.array([np.nan if r[f"{c}_masked"] else rows[i][j] for j, c in enumerate(cols)])
        donors = {d: rows[d] for d, x in mask.items() if x.fold != r.fold}
        near = [donors[d] for _, d in ranked(v, donors, max(ks))]
        for j, c in enumerate(cols):
            if r[f"{c}_masked"] and near:
                for k in ks:
                    err[k, r.fold].append(np.mean([d[j] for d in near[:k]]) - rows[i][j])
    for k in ks:
        mse = np.mean([np.mean(np.square(err[k, f])) for f in range(4)])
        assert got[k].mse == pytest.approx(mse)
        assert got[k].std_mse == pytest.approx(np.std([np.mean(np.square(err[k, f])) for f in range(4)], ddof=1))
    assert [k for k in ks if got[k].best] == [min(ks, key=lambda k: (got[k].mse, k))]


def test_quick_k_splits_seventy_thirty(spark):
    rnd = random.Random(2)
    df = spark.createDataFrame([(i, rnd.gauss(0, 1), rnd.gauss(0, 1)) for i in range(200)], "id long, a double, b double")
    res = K.quick_k_table(df, ["a", "b"], "id").collect()
    assert [r.k for r in res if r.best] == [K.quick_k(df, ["a", "b"], "id")]
    assert {r.k for r in res} == set(K.QUICK_K) and all(r.std_mse is None for r in res)     # one split
    assert K.quick_k(df.limit(30), ["a", "b"], "id") == K.QUICK_DEFAULT
