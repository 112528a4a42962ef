"""Synthetic minority rows per cross-validation run, and the sparse phi pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlytics.operators import phi as P
from adlytics.operators import resample as S
from adlytics.session import cut_lineage


def skewed(spark, n=400, seed=1, folds=4):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        y = int(i % 7 == 0)
        x = rng.normal(1.2 * y, 1.0, 3)
        rows.append((i, float(y), i // 7 % folds, *map(float, x), 1))
    return spark.createDataFrame(rows, "id long, label double, fold int, a double, b double, c double, z int").repartition(6)


def test_each_fold_has_rows_of_its_own(spark):
    df, feats = skewed(spark), ["a", "b", "c"]
    frames = S.FoldFrames(df, feats, "id")
    assert frames.folds == [0, 1, 2, 3]
    real = {r.id: r for r in df.collect()}
    for run in [S.ALL, *frames.folds]:
        train = frames.training(run).collect()
        kept = [r for r in train if r.id in real]
        made = [r for r in train if r.id not in real]
        assert sorted(r.id for r in kept) == sorted(i for i, r in real.items() if r.fold != run)
        minority, majority = sum(r.label for r in train), sum(r.label == 0 for r in train)
        assert made and all(r.label == 1.0 and r.id < 0 for r in made) and len({r.id for r in made}) == len(made)
        assert minority == math.floor(0.8 * majority)
        ones = np.array([[r.a, r.b, r.c] for r in kept if r.label == 1.0])
        for r in made[:40]:                              # on a line between two minority rows of the run
            x = np.array([r.a, r.b, r.c])
            d = ones - x
            gap = [np.linalg.norm(d[i]) + np.linalg.norm(d[j]) - np.linalg.norm(ones[i] - ones[j])
                   for i in range(len(ones)) for j in range(i)]
            assert min(gap) < 1e-9
        if run >= 0:
            scored = frames.scored(run).collect()
            assert sorted(r.id for r in scored) == sorted(i for i, r in real.items() if r.fold == run)


def test_runs_equal_a_search_of_their_own(spark):
    """What one search for all folds gives a run is what its training rows alone give."""
    df, feats = cut_lineage(skewed(spark, 300, 4, 2)), ["a", "b", "c"]
    every = cut_lineage(S.synthetic_rows(df, feats, "id", fold_col="fold", scale=False))
    for run in (0, 1):
        alone = S.synthetic_rows(df.filter(F.col("fold") != run), feats, "id", scale=False)
        parts = lambda d: sorted(r[0] for r in d.select("id").collect())
        assert parts(every.filter(F.col("run") == run)) == parts(alone)
    whole = S.synthetic_rows(df, feats, "id", scale=False)
    assert every.filter(F.col("run") == S.ALL).count() == whole.count()


def test_nothing_to_make(spark):
    df, feats = skewed(spark), ["a", "b", "c"]
    assert S.synthetic_rows(df.filter("label = 0"), feats, "id").count() == 0
    assert S.synthetic_rows(df.limit(0), feats, "id", fold_col="fold").count() == 0
    assert S.synthetic_rows(df, feats, "id", ratio=0.01).count() == 0
    far = df.withColumn("a", F.col("a") + F.col("label") * 1000)           # no row in danger
    assert S.synthetic_rows(far, feats, "id").count() == 0


def reference_pairs(m, names):
    out = {}
    for i in range(len(names)):
        for j in range(i + 1, len(names)):
            a, b = m[:, i], m[:, j]
            ok = ~np.isnan(a) & ~np.isnan(b)
            x, y = a[ok], b[ok]
            const = len(x) == 0 or x.std() == 0 or y.std() == 0
            out[tuple(sorted((names[i], names[j])))] = None if const else float(np.corrcoef(x, y)[0, 1])
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for k, r in want.items():
        assert (got[k] is None) if r is None else got[k] == pytest.approx(r, abs=2e-6), k


@pytest.mark.parametrize("piece", [256, 4])
def test_phi_against_numpy(spark, monkeypatch, piece):
    monkeypatch.setattr(P, "PIECE", piece)
    rng = np.random.default_rng(piece)
    m = (rng.random((150, 14)) < np.linspace(0, 1, 14)).astype(float)
    m[:, 4] = m[:, 9]
    m[:, 5] = 1 - m[:, 8]
    m[:, 3][rng.random(150) < 0.2] = np.nan
    m[:, 10][rng.random(150) < 0.5] = np.nan
    m[:, 12] = np.nan
    m[:, 2] = np.arange(150) % 2
    m[:, 1] = 1 - m[:, 2]                                # never meet, r = -1
    names = [f"x.{i}" for i in range(14)]
    df = spark.createDataFrame([[None if math.isnan(x) else int(x) for x in r] for r in m],
                               ", ".join(f"`{c}` int" for c in names)).repartition(4)
    want = reference_pairs(m, names)
    same({(r.var1, r.var2): r.r for r in P.phi_pairs(df, names).collect()}, want)
    for t in (0.3, 0.9):
        got = {(r.var1, r.var2): r.r for r in P.phi_pairs(df, names, t).collect()}
        same(got, {k: r for k, r in want.items() if r is not None and abs(r) > t + 1e-6})
    assert P.phi_pairs(df, names[:1]).count() == 0
    assert {r.r for r in P.phi_pairs(df.limit(0), names[:3]).collect()} == {None}
    with pytest.raises(ValueError):
        P.phi_pairs(df.selectExpr("`x.0`", "2 AS two"), ["x.0", "two"])


def test_phi_of_1555_flags(spark):
    rng = np.random.default_rng(6)
    d = 1555
    m = (rng.random((120, d)) < 0.02).astype(int)
    m[:, 7] = m[:, 1200]
    m[:, 30] = 1 - m[:, 31]
    m[5] = 1                                             # a row with every flag
    names = [f"f{i}" for i in range(d)]
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/phi-flags"
    spark.createDataFrame(m.tolist(), ", ".join(f"{c} int" for c in names)).write.mode("overwrite").parquet(path)
    got = {(r.var1, r.var2): r.r for r in P.phi_pairs(spark.read.parquet(path), names, 0.95).collect()}
    with np.errstate(invalid="ignore", divide="ignore"):
        c = np.corrcoef(m.T)
    i, j = np.where(np.triu(np.abs(np.nan_to_num(c)) > 0.95, 1))
    same(got, {tuple(sorted((names[a], names[b]))): c[a, b] for a, b in zip(i, j)})
