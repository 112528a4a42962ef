"""The neighbour search where one coordinate spreads far wider than another and rows lack either."""

import math

import numpy as np

from adlytics.operators import neighbours as N
from tests.test_neighbours import frame, ranked


def holed(n):
    """Lengths, word counts and their ratios, each missing in a quarter of the rows, with a few far rows."""
    rng = np.random.default_rng(11)
    rows = {}
    for i in range(n):
        words = round(math.exp(rng.normal(5, 1.2))) + 1
        ratio = 6 + rng.normal(0, 0.3)
        v = np.array([round(words * ratio), words, ratio if i % 97 else 4000.0 + i])
        if i % 4 < 3:
            v[i % 4] = np.nan
        rows[i] = v
    return rows


def search(spark, monkeypatch, rows, pairs, exclude=False, slots="missing"):
    class Counted(N.BlockSearch):
        def __call__(self, q, d):
            pairs.add(len(q) * len(d))
            return super().__call__(q, d)
    monkeypatch.setattr(N, "BlockSearch", Counted)
    df = frame(spark, rows, 3)
    return N.nearest(df, df, ["c0", "c1", "c2"], 5, "id", "id", exclude_self=exclude, slots=slots).collect()


def test_narrow_coordinates_have_cells_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(N, "CELL_ROWS", 64)
    monkeypatch.setattr(N, "REST_PAIRS", 2000)
    rows, pairs = holed(3000), spark.sparkContext.accumulator(0)
    got = {}
    for r in search(spark, monkeypatch, rows, pairs):
        got.setdefault((r.id, r.slot), []).append((r["rank"], r.id_donor))
    assert pairs.value < 3000 * 3000 / 4
    assert len(got) == 2250
    for i in range(0, 3000, 7):
        for j in np.flatnonzero(np.isnan(rows[i])):
            want = ranked(rows[i], rows, 5, lambda x, j=j: not np.isnan(rows[x][j]))
            assert [d for _, d in sorted(got[i, j])] == [d for _, d in want], i


def test_far_rows_reach_merged_cells(spark, monkeypatch):
    """Rows whose nearest are many cells away, and one that shares nothing with any other."""
    monkeypatch.setattr(N, "CELL_ROWS", 16)
    monkeypatch.setattr(N, "REST_PAIRS", 0)
    monkeypatch.setattr(N, "CELLS_EACH", 2)
    rng = np.random.default_rng(4)
    rows = {i: np.array([rng.normal(0, 1), np.nan, rng.normal(0, 50)]) for i in range(300)}
    rows |= {1000 + i: np.array([np.nan, rng.normal(0, 1), rng.normal(0, 50)]) for i in range(200)}
    rows[2000], rows[2001] = np.array([50.0, 1.0, 900.0]), np.array([np.nan, np.nan, np.nan])
    got = {}
    for r in search(spark, monkeypatch, rows, spark.sparkContext.accumulator(0), exclude=True, slots=None):
        got.setdefault(r.id, []).append((r["rank"], r.id_donor))
    assert 2001 not in got
    for i, v in rows.items():
        assert [d for _, d in sorted(got.get(i, []))] == [d for _, d in ranked(v, rows, 5, lambda x, i=i: x != i)], i
