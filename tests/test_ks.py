"""Exact small-sample p-values of the two-sample Kolmogorov-Smirnov test."""

import itertools
import random

import pytest

from adlytics.operators import missing as M


def enumerated(n_a, n_b):
    """{gap: share of all orders of the pooled sample with max |i n_b - j n_a| >= gap}."""
    top = []
    for pick in itertools.combinations(range(n_a + n_b), n_a):
        i = j = worst = 0
        chosen = set(pick)
        for x in range(n_a + n_b):
            i, j = (i + 1, j) if x in chosen else (i, j + 1)
            worst = max(worst, abs(i * n_b - j * n_a))
        top.append(worst)
    return {g: sum(t >= g for t in top) / len(top) for g in set(top)}


@pytest.mark.parametrize("n_a, n_b", [(1, 1), (2, 3), (4, 4), (5, 7), (8, 3), (8, 8)])
def test_recursion_equals_enumeration(n_a, n_b):
    for gap, p in enumerated(n_a, n_b).items():
        assert M.ks_exact_p(n_a, n_b, gap) == pytest.approx(p, abs=1e-12)


def test_small_samples_are_exact_and_large_ones_asymptotic(spark):
    rnd = random.Random(4)
    a, b = [rnd.random() for _ in range(7)], [rnd.random() * 2 for _ in range(8)]
    gap = max(abs(sum(x <= v for x in a) * 8 - sum(x <= v for x in b) * 7) for v in a + b)
    da, db = (spark.createDataFrame([(x, y) for x, y in zip(s, t)], "small double, large double")
              for s, t in ((a + [None] * 193, [rnd.random() for _ in range(200)]), (b + [None] * 192, [rnd.random() for _ in range(200)])))
    got = {r.column: r for r in M.ks_two_sample(da, db, ["small", "large"]).collect()}
    assert (got["small"].n_a, got["small"].n_b) == (7, 8)
    assert got["small"].p_value == pytest.approx(enumerated(7, 8)[gap], abs=1e-6)
    assert 0 <= got["large"].p_value <= 1 and got["large"].d < 0.3
