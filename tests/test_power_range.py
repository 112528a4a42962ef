"""Power fits whose likelihood peaks outside the first grid."""

import numpy as np
import pytest

from adlytics.operators import transform as TR


@pytest.mark.parametrize("method, power", [("box-cox", 6), ("box-cox", -7), ("yeo-johnson", -9)])
def test_lambda_outside_the_first_grid(spark, method, power):
    z = np.random.default_rng(1).normal(30, 3, 2000)
    x = (z / 30) ** (1 / power) * 3 - (1 if method == "yeo-johnson" else 0)
    df = spark.createDataFrame([(float(v), float(v) * 0 + 2) for v in x], "x double, same double")
    lam = TR.fit_power(df, ["x", "same"], method, standardize=False)["x"].lmbda
    y = x + 1 if method == "yeo-johnson" else x

    def ll(lam):
        return -len(y) / 2 * np.log(((y ** lam - 1) / lam).var()) + (lam - 1) * np.log(y).sum()
    grid = np.linspace(-20, 20, 4000)
    want = grid[np.argmax([ll(v) for v in grid])]
    assert abs(want) > 2.5 and abs(lam - want) < 0.02
