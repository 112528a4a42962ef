"""Random Fourier features without an object per row."""

import tracemalloc

import numpy as np
import pyarrow as pa

from adlytics.operators.kernel import directions, fourier


def test_features_without_an_object_per_row():
    rows, width, n = 10000, 40, 256
    w, b = directions(width, n, 0.1, 42)
    x = np.random.default_rng(1).normal(size=(rows, width))
    column = pa.ListArray.from_arrays(pa.array(np.arange(0, rows * width + 1, width, dtype=np.int32)), pa.array(x.ravel()))
    tracemalloc.start()
    out = fourier(column, w, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.3 * rows * n * 8
    assert np.array_equal(out.flatten().to_numpy().reshape(rows, n), np.sqrt(2.0 / n) * np.cos(x @ w.T + b))
    assert len(fourier(column.slice(0, 0), w, b)) == 0
