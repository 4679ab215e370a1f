"""Gradient descent of row 50 against the same solver in NumPy."""

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector, Vectors

from shelfscore.operators import models


def numpy_descent(x, y, rounds=100, step=1.0, tolerance=0.001):
    w = np.zeros(x.shape[1])
    for t in range(1, rounds + 1):
        moved = w - step / np.sqrt(t) * (x.T @ (x @ w - y)) / len(y)
        change, size = np.linalg.norm(moved - w), np.linalg.norm(moved)
        w = moved
        if t > 1 and change < tolerance * max(size, 1.0):
            break
    return w


@pytest.mark.parametrize("dense", [True, False])
def test_descent_equals_numpy(spark, dense):
    rng = np.random.default_rng(5)
    x = rng.random((300, 6)) * (rng.random((300, 6)) < 0.5)
    y = x @ np.array([0.5, -1.0, 2.0, 0.0, 1.5, 0.3]) + rng.normal(0, 0.1, 300)
    vector = (lambda r: Vectors.dense(r)) if dense else (lambda r: SparseVector(6, {k: v for k, v in enumerate(r) if v}))
    df = spark.createDataFrame([(float(b), vector(a)) for a, b in zip(x.tolist(), y.tolist())], ["label", "features"])
    assert models.gradient_descent(df, 6) == pytest.approx(numpy_descent(x, y).tolist(), rel=1e-9, abs=1e-12)


def test_no_examples_give_zero_weights(spark):
    df = spark.createDataFrame([(1.0, Vectors.dense([1.0, 2.0]))], ["label", "features"]).limit(0)
    assert models.gradient_descent(df, 2) == [0.0, 0.0]
