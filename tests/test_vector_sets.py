"""Embedding sets compared by one linear classifier (X-08)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import models as M


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(8)
    y = rng.integers(0, 3, 240)
    near = np.eye(3)[y] * 4 + rng.normal(size=(240, 3))
    noise = rng.normal(size=(240, 5))
    return y, near, noise


def frames(spark, data):
    y, near, noise = data
    rows = spark.createDataFrame([(i, "abc"[k], "test" if i % 4 == 0 else "train") for i, k in enumerate(y)] + [(900, None, "train")],
                                 "id int, label string, split string")
    vectors = lambda a: spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(a)], "id int, v array<float>")
    return rows, {"near": vectors(near), "noise": vectors(noise)}


def test_the_set_that_tells_the_classes_apart_wins(spark, data):
    rows, sets = frames(spark, data)
    got = M.compare_vector_sets(sets, rows, "id", "label", "v").collect()
    assert [r["representation"] for r in got] == ["near", "noise"] and [r["dims"] for r in got] == [3, 5]
    assert all((r["n_train"], r["n_test"]) == (180, 60) for r in got)
    assert got[0]["f1_macro"] > 0.9 > 0.6 > got[1]["f1_macro"]


def test_the_penalised_objective_has_no_gradient_at_the_fit(spark, data):
    y, near, _ = data
    df = spark.createDataFrame([(int(k), [float(x) for x in v]) for k, v in zip(y, near)], "y int, v array<double>")
    model = M.linear_vector_classifier(df, "v", "y", C=0.5)
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    z = near @ w.T + b
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    gap = (p - np.eye(3)[y])
    assert np.abs(0.5 * gap.T @ near + w).max() < 1e-2 and np.abs(gap.sum(0)).max() < 1e-2


def test_a_row_without_a_vector_is_an_error(spark, data):
    rows, sets = frames(spark, data)
    with pytest.raises(ValueError):
        M.compare_vector_sets({"short": sets["near"].where(F.col("id") < 100)}, rows, "id", "label", "v")
