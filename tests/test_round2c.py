"""Partial autocorrelations, decomposition ends, density grid."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import cluster as C
from tessera.operators import describe as D
from tessera.operators import timeseries as T


def _series(spark, values, name="s"):
    rows = [(name, "2024-01-01", i, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series_id string, d string, k int, close double") \
        .select("series_id", F.expr("date_add(to_date(d), k)").alias("ds"), "close")


def test_pacf_solves_the_yule_walker_equations(spark):
    rng = np.random.default_rng(5)
    x = [0.0, 0.0]
    for e in rng.normal(size=400):
        x.append(0.6 * x[-1] - 0.3 * x[-2] + e)
    both = _series(spark, x).unionByName(_series(spark, rng.normal(size=50), "noise"))
    a = T.acf(both, 12)
    r = [v.acf for v in a.filter("series_id = 's'").orderBy("lag").collect()]
    got = {v.lag: v.pacf for v in T.pacf(a).filter("series_id = 's'").collect()}
    assert got[0] == 1.0 and sorted(got) == list(range(13)) and T.pacf(a).count() == 26
    for k in range(1, 13):
        m = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        assert got[k] == pytest.approx(np.linalg.solve(m, np.array(r[1:k + 1]))[-1], abs=1e-9)


def test_extended_trend_follows_the_line(spark):
    s = _series(spark, [3.0 + 2.0 * i for i in range(30)])
    cut = T.seasonal_decompose(s, 5)
    full = T.seasonal_decompose(s, 5, extend=True)
    assert cut.filter("trend IS NULL").count() == 4 and full.filter("trend IS NULL OR resid IS NULL").count() == 0
    assert full.filter("abs(trend - close) > 1e-9 OR abs(seasonal) > 1e-9").count() == 0
    assert T.seasonal_decompose(_series(spark, [1.0, 2.0, 3.0]), 5, extend=True).filter("trend IS NULL").count() == 3


def test_density_equals_the_sum_of_kernels(spark):
    v = np.array([1.0, 2.0, 2.0, 5.0, 9.0])
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double")
    h = v.std(ddof=1) * len(v) ** -0.2
    for r in D.kde(df, "v", 9).collect():
        want = np.exp(-0.5 * ((r.x - v) / h) ** 2).sum() / (len(v) * h * np.sqrt(2 * np.pi))
        assert r.x == 1.0 + r.g and r.density == pytest.approx(want)


def test_kmeans_restarts_find_the_blobs(spark):
    rng = np.random.default_rng(2)
    centres = [(-9.0, 0.0), (0.0, 9.0), (9.0, 0.0)]
    rows = [(i, *map(float, np.array(centres[i % 3]) + rng.normal(0, 0.2, 2))) for i in range(90)] + [(90, None, 1.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    lab, found, cost = C.kmeans_best(df, ["x", "y"], 3, n_init=10)
    assert np.allclose(found, centres, atol=0.3) and cost < 20
    assert {(r["id"] % 3, r["cluster"]) for r in lab.collect()} == {(0, 0), (1, 1), (2, 2)}
    again = C.kmeans_best(df.repartition(1), ["x", "y"], 3, n_init=10)[2]
    assert again == pytest.approx(cost)
