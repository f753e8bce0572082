"""Shared-pass ridge search, permutations, missing features, ranks on crowded values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.ranks import exact_quantiles
from tessera.operators import evaluate as E
from tessera.operators import models as M
from tessera.operators import stats as S


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(240, 2)) * [1.0, 30.0] + [5.0, -100.0]
    y = 3 * x[:, 0] - 0.2 * x[:, 1] + rng.normal(size=240)
    return spark.createDataFrame([(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))],
                                 "id long, a double, b double, y double")


def test_ridge_search_equals_fitting_every_fold(spark, rows):
    alphas = [0.0, 25.0]
    want = {r["model"]: r for r in M.cv_summary(M.cross_validate(
        rows, ["a", "b"], lambda n, s: {str(v): M.ridge("features", "y", v, n, s) for v in alphas}, k=3)).collect()}
    for alpha, rmse, std, r2 in M.ridge_cv(rows, ["a", "b"], alphas, k=3):
        w = want[str(alpha)]
        assert (rmse, std, r2) == pytest.approx((w["rmse_mean"], w["rmse_std"], w["r2_mean"]), rel=1e-6)


def test_random_search_keeps_every_trial(spark, rows):
    found = M.random_search(rows, ["a", "b"], "y", "id", n_trials=6, k=3, gbt_trials=1, gbt_rounds=2)
    assert {r["family"]: r["n"] for r in found.groupBy("family").agg(F.count("*").alias("n")).collect()} == {"ridge": 6, "gbt": 1}
    best = {r["family"]: r["cv_rmse"] for r in M.select_best(found).collect()}
    assert best["ridge"] < 1.3 < best["gbt"]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 999, 1000])
def test_shuffles_are_permutations_that_move_rows(n):
    for a, b in M._shuffles(n, 30, 5):
        to = [(a * i + b) % n for i in range(n)]
        assert sorted(to) == list(range(n))
        if n > 2:
            assert sum(i == j for i, j in enumerate(to)) <= max(2, n // 100)


def test_missing_features_take_the_training_mean(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 4.0), (3, None, 6.0), (4, float("nan"), 8.0)],
                               "id long, a double, y double")
    out, _, params = M.scaled_features(df, [], ["a"])
    assert params["a"]["mean"] == 2.0
    assert {r["id"]: r["features"][0] for r in out.collect()} == {1: -1.0, 2: 1.0, 3: 0.0, 4: 0.0}


def _average_ranks(v):
    s = np.sort(v)
    return (np.searchsorted(s, v, "left") + np.searchsorted(s, v, "right") + 1) / 2


def test_spearman_and_auc_with_a_third_of_the_rows_on_one_value(spark):
    rng = np.random.default_rng(2)
    x = np.where(rng.random(300) < 0.34, 0.0, rng.normal(size=300))
    y = np.round(x + rng.normal(size=300), 1)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id long, x double, y double")
    got = S.spearman(df, "x", "y", "id").first()
    assert got["n"] == 300 and got["r"] == pytest.approx(np.corrcoef(_average_ranks(x), _average_ranks(y))[0, 1])
    pos = y > 0.5
    auc = (_average_ranks(x)[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    scored = df.select(F.when(F.col("y") > 0.5, "p").otherwise("n").alias("truth"), "x")
    assert E.roc_auc_ovr(scored, "truth", {"p": "x"}).first()["auc"] == pytest.approx(auc)


def test_quantiles_skip_nan_and_leave_nothing_cached(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, float("nan"), 3.0, None)], "v double")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    assert exact_quantiles(df, "v", [0.0, 0.5, 0.75, 1.0]).first()["q"] == [1.0, 2.0, 2.5, 3.0]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
