"""Statistics against closed forms, pandas conventions and known tail values."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tessera.functions import distributions as D
from tessera.functions.ranks import value_ranks
from tessera.operators import cluster as C
from tessera.operators import models as M
from tessera.operators import stats as S


def test_tail_probabilities():
    assert abs(D.chi2_sf(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(D.t_sf_two_sided(2.228138851986274, 10) - 0.05) < 1e-9
    assert abs(D.f_sf(4.102821015130399, 2, 10) - 0.05) < 1e-9
    assert abs(D.norm_ppf(0.975) - 1.959963984540054) < 1e-12


def test_average_ranks_match_pandas(spark):
    rnd = random.Random(1)
    vals = [float(rnd.randint(0, 30)) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r.x: r.avg_rank for r in value_ranks(df, "x", buckets=5).collect()}
    ref = pd.Series(vals).rank(method="average")
    assert all(abs(got[v] - r) < 1e-9 for v, r in zip(vals, ref))


def test_kruskal_and_anova_against_formulas(spark):
    rnd = random.Random(2)
    rows = [(g, float(rnd.randint(0, 20) + 3 * i)) for i, g in enumerate("abc") for _ in range(30)]
    df = spark.createDataFrame(rows, "g string, x double")
    pdf = pd.DataFrame(rows, columns=["g", "x"])
    r = pdf.x.rank()
    n = len(pdf)
    h = 12 / (n * (n + 1)) * sum(r[pdf.g == g].sum() ** 2 / (pdf.g == g).sum() for g in "abc") - 3 * (n + 1)
    ties = pdf.x.value_counts()
    h /= 1 - ((ties ** 3 - ties).sum()) / (n ** 3 - n)
    assert abs(S.kruskal_wallis(df, "g", ["x"]).first().h_stat - h) < 1e-9
    grand = pdf.x.mean()
    ssb = sum(len(v) * (v.mean() - grand) ** 2 for _, v in pdf.groupby("g").x)
    ssw = sum(((v - v.mean()) ** 2).sum() for _, v in pdf.groupby("g").x)
    f = (ssb / 2) / (ssw / (n - 3))
    assert abs(S.anova_oneway(df, "g", ["x"]).first().f_stat - f) < 1e-9


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(200, 3))
    y = X @ np.array([1.5, -2.0, 0.5]) + 3 + rng.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(X, y)],
                               "a double, b double, c double, y double")
    from pyspark.ml.feature import VectorAssembler
    data = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    alpha = 10.0
    model = M.ridge("features", "y", alpha, 200, float(np.std(y))).fit(data)
    Xc, yc = X - X.mean(0), y - y.mean()
    beta = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(3), Xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), beta, atol=1e-6)


def test_pca_sign_and_ratio(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 1))
    X = np.hstack([base * 3, -base * 2 + rng.normal(scale=0.1, size=(300, 1)), rng.normal(size=(300, 1))])
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], "a double, b double, c double")
    model = C.fit_pca(df, ["a", "b", "c"], k=2)
    comp = model["components"][:, 0]
    assert comp[np.argmax(np.abs(comp))] > 0
    ev = np.sort(np.linalg.eigvalsh(np.cov(X.T)))[::-1]
    assert np.allclose(model["ratio"], ev / ev.sum())


def test_skew_kurtosis_biased(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "x double")
    r = S.shape_stats(df, ["x"]).first()
    x = np.array([1, 2, 4, 10.0])
    m2 = ((x - x.mean()) ** 2).mean()
    assert abs(r.skew - ((x - x.mean()) ** 3).mean() / m2 ** 1.5) < 1e-12
    assert abs(r.kurt - (((x - x.mean()) ** 4).mean() / m2 ** 2 - 3)) < 1e-12
