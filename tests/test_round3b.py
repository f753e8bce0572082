"""Boosted classifier, the choice of a model per horizon, plot data from counts
and the normal quantile, against hand checks and brute force."""

import math
import random
from datetime import date, timedelta
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.normal import norm_ppf
from tessera.operators import describe as D
from tessera.operators import forecast as FC
from tessera.operators import models as M


def test_bins_count_the_cuts_below(spark):
    rows = [(i, [float(i), 5.0, float(i % 3)]) for i in range(100)] + [(100, [None, float("nan"), 9.0])]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    cuts = M.fit_bins(df.filter("id < 100"), "v", bins=8)
    assert len(cuts) == 3 and all(c == sorted(set(c)) for c in cuts) and cuts[1] == [5.0]
    got = {r["id"]: list(r["features"]) for r in M.binned(df, "v", cuts).collect()}
    for i, v in rows:
        want = [sum(e < x for e in c) if x is not None and x == x else 0 for x, c in zip(v, cuts)]
        assert got[i] == want


def test_boosting_separates_blobs_no_single_line_can(spark):
    rng = np.random.default_rng(3)
    centres = {0: [(0, 0), (6, 6)], 1: [(0, 6), (6, 0)], 2: [(3, 12)]}         # classes 0 and 1 are crossed
    rows = [(k, [float(x) for x in rng.normal(c, 0.5)]) for k, cs in centres.items() for c in cs for _ in range(40)]
    df = spark.createDataFrame(rows, "label int, v array<double>").coalesce(1)
    data = M.binned(df, "v", M.fit_bins(df, "v")).cache()
    model = M.boosted_classifier(data, "label", rounds=10, depth=3, at_once=3)
    p = model.transform(data).select((F.col("label") == F.col("prediction")).cast("double").alias("ok")).agg(F.avg("ok")).first()[0]
    assert p > 0.97 and len(model.models) == 3


def series(names, n):
    rnd = random.Random(6)
    start = date(2024, 1, 1)
    rows = []
    for s, name in enumerate(names):
        for t in range(n):
            rows.append((name, start + timedelta(days=t), 100.0 + 10 * s + 0.5 * t + 5 * math.sin(t / 4) + rnd.gauss(0, 0.3), 10 + t % 7))
    return rows


def test_family_is_chosen_on_rows_before_the_hold_out(spark):
    from pyspark.ml.regression import LinearRegression
    from tessera.operators.models import ridge
    from tessera.operators.timeseries import walk_forward_frame
    schema = "series_id string, ds date, close double, volume int"
    df = spark.createDataFrame(series(["a", "b"], 120), schema).coalesce(1)
    seen = []

    def spy(y, n, sd):
        seen.append((y, n))
        return ridge("features", y, 0.1, n, sd)
    flat = lambda y, n, sd: LinearRegression(featuresCol="features", labelCol=y, predictionCol="y_pred", regParam=1e9, elasticNetParam=1.0)
    cols = ["lag_1", "lag_2", "lag_5", "return_1"]
    scores, chosen, preds = FC.choose_per_horizon(df, cols, n_test=20, n_val=15, horizons=(1, 3), families={"flat": flat, "line": spy})
    assert {(r["horizon"], r["family"]) for r in scores.collect()} == {(h, f) for h in (1, 3) for f in ("flat", "line")}
    assert all(r["n_obs"] == 30 for r in scores.collect())                      # 15 rows of each series
    assert {r["horizon"]: r["family"] for r in chosen.collect()} == {1: "line", 3: "line"}
    # lag 5 is there from position 5 on; positions 0 ... 99 are training
    for h in (1, 3):
        fits = sorted(n for y, n in seen if y == f"target_h{h}")
        assert fits == [2 * (100 - h - 15 - h - 5), 2 * (100 - h - 5)]
    got = {(r["series_id"], r["origin_date"], r["horizon"]): (r["target_date"], round(r["y_true"], 9)) for r in preds.collect()}
    want = {(r["series_id"], r["origin_date"], r["horizon"]): (r["target_date"], round(r["y_true"], 9))
            for r in walk_forward_frame(df, 20, horizons=(1, 3)).collect()}
    assert got == want and {r["model"] for r in preds.collect()} == {"ml_line"}
    # what lies in the hold-out changes neither the scores nor the fits
    other = spark.createDataFrame([(s, d, c * 7 if d >= date(2024, 1, 1) + timedelta(days=100) else c, v)
                                   for s, d, c, v in series(["a", "b"], 120)], schema).coalesce(1)
    again, _, _ = FC.choose_per_horizon(other, cols, n_test=20, n_val=15, horizons=(1, 3), families={"flat": flat, "line": spy})
    a, b = ({(r["horizon"], r["family"]): r["mape"] for r in t.collect()} for t in (scores, again))
    assert a == pytest.approx(b)


def test_binned_density_stays_within_its_bound(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 1, 300), rng.normal(6, 0.5, 200), [6.0] * 50])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "x double")
    h = x.std(ddof=1) * len(x) ** -0.2
    for bins in (50, 2000):
        got = D.kde_binned(df, "x", 40, bins).orderBy("g").collect()
        grid = np.linspace(x.min(), x.max(), 40)
        exact = np.exp(-0.5 * ((grid[:, None] - x[None]) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
        bound = ((x.max() - x.min()) / bins) ** 2 / (8 * h ** 3 * math.sqrt(2 * math.pi))
        assert np.abs(np.array([r["density"] for r in got]) - exact).max() <= bound + 1e-12
        assert np.allclose([r["x"] for r in got], grid)
    assert D.kde_binned(df.where("x = 6"), "x").count() == 0 and D.kde_binned(df.where("1 = 0"), "x").count() == 0


def test_all_pairs_of_bins(spark):
    rnd = random.Random(1)
    rows = [(rnd.uniform(0, 9), rnd.gauss(0, 1), 3.0) for _ in range(200)] + [(None, 0.5, 3.0), (2.0, float("nan"), 3.0)]
    cols = ["p", "q", "same"]
    got = {tuple(r)[:4]: r["count"] for r in D.binned_pairs(spark.createDataFrame(rows, "p double, q double, same double"), cols, 6).collect()}
    good = lambda v: v is not None and v == v
    want = {}
    ends = [(min(r[i] for r in rows if good(r[i])), max(r[i] for r in rows if good(r[i]))) for i in range(3)]
    spot = lambda i, v: min(math.floor((v - ends[i][0]) / ((ends[i][1] - ends[i][0]) / 6 or 1.0)), 5)
    for r in rows:
        for i in range(3):
            for j in range(i, 3):
                if good(r[i]) and good(r[j]):
                    k = (cols[i], cols[j], spot(i, r[i]), spot(j, r[j]))
                    want[k] = want.get(k, 0) + 1
    assert got == want


def test_normal_quantile_is_exact_to_many_digits(spark):
    p = [1e-300, 1e-20, 1e-12, 1e-6, 0.01, 0.0749, 0.075, 0.3, 0.5, 0.7, 0.925, 0.99, 1 - 1e-6, 1 - 1e-12]
    rows = spark.createDataFrame([(v,) for v in p + [0.0, 1.0, -1.0, None]], "p double").select("p", norm_ppf("p").alias("z")).collect()
    for r in rows:
        if r["p"] is None or not 0 < r["p"] < 1:
            assert r["z"] is None
        else:
            assert r["z"] == pytest.approx(NormalDist().inv_cdf(r["p"]), rel=1e-12, abs=1e-14)


def test_nan_counts_as_missing(spark):
    from tessera.operators import stats as S
    rnd = random.Random(9)
    rows = [(i, rnd.gauss(0, 1), rnd.gauss(0, 1), "ab"[i % 2]) for i in range(60)]
    schema = "id int, x double, y double, g string"
    clean = spark.createDataFrame(rows, schema)
    nan = float("nan")
    with_nan = clean.unionByName(spark.createDataFrame([(100, nan, None, "a"), (101, None, nan, "b"), (102, nan, nan, "a")], schema))
    flat = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())
    for f in (lambda d: D.describe_numeric(d, ["x", "y"]), lambda d: S.pearson(d, "x", "y"), lambda d: S.spearman(d, "x", "y", "id"),
              lambda d: S.correlation_pairs(d, ["x", "y"]), lambda d: S.correlation_pairs(d, ["x", "y"], "spearman", "id"),
              lambda d: S.target_correlations(d, ["x"], "y"), lambda d: S.shape_stats(d, ["x", "y"]),
              lambda d: S.anova_oneway(d, "g", ["x", "y"]).select("metric", "N", "k", "f_stat"), lambda d: S.kruskal_wallis(d, "g", ["x", "y"]),
              lambda d: S.zscore_outliers(d, ["x", "y"])):
        assert flat(f(clean)) == flat(f(with_nan))


def test_drift_is_judged_against_the_saved_earlier_period(spark, tmp_path):
    from datetime import datetime
    from tessera.streaming import monitor as O
    day = lambda k, h=12: datetime(2024, 1, 1, h) + timedelta(days=k)
    rows, n = [], 0
    for k in range(50):
        for kind in ["view"] * 4 + (["click"] * 4 if k < 10 else ["error"] * 4):      # the mix turns after day 10
            rows.append((n, day(k), 1, kind, 0.8 if k < 10 else 0.3, None))
            n += 1
    rows.append((n, day(20), 1, "unknown", 0.8, None))
    ev = spark.createDataFrame(rows, O.EVENT_SCHEMA)
    src = str(tmp_path / "in")
    ev.coalesce(1).write.parquet(src)
    path = str(tmp_path / "baseline")
    O.store_baseline(ev, datetime(2024, 1, 11), path)
    base = O.load_baseline(spark, path)
    assert base["view"] == base["click"] == 0.5 and base["error"] == base["other"] == 0 and base["scale"] == 0.8
    closed = O.run_day_stream(spark, src, base, str(tmp_path / "state"))
    whole = {r["day"]: r["n"] for r in O.day_counts(ev, base, watermark=None).collect()}
    got = {r["day"]: r["n"] for r in closed.collect()}
    assert len(whole) == 40 and min(whole) == datetime(2024, 1, 11) and set(whole) - set(got) <= {day(48, 0), day(49, 0)}
    assert all(whole[k] == v for k, v in got.items())
    out = {(r["period"], r["start"]): r for r in O.period_drift(O.day_counts(ev, base, watermark=None), base).collect()}
    first = out["week", datetime(2024, 1, 8)]
    assert first["n"] == 4 * 8 and first["mix_drift"] == 0.5 and first["correction_rate"] == 0.5 and first["coverage"] == 0
    month = out["month", datetime(2024, 1, 1)]
    assert month["n"] == 21 * 8 + 1 and month["share_other"] == 1 / 169 and month["coverage"] == 1 / 169
    assert {k[0] for k in out} == {"week", "month"} and ("month", datetime(2024, 2, 1)) in out


def test_spearman_matrix_with_hot_values_missing_and_repeated_rows(spark):
    """Against ranks over each column's own non-missing rows, joined pair by pair."""
    from tessera.operators import stats as S
    rng = np.random.default_rng(5)
    x = np.where(rng.random(400) < 0.34, 0.0, np.round(rng.normal(size=400), 1))
    y = np.round(x + rng.normal(size=400), 1)
    z = np.where(rng.random(400) < 0.2, np.nan, -y + np.round(rng.normal(size=400), 1))
    rows = [(float(a), float(b), float(c), 1.0) for a, b, c in zip(x, y, z)]
    rows += rows[:100]                                                         # repeated rows count again
    df = spark.createDataFrame(rows, "x double, y double, z double, flat double").repartition(4)
    v = np.array(rows)

    def ranks(c):
        have = ~np.isnan(c)
        s = np.sort(c[have])
        out = np.full(len(c), np.nan)
        out[have] = (np.searchsorted(s, c[have], "left") + np.searchsorted(s, c[have], "right") + 1) / 2
        return out

    r = {n: ranks(v[:, i]) for i, n in enumerate(["x", "y", "z", "flat"])}
    got = {(t["col_a"], t["col_b"]): t["r"] for t in S.correlation_pairs(df, ["x", "y", "z", "flat"], "spearman").collect()}
    assert len(got) == 6
    for (a, b), value in got.items():
        both = ~np.isnan(r[a]) & ~np.isnan(r[b])
        if "flat" in (a, b):
            assert value is None
        else:
            assert value == pytest.approx(np.corrcoef(r[a][both], r[b][both])[0, 1], abs=1e-12)
    assert [t["r"] for t in S.correlation_pairs(df.where("1 = 0"), ["x", "y"], "spearman").collect()] == [None]
