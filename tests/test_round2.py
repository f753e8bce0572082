"""Seeds, bootstrap rules, array imputation, feature filter, sources."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.hashing import row_hash, row_hash_sql, row_uniform
from tessera.operators import evaluate as E
from tessera.operators import models as M
from tessera.operators import quality as Q
from tessera.operators import stats as S
from tessera.operators import text as X
from tessera.operators import timeseries as T


def test_seeds_give_unrelated_splits(spark):
    ids = spark.range(20_000)
    drawn = {s: {r[0] for r in ids.where(row_uniform("id", s) < 0.2).collect()} for s in (1, 2, 3)}
    for s in drawn.values():
        assert abs(len(s) / 20_000 - 0.2) < 0.01
    for a, b in ((1, 2), (1, 3), (2, 3)):
        assert abs(len(drawn[a] & drawn[b]) / 20_000 - 0.04) < 0.006


def test_row_hash_equals_its_sql(spark):
    import duckdb
    got = [r[0] for r in spark.range(50).orderBy("id").select(row_hash("id", 9)).collect()]
    want = duckdb.sql(f"SELECT {row_hash_sql('range', 9)} FROM range(50) ORDER BY range").fetchall()
    assert got == [w[0] for w in want]


def test_permutation_moves_rows_and_finds_the_driver(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=600), rng.normal(size=600)
    df = spark.createDataFrame([(i, float(x), float(z), float(5 * x + 0.1 * z)) for i, (x, z) in enumerate(zip(a, b))],
                               "id long, a double, b double, y double")
    scaled, _, _ = M.scaled_features(df, [], ["a", "b"])
    n, std = scaled.agg(F.count(F.lit(1)), F.stddev_pop("y")).first()
    model = M.ridge("features", "y", 0.1, n, std).fit(scaled)
    rise = {r["feature"]: r["importance_mean"]
            for r in M.permutation_importance(model, scaled, ["a", "b"], "y", "id", repeats=2).collect()}
    assert rise["a"] > 3 and rise["a"] > 10 * abs(rise["b"])


def test_rmse_bootstrap_is_two_sided_and_symmetric(spark):
    rng = np.random.default_rng(4)
    y = rng.normal(size=300)
    rows = [(i, float(v), float(v + e), float(v + f)) for i, (v, e, f) in
            enumerate(zip(y, rng.normal(size=300), rng.normal(0, 1.05, 300)))]
    df = spark.createDataFrame(rows, "id long, y double, a double, b double")
    ab, ba = E.paired_bootstrap_rmse(df, "y", "a", "b", 400), E.paired_bootstrap_rmse(df, "y", "b", "a", 400)
    assert ab["p_value"] == pytest.approx(ba["p_value"]) and ab["significant"] == ba["significant"]
    assert ab["observed_diff"] == pytest.approx(ab["rmse_a"] - ab["rmse_b"]) == pytest.approx(-ba["observed_diff"])


@pytest.mark.parametrize("metric", ["accuracy", "balanced_accuracy"])
def test_f1_bootstrap_takes_other_metrics(spark, metric):
    rows = [("x", "x", "x")] * 30 + [("x", "x", "z")] * 20 + [("z", "z", "z")] * 20 + [("z", "x", "x")] * 10
    df = spark.createDataFrame(rows, "t string, a string, b string")
    res = E.paired_bootstrap_f1(df, "t", "a", "b", n_boot=300, metric=metric)
    assert res["observed_diff"] == pytest.approx({"accuracy": 20 / 80, "balanced_accuracy": (20 / 50) / 2}[metric])
    assert res["significant"] == (res["p_value"] < 0.05)


def test_array_imputation_keeps_every_row(spark):
    nan = float("nan")
    train = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, nan]), (3, None), (4, [])], "id long, v array<double>")
    test = spark.createDataFrame([(5, [None, nan]), (6, None)], "id long, v array<double>")
    a, b = Q.impute_array_mean(train, test, "v")
    assert {r["id"]: r["v"] for r in a.collect()} == {1: [1.0, 2.0], 2: [3.0, 2.0], 3: None, 4: []}
    assert {r["id"]: r["v"] for r in b.collect()} == {5: [2.0, 2.0], 6: None}


def test_feature_at_the_threshold_is_dropped(spark):
    """Orthogonal features have correlation 0: dropped at threshold 0, kept above."""
    df = spark.createDataFrame([(1.0, 1.0, 3.0), (1.0, -1.0, 1.0), (-1.0, 1.0, -1.0), (-1.0, -1.0, -3.0)],
                               "a double, b double, y double")
    kept = lambda t: [r["kept"] for r in S.greedy_decorrelate(df, ["a", "b"], "y", t).orderBy("order_by_target").collect()]
    assert kept(0.0) == [True, False] and kept(0.1) == [True, True]


def test_feature_columns_follow_the_specification(spark):
    names = T.feature_columns(lags=(1, 3), windows=(2,))
    assert names[:4] == ["lag_1", "lag_3", "roll_mean_2", "roll_std_2"] and len(names) == len(set(names)) == 10


def test_building_postings_runs_no_job(spark):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    docs = spark.range(10).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"))
    X.postings(docs.groupBy("text").agg(F.min("doc_id").alias("doc_id")), "doc_id", "text")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_csv_and_parquet_round_trip(spark, tmp_path):
    rows = [(1, "a", 2.5), (2, None, None), (3, "ü,\"q\"", -1.0)]
    df = spark.createDataFrame(rows, "id long, s string, x double")
    for fmt in ("csv", "parquet", "json"):
        path = str(tmp_path / fmt)
        options = {"header": "true", "escape": '"'} if fmt == "csv" else {}
        df.write.format(fmt).options(**options).save(path)
        back = spark.read.schema(df.schema).format(fmt).options(**options).load(path)
        assert sorted(map(tuple, back.collect())) == rows
