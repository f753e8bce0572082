"""Boosted trials over cells (F6, F7): the errors of Spark's own fits, without them."""

import math
import random

import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tessera.operators import boosting as B
from tessera.operators import models as M
from tessera.plans import q_models as Q


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(4)
    out = []
    for i in range(3000):
        a, b, c = rnd.random(), round(rnd.gauss(0, 1), 1), float(rnd.randint(0, 3))
        out.append((i, a if i % 17 else None, b if i % 23 else float("nan"), c, 100 * (math.sin(6 * a) + b * c + rnd.gauss(0, 0.1))))
    return spark.createDataFrame(out, "id int, a double, b double, c double, y double").repartition(3)


def by_spark(df, cols, steps, rounds, k=2):
    gbt = lambda n, s: {f"gbt|step={v:.4g}": GBTRegressor(featuresCol="features", labelCol="y", predictionCol="y_pred", maxIter=rounds,
                                                          maxDepth=3, stepSize=v, seed=42) for v in steps}
    return {r["model"]: (r["rmse_mean"], r["rmse_std"], r["r2_mean"])
            for r in M.cv_summary(M.cross_validate(df, cols, gbt, "y", "id", k, 42)).collect()}


def test_f6_scores_equal_spark_fits(rows):
    want = by_spark(rows, ["a", "b", "c"], [0.05, 0.4], 5)
    got = B.boosted_scores(rows, ["a", "b", "c"], "y", "id", [0.05, 0.4], 5, 2)
    assert {f"gbt|step={s:.4g}": x for s, *x in got} == {m: pytest.approx(v, rel=1e-9) for m, v in want.items()}


def test_f6_more_features_than_a_key_holds(rows):
    wide = rows.select("id", "y", "a", "b", *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(997)) / 997.0 + F.col("c") * int(i == 11)).alias(f"x{i}") for i in range(12)])
    cols = [c for c in wide.columns if c not in ("id", "y")]
    want = by_spark(wide, cols, [0.3], 2)["gbt|step=0.3"]
    assert B.boosted_scores(wide, cols, "y", "id", [0.3], 2, 2)[0][1:] == pytest.approx(want, rel=1e-9)


def test_f6_search_makes_no_fit_of_its_own_unless_cells_are_too_many(rows, monkeypatch):
    whole = rows.select("id", "y", "c", F.coalesce("a", F.lit(0.5)).alias("a"))
    search = lambda: {r["model"]: r["rmse_mean"] for r in M.random_search(whole, ["a", "c"], "y", "id", 2, 2, gbt_rounds=2).collect()}
    with monkeypatch.context() as m:
        m.setattr(M, "GBTRegressor", None)       # before: one Spark fit per trial and fold
        over_cells = search()
    monkeypatch.setattr(B, "MAX_CELLS", 10)
    assert len(over_cells) == 4 and search() == pytest.approx(over_cells, rel=1e-9)


def test_f6_cells_do_not_grow_with_repeated_rows(spark, rows):
    again = rows.select("id", "c", "y").crossJoin(spark.range(4).toDF("copy")).withColumn("id", F.col("id") * 4 + F.col("copy"))
    for df in (rows, again):
        blocks, _ = B.fold_cells(df, ["c"], "y", "id", 2, 42)
        assert {r["n"] for r in blocks.groupBy("f").agg(F.sum("size").alias("n")).collect()} == {4}


def test_cuts_above_the_exact_size_lie_near_equal_shares(spark, monkeypatch):
    monkeypatch.setattr(B, "EXACT", 0)
    monkeypatch.setattr(B, "POINTS", 256)
    monkeypatch.setattr(B, "CHUNK", 500)
    df = spark.range(3000).select("id", (F.pmod(F.col("id") * 7919, F.lit(3000)) / 3000.0).alias("a"), F.lit(0).alias("fold"))
    folded = df.select(F.when(F.col("id") % 2 == 0, 0).otherwise(1).alias("fold"), "a", F.col("a").alias("y"))
    facts = {f: {"n": 1500, "held": [1500], "fill": [0.0]} for f in (0, 1)}
    for (cuts,) in B._fold_cuts(folded, 1, 2, 3000, facts):
        assert cuts == pytest.approx([i / 32 for i in range(1, 32)], abs=0.01)


def test_rows_without_target_are_an_error(rows):
    with pytest.raises(ValueError, match="without y"):
        B.boosted_scores(rows.withColumn("y", F.when(F.col("id") > 3, F.col("y"))), ["a"], "y", "id", [0.1], 1, 2)


def test_f7_registered_search_scores_every_trial_with_all_rounds(spark, tmp_path, monkeypatch):
    rnd = random.Random(1)
    items = [(i // 3, i % 7, float(rnd.randint(1, 50)), rnd.uniform(1e3, 1e5), rnd.randint(0, 10) / 100, rnd.randint(0, 8) / 100, "N") for i in range(450)]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                                 "l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(i, i + 1, 900.0 + i) for i in range(7)], "p_partkey long, p_size int, p_retailprice double") \
        .write.parquet(str(tmp_path / "part.parquet"))
    asked = {}
    real = B.boosted_scores

    def scores(df, cols, y, id_col, steps, rounds, k, seed):
        asked.update(steps=len(set(steps)), rounds=rounds, k=k)
        return real(df, cols, y, id_col, steps, 1, k, seed)

    monkeypatch.setattr(B, "boosted_scores", scores)
    monkeypatch.setattr(M, "select_best", lambda summary: summary)
    found = Q.v07_v08_random_search(spark, str(tmp_path)).groupBy("family").count().collect()
    assert asked == {"steps": 30, "rounds": 100, "k": 5}
    assert {r["family"]: r["count"] for r in found} == {"ridge": 30, "gbt": 30}
