"""Fits over shared, spread tables: the same results, from few passes over the input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.functions.hashing import row_uniform
from tessera.operators import cluster as C
from tessera.operators import models as M
from tessera.session import FIT_ROWS


def test_fit_table_is_shared_out(spark):
    """One task's rows become several files; rows with a gap still go."""
    n = 2 * FIT_ROWS + 10
    df = spark.range(n).coalesce(1).select("id", (F.col("id") % 7).cast("double").alias("a"),
                                           F.when(F.col("id") > 4, F.col("id") * 1.0).alias("b"))
    data = C.fit_table(df, ["a", "b"])
    assert data.count() == n - 5
    assert len(data.inputFiles()) == 3


def test_ridge_over_seeds_equals_separate_fits(spark):
    rows = [(i, None if i % 11 == 0 else float(i % 13), float("nan") if i % 17 == 0 else (i * 37 % 101) / 10.0, 5.0,
             3.0 * (i % 13) - (i * 37 % 101) + i % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double").withColumn("ok", F.col("b") > 4)
    variants = {"all": F.lit(True), "some": F.col("ok")}
    got = M.ridge_over_seeds(df, ["a", "b", "c"], variants, 10.0, [3, 8]).groupBy("seed", "variant").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y_pred").alias("s"), F.sum(F.col("y_pred") * F.col("a")).alias("sa"),
        F.sum("y_true").alias("t")).collect()
    assert len(got) == 4
    for r in got:
        part = (df if r["variant"] == "all" else df.filter("ok")).withColumn("u", row_uniform("id", r["seed"]))
        trs, (tes,), _ = M.scaled_features(part.filter("u >= 0.2"), [part.filter("u < 0.2")], ["a", "b", "c"])
        n, ystd = trs.agg(F.count(F.lit(1)), F.stddev_pop("y")).first()
        want = M.ridge("features", "y", 10.0, n, ystd).fit(trs).transform(tes).agg(
            F.count(F.lit(1)), F.sum("y_pred"), F.sum(F.col("y_pred") * F.col("a")), F.sum("y")).first()
        assert r["n"] == want[0]
        assert (r["s"], r["sa"], r["t"]) == pytest.approx(tuple(want)[1:], rel=1e-6, abs=1e-6)


def _scans(df, name="lineitem") -> int:
    return df._jdf.queryExecution().executedPlan().toString().count(f"{name}.parquet")


def test_regression_rows_are_read_from_their_own_table(spark):
    from tessera.plans.q_models import _rr_split
    for part in _rr_split(spark, "/root/testdata/sf0.001"):
        assert _scans(part) == 0


def test_weights_are_read_from_written_postings(spark):
    from tessera.plans import q_text
    for weights in (q_text._weights, q_text._all_weights):
        w, vocab, _ = weights(spark, "/root/testdata/sf0.001")
        assert _scans(w, "documents") == _scans(vocab, "documents") == 0
