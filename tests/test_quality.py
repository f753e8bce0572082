"""Cleaning and quality operators on tiny hand-made inputs."""


import pytest
from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.operators import text as X
from tessera.sources.tables import align_embeddings


def test_dropna_keeps_complete_rows(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "x"), (3, "b", None), (4, "c", "y")],
                               "id long, texto string, categoria string")
    assert Q.drop_missing(df, ["texto", "categoria"]).count() == 2


def test_dedup_keeps_same_text_in_other_category(spark):
    df = spark.createDataFrame([(1, "t1", "A"), (2, "t1", "A"), (3, "t1", "B"), (4, "t2", "A")],
                               "id long, text string, cat string")
    clean, audit = X.clean_texts(df, "id", "text", "cat")
    assert clean.count() == 3
    assert clean.filter("text = 't1'").count() == 2
    assert sorted(r.id for r in clean.collect()) == [1, 3, 4]


def test_category_normalise(spark):
    df = spark.createDataFrame([("Clothing & Accessories",), ("  Books  ",)], "c string")
    out = [r[0] for r in df.select(Q.normalise_category("c")).collect()]
    assert out == ["Clothing_Accessories", "Books"]


def test_counts_before_and_after_dedup(spark):
    df = spark.createDataFrame([(1, "a", "X"), (2, "a", "X"), (3, None, "X"), (4, "b", "Y")],
                               "id long, text string, cat string")
    _, audit = X.clean_texts(df, "id", "text", "cat")
    row = audit.first()
    assert (row.n_rows, row.n_non_null, row.n_unique) == (4, 3, 2)


def test_embeddings_alignment_and_mismatch(spark):
    rows = spark.createDataFrame([(0,), (1,), (3,)], "id long")  # row 2 removed as a duplicate
    emb = spark.createDataFrame([(i, [float(i)]) for i in range(4)], "id long, e array<double>")
    assert align_embeddings(rows, emb, "id", expected_total=4).count() == 3
    two = spark.createDataFrame([(0,), (1,)], "id long")
    five = spark.createDataFrame([(i, [float(i)]) for i in range(5)], "id long, e array<double>")
    with pytest.raises(ValueError):
        align_embeddings(two, five, "id", expected_total=2)


def test_impute_with_train_means(spark):
    train = spark.createDataFrame([(1.0, 2.0), (3.0, float("nan")), (5.0, 6.0)], "a double, b double")
    test = spark.createDataFrame([(float("nan"), 1.0)], "a double, b double")
    tr, te, report = Q.impute_mean(train, test, ["a", "b"])
    assert tr.collect()[1].b == 4.0
    assert te.first().a == 3.0
    rep = {r.column: r for r in report.collect()}
    assert rep["b"].n_missing_train == 1 and rep["a"].n_missing_test == 1


def test_rule_set_counts_in_order(spark):
    df = spark.createDataFrame([(15, 1), (30, 20), (40, 2), (16, 9)], "age int, tenure int")
    rules = Q.RuleSet([("too_young", F.col("age") < 18), ("tenure", F.col("tenure") > F.col("age") - 18)])
    audit = {r.rule: r.n_removed for r in rules.audit(df).collect()}
    # row (16, 9) breaks both rules but is counted once, under the first
    assert audit == {"too_young": 2, "tenure": 1}
    assert rules.clean(df).count() == 1


def test_interpolation_by_position(spark):
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate([None, 1.0, None, None, 4.0, None])],
                               "s string, t int, v double")
    out = [r.v for r in Q.interpolate_linear(df, "v", "t", "s").orderBy("t").collect()]
    assert out == [1.0, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_null_counts_treat_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    got = {r.column: r.n_null for r in Q.null_counts(df).collect()}
    assert got == {"x": 2, "s": 1}


def test_duplicate_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "k int")
    r = Q.duplicate_counts(df).first()
    assert (r.n_rows, r.n_distinct, r.n_duplicates, r.n_repeated_keys) == (4, 2, 2, 1)


def test_period_coverage_business_days(spark):
    import datetime as dt
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 5), dt.date(2024, 1, 9)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    r = Q.period_coverage(df, "d").first()
    assert r.expected_business_days == 7  # Jan 1-5, 8, 9
    assert r.missing_business_days == 3 and r.longest_gap_days == 4
