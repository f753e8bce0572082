"""The pipeline, stage by stage, against the plain Python versions."""

from collections import Counter

import brute
from pyspark.sql import functions as F

import corpus_pipeline as pipeline


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.createDataFrame(brute.awkward_rows(), brute.SCHEMA).repartition(2)
    columns = docs.columns
    text = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]

    def step(name, df):
        path = str(tmp_path / name)
        dict(pipeline.STAGES)[name](spark, df, "").write.parquet(path)
        return spark.read.parquet(path)

    a = step("language_id", docs)
    assert Counter(text(a)) == Counter((i, t) for i, t in text(docs) if t and any(c.isalpha() for c in t))
    b = step("line_dedup", a)
    assert Counter(text(b)) == Counter((i, t) for i, t, _, _ in brute.line_dedup(text(a)))
    assert b.where("n_chars <> length(text)").count() == 0
    c = step("simhash_near_dedup", b)
    assert Counter(i for i, _ in text(c)) == brute.one_per_component(text(b))
    d = step("secret_scan", c)
    assert Counter(text(d)) == Counter((i, brute.redact(t)) for i, t in text(c))
    assert a.columns == b.columns == c.columns == d.columns == columns
    e = step("best_fit_packing", d)
    tokens = Counter()
    for i, t in text(d):
        tokens[i] += len(brute.words(t)) + 1
    assert Counter({r["doc_id"]: r["n"] for r in e.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()}) == tokens


def test_empty_table_passes_every_stage(spark, tmp_path):
    docs = spark.createDataFrame([], brute.SCHEMA)
    for name, stage in pipeline.STAGES:
        stage(spark, docs, "").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0
