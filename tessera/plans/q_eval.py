"""Queries: splits, classification evaluation on a nearest-centroid model
over the embeddings table (V-01 … V-04, M-03, E-06 … E-11, E-14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import row_hash_sql, row_uniform_sql
from tessera.operators import evaluate as E
from tessera.operators import models as M
from tessera.operators import splits as V
from tessera.plans.registry import query
from tessera.sources.tables import table

T = 0.01  # softmax temperature of the centroid scores
THRESHOLDS = (0.3, 0.5, 0.7, 0.9)
CLASSES = list(range(10))

_SPLIT_CTE = f"""
h AS (SELECT vec_id, label, embedding, {row_hash_sql('vec_id', 42)} AS h FROM embeddings),
s AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, vec_id) - 1 AS pos,
             count(*) OVER (PARTITION BY label) AS nc FROM h),
sp AS (SELECT vec_id, label, embedding, CASE WHEN pos < round(nc * 0.2) THEN 'test' ELSE 'train' END AS split FROM s)"""

_PRED_CTE = "WITH " + _SPLIT_CTE.strip() + f""",
ex AS (SELECT vec_id, label, split, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(0, len(embedding))) AS dim FROM sp),
cen AS (SELECT label AS cls, dim, avg(x) AS m FROM ex WHERE split = 'train' GROUP BY ALL),
nrm AS (SELECT cls, sum(m * m) AS n2 FROM cen GROUP BY cls),
sc AS (SELECT e.vec_id, e.label AS truth, c.cls, sum(e.x * c.m) - 0.5 * any_value(n2) AS s
       FROM ex e JOIN cen c USING (dim) JOIN nrm USING (cls) WHERE e.split = 'test' GROUP BY ALL),
mx AS (SELECT vec_id, max(s) AS ms FROM sc GROUP BY vec_id),
pr AS (SELECT sc.vec_id, truth, cls, s, ms, exp((s - ms) / {T}) AS e FROM sc JOIN mx USING (vec_id)),
den AS (SELECT vec_id, sum(e) AS d FROM pr GROUP BY vec_id),
probs AS (SELECT pr.vec_id, truth, cls, e / d AS prob, s = ms AS is_max FROM pr JOIN den USING (vec_id)),
preds AS (SELECT vec_id, any_value(truth) AS truth, min(cls) FILTER (WHERE is_max) AS pred,
                 max(prob) AS confidence FROM probs GROUP BY vec_id)"""

_REPORT_CTE = _PRED_CTE + """,
c AS (SELECT truth, pred, count(*) AS n FROM preds GROUP BY ALL),
t AS (SELECT truth AS cls, sum(n) AS support, sum(n) FILTER (WHERE truth = pred) AS tp FROM c GROUP BY truth),
p AS (SELECT pred AS cls, sum(n) AS predicted FROM c GROUP BY pred),
r AS (SELECT cls, CAST(COALESCE(support, 0) AS BIGINT) AS support, CAST(COALESCE(tp, 0) AS BIGINT) AS tp,
             CAST(COALESCE(predicted, 0) AS BIGINT) AS predicted FROM t FULL JOIN p USING (cls)),
r2 AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM r),
r3 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM r2)"""


def _split(spark, d):
    emb = table(spark, d, "embeddings")
    sp = V.stratified_split(emb, "vec_id", "label", 0.2, 42)
    return emb.join(sp.select("vec_id", "split"), on="vec_id")


def _predictions(spark, d):
    s = _split(spark, d)
    cents = M.fit_centroids(s.filter("split = 'train'"), "embedding", "label")
    test = s.filter("split = 'test'").select("vec_id", F.col("label").alias("truth"), "embedding")
    return M.centroid_predict(test, cents, "embedding", T).drop("embedding")


# V-01 -----------------------------------------------------------------------
@query("v01_stratified_split", "WITH " + _SPLIT_CTE.strip() + """
SELECT label, split, count(*) AS n FROM sp GROUP BY ALL""")
def v01_stratified_split(spark, d):
    return _split(spark, d).groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))


# V-02 -----------------------------------------------------------------------
@query("v02_random_split", f"""
SELECT CASE WHEN {row_uniform_sql('event_id', 3)} < 0.2 THEN 'test' ELSE 'train' END AS split,
       event_type, count(*) AS n FROM events GROUP BY ALL""")
def v02_random_split(spark, d):
    s = V.random_split(table(spark, d, "events"), "event_id", 0.2, 3)
    return s.groupBy("split", "event_type").agg(F.count(F.lit(1)).alias("n"))


# V-03 -----------------------------------------------------------------------
@query("v03_inner_validation_split", "WITH " + _SPLIT_CTE.strip() + f""",
tr AS (SELECT vec_id, label FROM sp WHERE split = 'train'),
h2 AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {row_hash_sql('vec_id', 7)}, vec_id) - 1 AS pos,
              count(*) OVER (PARTITION BY label) AS nc FROM tr)
SELECT label, CASE WHEN pos < round(nc * 0.25) THEN 'test' ELSE 'train' END AS split, count(*) AS n
FROM h2 GROUP BY ALL""")
def v03_inner_validation_split(spark, d):
    tr = _split(spark, d).filter("split = 'train'").drop("split")
    inner = V.stratified_split(tr, "vec_id", "label", 0.25, 7)
    return inner.groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))


# V-04 -----------------------------------------------------------------------
@query("v04_stratified_folds", f"""
WITH s AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY {row_hash_sql('doc_id', 11)}, doc_id) - 1 AS pos
           FROM documents)
SELECT lang, CAST(pos % 5 AS INTEGER) AS fold, count(*) AS n FROM s GROUP BY ALL""")
def v04_stratified_folds(spark, d):
    f = V.kfold(table(spark, d, "documents"), "doc_id", 5, 11, label="lang")
    return f.groupBy("lang", "fold").agg(F.count(F.lit(1)).alias("n"))


# E-06 -----------------------------------------------------------------------
@query("e06_classification_metrics", _REPORT_CTE + """
SELECT sum(tp) / sum(support) AS accuracy, avg(recall) FILTER (WHERE support > 0) AS balanced_accuracy,
       avg(precision) AS precision_macro, avg(recall) AS recall_macro, avg(f1) AS f1_macro,
       sum(f1 * support) / sum(support) AS f1_weighted, CAST(sum(support) AS BIGINT) AS n FROM r3""",
       doubles=["accuracy", "balanced_accuracy", "precision_macro", "recall_macro", "f1_macro", "f1_weighted"])
def e06_classification_metrics(spark, d):
    return E.classification_metrics(_predictions(spark, d))


# E-07 -----------------------------------------------------------------------
@query("e07_confusion", _PRED_CTE + "\nSELECT truth, pred, count(*) AS n FROM preds GROUP BY ALL")
def e07_confusion(spark, d):
    return E.confusion(_predictions(spark, d))


# E-08 -----------------------------------------------------------------------
@query("e08_per_class_report", _REPORT_CTE + "\nSELECT cls, support, tp, predicted, precision, recall, f1 FROM r3",
       doubles=["precision", "recall", "f1"])
def e08_per_class_report(spark, d):
    return E.per_class_report(_predictions(spark, d))


# E-09 -----------------------------------------------------------------------
@query("e09_roc_auc_ovr", _PRED_CTE + """,
o AS (SELECT cls, prob, CAST(truth = cls AS INTEGER) AS pos FROM probs),
rk AS (SELECT *, rank() OVER (PARTITION BY cls ORDER BY prob) + (count(*) OVER (PARTITION BY cls, prob) - 1) / 2.0 AS r FROM o)
SELECT cls, sum(pos) AS n_pos,
       (sum(r) FILTER (WHERE pos = 1) - sum(pos) * (sum(pos) + 1) / 2.0) / (sum(pos) * (count(*) - sum(pos))) AS auc
FROM rk GROUP BY cls""", doubles=["auc"])
def e09_roc_auc_ovr(spark, d):
    p = _predictions(spark, d)
    return E.roc_auc_ovr(p, "truth", {c: f"p_{c}" for c in CLASSES}) \
        .withColumn("n_pos", F.col("n_pos").cast("long"))


# E-10 -----------------------------------------------------------------------
@query("e10_average_precision", _PRED_CTE + """,
o AS (SELECT cls, prob, CAST(truth = cls AS INTEGER) AS pos FROM probs),
g AS (SELECT cls, prob, sum(pos) AS tp_at, count(*) AS n_at FROM o GROUP BY ALL),
cu AS (SELECT *, sum(tp_at) OVER (PARTITION BY cls ORDER BY prob DESC) AS tp,
              sum(n_at) OVER (PARTITION BY cls ORDER BY prob DESC) AS np FROM g),
tot AS (SELECT cls, sum(pos) AS n_pos FROM o GROUP BY cls)
SELECT cls, n_pos, sum(tp_at / n_pos * tp / np) AS ap FROM cu JOIN tot USING (cls) GROUP BY cls, n_pos""",
       doubles=["ap"])
def e10_average_precision(spark, d):
    p = _predictions(spark, d)
    return E.average_precision(p, "truth", {c: f"p_{c}" for c in CLASSES}) \
        .withColumn("n_pos", F.col("n_pos").cast("long"))


@query("e10_macro_average_precision", _PRED_CTE + """,
o AS (SELECT cls, prob, CAST(truth = cls AS INTEGER) AS pos FROM probs),
g AS (SELECT cls, prob, sum(pos) AS tp_at, count(*) AS n_at FROM o GROUP BY ALL),
cu AS (SELECT *, sum(tp_at) OVER (PARTITION BY cls ORDER BY prob DESC) AS tp,
              sum(n_at) OVER (PARTITION BY cls ORDER BY prob DESC) AS np FROM g),
tot AS (SELECT cls, sum(pos) AS n_pos FROM o GROUP BY cls),
a AS (SELECT cls, sum(tp_at / n_pos * tp / np) AS ap FROM cu JOIN tot USING (cls) GROUP BY cls, n_pos)
SELECT count(*) AS n_classes, avg(ap) AS ap_macro, min(ap) AS ap_worst FROM a""", doubles=["ap_macro", "ap_worst"])
def e10_macro_average_precision(spark, d):
    ap = E.average_precision(_predictions(spark, d), "truth", {c: f"p_{c}" for c in CLASSES})
    return ap.agg(F.count(F.lit(1)).alias("n_classes"), F.avg("ap").alias("ap_macro"), F.min("ap").alias("ap_worst"))


# E-14 -----------------------------------------------------------------------
@query("e14_coverage_by_threshold", _PRED_CTE + "\n" + "\nUNION ALL\n".join(
    f"""SELECT CAST({t} AS DOUBLE) AS threshold, count(*) FILTER (WHERE confidence >= {t}) / count(*) AS coverage,
       CASE WHEN count(*) FILTER (WHERE confidence >= {t}) > 0 THEN
         count(*) FILTER (WHERE confidence >= {t} AND truth = pred) / count(*) FILTER (WHERE confidence >= {t}) END AS accuracy,
       count(*) FILTER (WHERE confidence >= {t}) AS n_covered FROM preds""" for t in THRESHOLDS),
       doubles=["coverage", "accuracy"])
def e14_coverage_by_threshold(spark, d):
    return E.coverage_by_threshold(_predictions(spark, d), "truth", "pred", "confidence", THRESHOLDS)


# M-03 -----------------------------------------------------------------------
@query("m03_majority_baseline", "WITH " + _SPLIT_CTE.strip() + """,
maj AS (SELECT label AS pred FROM sp WHERE split = 'train' GROUP BY label ORDER BY count(*) DESC, label LIMIT 1),
pp AS (SELECT label AS truth, pred FROM sp, maj WHERE split = 'test'),
c AS (SELECT truth, pred, count(*) AS n FROM pp GROUP BY ALL),
t AS (SELECT truth AS cls, sum(n) AS support, sum(n) FILTER (WHERE truth = pred) AS tp FROM c GROUP BY truth),
p AS (SELECT pred AS cls, sum(n) AS predicted FROM c GROUP BY pred),
r AS (SELECT cls, COALESCE(support, 0) AS support, COALESCE(tp, 0) AS tp, COALESCE(predicted, 0) AS predicted
      FROM t FULL JOIN p USING (cls)),
r2 AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM r),
r3 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM r2)
SELECT sum(tp) / sum(support) AS accuracy, avg(recall) FILTER (WHERE support > 0) AS balanced_accuracy,
       avg(precision) AS precision_macro, avg(recall) AS recall_macro, avg(f1) AS f1_macro,
       sum(f1 * support) / sum(support) AS f1_weighted, CAST(sum(support) AS BIGINT) AS n FROM r3""",
       doubles=["accuracy", "balanced_accuracy", "precision_macro", "recall_macro", "f1_macro", "f1_weighted"])
def m03_majority_baseline(spark, d):
    s = _split(spark, d)
    maj = M.majority_class(s.filter("split = 'train'"), "label")
    test = s.filter("split = 'test'").select(F.col("label").alias("truth"), F.lit(maj).alias("pred"))
    return E.classification_metrics(test)


# E-11 -----------------------------------------------------------------------
@query("e11_bootstrap_f1_vs_majority")
def e11_bootstrap_f1_vs_majority(spark, d):
    """Paired bootstrap: centroid model vs the majority baseline on the same test rows."""
    s = _split(spark, d)
    maj = M.majority_class(s.filter("split = 'train'"), "label")
    p = _predictions(spark, d).withColumn("base", F.lit(maj))
    res = E.paired_bootstrap_f1(p, "truth", "pred", "base", n_boot=3000, seed=42)
    return E.bootstrap_table(spark, res)
