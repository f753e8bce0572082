"""Queries: regression / classification models, model selection,
interpretation and walk-forward forecasters (R-*, M-*, V-05 … V-08, E-01,
E-03, E-04, E-12, E-13, E-15 … E-20, C-02, X-08, Q-12, P-15).

Model fits are not SQL-expressible, so most entries here get the driver's
rows-only check plus pytest checks against closed forms; the mean-baseline
entries have DuckDB twins.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import row_uniform, row_uniform_sql
from tessera.operators import cluster as C
from tessera.operators import describe as D
from tessera.operators import evaluate as E
from tessera.operators import forecast as FC
from tessera.operators import models as M
from tessera.operators import quality as Q
from tessera.operators import stats as S
from tessera.operators import text as X
from tessera.operators import timeseries as T
from tessera.operators.search import joint_search
from tessera.operators.splits import stratified_split
from tessera.plans.bindings import (REGRESSION_FEATURES, REGRESSION_ROWS_SQL, daily_series,
                                    regression_rows, with_sql)
from tessera.plans.registry import query
from tessera.session import FIT_ROWS, written
from tessera.sources.tables import table

FEATS = list(REGRESSION_FEATURES)
SPLIT_SQL = row_uniform_sql("id", 42) + " < 0.2"


def _rr_split(spark, d):
    """Written once: every scaler, fit and score reads the rows, none the line items."""
    rr = written(regression_rows(spark, d).withColumn("__u", row_uniform("id", 42)), "regression-rows", FIT_ROWS)
    return rr.filter("__u >= 0.2").drop("__u"), rr.filter("__u < 0.2").drop("__u")


# R-01 / E-01 ----------------------------------------------------------------
@query("r01_mean_baseline_metrics", with_sql(REGRESSION_ROWS_SQL) + f""",
tr AS (SELECT avg(y) AS m FROM regression_rows WHERE NOT ({SPLIT_SQL})),
te AS (SELECT y AS y_true, (SELECT m FROM tr) AS y_pred FROM regression_rows WHERE {SPLIT_SQL})
SELECT avg(abs(y_true - y_pred)) AS mae, sqrt(avg((y_true - y_pred) ^ 2)) AS rmse,
       1 - avg((y_true - y_pred) ^ 2) / var_pop(y_true) AS r2,
       avg(CASE WHEN y_true <> 0 THEN abs((y_true - y_pred) / y_true) END) AS mape,
       count(*) AS n_obs, count(*) FILTER (WHERE y_true = 0) AS n_zero_y FROM te""",
       doubles=["mae", "rmse", "r2", "mape"])
def r01_mean_baseline_metrics(spark, d):
    tr, te = _rr_split(spark, d)
    p = te.select(F.col("y").alias("y_true"), F.lit(M.mean_baseline(tr, "y")).alias("y_pred"))
    return E.regression_metrics(p, mape_percent=False)


# E-03 -----------------------------------------------------------------------
@query("e03_metrics_by_segment", with_sql(REGRESSION_ROWS_SQL) + f""",
tr AS (SELECT avg(y) AS m FROM regression_rows WHERE NOT ({SPLIT_SQL})),
te AS (SELECT retail_price, y AS y_true, (SELECT m FROM tr) AS y_pred FROM regression_rows WHERE {SPLIT_SQL}),
q AS (SELECT quantile_cont(retail_price, 0.25) AS e1, quantile_cont(retail_price, 0.5) AS e2,
             quantile_cont(retail_price, 0.75) AS e3, min(retail_price) AS e0, max(retail_price) AS e4 FROM te),
s AS (SELECT te.*, e0, e1, e2, e3, e4, CAST((retail_price > e1)::INT + (retail_price > e2)::INT + (retail_price > e3)::INT AS INTEGER) AS segment
      FROM te, q)
SELECT segment, CASE segment WHEN 0 THEN printf('[%.4f, %.4f]', e0, e1) WHEN 1 THEN printf('(%.4f, %.4f]', e1, e2)
                     WHEN 2 THEN printf('(%.4f, %.4f]', e2, e3) ELSE printf('(%.4f, %.4f]', e3, e4) END AS label,
       avg(abs(y_true - y_pred)) AS mae, sqrt(avg((y_true - y_pred) ^ 2)) AS rmse,
       1 - avg((y_true - y_pred) ^ 2) / var_pop(y_true) AS r2,
       avg(CASE WHEN y_true <> 0 THEN abs((y_true - y_pred) / y_true) END) AS mape,
       count(*) AS n_obs, count(*) FILTER (WHERE y_true = 0) AS n_zero_y FROM s GROUP BY ALL""",
       doubles=["mae", "rmse", "r2", "mape"])
def e03_metrics_by_segment(spark, d):
    """Mean-baseline errors by retail-price quartile (qcut edges, right-closed)."""
    tr, te = _rr_split(spark, d)
    p = te.select("retail_price", F.col("y").alias("y_true"), F.lit(M.mean_baseline(tr, "y")).alias("y_pred"))
    seg = E.quantile_segments(p, "retail_price", 4)
    label = F.format_string("%s%.4f, %.4f]", F.when(F.col("segment") == 0, "[").otherwise("("), "seg_lo", "seg_hi")
    return E.regression_metrics(seg.withColumn("label", label), by=["segment", "label"], mape_percent=False)


# R-02 … R-06 / E-04 ---------------------------------------------------------
@query("r06_model_comparison")
def r06_model_comparison(spark, d):
    """Mean, linear, ridge, tree, forest and GBT on the same split; hold-out
    metrics and the RMSE improvement over the mean baseline."""
    tr, te = _rr_split(spark, d)
    preds = M.fit_many(tr, te, FEATS, "y", "id", alpha=10.0)
    m = E.regression_metrics(preds, by="model", mape_percent=False)
    return E.improvement(m, m.filter("model = 'mean'").select("rmse"))


# V-05 / E-19 ----------------------------------------------------------------
def _cv_models(n, ystd):
    return {"linear": M.ridge("features", "y", 0.0, n, ystd),
            "ridge": M.ridge("features", "y", 10.0, n, ystd),
            "tree": M.regressors("y")["tree"]}


@query("v05_cross_validation")
def v05_cross_validation(spark, d):
    """5-fold CV (features refitted per fold): mean ± std (ddof 0) per model."""
    tr, _ = _rr_split(spark, d)
    return M.cv_summary(M.cross_validate(tr, FEATS, _cv_models, "y", "id", 5, 42))


@query("e19_fold_stability")
def e19_fold_stability(spark, d):
    """Per-fold metrics in long form (model, fold, metric, value)."""
    tr, _ = _rr_split(spark, d)
    per = M.cross_validate(tr, FEATS, _cv_models, "y", "id", 5, 42)
    return per.unpivot(["model", "fold"], ["rmse", "mae", "r2"], "metric", "value")


# V-07 / V-08 ----------------------------------------------------------------
@query("v07_v08_random_search")
def v07_v08_random_search(spark, d):
    """Seeded log-uniform search by 5-fold CV, best per family: 30 ridge
    penalties and 30 GBT steps of 100 rounds each."""
    tr, _ = _rr_split(spark, d)
    return M.select_best(M.random_search(tr, FEATS, "y", "id", seed=42))


@query("v07_joint_search")
def v07_joint_search(spark, d):
    """Every score of a joint search by 5-fold CV: all ten ridge penalties and 30
    joint draws of depth and leaf size. The operator's boosted and forest draws
    (up to 500 rounds, 800 trees, five fits each) are left to the caller."""
    tr, _ = _rr_split(spark, d)
    return joint_search(tr, FEATS, "y", "id", ("ridge", "tree"))


# E-16 / E-18 ----------------------------------------------------------------
@query("e16_e18_coefficients_attribution")
def e16_e18_coefficients_attribution(spark, d):
    """Ridge coefficients on standardised features (sorted by |β|) and the mean
    absolute additive attribution β·(x − mean) on the test rows."""
    tr, te = _rr_split(spark, d)
    trs, (tes,), params = M.scaled_features(tr, [te], FEATS)
    n, ystd = trs.agg(F.count(F.lit(1)), F.stddev_pop("y")).first()
    model = M.ridge("features", "y", 10.0, n, ystd).fit(trs)
    coefs = dict(M.coefficient_table(model, FEATS))
    means = tes.agg(*[F.avg(c).alias(c) for c in FEATS]).first().asDict()
    att = M.linear_attribution(tes, coefs, {c: 0.0 for c in FEATS})  # scaled train mean is 0
    coef_df = spark.createDataFrame([(c, float(b)) for c, b in coefs.items()], "feature string, coef double")
    return coef_df.join(att, on="feature").withColumn("abs_coef", F.abs("coef")) \
        .withColumn("test_mean_scaled", F.create_map(*[x for c, v in means.items()
                                                        for x in (F.lit(c), F.lit(float(v)))])[F.col("feature")])


# E-17 -----------------------------------------------------------------------
@query("e17_permutation_importance")
def e17_permutation_importance(spark, d):
    tr, te = _rr_split(spark, d)
    trs, (tes,), _ = M.scaled_features(tr, [te], FEATS)
    n, ystd = trs.agg(F.count(F.lit(1)), F.stddev_pop("y")).first()
    model = M.ridge("features", "y", 10.0, n, ystd).fit(trs)
    return M.permutation_importance(model, tes, FEATS, "y", "id", seed=42)


# E-12 -----------------------------------------------------------------------
@query("e12_bootstrap_rmse")
def e12_bootstrap_rmse(spark, d):
    """Paired Poisson bootstrap of RMSE(mean baseline) − RMSE(ridge), 5,000 replicates."""
    tr, te = _rr_split(spark, d)
    trs, (tes,), _ = M.scaled_features(tr, [te], FEATS)
    n, ystd = trs.agg(F.count(F.lit(1)), F.stddev_pop("y")).first()
    p = M.ridge("features", "y", 10.0, n, ystd).fit(trs).transform(tes) \
        .withColumn("base", F.lit(M.mean_baseline(trs, "y")))
    return E.bootstrap_table(spark, E.paired_bootstrap_rmse(p, "y", "base", "y_pred", 5000, 42, id_col="id"))


# P-14 on model residuals is in q_stats; Q-12 --------------------------------
@query("q12_rule_sensitivity")
def q12_rule_sensitivity(spark, d):
    """RMSE of the same ridge with and without the discount rule over 10 seeds,
    plus mean |error| of flagged vs other rows."""
    rules = Q.RuleSet([("discount_above_max", F.col("discount") > 0.09)])
    tagged = rules.tag(regression_rows(spark, d))
    p = rules.tag(M.ridge_over_seeds(tagged, FEATS, {"all_rows": F.lit(True), "rule_applied": F.col("first_failed_rule").isNull()},
                                     10.0, range(1, 11)))
    err = F.when(F.col("variant") == "all_rows", F.abs(F.col("y_true") - F.col("y_pred")))
    flagged = p.groupBy("seed", "variant").agg(F.avg(F.when(F.col("first_failed_rule").isNotNull(), err)).alias("mae_flagged"),
                                               F.avg(F.when(F.col("first_failed_rule").isNull(), err)).alias("mae_other"))
    out = E.regression_metrics(p, by=["seed", "variant"]).join(flagged, ["seed", "variant"])
    return out.groupBy("variant").agg(F.avg("rmse").alias("rmse_mean"), F.stddev_pop("rmse").alias("rmse_std"),
                                      F.avg("mae_flagged").alias("mae_flagged"), F.avg("mae_other").alias("mae_other"))


# M-01 / E-13 / E-15 ---------------------------------------------------------
def _text_model(spark, d, label="lang"):
    docs = table(spark, d, "documents")
    if label not in docs.columns:
        marks = table(spark, d, "labels").select("doc_id", F.col(label).cast("string").alias(label))
        docs = docs.join(marks, "doc_id")
    mapping = X.label_encoder(docs, label)
    enc = X.encode(docs, label, mapping)
    sp = stratified_split(enc, "doc_id", label, 0.2, 42)
    data = written(enc.join(sp.select("doc_id", "split"), on="doc_id").select("doc_id", "text", "label_idx", "split"),
                   "m01-rows", M.TEXT_ROWS)
    cv, model = M.fit_text_classifier(data.filter("split = 'train'"), "text", "label_idx", 5000, C=5.0)
    pred = M.predict_text(cv, model, data.filter("split = 'test'"), "text")
    return pred, cv, model, mapping


@query("m01_text_classifier_metrics")
def m01_text_classifier_metrics(spark, d):
    """TF-IDF (5,000 terms, smoothed IDF, L2) + balanced multinomial logistic regression."""
    pred, _, _, _ = _text_model(spark, d)
    p = pred.select(F.col("label_idx").cast("int").alias("truth"), F.col("prediction").cast("int").alias("pred"))
    return E.classification_metrics(p)


@query("v05_text_cross_validation")
def v05_text_cross_validation(spark, d):
    """Five stratified folds of the text classifier, refitted whole in each."""
    return M.cross_validate_text(table(spark, d, "documents"), "doc_id", "text", "lang", k=5)


@query("e13_error_listing")
def e13_error_listing(spark, d):
    """Test documents whose toxicity mark the text model gets wrong, and their share."""
    pred, _, _, mapping = _text_model(spark, d, "toxic")
    p = X.decode(X.decode(pred.withColumn("pred_idx", F.col("prediction").cast("int")), "pred_idx", mapping, "pred"),
                 "label_idx", mapping, "truth")
    rate = p.agg(F.avg((F.col("truth") != F.col("pred")).cast("double"))).first()[0]
    return E.error_listing(p.select("doc_id", "truth", "pred", "text"), "truth", "pred", "text", 120) \
        .withColumn("error_rate", F.lit(rate))


@query("e15_top_words")
def e15_top_words(spark, d):
    _, cv, model, mapping = _text_model(spark, d)
    inv = {v: k for k, v in mapping.items()}
    rows = [(inv[c], side, r, w, v) for c, side, r, w, v in M.top_words(cv, model, 10)]
    return spark.createDataFrame(rows, "class string, side string, rank int, word string, weight double")


# M-02 -----------------------------------------------------------------------
@query("m02_forest_embeddings")
def m02_forest_embeddings(spark, d):
    emb = table(spark, d, "embeddings")
    sp = stratified_split(emb, "vec_id", "label", 0.2, 42)
    data = emb.join(sp.select("vec_id", "split"), on="vec_id")
    model = M.embedding_forest(data.filter("split = 'train'"), "embedding", "label", trees=30)
    from pyspark.ml.functions import array_to_vector
    te = data.filter("split = 'test'").withColumn("features", array_to_vector(F.col("embedding").cast("array<double>")))
    p = model.transform(te).select(F.col("label").alias("truth"), F.col("prediction").cast("int").alias("pred"))
    return E.classification_metrics(p)


@query("m02_boosted_embeddings")
def m02_boosted_embeddings(spark, d):
    """Boosted trees, one ensemble per class, on the binned embeddings: the same
    split and metrics as the forest, with the forest's macro F1 beside them (20
    rounds, 30 trees of depth 8; README has the time of larger fits)."""
    emb = table(spark, d, "embeddings").dropna(subset=["embedding", "label"])
    mapping = X.label_encoder(emb, "label")
    sp = stratified_split(emb, "vec_id", "label", 0.2, 42)
    data = X.encode(emb.join(sp.select("vec_id", "split"), on="vec_id"), "label", mapping)
    cuts = M.fit_bins(data.filter("split = 'train'"), "embedding")
    feats = written(M.binned(data, "embedding", cuts).select("label_idx", "split", "features").hint("rebalance"), "m02-binned")
    train, test = feats.filter("split = 'train'"), feats.filter("split = 'test'")
    truth = F.col("label_idx").cast("int").alias("truth")
    score = lambda model: E.classification_metrics(model.transform(test).select(truth, F.col("prediction").cast("int").alias("pred")))
    forest = score(M.forest_classifier(train, "label_idx", trees=30, depth=8)).first()["f1_macro"]
    return score(M.boosted_classifier(train, "label_idx", rounds=20)).withColumn("forest_f1_macro", F.lit(float(forest)))


# C-02 / X-08 / E-20 ---------------------------------------------------------
@query("c02_x08_pca_embeddings")
def c02_x08_pca_embeddings(spark, d):
    """PCA fitted on the training embeddings once at 30 dims and sliced to
    10 / 20 / 30; the centroid model's macro F1 on each representation
    compared with the raw 64-dim vectors (embeddings supplied as a table)."""
    emb = table(spark, d, "embeddings")
    sp = stratified_split(emb, "vec_id", "label", 0.2, 42)
    data = emb.join(sp.select("vec_id", "split"), on="vec_id").persist()
    pca = C.fit_pca_vectors(data.filter("split = 'train'"), "embedding", k=30)
    scores = C.pca_vector_scores(data, pca, "embedding", keep=["vec_id", "label", "split"])
    dims = pca["dims"]
    rows = []
    for k in (10, 20, 30, dims):
        if k == dims:
            rep = data.select("vec_id", "label", "split", F.col("embedding").cast("array<double>").alias("v"))
        else:
            rep = scores.select("vec_id", "label", "split", F.slice("scores", 1, k).alias("v"))
        cents = M.fit_centroids(rep.filter("split = 'train'"), "v", "label")
        p = M.centroid_predict(rep.filter("split = 'test'").withColumnRenamed("label", "truth"), cents, "v", 0.01)
        f1 = E.classification_metrics(p).first()["f1_macro"]
        rows.append(("pca" if k < dims else "raw", int(k), float(sum(pca["ratio"][:k])) if k < dims else 1.0,
                     float(f1)))
    data.unpersist()
    return spark.createDataFrame(rows, "representation string, dims int, explained double, f1_macro double")


@query("x08_linear_classifier")
def x08_linear_classifier(spark, d):
    """Embedding sets compared by one linear classifier's macro F1: the raw
    vectors and their projections on 10 and 30 components fitted on the training rows."""
    emb = table(spark, d, "embeddings").dropna(subset=["embedding", "label"])
    rows = emb.join(stratified_split(emb, "vec_id", "label", 0.2, 42).select("vec_id", "split"), on="vec_id")
    pca = C.fit_pca_vectors(rows.filter("split = 'train'"), "embedding", k=30)
    scores = C.pca_vector_scores(rows, pca, "embedding", keep=["vec_id"])
    sets = {"raw": emb.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))} | {
        f"pca{k}": scores.select("vec_id", F.slice("scores", 1, k).alias("v")) for k in (10, 30)}
    return M.compare_vector_sets(sets, rows, "vec_id", "label", "v")


# V-06 -----------------------------------------------------------------------
# Model families of the grid and whether each accepts a representation:
# multinomial naive Bayes needs non-negative inputs, so signed vectors skip it.
_GRID_MODELS = ("centroid", "logistic", "forest", "naive_bayes")


def _grid_compatible(model: str, signed: bool) -> bool:
    return not (model == "naive_bayes" and signed)


@query("v06_grid_comparison")
def v06_grid_comparison(spark, d):
    """Representation × dimension × model, one row each: the raw vectors,
    their PCA projections to 10 / 20 / 30 dims (fitted once on train, cached)
    and their min-shifted non-negative twin; every model is fitted on the
    train split and scored on the test split; incompatible pairs are skipped.
    The loop is over configurations (a dozen), never over rows."""
    from pyspark.ml.classification import LogisticRegression, NaiveBayes, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector
    emb = table(spark, d, "embeddings")
    sp = stratified_split(emb, "vec_id", "label", 0.2, 42)
    data = emb.join(sp.select("vec_id", "split"), on="vec_id").persist()
    pca = C.fit_pca_vectors(data.filter("split = 'train'"), "embedding", k=30)
    scores = C.pca_vector_scores(data, pca, "embedding", keep=["vec_id", "label", "split"]).persist()
    raw = data.select("vec_id", "label", "split", F.col("embedding").cast("array<double>").alias("v"))
    lo = raw.filter("split = 'train'").select(F.explode("v").alias("x")).agg(F.min("x")).first()[0]
    reps = [("raw", pca["dims"], raw, True),
            ("raw_shifted", pca["dims"], raw.withColumn("v", F.transform("v", lambda x: F.greatest(x - F.lit(lo), F.lit(0.0)))), False)]
    reps += [("pca", k, scores.select("vec_id", "label", "split", F.slice("scores", 1, k).alias("v")), True)
             for k in (10, 20, 30)]
    rows = []
    for rep_name, dims, rep, signed in reps:
        rep = rep.persist()  # fitted and scored by every model of the row
        tr = rep.filter("split = 'train'")
        te = rep.filter("split = 'test'")
        for model in _GRID_MODELS:
            if not _grid_compatible(model, signed):
                continue
            if model == "centroid":
                p = M.centroid_predict(te.withColumnRenamed("label", "truth"), M.fit_centroids(tr, "v", "label"), "v", 0.01)
            else:
                est = {"logistic": LogisticRegression(maxIter=50, regParam=0.01, family="multinomial"),
                       "forest": RandomForestClassifier(numTrees=30, maxDepth=8, seed=42),
                       "naive_bayes": NaiveBayes(modelType="multinomial")}[model]
                fit = est.setFeaturesCol("features").setLabelCol("label").fit(
                    tr.withColumn("features", array_to_vector("v")))
                p = fit.transform(te.withColumn("features", array_to_vector("v"))).select(
                    F.col("label").alias("truth"), F.col("prediction").cast("int").alias("pred"))
            m = E.classification_metrics(p).first()
            rows.append((rep_name, int(dims), model, float(m["accuracy"]), float(m["f1_macro"]),
                         float(m["f1_weighted"])))
        rep.unpersist()
    scores.unpersist()
    data.unpersist()
    return spark.createDataFrame(rows, "representation string, dims int, model string, accuracy double, "
                                       "f1_macro double, f1_weighted double")


@query("e20_seed_stability")
def e20_seed_stability(spark, d):
    """Macro F1 of the centroid model over three split seeds; spread vs 0.01."""
    emb = table(spark, d, "embeddings")
    rows = []
    for seed in range(1, 11):
        sp = stratified_split(emb, "vec_id", "label", 0.2, seed)
        data = emb.join(sp.select("vec_id", "split"), on="vec_id")
        cents = M.fit_centroids(data.filter("split = 'train'"), "embedding", "label")
        p = M.centroid_predict(data.filter("split = 'test'").withColumnRenamed("label", "truth"), cents, "embedding", 0.01)
        rows.append((seed, float(E.classification_metrics(p).first()["f1_macro"])))
    runs = spark.createDataFrame(rows, "seed int, f1_macro double")
    return E.seed_stability(runs, "seed", "f1_macro", 0.01)


# R-09 … R-13, P-15 ----------------------------------------------------------
N_TEST = 40


@query("r09_r11_classical_forecasts")
def r09_r11_classical_forecasts(spark, d):
    """SES / Holt / Holt–Winters / ARIMA(p,1,0) / trend-Fourier walk-forward
    metrics per model and horizon, with the naive baselines for reference."""
    s = daily_series(spark, d)
    preds = FC.classical_walk_forward(s, N_TEST).unionByName(
        T.baseline_predictions(T.walk_forward_frame(s, N_TEST)))
    return E.regression_metrics(preds, by=["model", "horizon"])


@query("r12_r13_direct_ml_forecasts")
def r12_r13_direct_ml_forecasts(spark, d):
    """Direct ridge per horizon on all 19 features and on the P-11-filtered list."""
    s = daily_series(spark, d)
    full = T.feature_columns()
    feats = T.build_features(s)
    kept = [r["feature"] for r in S.greedy_decorrelate(
        T.direct_targets(feats).dropna(subset=full + ["target_h1"]), full, "target_h1", 0.9).collect() if r["kept"]]
    a = FC.direct_ml_forecast(s, full, N_TEST).withColumn("model", F.lit("ml_ridge_full"))
    b = FC.direct_ml_forecast(s, kept, N_TEST).withColumn("model", F.lit("ml_ridge_filtered"))
    return E.regression_metrics(a.unionByName(b), by=["model", "horizon"])


@query("r12_choice_per_horizon")
def r12_choice_per_horizon(spark, d):
    """Ridge, forest or boosting by the inner hold-out's MAPE in each horizon,
    fitted again on all training rows: walk-forward metrics per horizon beside
    the hold-out MAPE of every family (100 trees, 50 rounds; README has the
    study's sizes)."""
    s = daily_series(spark, d)
    families = FC.horizon_families(trees=100, rounds=50, step=0.18)
    scores, chosen, preds = FC.choose_per_horizon(s, T.feature_columns(), N_TEST, families=families)
    table_ = E.regression_metrics(preds, by=["model", "horizon"])
    inner = scores.groupBy("horizon").pivot("family", list(families)).agg(F.first("mape")) \
        .select("horizon", *[F.col(f).alias(f"holdout_mape_{f}") for f in families])
    return table_.join(chosen, "horizon").join(inner, "horizon")


@query("r13_filtered_features")
def r13_filtered_features(spark, d):
    """Ridge (penalty 5) on all 19 features and on the P-11-filtered list: both
    halves, the inner hold-out and the walk-forward, per horizon."""
    s = daily_series(spark, d)
    full = T.feature_columns()
    feats = T.direct_targets(T.build_features(s)).dropna(subset=full + ["target_h1"])
    kept = [r["feature"] for r in S.greedy_decorrelate(feats, full, "target_h1", 0.9).collect() if r["kept"]]
    ridge = {"ridge": FC.horizon_families()["ridge"]}
    out = None
    for name, cols in (("full", full), ("filtered", kept)):
        scores, _, preds = FC.choose_per_horizon(s, cols, N_TEST, families=ridge)
        walk = E.regression_metrics(preds, by="horizon").select("horizon", "mae", "rmse", "mape", "n_obs")
        both = scores.select(F.lit("holdout").alias("half"), *walk.columns).unionByName(walk.select(F.lit("walk_forward").alias("half"), *walk.columns)) \
            .select(F.lit(name).alias("features"), F.lit(len(cols)).alias("n_features"), "*")
        out = both if out is None else out.unionByName(both)
    return out


@query("p15_adf")
def p15_adf(spark, d):
    """ADF on the level and on the first difference of every series."""
    s = daily_series(spark, d)
    lvl = FC.adf(s).withColumn("on", F.lit("level"))
    dif = FC.adf(s, difference=True).withColumn("on", F.lit("difference"))
    return lvl.unionByName(dif)


# D-06 -----------------------------------------------------------------------
@query("d06_residuals", with_sql(REGRESSION_ROWS_SQL) + f""",
f AS (SELECT regr_slope(y, quantity) AS b, regr_intercept(y, quantity) AS a FROM regression_rows WHERE NOT ({SPLIT_SQL}))
SELECT id, y AS y_true, a + b * quantity AS y_pred, y - (a + b * quantity) AS resid
FROM regression_rows, f WHERE {SPLIT_SQL}""", doubles=["y_true", "y_pred", "resid"], digits=4)
def d06_residuals(spark, d):
    """Actual, predicted and residual value of every test row for the
    least-squares line of y on quantity."""
    tr, te = _rr_split(spark, d)
    line = D.fitted_line(tr, "quantity", "y").first()
    pred = F.lit(line["intercept"]) + F.lit(line["slope"]) * F.col("quantity")
    return te.select("id", F.col("y").alias("y_true"), pred.alias("y_pred"), (F.col("y") - pred).alias("resid"))
