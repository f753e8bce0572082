"""Models (R-01 … R-13, M-01 … M-03) and model selection (V-05 … V-08,
E-15 … E-19).

Fits are Spark ML estimators (distributed gradient / tree learners) or
closed-form aggregates; every model produces the same long prediction table
so evaluation is a ``groupBy``. Driver-side loops run only over the few
configurations of a grid or the folds of a CV, never over rows.
"""

from __future__ import annotations

import math
import random
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import IDF, CountVectorizer, ElementwiseProduct, Normalizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import nan_to_null, number
from tessera.functions.hashing import row_uniform
from tessera.operators.text import tokens
from tessera.session import FIT_ROWS, written


# ------------------------------------------------------- nearest centroid
def fit_centroids(train: DataFrame, vec_col: str, label: str) -> dict:
    """Class mean vectors: ``posexplode`` + one aggregate of (classes × dims)
    averages — bounded by the model size, not the rows."""
    ex = train.select(label, F.posexplode(vec_col).alias("dim", "x"))
    rows = ex.groupBy(label, "dim").agg(F.avg(F.col("x").cast("double")).alias("m")).collect()
    cents: dict = {}
    for r in rows:
        cents.setdefault(r[label], {})[r["dim"]] = r["m"]
    return {k: [v[i] for i in range(len(v))] for k, v in sorted(cents.items())}


def centroid_predict(df: DataFrame, centroids: dict, vec_col: str, temperature: float = 0.05,
                     prefix: str = "p_") -> DataFrame:
    """Linear scores s_c = x·μ_c − ½‖μ_c‖² (nearest centroid), softmax(s / T)
    probabilities ``p_<class>``, ``pred`` = argmax (ties → smallest class),
    ``confidence`` = max probability. All JVM expressions on literal arrays."""
    x = F.col(vec_col)
    scores = {}
    for c, mu in centroids.items():
        arr = F.array(*[F.lit(float(v)) for v in mu])
        dot = F.aggregate(F.zip_with(x, arr, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v)
        scores[c] = dot - F.lit(0.5 * float(sum(v * v for v in mu)))
    out = df.select("*", *[s.alias(f"__s{c}") for c, s in scores.items()])
    mx = F.greatest(*[F.col(f"__s{c}") for c in centroids])
    den = sum(F.exp((F.col(f"__s{c}") - mx) / temperature) for c in centroids)
    out = out.select("*", *[(F.exp((F.col(f"__s{c}") - mx) / temperature) / den).alias(f"{prefix}{c}")
                            for c in centroids])
    pred = F.coalesce(*[F.when(F.col(f"__s{c}") == mx, F.lit(c)) for c in centroids])
    return out.withColumn("pred", pred).withColumn("confidence", F.greatest(*[F.col(f"{prefix}{c}") for c in centroids])) \
              .drop(*[f"__s{c}" for c in centroids])


# ---------------------------------------------------------------- baselines
def majority_class(train: DataFrame, label: str):
    """M-03: the most frequent training class (ties → smallest)."""
    return train.groupBy(label).agg(F.count(F.lit(1)).alias("n")) \
        .agg(F.min_by(label, F.struct(-F.col("n"), F.col(label)))).first()[0]


def mean_baseline(train: DataFrame, y: str) -> float:
    """R-01: training mean of the target."""
    return float(train.agg(F.avg(y)).first()[0])


# ---------------------------------------------------------------- R-02 … R-06
def ridge(features, label: str, alpha: float, n: int, y_std_pop: float, fit_intercept: bool = True):
    """R-02: sklearn's Ridge objective ‖y − Xw‖² + α‖w‖² with Spark's normal
    solver: Spark scales the loss by 1/(2n) and the label by its std, so
    regParam = α · std_pop(y) / n reproduces the closed form."""
    reg = alpha * y_std_pop / n if alpha > 0 else 0.0
    return LinearRegression(featuresCol=features, labelCol=label, predictionCol="y_pred",
                            solver="normal", elasticNetParam=0.0, regParam=reg,
                            standardization=False, fitIntercept=fit_intercept)


def regressors(label: str = "y", features: str = "features", seed: int = 42) -> dict:
    """R-03 … R-05 defaults (trees are binned in Spark: close, not equal)."""
    return {
        "tree": DecisionTreeRegressor(featuresCol=features, labelCol=label, predictionCol="y_pred",
                                      maxDepth=5, seed=seed),
        "forest": RandomForestRegressor(featuresCol=features, labelCol=label, predictionCol="y_pred",
                                        numTrees=40, maxDepth=8, featureSubsetStrategy="all", seed=seed),
        "gbt": GBTRegressor(featuresCol=features, labelCol=label, predictionCol="y_pred",
                            maxIter=30, maxDepth=3, stepSize=0.1, subsamplingRate=1.0, seed=seed),
    }


def scaled_features(train: DataFrame, other: list[DataFrame], cols, out: str = "features"):
    """C-00 fitted on train (ddof 0), applied to every frame, then assembled.
    No row goes: a null or NaN feature takes the training mean (scaled: 0)."""
    from tessera.operators.cluster import fit_scaler, standardise
    floating = {f.name for f in train.schema.fields if f.dataType.typeName() in ("float", "double")}.intersection(cols)
    params = fit_scaler(nan_to_null(train, floating) if floating else train, cols, ddof=0)
    asm = VectorAssembler(inputCols=list(cols), outputCol=out)

    def tf(df):
        keep = [c for c in df.columns if c not in cols]
        scaled = standardise(df, cols, params, keep=keep)
        filled = {c: F.coalesce(F.nanvl(F.col(c), F.lit(None).cast("double")), F.lit(0.0)) for c in cols}
        return asm.transform(scaled.withColumns(filled))
    return tf(train), [tf(o) for o in other], params


def fit_many(train: DataFrame, test: DataFrame, cols, y: str = "y", id_col: str = "id",
             alpha: float = 1.0, seed: int = 42) -> DataFrame:
    """R-06: fit the baseline, linear, ridge and tree models on the same
    (scaled) training rows; one long prediction table (model, id, y_true, y_pred)."""
    tr, (te,), _ = scaled_features(train, [test], cols)
    tr = tr.persist()
    n, ystd = tr.agg(F.count(F.lit(1)), F.stddev_pop(y)).first()
    preds = [te.select(F.lit("mean").alias("model"), id_col, F.col(y).alias("y_true"),
                       F.lit(mean_baseline(tr, y)).alias("y_pred"))]
    models = {"linear": ridge("features", y, 0.0, n, ystd), "ridge": ridge("features", y, alpha, n, ystd)}
    models.update(regressors(y, "features", seed))
    for name, est in models.items():
        m = est.fit(tr)
        preds.append(m.transform(te).select(F.lit(name).alias("model"), id_col, F.col(y).alias("y_true"), "y_pred"))
    tr.unpersist()
    out = preds[0]
    for p in preds[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- V-05 / E-19
def cross_validate(df: DataFrame, cols, make_estimators, y: str = "y", id_col: str = "id", k: int = 5,
                   seed: int = 42, at_once: int = 3) -> DataFrame:
    """V-05: k folds (hash assignment); features are re-fitted inside every
    fold; returns the per-fold metric table (model, fold, rmse, mae, r2).
    Folds are independent and run ``at_once`` at a time."""
    from tessera.operators.evaluate import regression_metrics
    from tessera.operators.splits import kfold
    folded = kfold(df, id_col, k, seed).persist()

    def one(f):
        tr, (te,), _ = scaled_features(folded.filter(F.col("fold") != f), [folded.filter(F.col("fold") == f)], cols)
        n, ystd = tr.agg(F.count(F.lit(1)), F.stddev_pop(y)).first()
        return [est.fit(tr).transform(te).select(F.lit(name).alias("model"), F.lit(f).alias("fold"),
                                                 F.col(y).alias("y_true"), "y_pred")
                for name, est in make_estimators(n, ystd).items()]

    with ThreadPool(at_once) as pool:
        parts = [p for fold in pool.map(inheritable_thread_target(df.sparkSession)(one), range(k)) for p in fold]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    per = regression_metrics(rows, by=["model", "fold"], mape_percent=False)
    table = df.sparkSession.createDataFrame(per.collect(), per.schema)    # models x folds rows
    folded.unpersist()
    return table


def cross_validate_text(df: DataFrame, id_col: str, text: str, label: str, k: int = 5, seed: int = 42,
                        vocab_size: int = 5000, C: float = 5.0, at_once: int = 3, vocabularies: dict | None = None) -> DataFrame:
    """V-05 for the text classifier: (fold, n_train, n_test, vocabulary,
    accuracy, balanced_accuracy, f1_macro, f1_weighted), stratified folds.

    Vocabulary, IDF, class weights and the classifier are fitted again inside
    every fold on its training rows, so nothing of a held-out fold reaches its
    model; a class that a fold never trains on counts as a miss there. Folds are
    independent and run ``at_once`` at a time. Rows without text or label take
    no part. Texts are tokenised once, all folds read the written tokens.
    ``vocabularies`` (if given) receives each fold's term list."""
    from tessera.operators.evaluate import classification_metrics
    from tessera.operators.splits import kfold
    from tessera.operators.text import encode, label_encoder
    full = df.dropna(subset=[text, label]).select(id_col, text, label)
    enc = encode(full, label, label_encoder(full, label))
    folded = written(kfold(enc, id_col, k, seed, label=label).select(tokens(text).alias(text), "label_idx", "fold"), "v05-text-folds", TEXT_ROWS)

    def one(f):
        tr, te = folded.filter(F.col("fold") != f), folded.filter(F.col("fold") == f)
        cv, model = fit_text_classifier(tr, text, "label_idx", vocab_size, C=C)
        if vocabularies is not None:
            vocabularies[f] = list(cv.vocabulary)
        p = predict_text(cv, model, te, text).select(F.col("label_idx").cast("int").alias("truth"),
                                                     F.col("prediction").cast("int").alias("pred"))
        m = classification_metrics(p).first()
        return (f, tr.count(), m["n"], len(cv.vocabulary), m["accuracy"], m["balanced_accuracy"], m["f1_macro"], m["f1_weighted"])

    with ThreadPool(at_once) as pool:
        rows = pool.map(inheritable_thread_target(df.sparkSession)(one), range(k))
    return df.sparkSession.createDataFrame(rows, "fold int, n_train long, n_test long, vocabulary int, accuracy double, "
                                                 "balanced_accuracy double, f1_macro double, f1_weighted double")


def ridge_cv(df: DataFrame, cols, alphas, y: str = "y", id_col: str = "id", k: int = 5, seed: int = 42) -> list[tuple]:
    """V-05 for any number of ridge penalties in two passes over the rows.

    Each fold's count, sums and products of (features, target), centred on the
    column means, are one row of an aggregate. The sums of the other folds give
    a fold's training scaler and normal equations, its own sums the squared
    error: the same folds, scaling and objective as :func:`cross_validate`.
    Null and NaN features take the column's training mean there; here rows with
    one are not accepted, so fill them first. Returns (alpha, mean and population
    std of RMSE, mean R²)."""
    from tessera.operators.splits import kfold
    names = [*cols, y]
    shift = df.agg(*[F.avg(c) for c in names]).first()
    z = [F.col(c).cast("double") - F.lit(float(m)) for c, m in zip(names, shift)]
    d = len(names)
    parts = [F.count(F.lit(1)), *[F.sum(x) for x in z], *[F.sum(z[i] * z[j]) for i in range(d) for j in range(i, d)]]
    folds = kfold(df, id_col, k, seed).groupBy("fold").agg(*[p.alias(f"s{i}") for i, p in enumerate(parts)]).collect()

    def moments(v):
        full = np.zeros((d, d))
        full[np.triu_indices(d)] = v[1 + d:]
        return v[0], v[1:1 + d], full + np.triu(full, 1).T

    sums = {r["fold"]: np.array(list(r)[1:], float) for r in folds}
    total = sum(sums.values())
    out = []
    for alpha in alphas:
        rmse, r2 = [], []
        for v in sums.values():
            n, s, g = moments(total - v)
            mean = s / n
            cov = g / n - np.outer(mean, mean)
            std = np.sqrt(np.diag(cov)[:-1])
            std[std == 0] = 1.0
            w = np.linalg.solve(n * cov[:-1, :-1] / np.outer(std, std) + alpha * np.eye(d - 1),
                                n * cov[:-1, -1] / std) / std
            m, s, g = moments(v)
            c = np.append(-w, 1.0)                  # residual = c . (z - mean)
            centred = g - np.outer(s, mean) - np.outer(mean, s) + m * np.outer(mean, mean)
            sse = float(c @ centred @ c)
            rmse.append(math.sqrt(max(sse, 0.0) / m))
            r2.append(1 - sse / float(g[-1, -1] - s[-1] ** 2 / m))
        out.append((float(alpha), float(np.mean(rmse)), float(np.std(rmse)), float(np.mean(r2))))
    return out


def ridge_over_seeds(df: DataFrame, cols, variants: dict, alpha: float, seeds, y: str = "y", id_col: str = "id",
                     test_size: float = 0.2) -> DataFrame:
    """Held-out predictions (seed, variant, y_true, y_pred, scaled ``cols``) of
    one ridge per seed and variant, for any number of rows in four passes.

    A seed holds out the rows whose draw lies below ``test_size``; a variant is
    a condition on the rows that take part. Scaling, filling and objective are
    those of :func:`scaled_features` and :func:`ridge`: they follow from counts,
    sums and products, which one aggregate takes for every combination of seeds
    and variants that rows fall into (2 ^ (seeds + variants) at most); columns
    with missing values bring a marker column into the products. A held-out row
    is then predicted once for every fit that it was kept from."""
    cols, seeds = list(cols), list(seeds)
    bits = lambda conditions: sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions)), F.lit(0))
    out = bits([row_uniform(id_col, s) < test_size for s in seeds])
    data = written(df.select(*[number(c).alias(c) for c in [*cols, y]], out.alias("__out"),
                             bits([F.coalesce(c, F.lit(False)) for c in variants.values()]).alias("__in")), "ridge-seeds", FIT_ROWS)
    facts = data.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in [*cols, y] for f in (F.avg, F.count)]).first()
    if facts[f"count_{y}"] < facts["n"]:
        raise ValueError(f"rows without {y}")
    at = {c: facts[f"avg_{c}"] or 0.0 for c in [*cols, y]}
    gaps = [c for c in cols if facts[f"count_{c}"] < facts["n"]]
    v = [F.lit(1.0), *[F.coalesce(F.col(c) - F.lit(at[c]), F.lit(0.0)) for c in cols], F.col(y) - F.lit(at[y]),
         *[F.col(c).isNull().cast("double") for c in gaps]]
    d = len(v)
    sums = data.groupBy("__out", "__in").agg(*[F.sum(v[i] * v[j]) for i in range(d) for j in range(i, d)]).collect()
    fits = []
    for si, seed in enumerate(seeds):
        for vi, variant in enumerate(variants):
            g = np.zeros((d, d))
            g[np.triu_indices(d)] = sum((np.array(list(r)[2:], float) for r in sums
                                         if not r["__out"] >> si & 1 and r["__in"] >> vi & 1), np.zeros(d * (d + 1) // 2))
            g = g + np.triu(g, 1).T
            n, to = g[0, 0], np.zeros((len(cols), d))
            if not n:
                raise ValueError(f"no training rows for seed {seed}, {variant}")
            means, stds = [], []
            for j, c in enumerate(cols):
                m = 1 + len(cols) + 1 + gaps.index(c) if c in gaps else None
                held = n - (g[0, m] if m else 0.0)
                mean = g[0, 1 + j] / held if held else 0.0
                std = math.sqrt(max(g[1 + j, 1 + j] / held - mean * mean, 0.0)) if held else 0.0
                std = std or 1.0
                to[j, 1 + j], to[j, 0] = 1 / std, -mean / std
                if m:
                    to[j, m] = mean / std
                means.append(float(mean + at[c]))
                stds.append(float(std))
            ybar = g[0, 1 + len(cols)] / n
            ty = np.zeros(d)
            ty[1 + len(cols)], ty[0] = 1.0, -ybar
            w = np.linalg.solve(to @ g @ to.T + alpha * np.eye(len(cols)), to @ g @ ty)
            scaled = [F.coalesce((F.col(c) - F.lit(a)) / F.lit(b), F.lit(0.0)) for c, a, b in zip(cols, means, stds)]
            pred = sum((x * F.lit(float(b)) for x, b in zip(scaled, w)), F.lit(float(ybar + at[y])))
            held = (F.col("__out").bitwiseAND(1 << si) != 0) & (F.col("__in").bitwiseAND(1 << vi) != 0)
            fits.append(F.when(held, F.struct(F.lit(seed).alias("seed"), F.lit(variant).alias("variant"), F.col(y).alias("y_true"),
                                              pred.alias("y_pred"), *[x.alias(c) for x, c in zip(scaled, cols)])))
    return data.filter("__out <> 0").select(F.explode(F.filter(F.array(*fits), lambda x: x.isNotNull())).alias("p")).select("p.*")


def cv_summary(per_fold: DataFrame) -> DataFrame:
    """V-05: mean ± std (ddof 0) per model, ordered by mean RMSE (V-08)."""
    return per_fold.groupBy("model").agg(F.avg("rmse").alias("rmse_mean"), F.stddev_pop("rmse").alias("rmse_std"),
                                         F.avg("mae").alias("mae_mean"), F.avg("r2").alias("r2_mean"))


def random_search(df: DataFrame, cols, y: str, id_col: str, n_trials: int = 30, k: int = 5,
                  seed: int = 42, gbt_trials: int | None = None, gbt_rounds: int = 100) -> DataFrame:
    """V-07: seeded log-uniform draws of the ridge α and GBT step size, all
    scored on one fold assignment; (model, rmse_mean, rmse_std, r2_mean, family)
    rows. All ridge trials share two passes (:func:`ridge_cv`), all GBT trials
    the cells of their folds (:func:`~tessera.operators.boosting.boosted_scores`;
    one Spark fit per trial and fold where cells are too many for a task)."""
    from tessera.operators.boosting import boosted_scores
    rng = random.Random(seed)
    alphas = [10 ** rng.uniform(-3, 3) for _ in range(n_trials)]
    steps = [10 ** rng.uniform(-2, -0.3) for _ in range(n_trials if gbt_trials is None else gbt_trials)]
    scored = [(f"ridge|alpha={a:.6g}", *rest) for a, *rest in ridge_cv(df, cols, alphas, y, id_col, k, seed)]
    boosted = boosted_scores(df, cols, y, id_col, steps, gbt_rounds, k, seed) if steps else []
    scored += [(f"gbt|step={s:.4g}", *rest) for s, *rest in boosted or []]
    out = df.sparkSession.createDataFrame(scored, "model string, rmse_mean double, rmse_std double, r2_mean double")
    if boosted is None:
        gbt = lambda n, ystd: {f"gbt|step={s:.4g}": GBTRegressor(
            featuresCol="features", labelCol=y, predictionCol="y_pred", maxIter=gbt_rounds, maxDepth=3,
            stepSize=s, seed=seed) for s in steps}
        out = out.unionByName(cv_summary(cross_validate(df, cols, gbt, y, id_col, k, seed)).select(*out.columns))
    return out.withColumn("family", F.split("model", r"\|")[0])


def select_best(summary: DataFrame) -> DataFrame:
    """V-08 / K-04: best configuration per family by CV RMSE (not test score)."""
    return summary.groupBy("family").agg(F.min_by("model", F.struct("rmse_mean", "model")).alias("best"),
                                         F.min("rmse_mean").alias("cv_rmse"))


# ---------------------------------------------------------------- E-16 … E-18
def coefficient_table(model, cols) -> list[tuple[str, float]]:
    """E-16: signed coefficients (linear) or importances (trees)."""
    vals = model.coefficients.toArray() if hasattr(model, "coefficients") else model.featureImportances.toArray()
    return list(zip(cols, [float(v) for v in vals]))


def _shuffles(n: int, repeats: int, seed: int) -> list[tuple[int, int]]:
    """(a, b) of maps i -> (a i + b) mod n that permute 0 … n − 1 and leave at
    most one place in a hundred (at least two) where it is."""
    rng = random.Random(seed)
    out = []
    while len(out) < repeats:
        a = rng.randrange(1, max(2, min(n, 2 ** 62 // max(n, 1))))
        if n < 3 or (math.gcd(a, n) == 1 and math.gcd(a - 1, n) <= max(2, n // 100)):
            out.append((a, rng.randrange(max(n, 1))))
    return out


def permutation_importance(model, test: DataFrame, cols, y: str, id_col: str, repeats: int = 30,
                           seed: int = 42) -> DataFrame:
    """E-17: RMSE rise when one feature is shuffled, mean and std over repeats.

    Rows are numbered once by a seeded hash order (a bucketed running count, so
    no task sorts all rows). A repeat is an affine permutation of the numbers:
    row i takes the feature's value of row (a i + b) mod n. One join on the
    number serves every feature and repeat, one pass predicts them all."""
    from tessera.functions.hashing import row_hash
    from tessera.functions.ranks import ordered_cumsum
    from tessera.operators.evaluate import regression_metrics
    cols = list(cols)
    whole = regression_metrics(model.transform(test).select(F.col(y).alias("y_true"), "y_pred")).first()
    base, n = whole["rmse"], whole["n_obs"]
    hashed = test.select(id_col, F.col(y).alias("y_true"), *cols, row_hash(id_col, seed).alias("__h"), F.lit(1).alias("__one"))
    rows = ordered_cumsum(hashed, "__h", ["__one"], tie=id_col).withColumnRenamed("__one_before", "__r")
    maps = F.array(*[F.struct(F.lit(r).alias("repeat"), F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"))
                     for r, (a, b) in enumerate(_shuffles(n, repeats, seed))])
    takers = rows.select("y_true", *cols, "__r", F.explode(maps).alias("m")) \
        .withColumn("__from", F.pmod(F.col("m.a") * F.col("__r") + F.col("m.b"), F.lit(n).cast("long")))
    givers = rows.select(F.col("__r").alias("__from"), *[F.col(c).alias(f"__v_{c}") for c in cols])
    each = takers.join(givers, "__from").withColumn("feature", F.explode(F.array(*[F.lit(c) for c in cols])))
    swapped = each.select("feature", F.col("m.repeat").alias("repeat"), "y_true", *[
        F.when(F.col("feature") == c, F.col(f"__v_{c}")).otherwise(F.col(c)).alias(c) for c in cols])
    p = model.transform(VectorAssembler(inputCols=cols, outputCol="features").transform(swapped))
    per = regression_metrics(p, by=["feature", "repeat"]).withColumn("rise", F.col("rmse") - F.lit(base))
    return per.groupBy("feature").agg(F.avg("rise").alias("importance_mean"),
                                      F.stddev_pop("rise").alias("importance_std"))


def linear_attribution(df: DataFrame, coefs: dict, means: dict, by=()) -> DataFrame:
    """E-18: β_j · (x_j − mean_j) per row (exact additive attribution for a
    linear model with independent features) and its mean |value| per feature."""
    long = df.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), (F.lit(b) * (F.col(c) - F.lit(means[c]))).alias("phi"))
        for c, b in coefs.items()])))
    return long.groupBy(*by, "feature").agg(F.avg(F.abs("phi")).alias("mean_abs_attribution"))


# ---------------------------------------------------------------- M-01 / M-02
TEXT_ROWS = 5_000            # rows a file of texts or of their term counts


def text_logistic_pipeline(text: str, label: str, vocab_size: int = 5000, min_df: float = 1.0,
                           C: float = 1.0, n_train: int = 1, weight_col: str | None = None,
                           idf: list | None = None) -> Pipeline:
    """M-01 on TF-IDF: tokens → counts (CountVectorizer) → × smoothed IDF
    (ElementwiseProduct) → L2 rows (Normalizer) → multinomial logistic
    regression with sklearn's C mapped to regParam = 1 / (C · n)."""
    stages = []
    if idf is not None:
        stages.append(ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="tf", outputCol="tfidf"))
    stages.append(Normalizer(p=2.0, inputCol="tfidf" if idf is not None else "tf", outputCol="features"))
    lr = LogisticRegression(featuresCol="features", labelCol=label, family="multinomial",
                            regParam=1.0 / (C * n_train), elasticNetParam=0.0, standardization=False,
                            maxIter=200, tol=1e-8)
    if weight_col:
        lr = lr.setWeightCol(weight_col)
    stages.append(lr)
    return Pipeline(stages=stages)


def _tokens(df: DataFrame, text: str):
    """The tokens of a text column, or the column itself where it holds tokens already."""
    return F.col(text) if df.schema[text].dataType.typeName() == "array" else tokens(text)


def fit_text_classifier(train: DataFrame, text: str, label_idx: str, vocab_size: int = 5000,
                        C: float = 5.0, balanced: bool = True):
    """M-01: fit CountVectorizer on train tokens, the smoothed IDF from its
    document frequencies, then the weighted multinomial logistic regression."""
    tok = train.select(label_idx, _tokens(train, text).alias("__tok"))
    cv = CountVectorizer(inputCol="__tok", outputCol="tf", vocabSize=vocab_size, minDF=1.0).fit(tok)
    # IDF, class weights and the classifier read the counts, none the texts
    data = written(cv.transform(tok).select(label_idx, "tf"), "m01-counts", TEXT_ROWS)
    counted = IDF(inputCol="tf", outputCol="__idf").fit(data)
    n = int(counted.numDocs)
    idf = [math.log((1 + n) / (1 + int(d))) + 1 for d in counted.docFreq]
    if balanced:
        counts = {r[label_idx]: r["count"] for r in data.groupBy(label_idx).count().collect()}
        k = len(counts)
        wmap = F.create_map(*[x for c, m in counts.items() for x in (F.lit(c), F.lit(n / (k * m)))])
        data = data.withColumn("__w", wmap[F.col(label_idx)])
    pipe = text_logistic_pipeline(text, label_idx, vocab_size, C=C, n_train=n,
                                  weight_col="__w" if balanced else None, idf=idf)
    model = pipe.fit(data)
    return cv, model


def predict_text(cv, model, df: DataFrame, text: str) -> DataFrame:
    out = model.transform(cv.transform(df.withColumn("__tok", _tokens(df, text))))
    return out.withColumn("prob", vector_to_array("probability")).drop("__tok", "tf", "tfidf", "features",
                                                                       "rawPrediction", "probability")


def linear_vector_classifier(train: DataFrame, vec: str, label_idx: str, C: float = 1.0, max_iter: int = 2000):
    """M-01 on an array column, without class weights: sklearn's C as regParam = 1 / (C · n)."""
    data = train.select(array_to_vector(F.col(vec).cast("array<double>")).alias("features"), F.col(label_idx).cast("double").alias("label"))
    return LogisticRegression(family="multinomial", regParam=1.0 / (C * train.count()), elasticNetParam=0.0,
                              standardization=False, maxIter=max_iter, tol=1e-8).fit(data)


def compare_vector_sets(sets: dict, rows: DataFrame, id_col: str, label: str, vec: str, split: str = "split",
                        C: float = 1.0, at_once: int = 2) -> DataFrame:
    """X-08: (representation, dims, n_train, n_test, accuracy, f1_macro), one row
    per set of ``sets`` (name → table of ``id_col`` and ``vec``), in macro F1 order.

    One linear classifier a set, fitted on the ``train`` rows and scored on the
    ``test`` rows of ``rows`` (``id_col``, ``label``, ``split``), so sets differ in
    their vectors only. A row without a label takes no part; one without a vector in
    some set is an error. Sets are fitted ``at_once`` at a time."""
    from tessera.operators.evaluate import classification_metrics
    from tessera.operators.text import encode, label_encoder
    from tessera.sources.tables import align_embeddings
    rows = rows.dropna(subset=[label]).select(id_col, label, split)
    rows = encode(rows, label, label_encoder(rows, label), "__y").select(id_col, split, "__y")

    def one(item):
        name, vectors = item
        data = written(align_embeddings(rows, vectors.select(id_col, vec), id_col), "x08-set")
        train, test = data.filter(F.col(split) == "train"), data.filter(F.col(split) == "test")
        model = linear_vector_classifier(train, vec, "__y", C)
        p = model.transform(test.withColumn("features", array_to_vector(F.col(vec).cast("array<double>")))) \
            .select(F.col("__y").alias("truth"), F.col("prediction").cast("int").alias("pred"))
        m = classification_metrics(p).first()
        return name, model.numFeatures, train.count(), m["n"], m["accuracy"], m["f1_macro"]

    with ThreadPool(at_once) as pool:
        out = pool.map(inheritable_thread_target(rows.sparkSession)(one), sets.items())
    return rows.sparkSession.createDataFrame(out, "representation string, dims int, n_train long, n_test long, "
                                                  "accuracy double, f1_macro double").orderBy(F.desc("f1_macro"), "representation")


def top_words(cv, model, n: int = 10) -> list[tuple]:
    """E-15: words with the largest and smallest weights per class (the
    coefficient matrix is classes × vocabulary, read from the model)."""
    lr = model.stages[-1]
    coef = lr.coefficientMatrix.toArray()
    out = []
    for ci in range(coef.shape[0]):
        order = np.argsort(-coef[ci])
        for rank, j in enumerate(order[:n]):
            out.append((int(ci), "for", rank + 1, cv.vocabulary[j], float(coef[ci, j])))
        for rank, j in enumerate(order[::-1][:n]):
            out.append((int(ci), "against", rank + 1, cv.vocabulary[j], float(coef[ci, j])))
    return out


def embedding_forest(train: DataFrame, vec_col: str, label: str, seed: int = 42, trees: int = 50):
    """M-02: random forest on dense embedding vectors."""
    data = train.withColumn("features", array_to_vector(F.col(vec_col).cast("array<double>")))
    return RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=8,
                                  seed=seed).fit(data)



def fit_bins(train: DataFrame, vec_col: str, bins: int = 32) -> list[list[float]]:
    """Up to ``bins`` − 1 ascending distinct quantile cuts of every dimension of
    an array column: one aggregate per dimension, so the fit is model-sized."""
    probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    rows = train.select(F.posexplode(vec_col).alias("dim", "x")).groupBy("dim") \
        .agg(F.array_sort(F.array_distinct(F.percentile_approx(F.col("x").cast("double"), probs, 100 * bins))).alias("cuts")).collect()
    cuts = {r["dim"]: r["cuts"] for r in rows}
    return [cuts[i] for i in range(len(cuts))]


def binned(df: DataFrame, vec_col: str, cuts: list, out: str = "features") -> DataFrame:
    """``df`` with the bin numbers of ``vec_col`` as an ML vector: how many of a
    dimension's cuts lie below the value (a null or NaN value: bin 0)."""
    grid = F.array(*[F.array(*[F.lit(float(c)) for c in dim]) for dim in cuts])
    place = F.zip_with(F.col(vec_col), grid, lambda x, c: F.size(F.filter(
        c, lambda edge: edge < F.nanvl(x.cast("double"), F.lit(None).cast("double")))).cast("double"))
    return df.withColumn(out, array_to_vector(place))


def forest_classifier(train: DataFrame, label: str, features: str = "features", trees: int = 300, depth: int = 15,
                      seed: int = 42):
    """M-02, forest family at the study's size. Spark bounds the depth: trees
    stop at ``depth`` levels instead of growing until pure."""
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=trees, maxDepth=depth, seed=seed).fit(train)


def boosted_classifier(train: DataFrame, label: str, features: str = "features", rounds: int = 100, depth: int = 5,
                       step: float = 0.1, bins: int = 32, at_once: int = 8, seed: int = 42):
    """M-02, boosting family: one boosted ensemble per class against the rest,
    ``at_once`` classes side by side on the one feature table; the class with
    the largest margin wins. ``label`` holds 0 … k − 1 (X-02).

    Features that went through :func:`binned` have at most ``bins`` values, so
    every class fit cuts at the same places."""
    from tessera.session import checkpoint_dir
    checkpoint_dir(train.sparkSession)       # long ensembles cut their lineage there
    base = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=step, maxBins=bins, seed=seed)
    return OneVsRest(classifier=base, featuresCol=features, labelCol=label, parallelism=at_once).fit(train)
