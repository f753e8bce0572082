"""Model evaluation (E-01 … E-20).

Everything starts from a long prediction table — (id, truth, pred[, score
columns]) for classification or (id, y_true, y_pred[, group keys]) for
regression — so that metrics for any number of models, folds, horizons or
segments are one ``groupBy`` away.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.ranks import ordered_cumsum


def _by(by):
    return [by] if isinstance(by, str) else list(by)


# ---------------------------------------------------------------- E-01 / E-02
def regression_metrics(df: DataFrame, y: str = "y_true", yhat: str = "y_pred", by=(),
                       mape_percent: bool = True) -> DataFrame:
    """MAE, RMSE, R², MAPE (percent or fraction), n_obs and the count of y = 0
    (excluded from MAPE) per group, one aggregate."""
    by = _by(by)
    e = F.col(y) - F.col(yhat)
    ape = F.when(F.col(y) != 0, F.abs(e / F.col(y)))
    scale = 100.0 if mape_percent else 1.0
    return df.groupBy(*by).agg(
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.avg(e * e) / F.var_pop(y)).alias("r2"),
        (F.avg(ape) * scale).alias("mape"),
        F.count(F.lit(1)).alias("n_obs"),
        F.count_if(F.col(y) == 0).alias("n_zero_y"))


def improvement(metrics: DataFrame, baseline: DataFrame, on=(), metric: str = "rmse") -> DataFrame:
    """E-04: 1 − metric / baseline metric (joined on the group keys)."""
    on = _by(on)
    if on:
        j = metrics.join(baseline.select(*on, F.col(metric).alias("__base")), on=on, how="inner")
    else:  # one baseline number: fitted once, applied as a literal
        j = metrics.withColumn("__base", F.lit(baseline.select(metric).first()[0]))
    return j.withColumn(f"{metric}_improvement", 1 - F.col(metric) / F.col("__base")).drop("__base")


# ---------------------------------------------------------------------- E-03
def quantile_segments(df: DataFrame, col: str, q: int = 4, approx: bool = False) -> DataFrame:
    """E-03: pandas ``qcut`` segments: right-closed bins at the q-quantiles,
    duplicate edges dropped, the first bin includes the minimum.

    Edges are one aggregate (q + 1 numbers); the bin of a row is the number of
    inner edges strictly below its value, so no ``ntile`` window is needed."""
    probs = [i / q for i in range(q + 1)]
    from tessera.operators.describe import grouped_quantiles
    edges = sorted(set(grouped_quantiles(df, col, probs, (), approx, out="e").first()["e"]))
    inner = F.array(*[F.lit(float(e)) for e in edges[1:-1]])
    seg = F.size(F.filter(inner, lambda e: e < F.col(col)))
    lo = F.element_at(F.array(*[F.lit(float(e)) for e in edges]), seg + 1)
    hi = F.element_at(F.array(*[F.lit(float(e)) for e in edges]), seg + 2)
    return df.withColumn("segment", seg).withColumn("seg_lo", lo).withColumn("seg_hi", hi)


# ---------------------------------------------------------- E-06 … E-08
def confusion(df: DataFrame, truth: str = "truth", pred: str = "pred", by=()) -> DataFrame:
    """E-07: long confusion counts (by…, truth, pred, n)."""
    return df.groupBy(*_by(by), truth, pred).agg(F.count(F.lit(1)).alias("n"))


def per_class_report(df: DataFrame, truth: str = "truth", pred: str = "pred", by=()) -> DataFrame:
    """E-08: precision, recall, F1 and support per class (zero_division = 0).

    Classes are those present in truth ∪ prediction."""
    by = _by(by)
    c = confusion(df, truth, pred, by)
    t = c.groupBy(*by, F.col(truth).alias("cls")).agg(F.sum("n").alias("support"),
                                                       F.sum(F.when(F.col(truth) == F.col(pred), F.col("n"))).alias("tp"))
    p = c.groupBy(*by, F.col(pred).alias("cls")).agg(F.sum("n").alias("predicted"))
    r = t.join(p, on=by + ["cls"], how="full_outer").fillna(0, subset=["support", "tp", "predicted"])
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    r = r.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return r.withColumn("f1", f1)


def classification_metrics(df: DataFrame, truth: str = "truth", pred: str = "pred", by=()) -> DataFrame:
    """E-06: accuracy, balanced accuracy (truth classes only), macro
    precision / recall / F1 (truth ∪ prediction classes), weighted F1."""
    by = _by(by)
    r = per_class_report(df, truth, pred, by)
    return r.groupBy(*by).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
        F.sum("support").alias("n"))


# ---------------------------------------------------------------- E-09 / E-10
def _one_vs_rest(df: DataFrame, truth: str, scores: dict, by) -> DataFrame:
    """(by…, cls, score, pos) rows: one per example and class."""
    return df.select(*by, F.inline(F.array(*[
        F.struct(F.lit(k).alias("cls"), F.col(c).cast("double").alias("score"),
                 (F.col(truth) == F.lit(k)).cast("int").alias("pos")) for k, c in scores.items()])))


def roc_auc_ovr(df: DataFrame, truth: str, scores: dict, by=()) -> DataFrame:
    """E-09: one-vs-rest ROC-AUC per class by the rank-sum formula with average
    ranks (ties averaged), and the macro mean in ``by`` groups.

    ``scores`` maps a class value to its score column."""
    by = _by(by)
    cells = _one_vs_rest(df, truth, scores, by).filter("score IS NOT NULL").groupBy(*by, "cls", "score") \
        .agg(F.sum("pos").alias("tp_at"), F.count(F.lit(1)).alias("n_at"))
    rank = F.col("n_at_before") + (F.col("n_at") + 1) / 2.0
    per = ordered_cumsum(cells, "score", ["n_at"], by + ["cls"]).groupBy(*by, "cls").agg(
        F.sum(F.when(F.col("tp_at") > 0, F.col("tp_at") * rank)).alias("rank_sum"),
        F.sum("tp_at").alias("n_pos"), F.sum("n_at").alias("n"))
    n_neg = F.col("n") - F.col("n_pos")
    return per.withColumn("auc", (F.col("rank_sum") - F.col("n_pos") * (F.col("n_pos") + 1) / 2)
                          / (F.col("n_pos") * n_neg)).select(*by, "cls", "n_pos", "auc")


def average_precision(df: DataFrame, truth: str, scores: dict, by=()) -> DataFrame:
    """E-10: average precision per class: Σ (R_k − R_{k−1}) · P_k over distinct
    score thresholds from high to low (ties grouped)."""
    by = _by(by)
    ovr = _one_vs_rest(df, truth, scores, by)
    per_score = ovr.groupBy(*by, "cls", "score").agg(F.sum("pos").alias("tp_at"),
                                                     F.count(F.lit(1)).alias("n_at"))
    cum = ordered_cumsum(per_score, "score", ["tp_at", "n_at"], by + ["cls"], descending=True)
    tot = ovr.groupBy(*by, "cls").agg(F.sum("pos").alias("n_pos"))
    c = cum.join(tot, on=by + ["cls"])
    tp = F.col("tp_at_before") + F.col("tp_at")
    npred = F.col("n_at_before") + F.col("n_at")
    contrib = (F.col("tp_at") / F.col("n_pos")) * (tp / npred)
    return c.groupBy(*by, "cls").agg(F.first("n_pos").alias("n_pos"), F.sum(contrib).alias("ap"))


# ---------------------------------------------------------------------- E-13
def error_listing(df: DataFrame, truth: str, pred: str, text: str, width: int = 120) -> DataFrame:
    """E-13: misclassified rows with the text cut to ``width`` characters."""
    return df.filter(F.col(truth) != F.col(pred)) \
             .withColumn(text, F.substring(F.col(text), 1, width))


# ---------------------------------------------------------------------- E-14
def coverage_by_threshold(df: DataFrame, truth: str, pred: str, confidence: str,
                          thresholds, by=()) -> DataFrame:
    """E-14: for each confidence threshold, the share of rows covered
    (confidence ≥ t) and the accuracy among them (NULL if none).

    The thresholds are literals evaluated in one aggregate pass."""
    by = _by(by)
    ts = [float(t) for t in thresholds]
    cov = [F.count_if(F.col(confidence) >= t).alias(f"__c{i}") for i, t in enumerate(ts)]
    hit = [F.count_if((F.col(confidence) >= t) & (F.col(truth) == F.col(pred))).alias(f"__h{i}")
           for i, t in enumerate(ts)]
    one = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), *cov, *hit)
    return one.select(*by, F.inline(F.array(*[
        F.struct(F.lit(t).alias("threshold"),
                 (F.col(f"__c{i}") / F.col("__n")).alias("coverage"),
                 F.when(F.col(f"__c{i}") > 0, F.col(f"__h{i}") / F.col(f"__c{i}")).alias("accuracy"),
                 F.col(f"__c{i}").alias("n_covered"))
        for i, t in enumerate(ts)])))


# ---------------------------------------------------------------------- E-11
def paired_bootstrap_f1(df: DataFrame, truth: str, pred_a: str, pred_b: str, n_boot: int = 3000,
                        seed: int = 42, alpha: float = 0.05, metric: str = "f1_macro") -> dict:
    """E-11: paired bootstrap of macro-F1(a) − macro-F1(b); ``metric`` may also be
    ``accuracy`` or ``balanced_accuracy``.

    Resampling rows with replacement only changes how many times each
    (truth, a, b) cell is drawn, so the data work is one ``groupBy`` of the
    three labels; replicates are multinomial draws over those few cells. The
    p-value is twice the share of replicates on the other side of zero (at most
    1), and the difference is significant if p < alpha.
    """
    cells = df.groupBy(truth, pred_a, pred_b).agg(F.count(F.lit(1)).alias("n")).collect()
    keys = [(r[truth], r[pred_a], r[pred_b]) for r in cells]
    counts = np.array([r["n"] for r in cells], dtype=float)
    classes = sorted({k for t in keys for k in t if k is not None})
    n = counts.sum()
    rng = np.random.default_rng(seed)
    draws = rng.multinomial(int(n), counts / n, size=n_boot)

    def macro_f1(w, which):
        f1s = []
        for c in classes:
            tp = sum(w[..., i] for i, k in enumerate(keys) if k[0] == c and k[which] == c)
            fp = sum(w[..., i] for i, k in enumerate(keys) if k[0] != c and k[which] == c)
            fn = sum(w[..., i] for i, k in enumerate(keys) if k[0] == c and k[which] != c)
            tp, fp, fn = (np.asarray(x, dtype=float) for x in (tp, fp, fn))
            denom = 2 * tp + fp + fn
            f1s.append(np.where(denom > 0, 2 * tp / np.where(denom > 0, denom, 1), 0.0))
        return np.mean(f1s, axis=0)

    def accuracy(w, which):
        right = sum(w[..., i] for i, k in enumerate(keys) if k[0] == k[which])
        return np.asarray(right, dtype=float) / np.sum(w, axis=-1)

    def balanced(w, which):
        recalls = []
        for c in classes:
            own = np.asarray(sum(w[..., i] for i, k in enumerate(keys) if k[0] == c), dtype=float)
            hit = np.asarray(sum(w[..., i] for i, k in enumerate(keys) if k[0] == c and k[which] == c), dtype=float)
            recalls.append(np.where(own > 0, hit / np.where(own > 0, own, 1), np.nan))
        return np.nanmean(recalls, axis=0)

    score = {"f1_macro": macro_f1, "accuracy": accuracy, "balanced_accuracy": balanced}[metric]
    observed = float(score(counts, 1) - score(counts, 2))
    diffs = score(draws, 1) - score(draws, 2)
    lo, hi = np.percentile(diffs, [100 * alpha / 2, 100 * (1 - alpha / 2)])
    against = np.mean(diffs <= 0) if observed >= 0 else np.mean(diffs >= 0)
    p = min(1.0, 2 * float(against))
    return {"observed_diff": observed, "ci_low": float(lo), "ci_high": float(hi),
            "p_value": p, "significant": bool(p < alpha), "n_boot": n_boot,
            "metric": metric}


# ---------------------------------------------------------------------- E-12
# Cumulative Poisson(1) probabilities P(K <= k), k = 0 … 12.
_POISSON1_CDF = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, k + 1)) for k in range(13)])


def _splitmix64(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def poisson1_weights(ids: np.ndarray, reps: np.ndarray, seed: int) -> np.ndarray:
    """(len(ids) × len(reps)) Poisson(1) draws, a pure function of
    (row id, replicate, seed): vectorised counter-based hashing, inverse CDF."""
    with np.errstate(over="ignore"):
        key = _splitmix64(ids[:, None] * np.uint64(0x100000001B3) ^ _splitmix64(reps[None, :] + np.uint64(seed)))
    u = (key >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return np.searchsorted(_POISSON1_CDF, u, side="right").astype(np.float64)


def paired_bootstrap_rmse(df: DataFrame, y: str, pred_a: str, pred_b: str, n_boot: int = 5000,
                          seed: int = 42, alpha: float = 0.05, id_col: str = "id") -> dict:
    """E-12: paired bootstrap of RMSE(a) − RMSE(b) with Poisson(1) weights.

    Each row gets an independent Poisson(1) weight per replicate, seeded by
    (row id, seed) so the draw does not depend on partitioning; every task
    reduces its rows to per-replicate sums (Σw, Σw·e_a², Σw·e_b²) with
    ``mapInPandas`` and only those vectors are summed — the data never moves.
    p is two-sided, twice the smaller share of replicates on either side of zero
    (at most 1); significant if the interval leaves out zero.
    """
    import pandas as pd

    def part(it):
        acc = np.zeros((3, n_boot))
        reps = np.arange(n_boot, dtype=np.uint64)
        for pdf in it:
            ids = pdf[id_col].to_numpy(dtype=np.int64).astype(np.uint64)
            ea = (pdf[y] - pdf[pred_a]).to_numpy(dtype=float) ** 2
            eb = (pdf[y] - pdf[pred_b]).to_numpy(dtype=float) ** 2
            for s0 in range(0, len(ids), 256):  # bounded (256 × n_boot) blocks
                w = poisson1_weights(ids[s0:s0 + 256], reps, seed)
                acc[0] += w.sum(axis=0)
                acc[1] += ea[s0:s0 + 256] @ w
                acc[2] += eb[s0:s0 + 256] @ w
        yield pd.DataFrame({"rep": np.arange(n_boot), "w": acc[0], "sa": acc[1], "sb": acc[2]})

    sums = (df.select(id_col, y, pred_a, pred_b)
            .mapInPandas(part, "rep long, w double, sa double, sb double")
            .groupBy("rep").agg(F.sum("w").alias("w"), F.sum("sa").alias("sa"), F.sum("sb").alias("sb"))
            .collect())
    w = np.array([r["w"] for r in sums])
    ok = w > 0
    diffs = np.sqrt(np.array([r["sa"] for r in sums])[ok] / w[ok]) - \
        np.sqrt(np.array([r["sb"] for r in sums])[ok] / w[ok])
    obs = df.agg(F.sqrt(F.avg((F.col(y) - F.col(pred_a)) ** 2)).alias("a"),
                 F.sqrt(F.avg((F.col(y) - F.col(pred_b)) ** 2)).alias("b")).first()
    lo, hi = np.percentile(diffs, [100 * alpha / 2, 100 * (1 - alpha / 2)])
    return {"rmse_a": float(obs["a"]), "rmse_b": float(obs["b"]),
            "observed_diff": float(obs["a"] - obs["b"]), "ci_low": float(lo), "ci_high": float(hi),
            "p_value": min(1.0, 2 * float(min(np.mean(diffs >= 0), np.mean(diffs < 0)))),
            "significant": not lo <= 0 <= hi, "n_boot": int(ok.sum())}


def bootstrap_table(spark, result: dict) -> DataFrame:
    """One-row DataFrame of a bootstrap result."""
    keys = sorted(result)
    return spark.createDataFrame([tuple(result[k] for k in keys)], keys)


# ---------------------------------------------------------------------- E-20
def seed_stability(metrics: DataFrame, run_col: str, metric: str, tolerance: float = 0.01,
                   by=()) -> DataFrame:
    """E-20: max − min of a metric across runs (seeds) and whether it is under
    the tolerance."""
    by = _by(by)
    return metrics.groupBy(*by).agg(F.count(run_col).alias("n_runs"),
                                    (F.max(metric) - F.min(metric)).alias("spread")) \
        .withColumn("stable", F.col("spread") < tolerance)

