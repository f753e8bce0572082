"""Classical walk-forward forecasters and unit-root test per series
(R-09, R-10, R-11, P-15), plus the direct multi-horizon ML forecast (R-12, R-13).

Classical models are sequential recursions over one series, so each series is
one ``applyInPandas`` group. A group is one *aggregated daily series* — its
size is bounded by the number of calendar days covered, not by the raw data
volume — and series spread over tasks. Inside a group every model runs one
pass over the history for a whole parameter grid at once (numpy arrays over
the grid); because the in-sample squared one-step error is a running sum, the
best parameters *at each origin* come from the same pass, which equals a refit
per origin without re-running the history.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRED_SCHEMA = ("series_id string, origin_date date, target_date date, horizon int, model string, "
               "y_true double, y_pred double")

# Parameter grids of the smoothing models (seeded grid search
# replaces the maximum-likelihood optimiser).
ALPHAS = np.round(np.arange(0.05, 1.0, 0.1), 2)
BETAS = np.array([0.01, 0.05, 0.1, 0.2])
PHIS = np.array([0.8, 0.9, 0.98])
GAMMAS = np.array([0.01, 0.1, 0.3])


def _grid(*axes):
    mesh = np.meshgrid(*axes, indexing="ij")
    return [m.ravel() for m in mesh]


def _ses(y):
    a = ALPHAS
    level = np.full(a.shape, y[0])
    sse = np.zeros((len(y), a.size))
    states = np.zeros((len(y), a.size))
    states[0] = level
    for t in range(1, len(y)):
        err = y[t] - level
        sse[t] = sse[t - 1] + err * err
        level = level + a * err
        states[t] = level
    return sse, lambda t, g, h: states[t, g]


def _holt(y):
    a, b, p = _grid(ALPHAS, BETAS, PHIS)
    lvl = np.full(a.shape, y[0])
    tr = np.full(a.shape, y[1] - y[0] if len(y) > 1 else 0.0)
    sse = np.zeros((len(y), a.size))
    L = np.zeros((len(y), a.size))
    B = np.zeros((len(y), a.size))
    L[0], B[0] = lvl, tr
    for t in range(1, len(y)):
        fc = lvl + p * tr
        err = y[t] - fc
        sse[t] = sse[t - 1] + err * err
        new = fc + a * err
        tr = b * (new - lvl) + (1 - b) * p * tr
        lvl = new
        L[t], B[t] = lvl, tr

    def fc(t, g, h):
        damp = sum(p[g] ** i for i in range(1, h + 1))
        return L[t, g] + damp * B[t, g]
    return sse, fc


def _holt_winters(y, m=5):
    a, b, p, gm = _grid(ALPHAS, BETAS, PHIS, GAMMAS)
    n = len(y)
    init = y[:m].mean()
    lvl = np.full(a.shape, init)
    tr = np.zeros(a.shape)
    seas = np.tile((y[:m] - init)[:, None], (1, a.size))  # ring buffer of the last m seasonals
    sse = np.zeros((n, a.size))
    L = np.zeros((n, a.size))
    B = np.zeros((n, a.size))
    S = np.zeros((n, m, a.size))
    for t in range(n):
        s_old = seas[t % m]
        if t >= m:
            fc = lvl + p * tr + s_old
            err = y[t] - fc
            sse[t] = sse[t - 1] + err * err
            new = a * (y[t] - s_old) + (1 - a) * (lvl + p * tr)
            tr = b * (new - lvl) + (1 - b) * p * tr
            seas[t % m] = gm * (y[t] - new) + (1 - gm) * s_old
            lvl = new
        elif t > 0:
            sse[t] = sse[t - 1]
        L[t], B[t], S[t] = lvl, tr, seas

    def fc(t, g, h):
        damp = sum(p[g] ** i for i in range(1, h + 1))
        return L[t, g] + damp * B[t, g] + S[t, (t + h) % m, g]
    return sse, fc


def _ar_diff(y, t, h_max, max_p=5):
    """ARIMA(p,1,0) with p chosen by AIC, least squares on history ≤ t."""
    d = np.diff(y[: t + 1])
    best = None
    for p_ord in range(1, max_p + 1):
        if len(d) <= p_ord + 5:
            break
        X = np.column_stack([np.ones(len(d) - p_ord)] + [d[p_ord - i - 1: len(d) - i - 1] for i in range(p_ord)])
        target = d[p_ord:]
        coef, *_ = np.linalg.lstsq(X, target, rcond=None)
        rss = float(np.sum((target - X @ coef) ** 2))
        k = len(target)
        aic = k * math.log(rss / k + 1e-300) + 2 * (p_ord + 1)
        if best is None or aic < best[0]:
            best = (aic, p_ord, coef)
    if best is None:
        return [float(y[t])] * h_max
    _, p_ord, coef = best
    hist = list(d[-p_ord:])
    level = float(y[t])
    out = []
    for _ in range(h_max):
        nxt = coef[0] + sum(coef[i + 1] * hist[-i - 1] for i in range(p_ord))
        hist.append(nxt)
        level += nxt
        out.append(level)
    return out


def _trend_fourier(dates, y, t, h_max, alpha=1.0, k_year=3):
    """Trend + yearly and weekly Fourier terms, ridge fit on history ≤ t."""
    day = (dates - dates[0]).astype("timedelta64[D]").astype(float)
    dow = pd.DatetimeIndex(dates).dayofweek.to_numpy()

    def design(dd, dw):
        cols = [np.ones_like(dd), dd / 365.25]
        for k in range(1, k_year + 1):
            cols += [np.sin(2 * np.pi * k * dd / 365.25), np.cos(2 * np.pi * k * dd / 365.25)]
        cols += [np.sin(2 * np.pi * dw / 7), np.cos(2 * np.pi * dw / 7)]
        return np.column_stack(cols)
    X = design(day[: t + 1], dow[: t + 1])
    reg = alpha * np.eye(X.shape[1])
    reg[0, 0] = 0.0
    coef = np.linalg.solve(X.T @ X + reg, X.T @ y[: t + 1])
    fut = np.arange(1, h_max + 1)
    # future days step by the median spacing of the series (business days ≈ 1.4)
    step = float(np.median(np.diff(day[: t + 1]))) if t > 1 else 1.0
    fd = day[t] + fut * step
    fdw = (dow[t] + fut) % 7
    return list(design(fd, fdw) @ coef)


def classical_walk_forward(df: DataFrame, n_test: int = 40, horizons=(1, 2, 3), series: str = "series_id",
                           ts: str = "ds", value: str = "close") -> DataFrame:
    """R-09 … R-11: SES, damped Holt, damped Holt–Winters (m = 5), ARIMA(p,1,0)
    and trend + Fourier forecasts at every walk-forward origin, as one long
    prediction table. One ``applyInPandas`` group per (bounded) daily series."""
    h_max = max(horizons)

    def per_series(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ts).reset_index(drop=True)
        y = pdf[value].to_numpy(dtype=float)
        dates = pdf[ts].to_numpy(dtype="datetime64[D]")
        n = len(y)
        origins = range(max(n - n_test - 1, 1), n - h_max)
        rows = []
        smoothers = {"ses": _ses(y), "holt": _holt(y), "holt_winters": _holt_winters(y)}
        for o in origins:
            for name, (sse, fc) in smoothers.items():
                g = int(np.argmin(sse[o]))
                for h in horizons:
                    rows.append((o, h, name, float(fc(o, g, h))))
            for h, v in zip(horizons, _ar_diff(y, o, h_max)):
                rows.append((o, h, "arima", float(v)))
            for h, v in zip(horizons, _trend_fourier(dates, y, o, h_max)):
                rows.append((o, h, "trend_fourier", float(v)))
        out = pd.DataFrame(rows, columns=["o", "horizon", "model", "y_pred"])
        out["series_id"] = pdf[series].iloc[0]
        out["origin_date"] = pdf[ts].to_numpy()[out["o"]]
        out["target_date"] = pdf[ts].to_numpy()[out["o"] + out["horizon"]]
        out["y_true"] = y[out["o"] + out["horizon"]]
        return out[["series_id", "origin_date", "target_date", "horizon", "model", "y_true", "y_pred"]]

    return df.select(series, ts, value).groupBy(series).applyInPandas(per_series, PRED_SCHEMA)


# ---------------------------------------------------------------------- P-15
# Asymptotic critical values of the Dickey–Fuller t statistic
# with a constant (MacKinnon), for 1 %, 5 % and 10 %.
ADF_CRITICAL = {"1%": -3.43, "5%": -2.86, "10%": -2.57}


def adf(df: DataFrame, series: str = "series_id", ts: str = "ds", value: str = "close",
        max_lag: int = 10, difference: bool = False) -> DataFrame:
    """P-15: augmented Dickey–Fuller with a constant; the lag order is chosen
    by AIC over 0 … max_lag on a common sample; reports the t statistic of
    y_{t−1}, the lag used and rejection at the tabulated critical values."""

    def per_series(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values(ts)[value].to_numpy(dtype=float)
        if difference:
            y = np.diff(y)
        dy = np.diff(y)
        best = None
        for lag in range(0, max_lag + 1):
            start = max_lag + 1
            target = dy[start - 1:]
            cols = [np.ones(len(target)), y[start - 1:-1]]
            cols += [dy[start - 1 - i: len(dy) - i] for i in range(1, lag + 1)]
            X = np.column_stack(cols)
            coef, *_ = np.linalg.lstsq(X, target, rcond=None)
            resid = target - X @ coef
            rss = float(resid @ resid)
            nobs = len(target)
            aic = nobs * math.log(rss / nobs) + 2 * X.shape[1]
            if best is None or aic < best[0]:
                sigma2 = rss / (nobs - X.shape[1])
                cov = sigma2 * np.linalg.inv(X.T @ X)
                best = (aic, lag, coef[1] / math.sqrt(cov[1, 1]), nobs)
        _, lag, stat, nobs = best
        return pd.DataFrame([{series: pdf[series].iloc[0], "adf_stat": float(stat), "used_lag": int(lag),
                              "nobs": int(nobs), "reject_5pct": bool(stat < ADF_CRITICAL["5%"]),
                              "reject_1pct": bool(stat < ADF_CRITICAL["1%"])}])

    schema = (f"{series} string, adf_stat double, used_lag int, nobs int, reject_5pct boolean, "
              "reject_1pct boolean")
    return df.select(series, ts, value).groupBy(series).applyInPandas(per_series, schema)


# ---------------------------------------------------------------- R-12 / R-13
def direct_ml_forecast(df: DataFrame, feature_cols, n_test: int = 40, horizons=(1, 2, 3),
                       alpha: float = 1.0, series: str = "series_id", ts: str = "ds",
                       value: str = "close") -> DataFrame:
    """R-12: one ridge model per horizon on the lag/rolling features (W-01 …
    W-07), trained on every series' rows before its first origin (pooled,
    distributed fit), predicting at every walk-forward origin. Features are
    computed once; origins are a filter. R-13 is the same with a filtered
    feature list (P-11)."""
    from pyspark.ml.feature import VectorAssembler
    from tessera.operators.models import ridge
    from tessera.operators.timeseries import build_features, direct_targets, with_position
    feat = direct_targets(build_features(df, series, ts, value), series, ts, value, horizons)
    feat = with_position(feat, series, ts)
    n = feat.groupBy(series).agg(F.count(F.lit(1)).alias("__n"))
    feat = feat.join(n, on=series)
    first_origin = F.col("__n") - n_test - 1
    feat = feat.dropna(subset=list(feature_cols))        # the first rows of a series have no full window yet
    asm = VectorAssembler(inputCols=list(feature_cols), outputCol="features")
    out = None
    for h in horizons:
        tgt = f"target_h{h}"
        train = asm.transform(feat.filter((F.col("pos") + h <= first_origin) & F.col(tgt).isNotNull()))
        cnt, ystd = train.agg(F.count(F.lit(1)), F.stddev_pop(tgt)).first()
        model = ridge("features", tgt, alpha, cnt, ystd).fit(train)
        origins = feat.filter((F.col("pos") >= first_origin) & (F.col("pos") <= F.col("__n") - max(horizons) - 1))
        pred = model.transform(asm.transform(origins)).select(
            series, F.col(ts).alias("origin_date"), F.date_add(F.col(ts), 0).alias("target_date_stub"),
            F.lit(h).alias("horizon"), F.lit("ml_ridge").alias("model"),
            F.col(tgt).alias("y_true"), "y_pred", "pos")
        out = pred if out is None else out.unionByName(pred)
    dates = with_position(df.select(series, ts), series, ts).select(
        F.col(series).alias("__s"), F.col("pos").alias("__p"), F.col(ts).alias("target_date"))
    return (out.join(dates, (F.col(series) == F.col("__s")) & (F.col("__p") == F.col("pos") + F.col("horizon")))
            .select(series, "origin_date", "target_date", "horizon", "model", "y_true", "y_pred"))


def horizon_families(trees: int = 400, rounds: int = 300, step: float = 0.03, seed: int = 42) -> dict:
    """Candidate families of the per-horizon choice: name -> function of (target,
    rows, std of the target) that gives the estimator. Default sizes are those
    of the study."""
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
    from tessera.operators.models import ridge
    common = lambda y: dict(featuresCol="features", labelCol=y, predictionCol="y_pred", seed=seed)
    return {
        "ridge": lambda y, n, sd: ridge("features", y, 5.0, n, sd),
        "random_forest": lambda y, n, sd: RandomForestRegressor(
            numTrees=trees, maxDepth=6, minInstancesPerNode=3, featureSubsetStrategy="all", **common(y)),
        "gradient_boosting": lambda y, n, sd: GBTRegressor(maxIter=rounds, maxDepth=3, stepSize=step, **common(y)),
    }


def choose_per_horizon(df: DataFrame, feature_cols, n_test: int = 40, n_val: int = 40, horizons=(1, 2, 3),
                       families: dict | None = None, at_once: int = 6, series: str = "series_id", ts: str = "ds",
                       value: str = "close") -> tuple[DataFrame, DataFrame, DataFrame]:
    """R-12 with the family chosen per horizon, nested and in time order.

    A training row's target lies before the hold-out (``n_test`` last points of
    its series). The last ``n_val`` training rows of each series are the inner
    hold-out: every family is fitted on the rows whose targets lie before its
    first row and scored there. The family of the smallest MAPE (ties: name) is
    fitted again on all training rows and predicts every walk-forward origin.

    Returns (scores, chosen, predictions): scores (horizon, family, mae, rmse,
    mape, n_obs) on the inner hold-out, chosen (horizon, family), predictions
    in the long table of the walk-forward evaluation (model ``ml_<family>``).
    Features are computed once and written (in files of the advisory size, so
    that many small fits are not many small tasks); the fits, families x horizons, are
    independent and run ``at_once`` at a time over all series together. Rows
    without a full feature window take no part; a series shorter than
    ``n_test`` has no training row and no origin."""
    from multiprocessing.pool import ThreadPool
    from pyspark import inheritable_thread_target
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import Window
    from tessera.operators.evaluate import regression_metrics
    from tessera.operators.timeseries import build_features, with_position
    from tessera.session import written
    spark, feature_cols, last = df.sparkSession, list(feature_cols), max(horizons)
    families = families or horizon_families()
    w = Window.partitionBy(series).orderBy(ts)
    ahead = {f"{kind}_h{h}": F.lead(c, h).over(w) for h in horizons for kind, c in (("target", value), ("date", ts))}
    wide = with_position(build_features(df, series, ts, value).withColumns(ahead), series, ts) \
        .withColumn("__first", F.count(F.lit(1)).over(Window.partitionBy(series)) - n_test)       # first hold-out position
    asm = VectorAssembler(inputCols=feature_cols, outputCol="features")
    feat = written(asm.transform(wide.dropna(subset=feature_cols)).select(
        series, ts, "pos", "__first", "features", *ahead).hint("rebalance"), "horizon-features")
    train = lambda h: feat.filter(F.col("pos") + h < F.col("__first"))
    # the inner hold-out is the last n_val training rows; nothing before it may look into it
    inner_from = lambda h: F.col("__first") - h - n_val

    def fit(h, family, rows):
        n, sd = rows.agg(F.count(F.lit(1)), F.stddev_pop(f"target_h{h}")).first()
        return families[family](f"target_h{h}", n, sd).fit(rows)

    def score(task):
        h, family = task
        rows = train(h)
        model = fit(h, family, rows.filter(F.col("pos") + h < inner_from(h)))
        p = model.transform(rows.filter(F.col("pos") >= inner_from(h)))
        m = regression_metrics(p.select(F.col(f"target_h{h}").alias("y_true"), "y_pred")).first()
        return h, family, float(m["mae"]), float(m["rmse"]), float(m["mape"]), int(m["n_obs"])

    in_session = lambda f: inheritable_thread_target(spark)(f)
    with ThreadPool(at_once) as pool:
        scores = pool.map(in_session(score), [(h, f) for h in horizons for f in families], chunksize=1)
        chosen = {h: min((r[4], r[1]) for r in scores if r[0] == h)[1] for h in horizons}
        final = dict(zip(horizons, pool.map(in_session(lambda h: fit(h, chosen[h], train(h))), horizons, chunksize=1)))
    origins = feat.filter((F.col("pos") >= F.col("__first") - 1) & (F.col("pos") + last < F.col("__first") + n_test))
    out = None
    for h in horizons:
        p = final[h].transform(origins).select(
            series, F.col(ts).alias("origin_date"), F.col(f"date_h{h}").alias("target_date"), F.lit(h).alias("horizon"),
            F.lit(f"ml_{chosen[h]}").alias("model"), F.col(f"target_h{h}").alias("y_true"), "y_pred")
        out = p if out is None else out.unionByName(p)
    return (spark.createDataFrame(scores, "horizon int, family string, mae double, rmse double, mape double, n_obs long"),
            spark.createDataFrame(sorted(chosen.items()), "horizon int, family string"), out)
