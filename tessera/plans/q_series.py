"""Queries: time-series features, diagnostics and walk-forward evaluation
(W-*, J-07, V-09, V-10, R-07, R-08, E-02, E-05, A-07, P-16 … P-18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import evaluate as E
from tessera.operators import timeseries as T
from tessera.operators.describe import pivot_wide
from tessera.plans.bindings import DAILY_SERIES_SQL, daily_series, with_sql
from tessera.plans.registry import query

DS = with_sql(DAILY_SERIES_SQL)
N_TEST = 40
W = "PARTITION BY series_id ORDER BY ds"

_FEATURES_SQL = DS + """
SELECT series_id, ds, """ + ",\n".join(
    [f"lag(close, {k}) OVER (w) AS lag_{k}" for k in T.LAGS] +
    [f"CASE WHEN count(close) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) = {n} "
     f"THEN avg(close) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) END AS roll_mean_{n},\n"
     f"CASE WHEN count(close) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) = {n} "
     f"THEN stddev_samp(close) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) END AS roll_std_{n}"
     for n in T.WINDOWS] +
    ["lag(close, 1) OVER (w) / lag(close, 2) OVER (w) - 1 AS return_1",
     "lag(close, 1) OVER (w) / lag(close, 6) OVER (w) - 1 AS return_5",
     "CAST(isodow(ds) - 1 AS INTEGER) AS dow", "CAST(dayofmonth(ds) AS INTEGER) AS day",
     "CAST(month(ds) AS INTEGER) AS month", "lag(volume, 1) OVER (w) AS volume_lag1"]) + f"""
FROM daily_series WINDOW w AS ({W})"""

_FEATURE_DOUBLES = [f"lag_{k}" for k in T.LAGS] + [f"roll_{s}_{n}" for n in T.WINDOWS for s in ("mean", "std")] \
    + ["return_1", "return_5"]


# W-01 … W-08 ----------------------------------------------------------------
@query("w02_rolling_features", _FEATURES_SQL, doubles={c: "b10" for c in _FEATURE_DOUBLES})
def w02_rolling_features(spark, d):
    f = T.build_features(daily_series(spark, d))
    return f.select("series_id", "ds", *T.feature_columns())


# W-07 -----------------------------------------------------------------------
@query("w07_direct_targets", DS + f"""
SELECT series_id, ds, lead(close, 1) OVER (w) AS target_h1, lead(close, 2) OVER (w) AS target_h2,
       lead(close, 3) OVER (w) AS target_h3 FROM daily_series WINDOW w AS ({W})""",
       doubles=["target_h1", "target_h2", "target_h3"])
def w07_direct_targets(spark, d):
    return T.direct_targets(daily_series(spark, d)).drop("close", "volume")


# W-04 / W-09 ----------------------------------------------------------------
@query("w04_returns_gaps", DS + f"""
SELECT series_id, ds, close / lag(close) OVER (w) - 1 AS ret, close - lag(close) OVER (w) AS diff,
       CAST(date_diff('day', lag(ds) OVER (w), ds) AS INTEGER) AS gap_days
FROM daily_series WINDOW w AS ({W})""", doubles=["ret", "diff"])
def w04_returns_gaps(spark, d):
    return T.returns(daily_series(spark, d)).drop("close", "volume")


# W-10 -----------------------------------------------------------------------
@query("w10_return_shocks", DS + f""",
r AS (SELECT series_id, ds, close / lag(close) OVER (w) - 1 AS ret FROM daily_series WINDOW w AS ({W})),
s AS (SELECT series_id, stddev_samp(ret) AS ret_std FROM r GROUP BY 1)
SELECT r.series_id, ds, ret, ret_std FROM r JOIN s USING (series_id) WHERE abs(ret) > 4 * ret_std""",
       doubles=["ret", "ret_std"])
def w10_return_shocks(spark, d):
    return T.return_shocks(daily_series(spark, d), k=4.0).select("series_id", "ds", "ret", "ret_std")


# W-12 / V-09 ----------------------------------------------------------------
@query("w12_holdout_tail", DS + f"""
SELECT series_id, ds, close FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS rn FROM daily_series)
WHERE rn <= {N_TEST}""", doubles=["close"])
def w12_holdout_tail(spark, d):
    return T.tail_rows(daily_series(spark, d), N_TEST).select("series_id", "ds", "close")


# V-10 / J-07 / R-07 / R-08 --------------------------------------------------
_WF_SQL = DS + f""",
p AS (SELECT series_id, ds, close, row_number() OVER ({W}) - 1 AS pos,
             count(*) OVER (PARTITION BY series_id) AS n FROM daily_series),
o AS (SELECT series_id, pos AS origin_pos, ds AS origin_date, close AS naive, h.horizon
      FROM p, (VALUES (1), (2), (3)) h(horizon)
      WHERE pos >= n - {N_TEST} - 1 AND pos <= n - 3 - 1)
SELECT o.series_id, o.origin_pos, o.origin_date, a.ds AS target_date, CAST(o.horizon AS INTEGER) AS horizon,
       a.close AS y_true, o.naive, s.close AS seasonal_naive
FROM o JOIN p a ON a.series_id = o.series_id AND a.pos = o.origin_pos + o.horizon
LEFT JOIN p s ON s.series_id = o.series_id AND s.pos = o.origin_pos + o.horizon - 5"""


@query("j07_walk_forward_frame", _WF_SQL, doubles=["y_true", "naive", "seasonal_naive"])
def j07_walk_forward_frame(spark, d):
    return T.walk_forward_frame(daily_series(spark, d), N_TEST)


_PRED_SQL = _WF_SQL.replace("SELECT o.series_id, o.origin_pos", "SELECT o.series_id AS sid, o.origin_pos", 1)
_METRICS_SQL = DS + f""",
p AS (SELECT series_id, ds, close, row_number() OVER ({W}) - 1 AS pos,
             count(*) OVER (PARTITION BY series_id) AS n FROM daily_series),
o AS (SELECT series_id, pos AS origin_pos, close AS naive, h.horizon
      FROM p, (VALUES (1), (2), (3)) h(horizon)
      WHERE pos >= n - {N_TEST} - 1 AND pos <= n - 3 - 1),
f AS (SELECT o.series_id, CAST(o.horizon AS INTEGER) AS horizon, a.close AS y_true, o.naive, s.close AS seasonal_naive
      FROM o JOIN p a ON a.series_id = o.series_id AND a.pos = o.origin_pos + o.horizon
      LEFT JOIN p s ON s.series_id = o.series_id AND s.pos = o.origin_pos + o.horizon - 5),
preds AS (SELECT series_id, horizon, y_true, 'naive' AS model, naive AS y_pred FROM f
          UNION ALL SELECT series_id, horizon, y_true, 'seasonal_naive', seasonal_naive FROM f)"""


# E-02 -----------------------------------------------------------------------
@query("e02_metrics_by_model_horizon", _METRICS_SQL + """
SELECT model, horizon, avg(abs(y_true - y_pred)) AS mae, sqrt(avg((y_true - y_pred) ^ 2)) AS rmse,
       1 - avg((y_true - y_pred) ^ 2) / var_pop(y_true) AS r2,
       avg(CASE WHEN y_true <> 0 THEN abs((y_true - y_pred) / y_true) END) * 100 AS mape,
       count(*) AS n_obs, count(*) FILTER (WHERE y_true = 0) AS n_zero_y
FROM preds GROUP BY model, horizon""", doubles=["mae", "rmse", "r2", "mape"])
def e02_metrics_by_model_horizon(spark, d):
    preds = T.baseline_predictions(T.walk_forward_frame(daily_series(spark, d), N_TEST))
    return E.regression_metrics(preds, by=["model", "horizon"])


# E-05 / A-07 ----------------------------------------------------------------
@query("e05_horizon_mean_ranking", _METRICS_SQL + """,
m AS (SELECT model, horizon, avg(CASE WHEN y_true <> 0 THEN abs((y_true - y_pred) / y_true) END) * 100 AS mape
      FROM preds GROUP BY model, horizon),
w AS (SELECT model, max(mape) FILTER (WHERE horizon = 1) AS "1", max(mape) FILTER (WHERE horizon = 2) AS "2",
             max(mape) FILTER (WHERE horizon = 3) AS "3" FROM m GROUP BY model)
SELECT model, "1" AS mape_h1, "2" AS mape_h2, "3" AS mape_h3, ("1" + "2" + "3") / 3 AS row_mean,
       CAST(row_number() OVER (ORDER BY ("1" + "2" + "3") / 3, model) AS INTEGER) AS rank FROM w""",
       doubles=["mape_h1", "mape_h2", "mape_h3", "row_mean"])
def e05_horizon_mean_ranking(spark, d):
    from pyspark.sql import Window
    preds = T.baseline_predictions(T.walk_forward_frame(daily_series(spark, d), N_TEST))
    m = E.regression_metrics(preds, by=["model", "horizon"])
    wide = pivot_wide(m, "model", "horizon", "mape", [1, 2, 3]).select(
        "model", *[F.col(f"`{h}`").alias(f"mape_h{h}") for h in (1, 2, 3)], "row_mean")
    # one row per model: ranking the small wide table is free
    return wide.withColumn("rank", F.row_number().over(Window.orderBy("row_mean", "model")))


# P-16 -----------------------------------------------------------------------
@query("p16_acf", DS + f""",
m AS (SELECT series_id, avg(close) AS mu FROM daily_series GROUP BY 1),
d AS (SELECT s.series_id, s.ds, s.close - m.mu AS x FROM daily_series s JOIN m USING (series_id)),
l AS (SELECT series_id, x, """ + ", ".join(f"lag(x, {k}) OVER (PARTITION BY series_id ORDER BY ds) AS l{k}"
                                          for k in range(1, 41)) + """ FROM d),
s AS (SELECT series_id, sum(x * x) AS c0, """ + ", ".join(f"sum(x * l{k}) AS c{k}" for k in range(1, 41)) + """
      FROM l GROUP BY 1)
SELECT series_id, CAST(0 AS INTEGER) AS lag, 1.0::DOUBLE AS acf FROM s
""" + "".join(f"UNION ALL SELECT series_id, {k}, c{k} / c0 FROM s\n" for k in range(1, 41)),
       doubles=["acf"])
def p16_acf(spark, d):
    return T.acf(daily_series(spark, d), 40)


@query("p16_pacf")
def p16_pacf(spark, d):
    return T.pacf(T.acf(daily_series(spark, d), 40))


# E-04 -----------------------------------------------------------------------
@query("e04_improvement_over_seasonal", _METRICS_SQL + """,
m AS (SELECT model, horizon, sqrt(avg((y_true - y_pred) ^ 2)) AS rmse FROM preds GROUP BY model, horizon)
SELECT m.model, m.horizon, m.rmse, 1 - m.rmse / b.rmse AS rmse_improvement
FROM m JOIN m b ON m.horizon = b.horizon AND b.model = 'seasonal_naive'""", doubles=["rmse", "rmse_improvement"])
def e04_improvement_over_seasonal(spark, d):
    preds = T.baseline_predictions(T.walk_forward_frame(daily_series(spark, d), N_TEST))
    m = E.regression_metrics(preds, by=["model", "horizon"]).select("model", "horizon", "rmse")
    return E.improvement(m, m.filter("model = 'seasonal_naive'"), on=["horizon"])


# P-17 / P-18 ----------------------------------------------------------------
_DECOMP_SQL = DS + f""",
p AS (SELECT series_id, ds, close, row_number() OVER ({W}) - 1 AS pos,
             CASE WHEN count(close) OVER ({W} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) = 5
                  THEN avg(close) OVER ({W} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) END AS trend
      FROM daily_series),
q AS (SELECT *, pos % 5 AS phase, close - trend AS det FROM p),
i AS (SELECT series_id, phase, avg(det) AS s FROM q GROUP BY ALL),
c AS (SELECT series_id, avg(s) AS sm FROM i GROUP BY 1),
dec AS (SELECT q.series_id, q.ds, q.close, q.trend, i.s - c.sm AS seasonal, q.close - q.trend - (i.s - c.sm) AS resid
        FROM q JOIN i ON q.series_id = i.series_id AND q.phase = i.phase JOIN c ON q.series_id = c.series_id)"""


@query("p17_seasonal_decompose", _DECOMP_SQL + "\nSELECT series_id, ds, trend, seasonal, resid FROM dec",
       doubles=["trend", "seasonal", "resid"], digits=4)
def p17_seasonal_decompose(spark, d):
    return T.seasonal_decompose(daily_series(spark, d), 5).select("series_id", "ds", "trend", "seasonal", "resid")


@query("p18_seasonality_strength", _DECOMP_SQL + """
SELECT series_id, max(seasonal) - min(seasonal) AS seasonal_amplitude, max(trend) - min(trend) AS trend_amplitude,
       (max(seasonal) - min(seasonal)) / (max(trend) - min(trend)) AS ratio FROM dec GROUP BY 1""",
       doubles=["seasonal_amplitude", "trend_amplitude", "ratio"], digits=4)
def p18_seasonality_strength(spark, d):
    return T.seasonality_strength(T.seasonal_decompose(daily_series(spark, d), 5))


@query("p17_decompose_extended", DS + f""",
p AS (SELECT series_id, ds, close, row_number() OVER ({W}) - 1 AS pos,
             count(*) OVER ({W} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS nw,
             avg(close) OVER ({W} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS aw FROM daily_series),
t AS (SELECT series_id, ds, close, pos, CASE WHEN nw = 5 THEN aw END AS trend FROM p),
e AS (SELECT series_id, min(pos) AS lo, max(pos) AS hi FROM t WHERE trend IS NOT NULL GROUP BY 1),
f AS (SELECT t.series_id, lo, hi, regr_intercept(trend, pos) FILTER (WHERE pos < lo + 5) AS a0,
             regr_slope(trend, pos) FILTER (WHERE pos < lo + 5) AS a1,
             regr_intercept(trend, pos) FILTER (WHERE pos > hi - 5) AS z0,
             regr_slope(trend, pos) FILTER (WHERE pos > hi - 5) AS z1
      FROM t JOIN e USING (series_id) GROUP BY ALL),
x AS (SELECT t.series_id, ds, close, pos % 5 AS phase,
             CASE WHEN pos < lo THEN a0 + a1 * pos WHEN pos > hi THEN z0 + z1 * pos ELSE trend END AS trend
      FROM t LEFT JOIN f USING (series_id)),
i AS (SELECT series_id, phase, avg(close - trend) AS s FROM x GROUP BY ALL),
c AS (SELECT series_id, phase, s - avg(s) OVER (PARTITION BY series_id) AS seasonal FROM i)
SELECT series_id, ds, trend, seasonal, close - trend - seasonal AS resid FROM x LEFT JOIN c USING (series_id, phase)""",
       doubles=["trend", "seasonal", "resid"], digits=4)
def p17_decompose_extended(spark, d):
    return T.seasonal_decompose(daily_series(spark, d), 5, extend=True).select("series_id", "ds", "trend", "seasonal", "resid")
