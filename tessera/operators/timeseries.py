"""Time-series features, diagnostics and walk-forward baselines
(W-01 … W-12, F-12 via quality, P-16 … P-18, V-09, V-10, J-07, R-07, R-08).

Every window is partitioned by the series id and ordered by the date, so
series spread over tasks. Features only look back, so they are computed once
for the whole history and each walk-forward origin is a filter on them
(never a per-origin recomputation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Feature definitions of the forecasting study.
LAGS = (1, 2, 3, 4, 5, 10, 20)
WINDOWS = (5, 10, 20)
HORIZONS = (1, 2, 3)


def _w(series: str, ts: str):
    return Window.partitionBy(series).orderBy(ts)


def with_position(df: DataFrame, series: str, ts: str, out: str = "pos") -> DataFrame:
    """0-based position of each row within its series."""
    return df.withColumn(out, F.row_number().over(_w(series, ts)) - 1)


# ------------------------------------------------------------ W-01 … W-08
def feature_spec(w, ts: str = "ds", value: str = "close", volume: str = "volume", lags=LAGS, windows=WINDOWS) -> dict:
    """W-01 … W-06 as one ordered specification, name -> column: lags, trailing
    mean and deviation that exclude the current row (NULL until the window is
    full), lagged returns, calendar parts (Monday = 0), lagged volume."""
    def back(k, c=value):
        return F.lag(c, k).over(w)

    def trailing(n, agg):
        frame = w.rowsBetween(-n, -1)
        return F.when(F.count(value).over(frame) == n, agg(value).over(frame))

    spec = {f"lag_{k}": back(k) for k in lags}
    for n in windows:
        spec |= {f"roll_mean_{n}": trailing(n, F.avg), f"roll_std_{n}": trailing(n, F.stddev_samp)}
    return spec | {"return_1": back(1) / back(2) - 1, "return_5": back(1) / back(6) - 1, "dow": F.weekday(ts),
                   "day": F.dayofmonth(ts), "month": F.month(ts), "volume_lag1": back(1, volume)}


def feature_columns(lags=LAGS, windows=WINDOWS) -> list[str]:
    """W-08: the feature names in model order, read off the specification."""
    return list(feature_spec(_w("series_id", "ds"), lags=lags, windows=windows))


def build_features(df: DataFrame, series: str = "series_id", ts: str = "ds", value: str = "close",
                   volume: str = "volume", lags=LAGS, windows=WINDOWS) -> DataFrame:
    """``df`` with every column of :func:`feature_spec`."""
    return df.withColumns(feature_spec(_w(series, ts), ts, value, volume, lags, windows))


def direct_targets(df: DataFrame, series: str = "series_id", ts: str = "ds", value: str = "close",
                   horizons=HORIZONS) -> DataFrame:
    """W-07: ``target_h{h}`` = value h steps ahead (lead)."""
    w = _w(series, ts)
    for h in horizons:
        df = df.withColumn(f"target_h{h}", F.lead(value, h).over(w))
    return df


def returns(df: DataFrame, series: str = "series_id", ts: str = "ds", value: str = "close") -> DataFrame:
    """W-04 / W-09: daily return, difference and gap in days to the previous row."""
    w = _w(series, ts)
    prev = F.lag(value, 1).over(w)
    return df.withColumn("ret", F.col(value) / prev - 1) \
             .withColumn("diff", F.col(value) - prev) \
             .withColumn("gap_days", F.datediff(ts, F.lag(ts, 1).over(w)))


def return_shocks(df: DataFrame, series: str = "series_id", ts: str = "ds", value: str = "close",
                  k: float = 4.0) -> DataFrame:
    """W-10: rows whose |return| exceeds k · std of the series' returns.

    The std is a per-series aggregate joined back on the series id."""
    r = returns(df, series, ts, value)
    sd = r.groupBy(series).agg(F.stddev_samp("ret").alias("ret_std"))
    return r.join(sd, on=series).filter(F.abs("ret") > k * F.col("ret_std"))


def tail_rows(df: DataFrame, n: int, series: str = "series_id", ts: str = "ds") -> DataFrame:
    """W-12 / V-09: the last n rows of each series (hold-out)."""
    w = Window.partitionBy(series).orderBy(F.col(ts).desc())
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def business_calendar(df: DataFrame, series: str = "series_id", ts: str = "ds") -> DataFrame:
    """W-11: every business day between a series' first and last date, left
    joined to the observations (gaps come back as NULL)."""
    b = df.groupBy(series).agg(F.min(ts).alias("__lo"), F.max(ts).alias("__hi"))
    cal = (b.select(series, F.explode(F.sequence("__lo", "__hi")).alias(ts))
           .filter(F.weekday(ts) < 5))
    return cal.join(df, on=[series, ts], how="left")


# ---------------------------------------------------------------- V-10 / J-07
def walk_forward_frame(df: DataFrame, n_test: int, series: str = "series_id", ts: str = "ds",
                       value: str = "close", horizons=HORIZONS, season: int = 5) -> DataFrame:
    """V-10 + J-07 + R-07 + R-08: origins × horizons with actuals and the two
    naive forecasts.

    Origins per series are positions n_train − 1 … n − max_h − 1 with
    n_train = n − n_test. Horizons are generated inside each origin row
    (``explode`` of a literal array — no join), then the actual at origin + h
    and the seasonal-naive value at origin + h − season come from equi-joins
    on (series, position).
    """
    max_h = max(horizons)
    pos = with_position(df.select(series, ts, value), series, ts)
    n = pos.groupBy(series).agg(F.count(F.lit(1)).alias("__n"))
    origins = (pos.join(n, on=series)
               .filter((F.col("pos") >= F.col("__n") - n_test - 1) &
                       (F.col("pos") <= F.col("__n") - max_h - 1))
               .select(series, F.col("pos").alias("origin_pos"), F.col(ts).alias("origin_date"),
                       F.col(value).alias("naive"),
                       F.explode(F.array(*[F.lit(h) for h in horizons])).alias("horizon")))
    actual = pos.select(F.col(series).alias("__as"), F.col("pos").alias("__tp"),
                        F.col(ts).alias("target_date"), F.col(value).alias("y_true"))
    seas = pos.select(F.col(series).alias("__ss"), F.col("pos").alias("__sp"),
                      F.col(value).alias("seasonal_naive"))
    return (origins
            .join(actual, (F.col(series) == F.col("__as")) &
                  (F.col("__tp") == F.col("origin_pos") + F.col("horizon")), "inner")
            .join(seas, (F.col(series) == F.col("__ss")) &
                  (F.col("__sp") == F.col("origin_pos") + F.col("horizon") - season), "left")
            .select(series, "origin_pos", "origin_date", "target_date", "horizon", "y_true",
                    "naive", "seasonal_naive"))


def baseline_predictions(frame: DataFrame, series: str = "series_id") -> DataFrame:
    """Long prediction table (series, origin_date, target_date, horizon, model,
    y_true, y_pred) for the naive and seasonal-naive forecasts."""
    return frame.select(series, "origin_date", "target_date", "horizon", "y_true",
                        F.inline(F.array(
                            F.struct(F.lit("naive").alias("model"), F.col("naive").alias("y_pred")),
                            F.struct(F.lit("seasonal_naive").alias("model"),
                                     F.col("seasonal_naive").alias("y_pred")))))


# ---------------------------------------------------------------------- P-16
def acf(df: DataFrame, nlags: int = 40, series: str = "series_id", ts: str = "ds",
        value: str = "close") -> DataFrame:
    """P-16: autocorrelation r_k = Σ (x_t − m)(x_{t−k} − m) / Σ (x_t − m)².

    Per series: mean (aggregate joined back), then all lag products summed in
    one aggregate; output one row per (series, lag)."""
    m = df.groupBy(series).agg(F.avg(value).alias("__m"))
    w = _w(series, ts)
    d = df.join(m, on=series).withColumn("__d", F.col(value) - F.col("__m"))
    sums = d.groupBy(series).agg(F.sum(F.col("__d") ** 2).alias("c0"))
    lagged = d.select(series, "__d", *[F.lag("__d", k).over(w).alias(f"__l{k}") for k in range(1, nlags + 1)])
    prods = lagged.groupBy(series).agg(*[F.sum(F.col("__d") * F.col(f"__l{k}")).alias(f"c{k}")
                                         for k in range(1, nlags + 1)])
    both = sums.join(prods, on=series)
    return both.select(series, F.inline(F.array(
        F.struct(F.lit(0).alias("lag"), F.lit(1.0).alias("acf")),
        *[F.struct(F.lit(k).alias("lag"), (F.col(f"c{k}") / F.col("c0")).alias("acf"))
          for k in range(1, nlags + 1)])))


def pacf(acf_rows: DataFrame, series: str = "series_id") -> DataFrame:
    """P-16: partial autocorrelations of every series from its :func:`acf` rows.

    The Durbin–Levinson recursion runs as a fold over the lags of one row per
    series (their number is the parameter of ``acf``), in JVM expressions."""
    r = F.col("__r")
    rows = acf_rows.groupBy(series).agg(F.transform(F.sort_array(F.collect_list(F.struct("lag", "acf"))),
                                                    lambda x: x["acf"]).alias("__r"))

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, v: t + v)

    def step(state, k):
        phi, past = state["phi"], F.slice(r, F.lit(2), k - 1)
        top = (F.get(r, k) - dot(phi, F.reverse(past))) / (F.lit(1.0) - dot(phi, past))
        return F.struct(F.concat(F.zip_with(phi, F.reverse(phi), lambda x, y: x - top * y), F.array(top)).alias("phi"),
                        F.concat(state["out"], F.array(top)).alias("out"))

    none = F.array().cast("array<double>")
    lags = F.when(F.size(r) > 1, F.sequence(F.lit(1), F.size(r) - 1)).otherwise(F.array().cast("array<int>"))
    out = F.aggregate(lags, F.struct(none.alias("phi"), F.array(F.lit(1.0)).cast("array<double>").alias("out")), step,
                      lambda state: state["out"])
    return rows.select(series, F.posexplode(out).alias("lag", "pacf"))


# ---------------------------------------------------------------- P-17 / P-18
def seasonal_decompose(df: DataFrame, period: int = 5, series: str = "series_id", ts: str = "ds",
                       value: str = "close", extend: bool = False) -> DataFrame:
    """P-17: additive decomposition with an odd ``period``: centred moving
    average trend (NULL where the window is incomplete), seasonal index per
    position mod period (centred to mean 0), residual. With ``extend`` the
    trend goes on to both ends of the series along the least-squares line of
    its first and last ``period`` known points, before the seasonal fit."""
    half = period // 2
    w = _w(series, ts)
    frame = w.rowsBetween(-half, half)
    d = with_position(df, series, ts)
    d = d.withColumn("trend", F.when(F.count(value).over(frame) == period, F.avg(value).over(frame)))
    if extend:
        d = _extended(d, period, series)
    d = d.withColumn("phase", F.col("pos") % period) \
         .withColumn("__det", F.col(value) - F.col("trend"))
    idx = d.groupBy(series, "phase").agg(F.avg("__det").alias("__s"))
    centre = idx.groupBy(series).agg(F.avg("__s").alias("__sm"))
    idx = idx.join(centre, on=series).select(series, "phase", (F.col("__s") - F.col("__sm")).alias("seasonal"))
    return (d.join(idx, on=[series, "phase"], how="left")
            .withColumn("resid", F.col(value) - F.col("trend") - F.col("seasonal"))
            .drop("__det"))


def _extended(d: DataFrame, period: int, series: str) -> DataFrame:
    """``trend`` filled at both ends of every series along its end lines."""
    ends = d.filter("trend IS NOT NULL").groupBy(series).agg(F.min("pos").alias("__lo"), F.max("pos").alias("__hi"))
    known = d.join(ends, series)
    lines = known.groupBy(series, "__lo", "__hi").agg(*[
        fit(F.when(near, F.col("trend")), F.col("pos")).alias(f"__{side}{k}")
        for side, near in (("a", F.col("pos") < F.col("__lo") + period), ("z", F.col("pos") > F.col("__hi") - period))
        for k, fit in enumerate((F.regr_intercept, F.regr_slope))])
    line = lambda side: F.col(f"__{side}0") + F.col(f"__{side}1") * F.col("pos")
    filled = F.when(F.col("pos") < F.col("__lo"), line("a")).when(F.col("pos") > F.col("__hi"), line("z")).otherwise(F.col("trend"))
    return d.join(lines, series, "left").withColumn("trend", filled).select(*d.columns)


def seasonality_strength(decomposed: DataFrame, series: str = "series_id") -> DataFrame:
    """P-18: amplitude (max − min) of the seasonal and trend parts and their ratio."""
    return decomposed.groupBy(series).agg(
        (F.max("seasonal") - F.min("seasonal")).alias("seasonal_amplitude"),
        (F.max("trend") - F.min("trend")).alias("trend_amplitude")) \
        .withColumn("ratio", F.col("seasonal_amplitude") / F.col("trend_amplitude"))
