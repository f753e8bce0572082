"""Profiles, grouped statistics, reshaping and chart data (Q-05 … Q-07, A-*, D-*).

Quantiles are exact (linear interpolation as in pandas) by default, computed
by :func:`tessera.functions.ranks.exact_quantiles` — skew-safe, no group is
gathered into one task; ``approx=True`` switches to ``percentile_approx``
(one pass, memory bounded by the sketch accuracy).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import long_table, number
from tessera.functions.ranks import exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)


def _approx_quantiles(c: Column, probs, accuracy: int = 10000) -> Column:
    return F.percentile_approx(c.cast("double"), F.array(*[F.lit(float(p)) for p in probs]), accuracy)


def grouped_quantiles(df: DataFrame, value: str, probs, by=(), approx: bool = False,
                      out: str = "q") -> DataFrame:
    """(by…, ``out`` array) of quantiles of ``value`` per group."""
    by = [by] if isinstance(by, str) else list(by)
    if approx:
        return df.groupBy(*by).agg(_approx_quantiles(F.col(value), probs).alias(out))
    return exact_quantiles(df, value, probs, by, out=out)


# ---------------------------------------------------------------------- Q-05
def describe_numeric(df: DataFrame, cols, approx: bool = False) -> DataFrame:
    """Q-05: pandas ``describe`` transposed: one row per column, one pass.
    NaN is missing in every statistic, as null is."""
    cols = list(cols)
    aggs = []
    for i, c in enumerate(cols):
        x = number(c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"),
                 F.stddev_samp(x).alias(f"std{i}"), F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
    one = df.agg(*aggs)
    moments = long_table(one, [(c, {"count": F.col(f"n{i}"), "mean": F.col(f"mean{i}"),
                                    "std": F.col(f"std{i}"), "min": F.col(f"min{i}"),
                                    "max": F.col(f"max{i}")})
                               for i, c in enumerate(cols)])
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])))
    q = grouped_quantiles(long, "x", QUARTILES, "column", approx)
    return moments.join(q, on="column", how="left").select(
        "column", "count", "mean", "std", "min", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"),
        F.col("q")[2].alias("p75"), "max")


# ---------------------------------------------------------------------- Q-06
def describe_categorical(df: DataFrame, cols) -> DataFrame:
    """Q-06: count, unique, top, freq per string column (ties → smallest value).

    Columns are unpivoted to (column, value) and counted with one partial
    aggregation; the top value per column is a ``max_by`` over the few
    distinct values of that column.
    """
    cols = list(cols)
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])))
    counts = (long.filter(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt")))
    return counts.groupBy("column").agg(
        F.sum("cnt").cast("long").alias("count"),
        F.count(F.lit(1)).cast("long").alias("unique"),
        F.min_by("value", F.struct(-F.col("cnt"), F.col("value"))).alias("top"),
        F.max("cnt").alias("freq"))


# ---------------------------------------------------------------- Q-07 / A-01
def group_describe(df: DataFrame, by, cols, approx: bool = False) -> DataFrame:
    """A-01 / Q-07: per group and column: n, mean, median, std (ddof=1)."""
    by = [by] if isinstance(by, str) else list(by)
    cols = list(cols)
    long = df.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])))
    med = grouped_quantiles(long, "x", [0.5], by + ["column"], approx) \
        .select(*by, "column", F.col("q")[0].alias("median"))
    mom = long.groupBy(*by, "column").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"))
    return mom.join(med, on=by + ["column"], how="left").select(*by, "column", "n", "mean", "median", "std")


def group_means(df: DataFrame, by, cols) -> DataFrame:
    """A-02: mean of many columns per group (profile table), one aggregate."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                               *[F.avg(F.col(c)).alias(f"mean_{c}") for c in cols])


# ---------------------------------------------------------- A-03 / A-04 / A-13
def value_counts(df: DataFrame, col: str, by=()) -> DataFrame:
    """A-03 / A-04 / A-13: counts and percent of each value (within ``by``).

    The per-``by`` totals are a second aggregate joined on ``by``; with no
    ``by`` the total is one scalar fitted first, so no single-partition
    window is used.
    """
    by = [by] if isinstance(by, str) else list(by)
    counts = df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("count"))
    if by:
        totals = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__total"))
        return (counts.join(totals, on=by, how="inner")
                .withColumn("pct", F.col("count") * 100.0 / F.col("__total")).drop("__total"))
    total = df.count()
    return counts.withColumn("pct", F.col("count") * 100.0 / F.lit(total))


def imbalance_ratio(df: DataFrame, col: str) -> DataFrame:
    """A-05: largest class count over smallest class count."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.agg(F.max("cnt").alias("max_count"), F.min("cnt").alias("min_count"),
                      (F.max("cnt") / F.min("cnt")).alias("imbalance_ratio"))


# ---------------------------------------------------------------- A-06 / A-07
def crosstab(df: DataFrame, row: str, col: str, values) -> DataFrame:
    """A-06: counts of ``row`` × ``col``, one column per listed value (no extra
    job) and ``other`` for null and every value not listed."""
    listed = F.coalesce(F.col(col).isin(*values), F.lit(False))
    return df.groupBy(row).agg(*[F.count_if(F.col(col) == v).alias(str(v)) for v in values],
                               F.count_if(~listed).alias("other"))


def pivot_wide(df: DataFrame, index, column: str, value: str, values, add_mean: bool = True) -> DataFrame:
    """A-07: long → wide with explicit pivot values, plus the row mean."""
    index = [index] if isinstance(index, str) else list(index)
    wide = df.groupBy(*index).pivot(column, list(values)).agg(F.first(value))
    if add_mean:
        cols = [F.col(f"`{v}`") for v in values]
        wide = wide.withColumn("row_mean", sum(cols) / F.lit(len(cols)))
    return wide


def melt(df: DataFrame, ids, values, var_name: str = "variable", value_name: str = "value") -> DataFrame:
    """A-08: wide → long (``unpivot``)."""
    return df.unpivot(list(ids), list(values), var_name, value_name)


def pair_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """A-10: counts of (a, b) pairs — e.g. (truth, prediction) confusions."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))


def distinct_count(df: DataFrame, col: str, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """A-11: exact or HyperLogLog++ distinct count."""
    c = F.approx_count_distinct(col, rsd) if approx else F.count_distinct(col)
    return df.agg(c.alias(f"n_distinct_{col}"))


# ---------------------------------------------------------------------- A-12
def monthly_counts(df: DataFrame, date_col: str) -> DataFrame:
    """A-12: rows per month start, empty months = 0 (calendar via ``sequence``)."""
    m = df.select(F.trunc(F.to_date(date_col), "month").alias("month"))
    counts = m.groupBy("month").agg(F.count(F.lit(1)).alias("n"))
    months = (counts.agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
              .select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month")))
    return (months.join(counts, on="month", how="left")
            .select("month", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


# ---------------------------------------------------------------------- A-14
def text_lengths(df: DataFrame, text: str) -> DataFrame:
    """A-14: characters and whitespace-separated words of every text."""
    t = F.trim(F.col(text))
    return df.withColumn("n_chars", F.length(F.col(text))) \
             .withColumn("n_words", F.when(t == "", 0).otherwise(F.size(F.split(t, r"\s+"))))


# ---------------------------------------------------------------------- D-01
def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """D-01: ``bins`` equal-width bins between min and max, last edge inclusive,
    empty bins present with count 0. Fit (min, max) is one scalar aggregate."""
    lo, hi = df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first()
    width = (hi - lo) / bins if hi > lo else 1.0
    x = F.col(col).cast("double")
    idx = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = (df.filter(x.isNotNull()).select(idx.alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    spark = df.sparkSession
    edges = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (edges.join(counts, on="bin", how="left")
            .select("bin",
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("count")))


# ---------------------------------------------------------------------- D-02
def kde(df: DataFrame, col: str, grid_points: int = 100, prebin: int | None = None) -> DataFrame:
    """D-02: Gaussian KDE on an even grid, Scott bandwidth (n^-1/5 · std).

    Each row contributes to every grid point: the grid is generated inside the
    row (``sequence`` + ``posexplode``) and summed with partial aggregation,
    so there is no join. With ``prebin`` rows are first collapsed to that many
    equal-width bin centres with counts (bounded work at any scale).
    """
    x = F.col(col).cast("double")
    n, mean, std, lo, hi = df.agg(F.count(x), F.avg(x), F.stddev_samp(x), F.min(x), F.max(x)).first()
    h = std * n ** (-0.2)
    step = (hi - lo) / (grid_points - 1)
    src = df.select(x.alias("x"), F.lit(1).cast("long").alias("w")).filter("x is not null")
    if prebin:
        bw = (hi - lo) / prebin
        src = (src.select(F.least(F.floor((F.col("x") - lo) / bw), F.lit(prebin - 1)).alias("b"))
               .groupBy("b").agg(F.count(F.lit(1)).alias("w"))
               .select((F.lit(lo) + (F.col("b") + 0.5) * bw).alias("x"), "w"))
    contrib = src.select(F.posexplode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("g", "_"),
                         "x", "w")
    gx = F.lit(lo) + F.col("g") * F.lit(step)
    z = (gx - F.col("x")) / F.lit(h)
    return (contrib.groupBy("g").agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("s"))
            .select("g", (F.lit(lo) + F.col("g") * F.lit(step)).alias("x"),
                    (F.col("s") / F.lit(n * h * math.sqrt(2 * math.pi))).alias("density")))


def kde_binned(df: DataFrame, col: str, grid_points: int = 100, bins: int = 2000) -> DataFrame:
    """D-02 at scale: :func:`kde` from counts instead of rows.

    Linear binning: a row gives its weight to the two of ``bins`` + 1 even knots
    around it, in proportion to its nearness, as two entries of one partial
    aggregate; only the knots meet the grid. With knot distance d the density is
    off by at most d^2 / (8 h^3 sqrt(2 pi)) from the exact form. Nulls and NaN
    take no part; a constant column has no bandwidth and gives no row."""
    x = F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))
    n, std, lo, hi = df.agg(F.count(x), F.stddev_samp(x), F.min(x), F.max(x)).first()
    empty = df.sparkSession.createDataFrame([], "g int, x double, density double")
    if n < 2 or hi == lo:
        return empty
    h, width, step = std * n ** (-0.2), (hi - lo) / bins, (hi - lo) / (grid_points - 1)
    at = (x - F.lit(lo)) / F.lit(width)
    left = F.least(F.floor(at), F.lit(bins - 1))
    knot = lambda k, w: F.struct(k.cast("long").alias("k"), w.alias("w"))
    knots = df.filter(x.isNotNull()).select(F.inline(F.array(knot(left, left + 1 - at), knot(left + 1, at - left)))) \
        .groupBy("k").agg(F.sum("w").alias("w"))
    gx = F.lit(lo) + F.col("g") * F.lit(step)
    z = (gx - F.lit(lo) - F.col("k") * F.lit(width)) / F.lit(h)
    return knots.select("w", "k", F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("g")) \
        .groupBy("g").agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("s")) \
        .select("g", gx.alias("x"), (F.col("s") / F.lit(n * h * math.sqrt(2 * math.pi))).alias("density"))


# ---------------------------------------------------------------------- D-03
def box_stats(df: DataFrame, col: str, by=(), approx: bool = False, k: float = 1.5) -> DataFrame:
    """D-03: quartiles, whiskers (furthest points inside the fences), fliers.

    Pass 1: quartiles per group. Pass 2: joined back on the group key (an
    equi-join; the per-group table is tiny and broadcast by size), then
    conditional min/max/count in one aggregate.
    """
    by = [by] if isinstance(by, str) else list(by)
    x = F.col(col).cast("double")
    q = (grouped_quantiles(df.select(*by, x.alias("__x")), "__x", QUARTILES, by, approx)
         .select(*by, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                 F.col("q")[2].alias("q3")))
    q = q.withColumn("lo_fence", F.col("q1") - k * (F.col("q3") - F.col("q1"))) \
         .withColumn("hi_fence", F.col("q3") + k * (F.col("q3") - F.col("q1")))
    src = df.select(*by, x.alias("__x")).filter("__x is not null")
    joined = src.join(q, on=by, how="inner") if by else _attach(src, q)
    inside = (F.col("__x") >= F.col("lo_fence")) & (F.col("__x") <= F.col("hi_fence"))
    return joined.groupBy(*by, "q1", "median", "q3", "lo_fence", "hi_fence").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(inside, F.col("__x"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("__x"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_fliers"))


def _attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row fitted aggregate as literals."""
    row = one_row.first().asDict()
    return df.select("*", *[F.lit(v).alias(k) for k, v in row.items()])


# ---------------------------------------------------------------------- D-04
def fitted_line(df: DataFrame, x: str, y: str, by=()) -> DataFrame:
    """D-04: least-squares slope and intercept (``regr_slope``/``regr_intercept``)."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                               F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                               F.regr_count(F.col(y), F.col(x)).alias("n"))


# ---------------------------------------------------------------- D-05 / D-06
def binned_2d(df: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """D-05 / D-06: 2-D equal-width bin counts for a pair of columns (scatter
    data whose size does not grow with the rows)."""
    stats = df.agg(F.min(x).cast("double").alias("x0"), F.max(x).cast("double").alias("x1"),
                   F.min(y).cast("double").alias("y0"), F.max(y).cast("double").alias("y1")).first()
    wx = (stats.x1 - stats.x0) / bins or 1.0
    wy = (stats.y1 - stats.y0) / bins or 1.0
    bx = F.least(F.floor((F.col(x) - stats.x0) / wx), F.lit(bins - 1)).cast("int")
    by_ = F.least(F.floor((F.col(y) - stats.y0) / wy), F.lit(bins - 1)).cast("int")
    return (df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(bx.alias("bin_x"), by_.alias("bin_y")).agg(F.count(F.lit(1)).alias("count")))


def binned_pairs(df: DataFrame, cols, bins: int = 20) -> DataFrame:
    """D-05 for every pair at once: (col_x, col_y, bin_x, bin_y, count), columns
    in list order, and a column with itself as its histogram (bin_x = bin_y).

    One pass fits the ranges; in the other each row's bin numbers are unfolded
    into its pairs and counted map-side, so what is shuffled is bounded by
    pairs x bins^2. A pair counts the rows where both are given (NaN is not)."""
    cols = list(cols)
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols}
    ends = df.agg(*[f(v).alias(f"{k}{i}") for i, v in enumerate(value.values()) for k, f in (("lo", F.min), ("hi", F.max))]).first()
    place = []
    for i, c in enumerate(cols):
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        width = (hi - lo) / bins or 1.0 if lo is not None else 1.0
        bin_ = F.least(F.floor((value[c] - F.lit(lo).cast("double")) / F.lit(width)), F.lit(bins - 1)).cast("int")
        place.append(F.when(value[c].isNotNull(), bin_).alias(f"b{i}"))         # least() passes over nulls
    pairs = F.array(*[F.struct(F.lit(a).alias("col_x"), F.lit(b).alias("col_y"), F.col(f"b{i}").alias("bin_x"), F.col(f"b{j}").alias("bin_y"))
                      for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j])
    return df.select(*place).select(F.inline(pairs)).dropna() \
        .groupBy("col_x", "col_y", "bin_x", "bin_y").agg(F.count(F.lit(1)).alias("count"))


# ---------------------------------------------------------------------- D-08
def biplot_loadings(loadings: DataFrame, scores: DataFrame, pcs=("pc1", "pc2")) -> DataFrame:
    """D-08: loadings scaled to the score range (arrow coordinates)."""
    rng = scores.agg(*[(F.max(F.abs(F.col(p)))).alias(p) for p in pcs]).first().asDict()
    lmax = loadings.agg(*[(F.max(F.abs(F.col(p)))).alias(p) for p in pcs]).first().asDict()
    return loadings.select("feature", *[
        (F.col(p) * F.lit(rng[p] / lmax[p] if lmax[p] else 0.0)).alias(f"{p}_arrow") for p in pcs])
