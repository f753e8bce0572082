"""Queries: correlations, hypothesis tests and chart data (P-04 … P-14, D-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import distributions as dist
from tessera.functions.normal import norm_ppf, ppf_sql
from tessera.operators import describe as D
from tessera.operators import stats as S
from tessera.plans.bindings import (CUSTOMER_PROFILE_SQL, PROFILE_NUMERIC, REGRESSION_FEATURES,
                                    REGRESSION_ROWS_SQL, customer_profile, regression_rows,
                                    with_sql)
from tessera.plans.registry import query

CP = with_sql(CUSTOMER_PROFILE_SQL)
RR = with_sql(REGRESSION_ROWS_SQL)
NUM = PROFILE_NUMERIC
U = "\nUNION ALL\n"
LONG_BY_PLAN = """,
long AS (SELECT plan, metric, CAST(x AS DOUBLE) AS x FROM customer_profile
         UNPIVOT (x FOR metric IN (""" + ", ".join(NUM) + """)) WHERE x IS NOT NULL AND plan IS NOT NULL)"""


def _avg_rank_sql(x, part=""):
    p = f"PARTITION BY {part} " if part else ""
    pp = f"PARTITION BY {part}, {x}" if part else f"PARTITION BY {x}"
    return f"(rank() OVER ({p}ORDER BY {x}) + (count(*) OVER ({pp}) - 1) / 2.0)"


# P-04 -----------------------------------------------------------------------
_PEARSON_SQL = CP + """
SELECT corr(income, spend) AS r, count(*) AS n,
       corr(income, spend) * sqrt((count(*) - 2) / (1 - corr(income, spend) ^ 2)) AS t
FROM customer_profile WHERE income IS NOT NULL AND spend IS NOT NULL"""


@query("p04_pearson", _PEARSON_SQL, doubles=["r", "t"])
def p04_pearson(spark, d):
    return S.pearson(customer_profile(spark, d), "income", "spend")


@query("p04_pearson_test")
def p04_pearson_test(spark, d):
    """r, t and the two-sided p-value (t distribution, n − 2 dof)."""
    return S.with_t_pvalue(S.pearson(customer_profile(spark, d), "income", "spend"))


# P-05 -----------------------------------------------------------------------
@query("p05_spearman", CP + f""",
r AS (SELECT {_avg_rank_sql('income')} AS rx, {_avg_rank_sql('spend')} AS ry
      FROM customer_profile WHERE income IS NOT NULL AND spend IS NOT NULL)
SELECT corr(rx, ry) AS r, count(*) AS n, corr(rx, ry) * sqrt((count(*) - 2) / (1 - corr(rx, ry) ^ 2)) AS t
FROM r""", doubles=["r", "t"])
def p05_spearman(spark, d):
    return S.spearman(customer_profile(spark, d), "income", "spend", "customer_id")


# P-06 -----------------------------------------------------------------------
_ANOVA_SQL = CP + LONG_BY_PLAN + """,
g AS (SELECT metric, plan, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM long GROUP BY ALL),
per AS (SELECT metric, sum(n) AS "N", count(*) AS k, sum(n * m) / sum(n) AS grand, sum(n * v) AS ssw
        FROM g GROUP BY metric),
b AS (SELECT g.metric, sum(g.n * (g.m - per.grand) ^ 2) AS ssb FROM g JOIN per USING (metric) GROUP BY g.metric)
SELECT metric, CAST("N" AS BIGINT) AS "N", k, (ssb / (k - 1)) / (ssw / ("N" - k)) AS f_stat
FROM per JOIN b USING (metric)"""


@query("p06_anova_by_plan", _ANOVA_SQL, doubles=["f_stat"])
def p06_anova_by_plan(spark, d):
    return S.anova_oneway(customer_profile(spark, d), "plan", NUM).select("metric", "N", "k", "f_stat")


@query("p06_anova_test")
def p06_anova_test(spark, d):
    return S.with_f_pvalue(S.anova_oneway(customer_profile(spark, d), "plan", NUM))


# P-07 -----------------------------------------------------------------------
_KW_SQL = CP + LONG_BY_PLAN + f""",
r AS (SELECT metric, plan, x, {_avg_rank_sql('x', 'metric')} AS rk FROM long),
t AS (SELECT metric, sum(c * c * c - c) AS tie_sum, sum(c) AS "N"
      FROM (SELECT metric, x, count(*) AS c FROM long GROUP BY ALL) GROUP BY metric),
g AS (SELECT metric, plan, sum(rk) AS "R", count(*) AS n FROM r GROUP BY ALL),
per AS (SELECT metric, sum("R" * "R" / n) AS s, count(*) AS k FROM g GROUP BY metric)
SELECT metric, CAST("N" AS BIGINT) AS "N", k,
       (12.0 / ("N" * ("N" + 1)) * s - 3 * ("N" + 1)) / (1 - tie_sum / ("N" * "N" * "N" - "N")) AS h_stat
FROM per JOIN t USING (metric)"""


@query("p07_kruskal_by_plan", _KW_SQL, doubles=["h_stat"])
def p07_kruskal_by_plan(spark, d):
    return S.kruskal_wallis(customer_profile(spark, d), "plan", NUM)


@query("p07_kruskal_test")
def p07_kruskal_test(spark, d):
    h = S.kruskal_wallis(customer_profile(spark, d), "plan", NUM)
    return S.with_chi2_pvalue(h, "h_stat", F.col("k") - 1)


# P-08 / P-09 ----------------------------------------------------------------
_RCOLS = list(REGRESSION_FEATURES) + ["y"]
_PAIRS = [(a, b) for i, a in enumerate(_RCOLS) for b in _RCOLS[i + 1:]]


@query("p08_correlation_matrix", RR + "\n" + U.join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS r FROM regression_rows" for a, b in _PAIRS),
    doubles=["r"])
def p08_correlation_matrix(spark, d):
    return S.correlation_pairs(regression_rows(spark, d), _RCOLS)


_NUMP = [(a, b) for i, a in enumerate(NUM) for b in NUM[i + 1:]]


@query("p08_spearman_matrix", CP + ",\nr AS (SELECT " + ", ".join(
    f"{_avg_rank_sql(c)} AS {c}" for c in NUM) + " FROM customer_profile)\n" + U.join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS r FROM r" for a, b in _NUMP),
    doubles=["r"])
def p08_spearman_matrix(spark, d):
    return S.correlation_pairs(customer_profile(spark, d), NUM, method="spearman", id_col="customer_id")


@query("p09_strong_pairs", CP + ",\nc AS (" + U.join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS r FROM customer_profile" for a, b in _NUMP)
    + ")\nSELECT * FROM c WHERE abs(r) > 0.75", doubles=["r"])
def p09_strong_pairs(spark, d):
    """Profile feature pairs with |r| above the 0.75 redundancy threshold."""
    return S.strong_pairs(customer_profile(spark, d), NUM, 0.75)


# P-11 -----------------------------------------------------------------------
@query("p11_greedy_feature_filter")
def p11_greedy_feature_filter(spark, d):
    """Features kept by |corr with target| order with a 0.3 redundancy cut."""
    return S.greedy_decorrelate(regression_rows(spark, d), REGRESSION_FEATURES, "y", 0.3)


# P-12 / P-13 ----------------------------------------------------------------
@query("p12_p13_shape_stats", RR + """,
long AS (SELECT metric, x FROM regression_rows UNPIVOT (x FOR metric IN (""" + ", ".join(_RCOLS) + """))),
m AS (SELECT metric, avg(x) AS mu FROM long GROUP BY metric),
mo AS (SELECT l.metric, count(*) AS n, avg((x - mu) ^ 2) AS m2, avg((x - mu) ^ 3) AS m3, avg((x - mu) ^ 4) AS m4
       FROM long l JOIN m USING (metric) GROUP BY l.metric)
SELECT metric, n, m3 / m2 ^ 1.5 AS skew, m4 / m2 ^ 2 - 3 AS kurt,
       n / 6.0 * ((m3 / m2 ^ 1.5) ^ 2 + (m4 / m2 ^ 2 - 3) ^ 2 / 4.0) AS jb,
       exp(-(n / 6.0 * ((m3 / m2 ^ 1.5) ^ 2 + (m4 / m2 ^ 2 - 3) ^ 2 / 4.0)) / 2.0) AS jb_p FROM mo""",
       doubles={"skew": 6, "kurt": 6, "jb": 3, "jb_p": 6})
def p12_p13_shape_stats(spark, d):
    return S.shape_stats(regression_rows(spark, d), _RCOLS)


# P-14 -----------------------------------------------------------------------
@query("p14_breusch_pagan")
def p14_breusch_pagan(spark, d):
    """OLS of y on the features (one Gram aggregate), then Breusch–Pagan on its residuals."""
    rr = regression_rows(spark, d)
    g, _ = S.gram(rr, list(REGRESSION_FEATURES) + ["y"])
    beta, _, _ = S.ols_from_gram(g, len(REGRESSION_FEATURES) + 1)
    fitted = F.lit(float(beta[0]))
    for b, c in zip(beta[1:], REGRESSION_FEATURES):
        fitted = fitted + F.lit(float(b)) * F.col(c)
    return S.breusch_pagan(rr.withColumn("resid", F.col("y") - fitted), "resid", REGRESSION_FEATURES)


@query("p14_vif")
def p14_vif(spark, d):
    return S.vif(regression_rows(spark, d), REGRESSION_FEATURES)


# D-01 -----------------------------------------------------------------------
@query("d01_histogram", CP + """,
s AS (SELECT min(income) AS lo, max(income) AS hi, (max(income) - min(income)) / 20 AS w FROM customer_profile),
c AS (SELECT CAST(least(floor((income - lo) / w), 19) AS INTEGER) AS bin, count(*) AS n
      FROM customer_profile, s WHERE income IS NOT NULL GROUP BY 1)
SELECT b.bin, lo + b.bin * w AS lo, lo + (b.bin + 1) * w AS hi, CAST(COALESCE(c.n, 0) AS BIGINT) AS count
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(20)) b CROSS JOIN s LEFT JOIN c ON b.bin = c.bin""",
       doubles=["lo", "hi"])
def d01_histogram(spark, d):
    return D.histogram(customer_profile(spark, d), "income", 20)


# D-02 -----------------------------------------------------------------------
@query("d02_kde", CP + """,
s AS (SELECT count(spend) AS n, stddev_samp(spend) * count(spend) ^ (-0.2) AS h, min(spend) AS lo,
             (max(spend) - min(spend)) / 99 AS step FROM customer_profile),
g AS (SELECT CAST(range AS INTEGER) AS g FROM range(100))
SELECT g.g, lo + g.g * step AS x,
       sum(exp(-0.5 * ((lo + g.g * step - spend) / h) ^ 2)) / (n * h * sqrt(2 * pi())) AS density
FROM g CROSS JOIN s CROSS JOIN customer_profile WHERE spend IS NOT NULL GROUP BY g.g, lo, step, n, h""",
       doubles={"x": 4, "density": "b50"})
def d02_kde(spark, d):
    return D.kde(customer_profile(spark, d), "spend", 100)


# D-03 -----------------------------------------------------------------------
@query("d03_box_by_plan", CP + """,
q AS (SELECT plan, quantile_cont(ticket, 0.25) AS q1, quantile_cont(ticket, 0.5) AS median,
             quantile_cont(ticket, 0.75) AS q3 FROM customer_profile WHERE ticket IS NOT NULL GROUP BY plan),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM q)
SELECT f.plan, q1, median, q3, lo_fence, hi_fence, count(*) AS n,
       min(ticket) FILTER (WHERE ticket BETWEEN lo_fence AND hi_fence) AS whisker_lo,
       max(ticket) FILTER (WHERE ticket BETWEEN lo_fence AND hi_fence) AS whisker_hi,
       count(*) FILTER (WHERE NOT (ticket BETWEEN lo_fence AND hi_fence)) AS n_fliers
FROM customer_profile p JOIN f ON p.plan = f.plan WHERE ticket IS NOT NULL
GROUP BY f.plan, q1, median, q3, lo_fence, hi_fence""",
       doubles=["q1", "median", "q3", "lo_fence", "hi_fence", "whisker_lo", "whisker_hi"])
def d03_box_by_plan(spark, d):
    return D.box_stats(customer_profile(spark, d), "ticket", by="plan")


# D-04 -----------------------------------------------------------------------
@query("d04_fitted_line", CP + """
SELECT plan, regr_slope(spend, income) AS slope, regr_intercept(spend, income) AS intercept,
       regr_count(spend, income) AS n FROM customer_profile GROUP BY plan""",
       doubles=["slope", "intercept"], digits=4)
def d04_fitted_line(spark, d):
    return D.fitted_line(customer_profile(spark, d), "income", "spend", by="plan")


# D-05 / D-06 ----------------------------------------------------------------
@query("d05_binned_2d", RR + """,
s AS (SELECT min(quantity) AS x0, max(quantity) AS x1, min(y) AS y0, max(y) AS y1 FROM regression_rows)
SELECT CAST(least(floor((quantity - x0) / ((x1 - x0) / 10)), 9) AS INTEGER) AS bin_x,
       CAST(least(floor((y - y0) / ((y1 - y0) / 10)), 9) AS INTEGER) AS bin_y, count(*) AS count
FROM regression_rows, s GROUP BY 1, 2""")
def d05_binned_2d(spark, d):
    return D.binned_2d(regression_rows(spark, d), "quantity", "y", 10)


# D-07 -----------------------------------------------------------------------
@query("d07_qq_points")
def d07_qq_points(spark, d):
    """Ordered standardised values of y against normal quantiles at the
    plotting positions (i − 0.5) / n; ranks from the bucketed running sum."""
    from tessera.functions.ranks import value_ranks
    rr = regression_rows(spark, d)
    n, mu, sd = rr.agg(F.count("y"), F.avg("y"), F.stddev_samp("y")).first()
    r = value_ranks(rr, "y")
    p = (F.col("avg_rank") - 0.5) / F.lit(n)
    return r.select("y", "n_ties", p.alias("p"),
                    dist.norm_ppf_udf(p).alias("theoretical"),
                    ((F.col("y") - mu) / sd).alias("sample"))


@query("d07_qq_residuals", RR + """,
f AS (SELECT regr_slope(y, quantity) AS b, regr_intercept(y, quantity) AS a FROM regression_rows),
e AS (SELECT round(y - (a + b * quantity), 6) AS resid FROM regression_rows, f WHERE y IS NOT NULL AND quantity IS NOT NULL),
m AS (SELECT count(*) AS n, avg(resid) AS mu, stddev_samp(resid) AS sd FROM e),
t AS (SELECT resid, count(*) AS n_ties FROM e GROUP BY resid),
r AS (SELECT resid, n_ties, (sum(n_ties) OVER (ORDER BY resid) - n_ties + (n_ties + 1) / 2.0::DOUBLE - 0.5::DOUBLE) / n AS p,
        (resid - mu) / sd AS sample FROM t, m)
SELECT round(sample, 4) + 0.0 AS sample, round(p, 6) AS p, round(""" + ppf_sql("p") + """, 4) + 0.0 AS theoretical, CAST(n_ties AS BIGINT) AS n_ties FROM r""")
def d07_qq_residuals(spark, d):
    """Standardised residuals of the line of y on quantity against normal
    quantiles at (rank - 0.5) / n, a row per distinct residual; all in the JVM."""
    from tessera.functions.ranks import value_ranks
    rr = regression_rows(spark, d).dropna(subset=["y", "quantity"])
    line = D.fitted_line(rr, "quantity", "y").first()
    e = rr.select(F.round(F.col("y") - (F.lit(line["intercept"]) + F.lit(line["slope"]) * F.col("quantity")), 6).alias("resid"))
    n, mu, sd = e.agg(F.count("resid"), F.avg("resid"), F.stddev_samp("resid")).first()
    r = value_ranks(e, "resid").withColumn("p", (F.col("avg_rank") - 0.5) / F.lit(n))
    return r.select((F.round((F.col("resid") - F.lit(mu)) / F.lit(sd), 4) + 0.0).alias("sample"), F.round("p", 6).alias("p"),
                    (F.round(norm_ppf("p"), 4) + 0.0).alias("theoretical"), F.col("n_ties").cast("long").alias("n_ties"))


# D-02 / D-05 from counts ------------------------------------------------------
@query("d02_kde_binned", RR + """,
s AS (SELECT count(y) AS n, stddev_samp(y) AS sd, min(y) AS lo, max(y) AS hi FROM regression_rows),
c AS (SELECT (y - lo) / ((hi - lo) / 2000) AS u, least(floor((y - lo) / ((hi - lo) / 2000)), 1999) AS k FROM regression_rows, s WHERE y IS NOT NULL),
w AS (SELECT k, sum(v) AS v FROM (SELECT k, k + 1 - u AS v FROM c UNION ALL SELECT k + 1, u - k FROM c) GROUP BY k),
g AS (SELECT CAST(unnest(range(100)) AS INTEGER) AS g)
SELECT g, lo + g * ((hi - lo) / 99) AS x,
       sum(v * exp(-0.5 * ((g * ((hi - lo) / 99) - k * ((hi - lo) / 2000)) / (sd * n ^ -0.2)) ^ 2))
         / (n * (sd * n ^ -0.2) * sqrt(2 * pi())) * 1e6 AS density_e6
FROM g, w, s GROUP BY g, lo, hi, n, sd""", doubles=["x", "density_e6"], digits=4)
def d02_kde_binned(spark, d):
    return D.kde_binned(regression_rows(spark, d), "y").select("g", "x", (F.col("density") * 1e6).alias("density_e6"))


_BIN_COLS = list(REGRESSION_FEATURES) + ["y"]


def _bin_sql(c):
    return f"CAST(least(floor(({c} - (SELECT min({c}) FROM regression_rows)) / (SELECT (max({c}) - min({c})) / 10 FROM regression_rows)), 9) AS INTEGER)"


@query("d05_binned_pairs", RR + ",\nb AS (SELECT " + ", ".join(f"{_bin_sql(c)} AS {c}" for c in _BIN_COLS) + " FROM regression_rows)\n" + U.join(
    f"SELECT '{a}' AS col_x, '{b}' AS col_y, {a} AS bin_x, {b} AS bin_y, count(*) AS count FROM b WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY {a}, {b}"
    if a != b else f"SELECT '{a}' AS col_x, '{a}' AS col_y, {a} AS bin_x, {a} AS bin_y, count(*) AS count FROM b WHERE {a} IS NOT NULL GROUP BY {a}"
    for i, a in enumerate(_BIN_COLS) for b in _BIN_COLS[i:]))
def d05_binned_pairs(spark, d):
    return D.binned_pairs(regression_rows(spark, d), _BIN_COLS, 10)
