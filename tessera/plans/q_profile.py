"""Queries: profiling, outliers and grouped statistics on the customer profile."""

from __future__ import annotations

from tessera.operators import describe as D
from tessera.operators import stats as S
from tessera.plans.bindings import (CUSTOMER_PROFILE_SQL, PROFILE_NUMERIC, customer_profile,
                                    with_sql)
from tessera.plans.registry import query

NUM = PROFILE_NUMERIC
CP = with_sql(CUSTOMER_PROFILE_SQL)


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# Q-05 -----------------------------------------------------------------------
_DESCRIBE_SQL = CP + "\n" + _union([
    f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
       CAST(min({c}) AS DOUBLE) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25,
       quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75,
       CAST(max({c}) AS DOUBLE) AS max FROM customer_profile""" for c in NUM])


@query("q05_describe_numeric", _DESCRIBE_SQL, doubles=["mean", "std", "p25", "p50", "p75", "min", "max"])
def q05_describe_numeric(spark, d):
    return D.describe_numeric(customer_profile(spark, d), NUM)


# P-01 / P-03 ----------------------------------------------------------------
_IQR_SQL = CP + """,
long AS (
  SELECT plan, metric, x FROM customer_profile
  UNPIVOT (x FOR metric IN (""" + ", ".join(NUM) + """))
),
longd AS (SELECT plan, metric, CAST(x AS DOUBLE) AS x FROM long WHERE x IS NOT NULL),
f AS (
  SELECT metric, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM longd GROUP BY metric
),
f2 AS (SELECT metric, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM f)
SELECT plan, l.metric, lower, upper, count(*) AS n,
       count(*) FILTER (WHERE x < lower OR x > upper) AS n_outliers,
       count(*) FILTER (WHERE x < lower OR x > upper) * 100.0 / count(*) AS pct_outliers
FROM longd l JOIN f2 ON l.metric = f2.metric
GROUP BY plan, l.metric, lower, upper"""


@query("p01_iqr_outliers_by_plan", _IQR_SQL, doubles=["lower", "upper", "pct_outliers"])
def p01_iqr_outliers_by_plan(spark, d):
    """Global 1.5·IQR fences per metric; outliers counted per plan (P-01, P-03)."""
    return S.iqr_outliers(customer_profile(spark, d), NUM, by="plan")


_IQR_GLOBAL_SQL = CP + """,
long AS (SELECT metric, CAST(x AS DOUBLE) AS x FROM customer_profile
         UNPIVOT (x FOR metric IN (""" + ", ".join(NUM) + """)) WHERE x IS NOT NULL),
f AS (SELECT metric, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM long GROUP BY metric),
f2 AS (SELECT metric, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM f)
SELECT l.metric, lower, upper, count(*) AS n,
       count(*) FILTER (WHERE x < lower OR x > upper) AS n_outliers,
       count(*) FILTER (WHERE x < lower OR x > upper) * 100.0 / count(*) AS pct_outliers
FROM long l JOIN f2 ON l.metric = f2.metric GROUP BY l.metric, lower, upper"""


@query("p01_iqr_outliers", _IQR_GLOBAL_SQL, doubles=["lower", "upper", "pct_outliers"])
def p01_iqr_outliers(spark, d):
    return S.iqr_outliers(customer_profile(spark, d), NUM)


# P-02 -----------------------------------------------------------------------
_Z_SQL = CP + """,
long AS (SELECT metric, CAST(x AS DOUBLE) AS x FROM customer_profile
         UNPIVOT (x FOR metric IN (""" + ", ".join(NUM) + """)) WHERE x IS NOT NULL),
f AS (SELECT metric, avg(x) AS mean, stddev_pop(x) AS std FROM long GROUP BY metric)
SELECT l.metric, mean, std, count(*) AS n,
       count(*) FILTER (WHERE abs(x - mean) / std > 3) AS n_outliers
FROM long l JOIN f ON l.metric = f.metric GROUP BY l.metric, mean, std"""


@query("p02_zscore_outliers", _Z_SQL, doubles=["mean", "std"])
def p02_zscore_outliers(spark, d):
    return S.zscore_outliers(customer_profile(spark, d), NUM, 3.0)


# A-01 / Q-07 ----------------------------------------------------------------
_GROUP_SQL = CP + """,
long AS (SELECT plan, metric, CAST(x AS DOUBLE) AS x FROM customer_profile
         UNPIVOT INCLUDE NULLS (x FOR metric IN (""" + ", ".join(NUM) + """)))
SELECT plan, metric AS "column", count(x) AS n, avg(x) AS mean, median(x) AS median,
       stddev_samp(x) AS std
FROM long GROUP BY plan, metric"""


@query("a01_group_stats_by_plan", _GROUP_SQL, doubles=["mean", "median", "std"])
def a01_group_stats_by_plan(spark, d):
    return D.group_describe(customer_profile(spark, d), "plan", NUM)


# A-02 -----------------------------------------------------------------------
_MEANS_SQL = CP + "\nSELECT plan, count(*) AS n, " + ", ".join(
    f"avg({c}) AS mean_{c}" for c in NUM) + " FROM customer_profile GROUP BY plan"


@query("a02_profile_means_by_plan", _MEANS_SQL, doubles=[f"mean_{c}" for c in NUM])
def a02_profile_means_by_plan(spark, d):
    return D.group_means(customer_profile(spark, d), "plan", NUM)
