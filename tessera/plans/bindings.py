"""Stand-in analysis tables derived from the driver tables by Spark.

Each builder has a SQL twin (``*_SQL``) used by the DuckDB oracle, so a query
and its oracle start from the same derived rows. All builders read whole
tables; dimension joins (nation, region, part) are left to Catalyst, which
broadcasts them when their measured size is under the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import table

PROFILE_NUMERIC = ("income", "spend", "ticket", "frequency", "tenure_days")


def customer_profile(spark: SparkSession, d: str) -> DataFrame:
    """Customers with plan/region and spend features (the C0/C3 stand-in).

    income = account balance; spend/ticket/frequency = sum/avg/count of order
    value; tenure_days = first to last order; plan = market segment.
    """
    o = (table(spark, d, "orders")
         .groupBy("o_custkey")
         .agg(F.count(F.lit(1)).alias("frequency"),
              F.sum("o_totalprice").alias("spend"),
              F.avg("o_totalprice").alias("ticket"),
              F.min("o_orderdate").alias("first_order"),
              F.max("o_orderdate").alias("last_order")))
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "inner")
            .join(r, n.n_regionkey == r.r_regionkey, "inner")
            .join(o, c.c_custkey == o.o_custkey, "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    F.col("c_acctbal").alias("income"),
                    F.col("spend"), F.col("ticket"),
                    F.coalesce("frequency", F.lit(0)).cast("long").alias("frequency"),
                    F.datediff(F.to_date("last_order"), F.to_date("first_order")).alias("tenure_days"),
                    F.col("c_mktsegment").alias("plan"),
                    F.col("r_name").alias("region"),
                    F.col("n_name").alias("nation"),
                    F.to_date("first_order").alias("signup_date")))


CUSTOMER_PROFILE_SQL = """
customer_profile AS (
  SELECT c.c_custkey AS customer_id, c.c_acctbal AS income, o.spend, o.ticket,
         CAST(COALESCE(o.frequency, 0) AS BIGINT) AS frequency,
         CAST(date_diff('day', CAST(o.first_order AS DATE), CAST(o.last_order AS DATE)) AS INTEGER) AS tenure_days,
         c.c_mktsegment AS plan, r.r_name AS region, n.n_name AS nation,
         CAST(o.first_order AS DATE) AS signup_date
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT o_custkey, count(*) AS frequency, sum(o_totalprice) AS spend,
                    avg(o_totalprice) AS ticket, min(o_orderdate) AS first_order,
                    max(o_orderdate) AS last_order
             FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
)"""


def regression_rows(spark: SparkSession, d: str) -> DataFrame:
    """Orders summed over their lines and parts (the C3 regression stand-in):
    id = order key, unique; y = extended price of the order, which grows with
    its summed quantity and list price. Sums run over whole cents, so their
    order cannot change them.
    """
    l = table(spark, d, "lineitem")
    p = table(spark, d, "part")
    cents = lambda c: F.sum(F.round(F.col(c) * 100).cast("long")) / F.lit(100.0)
    n = F.count(F.lit(1))
    return (l.join(p, l.l_partkey == p.p_partkey, "inner")
            .groupBy(F.col("l_orderkey").alias("id"))
            .agg(cents("l_quantity").alias("quantity"), (cents("l_discount") / n).alias("discount"),
                 (cents("l_tax") / n).alias("tax"), (F.sum("p_size") / n).alias("size"),
                 cents("p_retailprice").alias("retail_price"), F.max("l_returnflag").alias("return_flag"),
                 cents("l_extendedprice").alias("y")))


REGRESSION_ROWS_SQL = """
regression_rows AS (
  SELECT l.l_orderkey AS id, sum(CAST(round(l.l_quantity * 100) AS BIGINT)) / 100.0::DOUBLE AS quantity,
         sum(CAST(round(l.l_discount * 100) AS BIGINT)) / 100.0::DOUBLE / count(*) AS discount,
         sum(CAST(round(l.l_tax * 100) AS BIGINT)) / 100.0::DOUBLE / count(*) AS tax,
         CAST(sum(p.p_size) AS DOUBLE) / count(*) AS size,
         sum(CAST(round(p.p_retailprice * 100) AS BIGINT)) / 100.0::DOUBLE AS retail_price,
         max(l.l_returnflag) AS return_flag, sum(CAST(round(l.l_extendedprice * 100) AS BIGINT)) / 100.0::DOUBLE AS y
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY l.l_orderkey
)"""

REGRESSION_FEATURES = ("quantity", "discount", "tax", "size", "retail_price")


def daily_series(spark: SparkSession, d: str) -> DataFrame:
    """Order value per day and priority (the C4 price-series stand-in):
    series_id = priority, close = mean order value, volume = orders."""
    return (table(spark, d, "orders")
            .groupBy(F.col("o_orderpriority").alias("series_id"),
                     F.to_date("o_orderdate").alias("ds"))
            .agg(F.avg("o_totalprice").alias("close"), F.count(F.lit(1)).alias("volume")))


DAILY_SERIES_SQL = """
daily_series AS (
  SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS ds,
         avg(o_totalprice) AS close, count(*) AS volume
  FROM orders GROUP BY 1, 2
)"""


def with_sql(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


def profile_with_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Customer profile with injected missing values (the driver tables have no
    NULLs): income NULL when id % 17 = 0, ticket NaN when id % 23 = 0, plan
    NULL when id % 29 = 0; every row is kept."""
    p = customer_profile(spark, d)
    cid = F.col("customer_id")
    return p.select(
        "customer_id",
        F.when(F.pmod(cid, F.lit(17)) == 0, F.lit(None).cast("double")).otherwise(F.col("income")).alias("income"),
        "spend",
        F.when(F.pmod(cid, F.lit(23)) == 0, F.lit(float("nan"))).otherwise(F.col("ticket")).alias("ticket"),
        "frequency", "tenure_days",
        F.when(F.pmod(cid, F.lit(29)) == 0, F.lit(None).cast("string")).otherwise(F.col("plan")).alias("plan"),
        "region", "nation", "signup_date")


PROFILE_WITH_GAPS_SQL = CUSTOMER_PROFILE_SQL.strip() + """,
profile_with_gaps AS (
  SELECT customer_id,
         CASE WHEN customer_id % 17 = 0 THEN NULL ELSE income END AS income,
         spend,
         CASE WHEN customer_id % 23 = 0 THEN 'NaN'::DOUBLE ELSE ticket END AS ticket,
         frequency, tenure_days,
         CASE WHEN customer_id % 29 = 0 THEN NULL ELSE plan END AS plan,
         region, nation, signup_date
  FROM customer_profile
)"""

# Column names and Spark type names of the lineitem table.
LINEITEM_SCHEMA = (
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
)
