"""Queries: sorts / top-k (K-*), joins and set operations (J-*), counts and
reshaping (A-03 … A-13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import row_hash_sql, row_uniform, row_uniform_sql
from tessera.operators import describe as D
from tessera.operators import ranking as K
from tessera.operators import stats as S
from tessera.plans.bindings import (CUSTOMER_PROFILE_SQL, PROFILE_NUMERIC, REGRESSION_FEATURES,
                                    REGRESSION_ROWS_SQL, customer_profile, regression_rows,
                                    with_sql)
from tessera.plans.registry import query
from tessera.sources.tables import table

CP = with_sql(CUSTOMER_PROFILE_SQL)
PLANS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


# K-01 -----------------------------------------------------------------------
@query("k01_top10_spend", CP + """
SELECT customer_id, plan, spend FROM customer_profile
ORDER BY spend DESC NULLS LAST, customer_id LIMIT 10""", doubles=["spend"], digits=2)
def k01_top10_spend(spark, d):
    return K.top_n(customer_profile(spark, d).select("customer_id", "plan", "spend"),
                   "spend", 10, "customer_id")


# K-02 -----------------------------------------------------------------------
@query("k02_nations_by_income", CP + """
SELECT nation, avg(income) AS mean_income FROM customer_profile GROUP BY nation
ORDER BY mean_income DESC, nation LIMIT 5""", doubles=["mean_income"])
def k02_nations_by_income(spark, d):
    m = customer_profile(spark, d).groupBy("nation").agg(F.avg("income").alias("mean_income"))
    return K.top_n(m, "mean_income", 5, "nation")


# K-03 -----------------------------------------------------------------------
@query("k03_extreme_customers", CP + """
SELECT plan, first(customer_id ORDER BY spend DESC, customer_id) AS max_customer_id, max(spend) AS max_spend
FROM customer_profile WHERE spend IS NOT NULL GROUP BY plan""", doubles=["max_spend"], digits=2)
def k03_extreme_customers(spark, d):
    return K.arg_extreme(customer_profile(spark, d), "plan", "customer_id", "spend", "max")


# K-04 -----------------------------------------------------------------------
@query("k04_best_plan_per_region", CP + """,
m AS (SELECT region, plan, avg(ticket) AS mean_ticket FROM customer_profile GROUP BY ALL)
SELECT region, first(plan ORDER BY mean_ticket, plan) AS min_plan, min(mean_ticket) AS min_mean_ticket
FROM m GROUP BY region""", doubles=["min_mean_ticket"])
def k04_best_plan_per_region(spark, d):
    m = customer_profile(spark, d).groupBy("region", "plan").agg(F.avg("ticket").alias("mean_ticket"))
    return K.arg_extreme(m, "region", "plan", "mean_ticket", "min")


# K-05 -----------------------------------------------------------------------
@query("k05_first_per_group", """
SELECT lang, min(doc_id) AS doc_id, first(source ORDER BY doc_id) AS source,
       first(n_chars ORDER BY doc_id) AS n_chars FROM documents GROUP BY lang""")
def k05_first_per_group(spark, d):
    return K.first_per_group(table(spark, d, "documents"), "lang", "doc_id", ["source", "n_chars"])


# K-06 -----------------------------------------------------------------------
@query("k06_rank_labels", CP + """,
m AS (SELECT plan, avg(spend) AS mean_spend FROM customer_profile GROUP BY plan)
SELECT plan, mean_spend, CAST(row_number() OVER (ORDER BY mean_spend, plan) AS INTEGER) AS rank,
       'tier_' || CAST(row_number() OVER (ORDER BY mean_spend, plan) AS VARCHAR) AS label
FROM m""", doubles=["mean_spend"])
def k06_rank_labels(spark, d):
    m = customer_profile(spark, d).groupBy("plan").agg(F.avg("spend").alias("mean_spend"))
    return K.rank_labels(m, "plan", "mean_spend", [f"tier_{i}" for i in range(1, 6)])


# K-07 / P-10 ----------------------------------------------------------------
@query("k07_target_corr_by_abs", with_sql(REGRESSION_ROWS_SQL) + """,
c AS (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, corr({c}, y) AS r FROM regression_rows" for c in REGRESSION_FEATURES) + """)
SELECT feature, r, abs(r) AS abs_r, CAST(row_number() OVER (ORDER BY abs(r) DESC, feature) AS INTEGER) AS rank
FROM c""", doubles=["r", "abs_r"])
def k07_target_corr_by_abs(spark, d):
    from pyspark.sql import Window
    t = S.target_correlations(regression_rows(spark, d), REGRESSION_FEATURES, "y")
    # the correlation table has one row per feature; ordering it is free
    return t.withColumn("rank", F.row_number().over(Window.orderBy(F.abs("r").desc(), "feature")))


# K-08 -----------------------------------------------------------------------
@query("k08_seeded_sample", f"""
SELECT doc_id, lang FROM documents ORDER BY {row_hash_sql('doc_id', 7)}, doc_id LIMIT 50""")
def k08_seeded_sample(spark, d):
    return K.seeded_sample(table(spark, d, "documents").select("doc_id", "lang"), "doc_id", 50, 7)


# K-09 -----------------------------------------------------------------------
@query("k09_nth_distinct_day", """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
r AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS position FROM d)
SELECT position, day FROM r WHERE position IN (0, 8, 16)""")
def k09_nth_distinct_day(spark, d):
    days = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"))
    return K.nth_distinct(days, "day", [0, 8, 16])


# J-01 -----------------------------------------------------------------------
@query("j01_align_labels", """
SELECT d.lang, l.quality, count(*) AS n, avg(d.n_chars) AS mean_chars
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY ALL""", doubles=["mean_chars"])
def j01_align_labels(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    j = docs.join(labels, on="doc_id", how="inner")
    return j.groupBy("lang", "quality").agg(F.count(F.lit(1)).alias("n"), F.avg("n_chars").alias("mean_chars"))


# J-02 -----------------------------------------------------------------------
@query("j02_semi_anti", """
WITH late AS (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT c_mktsegment AS plan,
       count(*) FILTER (WHERE c_custkey IN (SELECT o_custkey FROM late)) AS n_with,
       count(*) FILTER (WHERE c_custkey NOT IN (SELECT o_custkey FROM late)) AS n_without
FROM customer GROUP BY 1""")
def j02_semi_anti(spark, d):
    c = table(spark, d, "customer")
    late = table(spark, d, "orders").filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) \
        .select(F.col("o_custkey").alias("c_custkey"))
    w = c.join(late, on="c_custkey", how="left_semi").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_with"))
    wo = c.join(late, on="c_custkey", how="left_anti").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_without"))
    return (w.join(wo, on="c_mktsegment", how="full_outer")
            .select(F.col("c_mktsegment").alias("plan"),
                    F.coalesce("n_with", F.lit(0)).alias("n_with"),
                    F.coalesce("n_without", F.lit(0)).alias("n_without")))


# J-03 / J-04 ----------------------------------------------------------------
@query("j03_j04_key_sets", """
SELECT 'suppliers_in_both' AS metric, count(*) AS n FROM (SELECT l_suppkey FROM lineitem INTERSECT SELECT s_suppkey FROM supplier)
UNION ALL
SELECT 'parts_never_sold', count(*) FROM (SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem)""")
def j03_j04_key_sets(spark, d):
    li = table(spark, d, "lineitem")
    inter = li.select("l_suppkey").intersect(table(spark, d, "supplier").select("s_suppkey"))
    never = table(spark, d, "part").select("p_partkey").subtract(li.select("l_partkey"))
    a = inter.agg(F.count(F.lit(1)).alias("n")).select(F.lit("suppliers_in_both").alias("metric"), "n")
    b = never.agg(F.count(F.lit(1)).alias("n")).select(F.lit("parts_never_sold").alias("metric"), "n")
    return a.unionByName(b)


# J-05 -----------------------------------------------------------------------
@query("j05_union_labelled", """
SELECT 'orders' AS source, date_trunc('year', o_orderdate)::DATE AS year, count(*) AS n, NULL::DOUBLE AS qty
FROM orders GROUP BY ALL
UNION ALL
SELECT 'lineitem', date_trunc('year', l_shipdate)::DATE, count(*), sum(l_quantity) FROM lineitem GROUP BY ALL""",
       doubles=["qty"], digits=2)
def j05_union_labelled(spark, d):
    o = (table(spark, d, "orders").groupBy(F.trunc(F.to_date("o_orderdate"), "year").alias("year"))
         .agg(F.count(F.lit(1)).alias("n")).withColumn("source", F.lit("orders")))
    li = (table(spark, d, "lineitem").groupBy(F.trunc(F.to_date("l_shipdate"), "year").alias("year"))
          .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))
          .withColumn("source", F.lit("lineitem")))
    return o.unionByName(li, allowMissingColumns=True).select("source", "year", "n", "qty")


# A-03 / A-04 ----------------------------------------------------------------
@query("a03_value_counts", """
SELECT o_orderstatus, count(*) AS count, count(*) * 100.0 / (SELECT count(*) FROM orders) AS pct
FROM orders GROUP BY 1""", doubles=["pct"])
def a03_value_counts(spark, d):
    return D.value_counts(table(spark, d, "orders"), "o_orderstatus")


# A-05 -----------------------------------------------------------------------
@query("a05_imbalance_ratio", """
WITH c AS (SELECT lang, count(*) AS cnt FROM documents GROUP BY lang)
SELECT max(cnt) AS max_count, min(cnt) AS min_count, max(cnt) / min(cnt) AS imbalance_ratio FROM c""",
       doubles=["imbalance_ratio"])
def a05_imbalance_ratio(spark, d):
    return D.imbalance_ratio(table(spark, d, "documents"), "lang")


# A-06 -----------------------------------------------------------------------
@query("a06_crosstab_plan_region", CP + "\nSELECT plan, " + ", ".join(
    f"count(*) FILTER (WHERE region = '{r}') AS \"{r}\"" for r in REGIONS) +
    f", count(*) FILTER (WHERE region IS NULL OR region NOT IN {REGIONS}) AS other FROM customer_profile GROUP BY plan")
def a06_crosstab_plan_region(spark, d):
    return D.crosstab(customer_profile(spark, d), "plan", "region", REGIONS)


# A-08 -----------------------------------------------------------------------
@query("a08_melt_profile_means", CP + """,
m AS (SELECT plan, """ + ", ".join(f"avg({c}) AS {c}" for c in PROFILE_NUMERIC) + """ FROM customer_profile GROUP BY plan)
SELECT plan, variable, value FROM m UNPIVOT (value FOR variable IN (""" + ", ".join(PROFILE_NUMERIC) + "))",
       doubles=["value"])
def a08_melt_profile_means(spark, d):
    m = customer_profile(spark, d).groupBy("plan").agg(*[F.avg(c).alias(c) for c in PROFILE_NUMERIC])
    return D.melt(m, ["plan"], PROFILE_NUMERIC)


# A-10 -----------------------------------------------------------------------
@query("a10_pair_counts", """
SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY ALL""")
def a10_pair_counts(spark, d):
    return D.pair_counts(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus")


# A-11 -----------------------------------------------------------------------
@query("a11_distinct_count", """SELECT count(DISTINCT o_custkey) AS n_distinct_o_custkey FROM orders""")
def a11_distinct_count(spark, d):
    return D.distinct_count(table(spark, d, "orders"), "o_custkey")


# A-12 -----------------------------------------------------------------------
@query("a12_monthly_counts", """
WITH c AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS n FROM lineitem GROUP BY 1),
m AS (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM c)
SELECT m.month, CAST(COALESCE(c.n, 0) AS BIGINT) AS n FROM m LEFT JOIN c ON m.month = c.month""")
def a12_monthly_counts(spark, d):
    return D.monthly_counts(table(spark, d, "lineitem"), "l_shipdate")


# A-13 -----------------------------------------------------------------------
_SPLIT = f"CASE WHEN {row_uniform_sql('doc_id', 42)} < 0.8 THEN 'train' ELSE 'test' END"


@query("a13_class_share_by_split", f"""
WITH s AS (SELECT {_SPLIT} AS split, lang FROM documents)
SELECT split, lang, count(*) AS count,
       count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY split) AS pct
FROM s GROUP BY split, lang""", doubles=["pct"])
def a13_class_share_by_split(spark, d):
    s = table(spark, d, "documents").withColumn(
        "split", F.when(row_uniform("doc_id", 42) < 0.8, "train").otherwise("test"))
    return D.value_counts(s, "lang", by="split")
