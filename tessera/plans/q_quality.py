"""Queries: data-quality audits and cleaning (Q-*, F-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import row_uniform, row_uniform_sql
from tessera.operators import describe as D
from tessera.operators import quality as Q
from tessera.plans.bindings import (CUSTOMER_PROFILE_SQL, DAILY_SERIES_SQL, LINEITEM_SCHEMA,
                                    PROFILE_WITH_GAPS_SQL, REGRESSION_ROWS_SQL, customer_profile,
                                    daily_series, profile_with_gaps, regression_rows, with_sql)
from tessera.operators.timeseries import business_calendar
from tessera.plans.registry import query
from tessera.sources.tables import table

U = "\nUNION ALL\n"
GAPS = with_sql(PROFILE_WITH_GAPS_SQL)
GAP_COLS = ("customer_id", "income", "spend", "ticket", "frequency", "tenure_days", "plan",
            "region", "nation", "signup_date")
GAP_DOUBLES = ("income", "spend", "ticket")


# Q-01 -----------------------------------------------------------------------
@query("q01_schema_info", U.join(
    f"""SELECT '{c}' AS "column", CAST({i} AS INTEGER) AS position, '{t}' AS dtype,
       count(*) AS n_rows, count({c}) AS non_null FROM lineitem"""
    for i, (c, t) in enumerate(LINEITEM_SCHEMA)))
def q01_schema_info(spark, d):
    return Q.schema_info(table(spark, d, "lineitem"))


# Q-02 -----------------------------------------------------------------------
def _missing_sql(c):
    return f"({c} IS NULL OR isnan({c}))" if c in GAP_DOUBLES else f"{c} IS NULL"


@query("q02_null_counts", GAPS + "\n" + U.join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {_missing_sql(c)}) AS n_null,
       count(*) FILTER (WHERE {_missing_sql(c)}) * 100.0 / count(*) AS pct_null FROM profile_with_gaps"""
    for c in GAP_COLS), doubles=["pct_null"])
def q02_null_counts(spark, d):
    return Q.null_counts(profile_with_gaps(spark, d))


# Q-03 -----------------------------------------------------------------------
@query("q03_duplicates_documents", """
WITH g AS (SELECT text, lang, count(*) AS c FROM documents GROUP BY text, lang)
SELECT CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_distinct,
       CAST(sum(c - 1) AS BIGINT) AS n_duplicates, count(*) FILTER (WHERE c > 1) AS n_repeated_keys
FROM g""")
def q03_duplicates_documents(spark, d):
    return Q.duplicate_counts(table(spark, d, "documents"), key=["text", "lang"])


@query("q03_duplicates_full_rows", """
WITH g AS (SELECT conv_id, turn, role, text, count(*) AS c FROM conversations GROUP BY ALL)
SELECT CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_distinct,
       CAST(sum(c - 1) AS BIGINT) AS n_duplicates, count(*) FILTER (WHERE c > 1) AS n_repeated_keys
FROM g""")
def q03_duplicates_full_rows(spark, d):
    return Q.duplicate_counts(table(spark, d, "conversations"))


# Q-04 -----------------------------------------------------------------------
@query("q04_empty_texts", """
SELECT count(*) FILTER (WHERE trim(text) = '') AS n_empty, count(text) AS n_text FROM conversations""")
def q04_empty_texts(spark, d):
    return Q.empty_text_count(table(spark, d, "conversations"), "text")


# Q-06 -----------------------------------------------------------------------
@query("q06_describe_categorical", with_sql(CUSTOMER_PROFILE_SQL) + """,
long AS (SELECT 'plan' AS "column", plan AS value FROM customer_profile
         UNION ALL SELECT 'region', region FROM customer_profile
         UNION ALL SELECT 'nation', nation FROM customer_profile),
c AS (SELECT "column", value, count(*) AS cnt FROM long WHERE value IS NOT NULL GROUP BY ALL)
SELECT "column", CAST(sum(cnt) AS BIGINT) AS count, count(*) AS "unique",
       first(value ORDER BY cnt DESC, value) AS top, max(cnt) AS freq
FROM c GROUP BY "column" """)
def q06_describe_categorical(spark, d):
    return D.describe_categorical(customer_profile(spark, d), ["plan", "region", "nation"])


# Q-07 / A-14 ----------------------------------------------------------------
@query("q07_words_by_lang", """
WITH t AS (SELECT lang, CAST(len(regexp_extract_all(text, '\\S+')) AS DOUBLE) AS n_words,
                  CAST(length(text) AS DOUBLE) AS n_chars FROM documents),
long AS (SELECT lang, 'n_words' AS "column", n_words AS x FROM t
         UNION ALL SELECT lang, 'n_chars', n_chars FROM t)
SELECT lang, "column", count(x) AS n, avg(x) AS mean, median(x) AS median, stddev_samp(x) AS std
FROM long GROUP BY ALL""", doubles=["mean", "median", "std"])
def q07_words_by_lang(spark, d):
    docs = D.text_lengths(table(spark, d, "documents"), "text")
    return D.group_describe(docs, "lang", ["n_words", "n_chars"])


@query("a14_text_extremes", """
SELECT lang, count(text) AS n, min({'n': length(text), 'd': doc_id}).n AS min_chars,
       min({'n': length(text), 'd': doc_id}).d AS shortest_id, max({'n': length(text), 'd': -doc_id}).n AS max_chars,
       -max({'n': length(text), 'd': -doc_id}).d AS longest_id FROM documents WHERE text IS NOT NULL GROUP BY lang""")
def a14_text_extremes(spark, d):
    """Shortest and longest text per language (ties: smallest id)."""
    docs = D.text_lengths(table(spark, d, "documents").filter("text IS NOT NULL"), "text")
    n = F.col("n_chars").cast("long")
    return docs.groupBy("lang").agg(
        F.count("text").alias("n"), F.min(n).alias("min_chars"), F.min_by("doc_id", F.struct(n, "doc_id")).alias("shortest_id"),
        F.max(n).alias("max_chars"), F.max_by("doc_id", F.struct(n, -F.col("doc_id"))).alias("longest_id"))


# Q-08 -----------------------------------------------------------------------
@query("q08_all_null_rows", GAPS + """
SELECT customer_id, region FROM profile_with_gaps
WHERE income IS NULL AND (ticket IS NULL OR isnan(ticket)) AND plan IS NULL""")
def q08_all_null_rows(spark, d):
    p = profile_with_gaps(spark, d)
    return Q.all_null_rows(p, ["income", "ticket", "plan"]).select("customer_id", "region")


# Q-09 / J-03 ----------------------------------------------------------------
@query("q09_key_overlap", """
WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT (SELECT count(*) FROM a) AS n_a, (SELECT count(*) FROM b) AS n_b,
       (SELECT count(*) FROM (SELECT k FROM a INTERSECT SELECT k FROM b)) AS n_both""")
def q09_key_overlap(spark, d):
    """Distinct customer keys of orders vs order keys of lineitem (a key-space audit)."""
    a = table(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    b = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"))
    return Q.key_overlap(a, b, "k")


# Q-10 -----------------------------------------------------------------------
_SPLIT_SQL = f"{row_uniform_sql('doc_id', 42)} < 0.8"


@query("q10_text_leakage", f"""
WITH tr AS (SELECT DISTINCT text, lang FROM documents WHERE {_SPLIT_SQL}),
te AS (SELECT text, lang FROM documents WHERE NOT ({_SPLIT_SQL})),
m AS (SELECT te.text, tr.text IS NOT NULL AS seen FROM te LEFT JOIN tr
      ON te.text = tr.text AND te.lang = tr.lang)
SELECT count(*) AS n_test, count(*) FILTER (WHERE seen) AS n_leaked,
       count(*) FILTER (WHERE seen) / count(*) AS leak_rate FROM m""", doubles=["leak_rate"])
def q10_text_leakage(spark, d):
    docs = table(spark, d, "documents").withColumn("__u", row_uniform("doc_id", 42))
    return Q.leakage_rate(docs.filter("__u < 0.8"), docs.filter("NOT (__u < 0.8)"), ["text", "lang"])


# Q-11 -----------------------------------------------------------------------
@query("q11_repeated_texts", """
WITH c AS (SELECT text, count(*) AS n_copies FROM documents GROUP BY text HAVING count(*) > 1)
SELECT d.doc_id, d.lang, c.n_copies FROM documents d JOIN c ON d.text = c.text""")
def q11_repeated_texts(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    return Q.repeated_key_members(docs, ["text"]).select("doc_id", "lang", "n_copies")


# Q-13 -----------------------------------------------------------------------
@query("q13_period_coverage", with_sql(DAILY_SERIES_SQL) + """,
days AS (SELECT DISTINCT series_id, ds AS d FROM daily_series),
b AS (SELECT series_id, min(d) AS first_day, max(d) AS last_day, count(*) AS n_days FROM days GROUP BY 1),
cal AS (SELECT series_id, CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
bd AS (SELECT * FROM cal WHERE isodow(d) <= 5),
e AS (SELECT series_id, count(*) AS expected_business_days FROM bd GROUP BY 1),
m AS (SELECT series_id, count(*) AS missing_business_days FROM
      (SELECT series_id, d FROM bd EXCEPT ALL SELECT series_id, d FROM days) GROUP BY 1),
g AS (SELECT series_id, max(gap) AS longest_gap_days FROM
      (SELECT series_id, CAST(date_diff('day', lag(d) OVER (PARTITION BY series_id ORDER BY d), d) AS INTEGER) AS gap FROM days)
      GROUP BY 1)
SELECT b.series_id, first_day, last_day, n_days, expected_business_days,
       CAST(COALESCE(missing_business_days, 0) AS BIGINT) AS missing_business_days, longest_gap_days
FROM b LEFT JOIN e USING (series_id) LEFT JOIN m USING (series_id) LEFT JOIN g USING (series_id)""")
def q13_period_coverage(spark, d):
    return Q.period_coverage(daily_series(spark, d), "ds", "series_id")


# F-03 / F-04 ----------------------------------------------------------------
@query("f04_spend_share", with_sql(CUSTOMER_PROFILE_SQL) + """
SELECT plan, count(*) AS n, avg(ticket / nullif(income, 0)) AS mean_ratio,
       stddev_samp(ticket / nullif(income, 0)) AS std_ratio
FROM customer_profile GROUP BY plan""", doubles=["mean_ratio", "std_ratio"])
def f04_spend_share(spark, d):
    """Ticket as a share of income (F-04), per plan; NULL where income is 0."""
    p = customer_profile(spark, d).withColumn("ratio", F.expr("try_divide(ticket, income)"))
    return p.groupBy("plan").agg(F.count(F.lit(1)).alias("n"), F.avg("ratio").alias("mean_ratio"),
                                 F.stddev_samp("ratio").alias("std_ratio"))


@query("f03_cast_types", """
SELECT CAST(l_shipdate AS DATE) AS ship_day, TRY_CAST(l_linenumber AS BIGINT) AS line,
       TRY_CAST(l_quantity AS INTEGER) AS qty, count(*) AS n
FROM lineitem GROUP BY ALL""")
def f03_cast_types(spark, d):
    li = table(spark, d, "lineitem").select(
        F.col("l_shipdate").alias("ship_day"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("qty"))
    typed = Q.cast_columns(li, {"ship_day": "date", "line": "bigint", "qty": "int"})
    return typed.groupBy("ship_day", "line", "qty").agg(F.count(F.lit(1)).alias("n"))


# F-02 / F-05 ----------------------------------------------------------------
@query("f05_dropna", GAPS + """
SELECT customer_id, region FROM profile_with_gaps
WHERE income IS NOT NULL AND NOT isnan(ticket) AND ticket IS NOT NULL AND plan IS NOT NULL""")
def f05_dropna(spark, d):
    p = Q.drop_missing(profile_with_gaps(spark, d), ["income", "ticket", "plan"])
    return p.select("customer_id", "region")


# F-06 … F-08 (F-07, the cross-column rule, is quantity > size + 10 here) ----
def _rules():
    return Q.RuleSet([
        ("discount_above_max", F.col("discount") > 0.09),
        ("quantity_over_size", F.col("quantity") > F.col("size") + 10),
    ])


_RULES_SQL = with_sql(REGRESSION_ROWS_SQL) + """,
t AS (SELECT CASE WHEN discount > 0.09 THEN 'discount_above_max'
                  WHEN quantity > size + 10 THEN 'quantity_over_size' END AS r FROM regression_rows),
rules AS (SELECT * FROM (VALUES ('discount_above_max', 0), ('quantity_over_size', 1)) v(rule, rule_order))
SELECT rule, CAST(rule_order AS INTEGER) AS rule_order, CAST(count(t.r) AS BIGINT) AS n_removed
FROM rules LEFT JOIN t ON t.r = rules.rule GROUP BY rule, rule_order"""


@query("f08_rule_audit", _RULES_SQL)
def f08_rule_audit(spark, d):
    return _rules().audit(regression_rows(spark, d))


@query("f08_clean_summary", with_sql(REGRESSION_ROWS_SQL) + """
SELECT return_flag, count(*) AS n, avg(y) AS mean_y FROM regression_rows
WHERE NOT (discount > 0.09) AND NOT (quantity > size + 10) GROUP BY return_flag""", doubles=["mean_y"])
def f08_clean_summary(spark, d):
    clean = _rules().clean(regression_rows(spark, d))
    return clean.groupBy("return_flag").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean_y"))


# F-09 -----------------------------------------------------------------------
@query("f09_normalise_category", """
SELECT regexp_replace(regexp_replace(trim(p_type), '\\s*&\\s*', ' ', 'g'), '\\s+', '_', 'g') AS category,
       count(*) AS n FROM part GROUP BY 1""")
def f09_normalise_category(spark, d):
    p = table(spark, d, "part").select(Q.normalise_category("p_type").alias("category"))
    return p.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


# F-10 / J-10 ----------------------------------------------------------------
@query("f10_map_with_fallback", """
WITH m AS (SELECT n_nationkey AS k, n_name AS v FROM nation JOIN region ON n_regionkey = r_regionkey
           WHERE r_name = 'EUROPE')
SELECT COALESCE(m.v, CAST(c.c_nationkey AS VARCHAR)) AS nation_label, count(*) AS n
FROM customer c LEFT JOIN m ON c.c_nationkey = m.k GROUP BY 1""")
def f10_map_with_fallback(spark, d):
    """Nation names for European nations, the raw code elsewhere."""
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    m = n.join(r, n.n_regionkey == r.r_regionkey).filter(F.col("r_name") == "EUROPE")
    c = Q.map_with_fallback(table(spark, d, "customer"), "c_nationkey", m, "n_nationkey", "n_name",
                            "nation_label")
    return c.groupBy("nation_label").agg(F.count(F.lit(1)).alias("n"))


# F-11 -----------------------------------------------------------------------
@query("f11_flag_top10", with_sql(CUSTOMER_PROFILE_SQL) + """,
top AS (SELECT customer_id FROM customer_profile ORDER BY spend DESC NULLS LAST, customer_id LIMIT 10)
SELECT plan, count(*) AS n, count(*) FILTER (WHERE t.customer_id IS NOT NULL) AS n_top10
FROM customer_profile p LEFT JOIN top t ON p.customer_id = t.customer_id GROUP BY plan""")
def f11_flag_top10(spark, d):
    from tessera.operators.ranking import top_n
    p = customer_profile(spark, d)
    flagged = Q.flag_in(p, top_n(p, "spend", 10, "customer_id"), "customer_id", "top10")
    return flagged.groupBy("plan").agg(F.count(F.lit(1)).alias("n"),
                                       F.count_if("top10").alias("n_top10"))


# F-12 / W-11 ----------------------------------------------------------------
@query("f12_interpolate_calendar", with_sql(DAILY_SERIES_SQL) + """,
b AS (SELECT series_id, min(ds) AS lo, max(ds) AS hi FROM daily_series GROUP BY 1),
cal AS (SELECT series_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS ds FROM b),
x AS (SELECT c.series_id, c.ds, s.close, CAST(s.volume AS DOUBLE) AS volume,
             row_number() OVER (PARTITION BY c.series_id ORDER BY c.ds) AS pos
      FROM cal c LEFT JOIN daily_series s ON c.series_id = s.series_id AND c.ds = s.ds
      WHERE isodow(c.ds) <= 5),
y AS (SELECT *,
  last_value(close IGNORE NULLS) OVER w1 AS pv, last_value(CASE WHEN close IS NOT NULL THEN pos END IGNORE NULLS) OVER w1 AS pp,
  first_value(close IGNORE NULLS) OVER w2 AS nv, first_value(CASE WHEN close IS NOT NULL THEN pos END IGNORE NULLS) OVER w2 AS np,
  last_value(volume IGNORE NULLS) OVER w1 AS vpv, last_value(CASE WHEN volume IS NOT NULL THEN pos END IGNORE NULLS) OVER w1 AS vpp,
  first_value(volume IGNORE NULLS) OVER w2 AS vnv, first_value(CASE WHEN volume IS NOT NULL THEN pos END IGNORE NULLS) OVER w2 AS vnp
  FROM x
  WINDOW w1 AS (PARTITION BY series_id ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         w2 AS (PARTITION BY series_id ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT series_id, ds,
  CASE WHEN close IS NOT NULL THEN close WHEN pp IS NULL THEN nv WHEN np IS NULL THEN pv
       ELSE pv + (nv - pv) * (pos - pp) / (np - pp) END AS close,
  CAST(round_even(CASE WHEN volume IS NOT NULL THEN volume WHEN vpp IS NULL THEN vnv WHEN vnp IS NULL THEN vpv
       ELSE vpv + (vnv - vpv) * (pos - vpp) / (vnp - vpp) END, 0) AS BIGINT) AS volume
FROM y""", doubles=["close"])
def f12_interpolate_calendar(spark, d):
    """Business-day calendar per series, gaps filled by linear interpolation."""
    s = daily_series(spark, d)
    cal = business_calendar(s, "series_id", "ds").select("series_id", "ds", "close",
                                                          F.col("volume").cast("double").alias("volume"))
    out = Q.interpolate_linear(cal, "close", "ds", "series_id")
    out = Q.interpolate_linear(out, "volume", "ds", "series_id", round_back=True)
    return out


# F-13 -----------------------------------------------------------------------
_IMPUTE_SPLIT = row_uniform_sql("customer_id", 7) + " < 0.8"


@query("f13_impute_train_mean", GAPS + f""",
tr AS (SELECT * FROM profile_with_gaps WHERE {_IMPUTE_SPLIT}),
te AS (SELECT * FROM profile_with_gaps WHERE NOT ({_IMPUTE_SPLIT}))
SELECT 'income' AS "column", (SELECT avg(income) FROM tr) AS train_mean,
       (SELECT count(*) FILTER (WHERE income IS NULL) FROM tr) AS n_missing_train,
       (SELECT count(*) FILTER (WHERE income IS NULL) FROM te) AS n_missing_test,
       (SELECT avg(COALESCE(income, (SELECT avg(income) FROM tr))) FROM te) AS test_mean_after
UNION ALL
SELECT 'ticket', (SELECT avg(CASE WHEN isnan(ticket) THEN NULL ELSE ticket END) FROM tr),
       (SELECT count(*) FILTER (WHERE ticket IS NULL OR isnan(ticket)) FROM tr),
       (SELECT count(*) FILTER (WHERE ticket IS NULL OR isnan(ticket)) FROM te),
       (SELECT avg(CASE WHEN ticket IS NULL OR isnan(ticket)
                        THEN (SELECT avg(CASE WHEN isnan(ticket) THEN NULL ELSE ticket END) FROM tr)
                        ELSE ticket END) FROM te)""",
       doubles=["train_mean", "test_mean_after"])
def f13_impute_train_mean(spark, d):
    p = profile_with_gaps(spark, d).withColumn("__u", row_uniform("customer_id", 7))
    tr, te = p.filter("__u < 0.8"), p.filter("NOT (__u < 0.8)")
    _, te_filled, report = Q.impute_mean(tr, te, ["income", "ticket"])
    after = te_filled.agg(F.avg("income").alias("income"), F.avg("ticket").alias("ticket")).first()
    return report.withColumn("test_mean_after",
                             F.when(F.col("column") == "income", F.lit(after["income"]))
                             .otherwise(F.lit(after["ticket"])))


# F-14 -----------------------------------------------------------------------
@query("f14_negative_counts", with_sql(REGRESSION_ROWS_SQL, CUSTOMER_PROFILE_SQL) + "\n" + U.join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} < 0) AS n_negative,
       count(*) FILTER (WHERE {c} = 0) AS n_zero FROM customer_profile"""
    for c in ("income", "spend", "ticket", "frequency", "tenure_days")))
def f14_negative_counts(spark, d):
    return Q.negative_counts(customer_profile(spark, d),
                             ["income", "spend", "ticket", "frequency", "tenure_days"])


@query("f13_impute_arrays", f"""
WITH x AS (SELECT vec_id, unnest(embedding) AS x, unnest(range(0, len(embedding))) AS dim,
                  {row_uniform_sql('vec_id', 42)} < 0.2 AS test FROM embeddings),
g AS (SELECT vec_id, dim, test, CASE WHEN (vec_id + dim) % 31 <> 0 THEN CAST(x AS DOUBLE) END AS x FROM x),
m AS (SELECT dim, avg(x) AS m FROM g WHERE NOT test GROUP BY dim)
SELECT vec_id, test, count(*) AS n_dims, sum(coalesce(x, m)) AS total, max(coalesce(x, m)) AS largest
FROM g JOIN m USING (dim) GROUP BY vec_id, test""", doubles=["total", "largest"])
def f13_impute_arrays(spark, d):
    """Embeddings with gaps (vec_id + dim divisible by 31) filled by train means."""
    e = table(spark, d, "embeddings").select("vec_id", (row_uniform("vec_id", 42) < 0.2).alias("test"), F.transform(
        "embedding", lambda x, i: F.when((F.col("vec_id") + i) % 31 != 0, x.cast("double"))).alias("v"))
    tr, te = Q.impute_array_mean(e.filter("NOT test"), e.filter("test"), "v")
    return tr.unionByName(te).select("vec_id", "test", F.size("v").cast("long").alias("n_dims"),
                                     F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("total"), F.array_max("v").alias("largest"))
