"""Data-quality audits and cleaning (Q-01 … Q-13, F-01 … F-14).

Each audit is a single aggregation pass (map-side partial aggregation, one
small shuffle); per-column results are reshaped to long tables with
``inline`` so the number of columns never drives the number of jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import all_of, is_missing, long_table


# ---------------------------------------------------------------- Q-01 / Q-02
def schema_info(df: DataFrame) -> DataFrame:
    """Q-01: (column, position, dtype, n_rows, non_null) — pandas ``info``."""
    fields = df.schema.fields
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count(F.col(f.name)).alias(f"__c{i}") for i, f in enumerate(fields)])
    items = [(f.name, {"position": F.lit(i),
                       "dtype": F.lit(f.dataType.simpleString()),
                       "n_rows": F.col("__n"),
                       "non_null": F.col(f"__c{i}")})
             for i, f in enumerate(fields)]
    return long_table(agg, items)


def null_counts(df: DataFrame) -> DataFrame:
    """Q-02: (column, n_null, pct_null); NaN counts as missing as in pandas."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(is_missing(df, c)).alias(f"__m{i}") for i, c in enumerate(cols)])
    items = [(c, {"n_null": F.col(f"__m{i}"),
                  "pct_null": F.col(f"__m{i}") * 100.0 / F.col("__n")})
             for i, c in enumerate(cols)]
    return long_table(agg, items)


# ---------------------------------------------------------------------- Q-03
def duplicate_counts(df: DataFrame, key=None) -> DataFrame:
    """Q-03: rows, duplicate rows (all but the first of each copy group).

    Grouping on the full row (or the key) with partial aggregation: a copy
    group holding a third of the table is combined map-side, so no task
    receives more than one partial count per group and map partition.
    """
    cols = list(key) if key else df.columns
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__cnt"))
    return groups.agg(
        F.sum("__cnt").cast("long").alias("n_rows"),
        F.count(F.lit(1)).cast("long").alias("n_distinct"),
        F.sum(F.col("__cnt") - 1).cast("long").alias("n_duplicates"),
        F.count_if(F.col("__cnt") > 1).cast("long").alias("n_repeated_keys"),
    )


# ---------------------------------------------------------------------- Q-04
def empty_text_count(df: DataFrame, col: str) -> DataFrame:
    """Q-04: texts that are empty after trimming (NULL texts excluded)."""
    return df.agg(F.count_if(F.trim(F.col(col)) == "").cast("long").alias("n_empty"),
                  F.count(F.col(col)).alias("n_text"))


# ---------------------------------------------------------------------- Q-08
def all_null_rows(df: DataFrame, cols=None) -> DataFrame:
    """Q-08: rows whose every listed column is missing."""
    cols = cols or df.columns
    return df.filter(all_of(is_missing(df, c) for c in cols))


# ---------------------------------------------------------------- Q-09 / Q-10
def key_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Q-09: distinct keys in a, in b, and in both.

    One full outer join of the two distinct key sets, then one aggregate.
    """
    ka = a.select(key).distinct().withColumn("__a", F.lit(True))
    kb = b.select(key).distinct().withColumn("__b", F.lit(True))
    both = ka.join(kb, on=key, how="full_outer")
    return both.agg(F.count_if(F.col("__a")).cast("long").alias("n_a"),
                    F.count_if(F.col("__b")).cast("long").alias("n_b"),
                    F.count_if(F.col("__a") & F.col("__b")).cast("long").alias("n_both"))


def leakage_rate(train: DataFrame, test: DataFrame, cols) -> DataFrame:
    """Q-10: share of test rows whose exact key (e.g. text + class) is in train.

    Train keys are deduplicated first (partial aggregation, so a key repeated
    a million times in train is shuffled once per map partition), then one
    left join marks the leaked test rows and one aggregate counts them.
    """
    cols = list(cols)
    train_keys = train.select(*cols).dropDuplicates(cols).withColumn("__seen", F.lit(True))
    marked = test.select(*cols).join(train_keys, on=cols, how="left")
    return (marked.agg(F.count(F.lit(1)).alias("n_test"),
                       F.count_if(F.col("__seen")).cast("long").alias("n_leaked"))
            .select("n_test", "n_leaked",
                    (F.col("n_leaked") / F.col("n_test")).alias("leak_rate")))


# ---------------------------------------------------------------------- Q-11
def repeated_key_members(df: DataFrame, key) -> DataFrame:
    """Q-11: all rows whose key occurs more than once, with the key's count."""
    key = list(key)
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_copies")).filter("n_copies > 1")
    return df.join(counts, on=key, how="inner")


# ---------------------------------------------------------------------- Q-13
def period_coverage(df: DataFrame, date_col: str, series_col: str | None = None) -> DataFrame:
    """Q-13: first/last date, expected business days, missing ones, longest gap.

    The business-day calendar is generated per series with ``sequence`` (its
    size is bounded by the covered days, not by the data volume) and anti
    joined against the observed days. Without a series column the whole table
    is one series.
    """
    s = series_col or "__series"
    src = df if series_col else df.withColumn(s, F.lit(0))
    days = src.select(s, F.to_date(F.col(date_col)).alias("d")).distinct()
    bounds = days.groupBy(s).agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"),
                                 F.count(F.lit(1)).alias("n_days"))
    calendar = (bounds.select(s, F.explode(F.sequence("first_day", "last_day")).alias("d"))
                .filter(F.weekday("d") < 5))
    expected = calendar.groupBy(s).agg(F.count(F.lit(1)).alias("expected_business_days"))
    missing = (calendar.join(days, on=[s, "d"], how="left_anti")
               .groupBy(s).agg(F.count(F.lit(1)).alias("missing_business_days")))
    w = Window.partitionBy(s).orderBy("d")
    gaps = (days.withColumn("gap", F.datediff("d", F.lag("d").over(w)))
            .groupBy(s).agg(F.max("gap").alias("longest_gap_days")))
    out = (bounds.join(expected, on=s, how="left").join(missing, on=s, how="left")
           .join(gaps, on=s, how="left")
           .withColumn("missing_business_days",
                       F.coalesce("missing_business_days", F.lit(0)).cast("long")))
    return out if series_col else out.drop(s)


# ---------------------------------------------------------------- F-02 … F-05
def cast_columns(df: DataFrame, casts: dict) -> DataFrame:
    """F-03: cast by name; ``'date'`` parses with ``to_date``; bad values → NULL."""
    out = []
    for c in df.columns:
        if c in casts:
            t = casts[c]
            out.append((F.to_date(F.col(c)) if t == "date" else F.col(c).try_cast(t)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def drop_missing(df: DataFrame, subset=None) -> DataFrame:
    """F-05: pandas ``dropna`` — NULL and NaN both drop the row."""
    subset = subset or df.columns
    return df.filter(~F.coalesce(*[F.when(is_missing(df, c), F.lit(True)) for c in subset],
                                 F.lit(False)))


# ------------------------------------------------------------- F-06 … F-08
class RuleSet:
    """F-06 … F-08: named row-validity rules applied in order with an audit.

    A rule is a (name, predicate_that_marks_a_bad_row). Rules are evaluated in
    one pass: ``first_failed_rule`` is the first rule a row breaks, which is
    the same as counting rule 2 on the survivors of rule 1. Rows where a rule
    predicate is NULL are kept (the predicate did not mark them bad).
    """

    def __init__(self, rules, enabled=None):
        self.rules = [(n, p) for n, p in rules if enabled is None or enabled.get(n, True)]

    def tag(self, df: DataFrame) -> DataFrame:
        if not self.rules:
            return df.withColumn("first_failed_rule", F.lit(None).cast("string"))
        expr = F.coalesce(*[F.when(pred, F.lit(name)) for name, pred in self.rules])
        return df.withColumn("first_failed_rule", expr)

    def clean(self, df: DataFrame) -> DataFrame:
        return self.tag(df).filter(F.col("first_failed_rule").isNull()).drop("first_failed_rule")

    def audit(self, df: DataFrame) -> DataFrame:
        """(rule, rule_order, n_removed) — zero rows for rules that removed none."""
        tagged = self.tag(df)
        counts = (tagged.filter(F.col("first_failed_rule").isNotNull())
                  .groupBy("first_failed_rule").agg(F.count(F.lit(1)).alias("n_removed")))
        spark = df.sparkSession
        order = spark.createDataFrame([(n, i) for i, (n, _) in enumerate(self.rules)],
                                      "rule string, rule_order int")
        return (order.join(counts, order.rule == counts.first_failed_rule, "left")
                .select("rule", "rule_order",
                        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed")))


# ---------------------------------------------------------------------- F-09
def normalise_category(c: Column | str) -> Column:
    """F-09: trim first, then '&' → '' and spaces → '_' (``'A & B'`` → ``'A_B'``)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.regexp_replace(F.trim(c), r"\s*&\s*", " "), r"\s+", "_")


# ---------------------------------------------------------------------- F-10
def map_with_fallback(df: DataFrame, col: str, mapping: DataFrame, key: str, value: str,
                      out: str) -> DataFrame:
    """F-10 / J-10: look a code up in a mapping table, keep the code if absent.

    The mapping side is a dimension table; Catalyst broadcasts it when its
    measured size is under the broadcast threshold and shuffles otherwise.
    """
    m = mapping.select(F.col(key).alias("__k"), F.col(value).alias("__v"))
    return (df.join(m, df[col] == m["__k"], "left")
            .withColumn(out, F.coalesce(F.col("__v"), F.col(col).cast("string")))
            .drop("__k", "__v"))


# ---------------------------------------------------------------------- F-11
def flag_in(df: DataFrame, other: DataFrame, key: str, flag: str) -> DataFrame:
    """F-11: boolean flag for membership of ``key`` in ``other`` (left join to marker)."""
    marker = other.select(F.col(key).alias("__k")).distinct().withColumn("__m", F.lit(True))
    return (df.join(marker, df[key] == marker["__k"], "left")
            .withColumn(flag, F.coalesce(F.col("__m"), F.lit(False)))
            .drop("__k", "__m"))


# ---------------------------------------------------------------------- F-12
def interpolate_linear(df: DataFrame, value: str, order: str, series: str | None = None,
                       round_back: bool = False) -> DataFrame:
    """F-12: linear interpolation by position, ends filled from the nearest value.

    Position = row number in ``order``; the previous/next observed (value,
    position) come from ``last``/``first`` with ``ignorenulls`` over the
    series window. ``round_back`` rounds half-even (numpy) and casts to long.
    """
    keys = [series] if series else []
    w = Window.partitionBy(*keys).orderBy(order)
    df = df.withColumn("__pos", F.row_number().over(w))
    obs_pos = F.when(F.col(value).isNotNull(), F.col("__pos"))
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    fwd = w.rowsBetween(0, Window.unboundedFollowing)
    df = (df.withColumn("__pv", F.last(F.col(value), True).over(back))
            .withColumn("__pp", F.last(obs_pos, True).over(back))
            .withColumn("__nv", F.first(F.col(value), True).over(fwd))
            .withColumn("__np", F.first(obs_pos, True).over(fwd)))
    blend = F.col("__pv") + (F.col("__nv") - F.col("__pv")) * \
        (F.col("__pos") - F.col("__pp")) / (F.col("__np") - F.col("__pp"))
    filled = F.when(F.col(value).isNotNull(), F.col(value).cast("double")) \
        .when(F.col("__pp").isNull(), F.col("__nv")) \
        .when(F.col("__np").isNull(), F.col("__pv")) \
        .otherwise(blend)
    if round_back:
        filled = F.bround(filled, 0).cast("long")
    return df.withColumn(value, filled).drop("__pos", "__pv", "__pp", "__nv", "__np")


# ---------------------------------------------------------------------- F-13
def impute_mean(train: DataFrame, test: DataFrame, cols) -> tuple[DataFrame, DataFrame, DataFrame]:
    """F-13: fill missing values in train and test with the **train** means.

    Fit/transform: the fit is one aggregate row (one mean per column) read on
    the driver; the transform is a literal ``coalesce`` per column. Returns
    (train_filled, test_filled, report) with train means and missing counts.
    """
    cols = list(cols)
    means = train.agg(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(c)
                        for c in cols]).first().asDict()

    def fill(df):
        return df.select(*[
            F.when(is_missing(df, c), F.lit(means[c])).otherwise(F.col(c)).alias(c)
            if c in cols else F.col(c) for c in df.columns])

    tr = train.agg(*[F.count_if(is_missing(train, c)).alias(c) for c in cols]).first().asDict()
    te = test.agg(*[F.count_if(is_missing(test, c)).alias(c) for c in cols]).first().asDict()
    report = train.sparkSession.createDataFrame(
        [(c, means[c], int(tr[c]), int(te[c])) for c in cols],
        "column string, train_mean double, n_missing_train long, n_missing_test long")
    return fill(train), fill(test), report


def impute_array_mean(train: DataFrame, test: DataFrame, vec_col: str):
    """F-13 for array columns: NaN and NULL entries become the train mean of
    their dimension (0 where a dimension has none).

    The means are one aggregate over (dimension, value); they come back as a
    literal array of the vectors' length and fill every row in place, so no row
    is lost: NULL vectors stay NULL and empty ones empty."""
    value = F.when(~F.isnan(F.col("x").cast("double")), F.col("x").cast("double"))
    means = {r["d"]: r["m"] for r in train.select(F.posexplode(vec_col).alias("d", "x"))
             .groupBy("d").agg(F.avg(value).alias("m")).collect()}
    table = F.array(*[F.lit(float(means.get(k) or 0.0)) for k in range(max(means, default=-1) + 1)]) \
        if means else F.array().cast("array<double>")

    def fill(df):
        filled = F.transform(vec_col, lambda x, i: F.when(
            x.isNotNull() & ~F.isnan(x.cast("double")), x.cast("double")).otherwise(F.coalesce(F.get(table, i), F.lit(0.0))))
        return df.withColumn(vec_col, filled)

    return fill(train), fill(test)


# ---------------------------------------------------------------------- F-14
def negative_counts(df: DataFrame, cols) -> DataFrame:
    """F-14: (column, n_negative, n_zero) for numeric columns, one pass."""
    cols = list(cols)
    agg = df.agg(*[F.count_if(F.col(c) < 0).alias(f"__neg{i}") for i, c in enumerate(cols)],
                 *[F.count_if(F.col(c) == 0).alias(f"__zero{i}") for i, c in enumerate(cols)])
    return long_table(agg, [(c, {"n_negative": F.col(f"__neg{i}"),
                                 "n_zero": F.col(f"__zero{i}")}) for i, c in enumerate(cols)])
