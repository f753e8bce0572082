"""Ordered running sums and average ranks without a global sort in one task.

A ``rank()`` or running-sum window with no ``partitionBy`` moves every row to
one task. Here the rows are first collapsed to distinct ordering values (one
partial aggregation), the distinct values are cut into ``buckets`` ranges by
an approximate-quantile fit, bucket totals give each range its starting
offset, and only inside a range is a running sum needed. A single value
repeated by a third of all rows is one row after the first step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 256                # ranges an order is cut into; a power of two


def _cuts_below(cuts: str, x: str, buckets: int) -> Column:
    """How many of the ``buckets`` − 1 ascending cuts lie below ``x``: a binary
    search whose steps halve."""
    steps = F.array(*[F.lit(buckets >> k) for k in range(1, buckets.bit_length())])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(F.col(cuts), at + step - 1) < F.col(x), at + step).otherwise(at))


def ordered_cumsum(distinct: DataFrame, order: str, cols, by=(), buckets: int = BUCKETS,
                   descending: bool = False, tie: str | None = None) -> DataFrame:
    """For a table already distinct on (by…, order[, tie]), add ``{c}_before``
    = sum of ``c`` over all rows strictly earlier in (order, tie) within ``by``.
    Equal ``order`` values always share a bucket, so ``tie`` only needs to
    order rows inside one bucket. ``buckets`` is a power of two."""
    by = [by] if isinstance(by, str) else list(by)
    cols = list(cols)
    dtype = distinct.schema[order].dataType.typeName()
    if dtype == "date":
        okey = F.unix_date(F.col(order)).cast("double")
    elif dtype.startswith("timestamp"):
        okey = F.unix_micros(F.col(order).cast("timestamp")).cast("double")
    else:
        okey = F.col(order).cast("double")
    src = distinct.withColumn("__o", -okey if descending else okey)
    if buckets > 1:
        probs = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
        cuts = src.groupBy(*by).agg(F.percentile_approx("__o", probs, 4 * buckets).alias("__cuts"))
        src = (src.join(cuts, on=by, how="inner") if by else
               src.withColumn("__cuts", F.lit(cuts.first()["__cuts"])))
        src = src.withColumn("__b", _cuts_below("__cuts", "__o", buckets)).drop("__cuts")
    else:
        src = src.withColumn("__b", F.lit(0))
    totals = src.groupBy(*by, "__b").agg(*[F.sum(c).alias(f"__t_{c}") for c in cols])
    # Offsets over the bucket totals: (groups × buckets) rows, tiny.
    wb = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("__b") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "__b", *[F.coalesce(F.sum(f"__t_{c}").over(wb), F.lit(0)).alias(f"__off_{c}")
                                          for c in cols])
    okeys = ["__o"] + ([F.col(tie).desc() if descending else F.col(tie)] if tie else [])
    wv = Window.partitionBy(*by, "__b").orderBy(*okeys).rowsBetween(Window.unboundedPreceding, -1)
    out = src.join(offsets, on=by + ["__b"], how="inner")
    for c in cols:
        out = out.withColumn(f"{c}_before", F.coalesce(F.sum(c).over(wv), F.lit(0)) + F.col(f"__off_{c}"))
    return out.drop("__b", "__o", *[f"__off_{c}" for c in cols])


def value_ranks(df: DataFrame, value: str, by=(), buckets: int = BUCKETS, count: str | None = None) -> DataFrame:
    """Distinct (by…, value) with ``n_ties`` and ``avg_rank`` (1-based) within
    ``by``; a row of ``df`` stands for ``count`` rows where that is given."""
    by = [by] if isinstance(by, str) else list(by)
    vc = (df.filter(F.col(value).isNotNull())
          .groupBy(*by, value).agg((F.sum(count) if count else F.count(F.lit(1))).alias("n_ties")))
    r = ordered_cumsum(vc, value, ["n_ties"], by, buckets)
    return r.withColumn("avg_rank", F.col("n_ties_before") + (F.col("n_ties") + 1) / 2.0) \
            .drop("n_ties_before")


def with_avg_rank(df: DataFrame, value: str, by=(), out: str | None = None,
                  buckets: int = BUCKETS) -> DataFrame:
    """Attach the average rank of ``value`` (within ``by``) to every row."""
    by = [by] if isinstance(by, str) else list(by)
    out = out or f"{value}_rank"
    ranks = value_ranks(df, value, by, buckets).select(*by, value, F.col("avg_rank").alias(out))
    return df.join(ranks, on=by + [value], how="left")


def exact_quantiles(df: DataFrame, value: str, probs, by=(), buckets: int = BUCKETS,
                    out: str = "q") -> DataFrame:
    """(by…, ``out`` array<double>): exact quantiles with linear interpolation
    (position (n − 1)·p, as pandas and SQL ``quantile_cont``), nulls and NaN ignored.

    Unlike ``percentile`` — whose final merge holds every distinct value of a
    group in one task — the values are collapsed to (value, count), the
    cumulative counts come from :func:`ordered_cumsum` (a hot group is cut
    into ranges), and the two order statistics around each position are
    picked by one partial aggregate."""
    by = [by] if isinstance(by, str) else list(by)
    probs = [float(p) for p in probs]
    vc = (df.select(*by, F.col(value).cast("double").alias("__v"))
          .filter(F.col("__v").isNotNull() & ~F.isnan("__v"))
          .groupBy(*by, "__v").agg(F.count(F.lit(1)).alias("__c")))
    r = ordered_cumsum(vc, "__v", ["__c"], by, buckets)
    n = vc.groupBy(*by).agg(F.sum("__c").alias("__n"))
    if by:
        r = r.join(n, on=by, how="inner")
    else:
        r = r.withColumn("__n", F.lit(n.first()["__n"]))

    def covers(k):
        return (F.col("__c_before") <= k) & (k < F.col("__c_before") + F.col("__c"))

    aggs = []
    for i, p in enumerate(probs):
        pos = (F.col("__n") - 1) * F.lit(p)
        aggs += [F.max(F.when(covers(F.floor(pos)), F.col("__v"))).alias(f"__lo{i}"),
                 F.max(F.when(covers(F.ceil(pos)), F.col("__v"))).alias(f"__hi{i}")]
    g = r.groupBy(*by).agg(F.max("__n").alias("__n"), *aggs)
    qs = []
    for i, p in enumerate(probs):
        pos = (F.col("__n") - 1) * F.lit(p)
        frac = pos - F.floor(pos)
        qs.append(F.col(f"__lo{i}") + frac * (F.col(f"__hi{i}") - F.col(f"__lo{i}")))
    return g.select(*by, F.array(*qs).alias(out))
