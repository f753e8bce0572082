"""Sorts, limits and arg-extremes (K-01 … K-09).

Top-n is ``orderBy(...).limit(n)``, which Spark plans as
TakeOrderedAndProject: every task keeps its own n best rows and only those
reach the final merge. Arg-extremes per group are ``min_by``/``max_by``
aggregates (partial aggregation, no sort, no window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import row_hash


def top_n(df: DataFrame, col: str, n: int, tie: str, ascending: bool = False) -> DataFrame:
    """K-01 / K-02: n largest (or smallest) rows, ties broken by ``tie``."""
    order = F.col(col).asc_nulls_last() if ascending else F.col(col).desc_nulls_last()
    return df.orderBy(order, F.col(tie).asc()).limit(n)


def arg_extreme(df: DataFrame, by, key: str, value: str, mode: str = "max") -> DataFrame:
    """K-03 / K-04: the ``key`` at the max (or min) ``value`` per group.

    Ties go to the smallest key: the ordering value is (value, −key) for max
    and (value, key) for min, so the answer never depends on row order.
    """
    by = [by] if isinstance(by, str) else list(by)
    v = F.col(value).cast("double")
    order = F.struct(-v if mode == "max" else v, F.col(key))
    ext = F.max(value) if mode == "max" else F.min(value)
    return df.filter(F.col(value).isNotNull()).groupBy(*by).agg(
        F.min_by(F.col(key), order).alias(f"{mode}_{key}"), ext.alias(f"{mode}_{value}"))


def first_per_group(df: DataFrame, by, order: str, cols) -> DataFrame:
    """K-05: the row with the smallest ``order`` per group (e.g. first example)."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.min(order).alias(order),
                               *[F.min_by(F.col(c), F.col(order)).alias(c) for c in cols])


def rank_labels(df: DataFrame, key: str, metric: str, labels) -> DataFrame:
    """K-06: name groups by the order of a metric (e.g. clusters by mean GDP).

    ``df`` is already one row per group (a handful of clusters), so the global
    window here runs over that small table only.
    """
    w = Window.orderBy(F.col(metric).asc(), F.col(key).asc())
    labels_arr = F.array(*[F.lit(s) for s in labels])
    return df.withColumn("rank", F.row_number().over(w)) \
             .withColumn("label", F.element_at(labels_arr, F.col("rank")))


def sort_by_abs(df: DataFrame, col: str, tie: str) -> DataFrame:
    """K-07: order by |col| descending."""
    return df.orderBy(F.abs(F.col(col)).desc(), F.col(tie))


def seeded_sample(df: DataFrame, id_col: str, n: int, seed: int = 0) -> DataFrame:
    """K-08: n rows chosen by a seeded per-row hash — same rows on any cluster."""
    return df.withColumn("__h", row_hash(id_col, seed)).orderBy("__h", id_col).limit(n).drop("__h")


def nth_distinct(df: DataFrame, col: str, positions) -> DataFrame:
    """K-09: the values at the given 0-based positions of the ordered distinct
    values. Distinct values are bounded (days of a calendar); ranks come from
    :func:`value_ranks` so no single task sorts them all."""
    from tessera.functions.ranks import value_ranks
    r = value_ranks(df.select(col).distinct(), col)
    return r.filter((F.col("avg_rank") - 1).cast("long").isin([int(p) for p in positions])) \
            .select((F.col("avg_rank") - 1).cast("long").alias("position"), col)
