"""Leakage-safe splits and folds (V-01 … V-04, V-09, V-10 via timeseries).

Every assignment is a pure function of (id, seed) — see
:mod:`tessera.functions.hashing` — so the same rows land in the same split on
any cluster layout and after any executor loss. Stratified splits rank rows
inside each class by their hash with the bucketed running count of
:func:`ordered_cumsum`, so a class holding a third of all rows is ranked by
many tasks, not one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import row_hash, row_uniform
from tessera.functions.ranks import ordered_cumsum


def _class_ranks(df: DataFrame, id_col: str, label: str, seed: int) -> DataFrame:
    """(id, label, pos, n_class): 0-based position of the row inside its class
    in (hash, id) order and the class size."""
    h = df.select(id_col, label, row_hash(id_col, seed).alias("__h"), F.lit(1).alias("__one"))
    r = ordered_cumsum(h, "__h", ["__one"], by=[label], tie=id_col)
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    return r.join(n, on=label).select(id_col, label, F.col("__one_before").alias("pos"), "n_class")


# ---------------------------------------------------------------- V-01 / V-03
def stratified_split(df: DataFrame, id_col: str, label: str, test_size: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """V-01: exact per-class test share: the first round(n_class · test_size)
    rows of each class in hash order go to test. Returns (id, label, split)."""
    r = _class_ranks(df, id_col, label, seed)
    n_test = F.round(F.col("n_class") * F.lit(test_size))
    return r.select(id_col, label, F.when(F.col("pos") < n_test, "test").otherwise("train").alias("split"))


def persisted_split(df: DataFrame, id_col: str, label: str, path: str, test_size: float = 0.2,
                    seed: int = 42) -> DataFrame:
    """V-01: reuse the split stored at ``path``; create it if absent; fail if
    it no longer covers exactly the rows of ``df`` (stale split)."""
    spark = df.sparkSession
    try:
        stored = spark.read.parquet(path)
    except AnalysisException:
        stratified_split(df, id_col, label, test_size, seed).select(id_col, "split") \
            .write.mode("overwrite").parquet(path)
        stored = spark.read.parquet(path)
    ids = df.select(id_col)
    extra = stored.join(ids, on=id_col, how="left_anti").limit(1).count()
    missing = ids.join(stored, on=id_col, how="left_anti").limit(1).count()
    if extra or missing:
        raise ValueError(f"split at {path} is stale: it does not cover exactly the current rows")
    return stored


# ---------------------------------------------------------------------- V-02
def random_split(df: DataFrame, id_col: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """V-02: plain seeded hold-out by hash threshold (no class balancing)."""
    return df.withColumn("split", F.when(row_uniform(id_col, seed) < test_size, "test").otherwise("train"))


# ---------------------------------------------------------------------- V-04
def kfold(df: DataFrame, id_col: str, k: int = 5, seed: int = 42, label: str | None = None) -> DataFrame:
    """V-04: fold ids 0 … k−1. Stratified when ``label`` is given (position
    in class hash order mod k, so every fold gets ⌊n/k⌋ or ⌈n/k⌉ of each
    class); otherwise ⌊u · k⌋ of the row's uniform draw."""
    if label is None:
        return df.withColumn("fold", F.floor(row_uniform(id_col, seed) * k).cast("int"))
    r = _class_ranks(df, id_col, label, seed).select(id_col, (F.col("pos") % k).cast("int").alias("fold"))
    return df.join(r, on=id_col, how="inner")
