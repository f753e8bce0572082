"""Small column helpers shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DecimalType, DoubleType, FloatType, IntegerType,
                               LongType, ShortType)

NUMERIC_TYPES = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DecimalType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.dataType.simpleString() == "string" and f.name not in exclude]


def is_missing(df: DataFrame, c: str) -> Column:
    """pandas ``isnull``: NULL, and NaN for floating columns."""
    dtype = df.schema[c].dataType
    if isinstance(dtype, (FloatType, DoubleType)):
        return F.col(c).isNull() | F.isnan(F.col(c))
    return F.col(c).isNull()


def nan_to_null(df: DataFrame, cols=None) -> DataFrame:
    """Convert NaN to NULL on ingest so aggregates skip it like pandas does."""
    cols = set(cols or [f.name for f in df.schema.fields
                        if isinstance(f.dataType, (FloatType, DoubleType))])
    return df.select(*[
        F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ])


def number(c) -> Column:
    """Column as a double with NaN as missing, the way pandas counts."""
    return F.nanvl((F.col(c) if isinstance(c, str) else c).cast("double"), F.lit(None).cast("double"))


def all_of(preds) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def any_of(preds) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)


def long_table(df_one_row: DataFrame, items, id_name: str = "column") -> DataFrame:
    """Turn one wide row of per-column stats into one row per column.

    ``items`` is a list of (name, {stat: column_expr}) pairs; every item
    yields one output row with the same struct layout.
    """
    structs = [F.struct(F.lit(name).alias(id_name), *[e.alias(k) for k, e in stats.items()])
               for name, stats in items]
    return df_one_row.select(F.inline(F.array(*structs)))


def rounded(c, digits: int = 6) -> Column:
    """Round a double for stable comparisons across summation orders."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits)
