"""Seeded, portable row hashing for splits, folds and samples.

``randomSplit`` and ``rand`` depend on the partition layout, so a split made
with them changes when the cluster changes. Here a row's draw is a pure
function of (id, seed): the first 13 hex digits (52 bits) of the MD5 of
``seed:id``. MD5 mixes every input bit, so two seeds give unrelated orders, and
the same expression runs in any SQL engine (the DuckDB oracle uses it too).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 13
RANGE = 16 ** HEX_DIGITS


def row_hash(id_col: Column | str, seed: int = 0) -> Column:
    """Integer in [0, 2^52) determined by (id, seed)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    digest = F.md5(F.concat(F.lit(f"{int(seed)}:"), c.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("long")


def row_uniform(id_col: Column | str, seed: int = 0) -> Column:
    """Uniform-like double in [0, 1) determined by (id, seed)."""
    return row_hash(id_col, seed) / F.lit(float(RANGE))


def row_hash_sql(id_expr: str, seed: int = 0) -> str:
    """The same hash as an SQL expression (for oracles)."""
    return f"CAST('0x' || substr(md5(concat('{int(seed)}:', {id_expr})), 1, {HEX_DIGITS}) AS BIGINT)"


def row_uniform_sql(id_expr: str, seed: int = 0) -> str:
    return f"(({row_hash_sql(id_expr, seed)}) / {float(RANGE)!r})"
