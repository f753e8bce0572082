"""Registry of named queries: a Spark builder and (optionally) its SQL twin.

Computed doubles are rounded identically on both sides (``doubles`` maps a
column to its number of decimals) so that summation order cannot change the
value hash. The SQL twin is wrapped in ``SELECT * REPLACE (round(...))``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doubles: dict = field(default_factory=dict)
    note: str = ""

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        if self.doubles:
            df = df.select(*[_round_col(F.col(c), self.doubles[c]).alias(c) if c in self.doubles
                             else F.col(c) for c in df.columns])
        return df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        if not self.doubles:
            return self.sql
        rep = ", ".join(f'{_round_sql(c, d)} AS "{c}"' for c, d in self.doubles.items())
        return f"SELECT * REPLACE ({rep}) FROM (\n{self.sql}\n) AS q"


def _round_col(c, d):
    """``d`` decimals, or for a string ``'b<k>'`` the nearest multiple of 2^-k
    (binary grids never tie on values derived from decimal money amounts)."""
    if isinstance(d, str):
        k = float(2 ** int(d[1:]))
        return F.round(c * k) / k + F.lit(0.0)  # + 0.0 folds -0.0 into 0.0
    return F.round(c, d) + F.lit(0.0)


def _round_sql(c, d):
    q = f'"{c}"'
    if isinstance(d, str):
        k = float(2 ** int(d[1:]))
        return f"(round({q} * {k}) / {k} + 0.0)"
    return f"(round({q}, {d}) + 0.0)"


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, doubles=None, digits: int = 6, note: str = ""):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``doubles`` may be a list (all rounded to ``digits``) or a dict.
    """
    if isinstance(doubles, (list, tuple)):
        doubles = {c: digits for c in doubles}

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, dict(doubles or {}), note)
        return fn
    return deco
