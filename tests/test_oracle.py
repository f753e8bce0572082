"""Every registered query with an SQL twin matches DuckDB on the smoke tables."""

import math

import duckdb
import pytest

import __spark_entry__ as ENTRY
from conftest import SMOKE

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SQL = ENTRY.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = ENTRY.queries()[name](spark, SMOKE)
    cols = sdf.columns
    srows = sorted("|".join(_norm(r[c]) for c in sorted(cols)) for r in sdf.collect())
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == sorted(cols)
    drows = sorted("|".join(_norm(dict(zip(dcols, r))[c]) for c in sorted(cols)) for r in res.fetchall())
    assert srows == drows


def test_entry_smoke(spark):
    df = ENTRY.entry(spark)
    assert df.count() > 0
