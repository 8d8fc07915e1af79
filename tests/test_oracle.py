"""Every registered query against its DuckDB oracle on the sf0.001 driver tables: same
column names and types, same rows (order-insensitive)."""

import os

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry
from sylva.plans.catalog import QUERIES
from tools.oracle_check import TABLES, table_hash

SQL = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"create view {t} as select * from read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    types = {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes}
    assert types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert len(rows) == len(orows)
    assert table_hash(df.columns, rows) == table_hash(rel.columns, orows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "Products", "Emissions", "CO2", "CH4", "CO"]
    assert df.count() > 0
