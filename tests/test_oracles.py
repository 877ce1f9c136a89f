"""Every registered query of the reference's operators against its SQL in DuckDB, over the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

from waymark.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(str(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    if name not in catalogue.ORACLES:
        assert got
        return
    want = duck.execute(catalogue.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(str(tuple(plain(r[i]) for i in at)) for r in want.fetchall())
