"""Every registered query against its DuckDB oracle at sf0.001: row count,
column names and an order-insensitive hash of values rounded to 6 places."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from terrascore import catalog
from terrascore.plans.testdata import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v.isoformat() if hasattr(v, "isoformat") else v


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)).encode()).hexdigest()


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


@pytest.mark.parametrize("key", sorted(catalog.ORACLES))
def test_query_matches_oracle(spark, con, key):
    df = catalog.QUERIES[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(catalog.ORACLES[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, ocols)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "field_id"
