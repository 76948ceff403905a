"""Every catalogue query against its DuckDB oracle on the smallest driver tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from ferrum.plans import catalogue  # noqa: E402
from check_oracle import norm  # noqa: E402
from ferrum.session import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _rows(cols, rows, order):
    idx = [cols.index(c) for c in order]
    return sorted(tuple(norm(r[i]) for i in idx) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL form")
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    order = sorted(cols)
    assert _rows(cols, rows, order) == _rows(ocols, res.fetchall(), order)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert df.columns
