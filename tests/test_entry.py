"""Registered queries against their SQL at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, differences

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

# Slow ones are left to tools/check.py; the operators behind them have tests of their own.
QUICK = [
    n for n in entry.oracle_sql()
    if not n.startswith(("stream_", "model_round", "multi_model_chain", "batch_", "udf_", "paced"))
]


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return con


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns[:2] == ["symbol", "date"]


@pytest.mark.parametrize("name", QUICK)
def test_query(spark, sql, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    assert differences(got, sql.execute(entry.oracle_sql()[name]).df()) == []
