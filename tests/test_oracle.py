"""Every registered query next to its SQL in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.check_oracle import TABLES, compare

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    _, rows, verdict, note = compare(spark, con, SF, key, QUERIES[key], ORACLES.get(key))
    assert verdict in ("ok", "rows-only"), note
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
