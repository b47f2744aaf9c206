"""Every registered query next to its SQL, over whole small tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import entry, oracle_sql, queries
from chainlake.plans.oracles import ORACLES
from chainlake.plans.registry import QUERIES
from tools.check import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"

@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    counts = {row.partition: row.records for row in entry(spark).collect()}
    assert sorted(counts) == list(range(9))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = rows_of(df.columns, [tuple(row) for row in df.collect()])
    assert got
    result = duck.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows_of(names, result.fetchall())
