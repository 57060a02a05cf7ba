"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, rows_of
from workload import all_oracles, all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def db(small):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, db, name):
    df = QUERIES[name](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    result = db.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, result.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
