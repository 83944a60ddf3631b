"""Every registered query against its SQL in DuckDB, at the smallest scale.

No plan may pair all rows with all rows or leave the JVM.
"""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import TABLES, rows_of
from workload import registry

SF = "/root/testdata/sf0.001"
ORACLES = registry.ORACLES


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, db, name):
    df = registry.QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas", plan)
    result = db.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, got) == rows_of(columns, result.fetchall())


def test_every_survey_id_has_a_query():
    wanted = (
        [f"SRC{i}" for i in range(1, 7)] + [f"SNK{i}" for i in range(1, 5)] + [f"FLT{i}" for i in range(1, 13)]
        + [f"FN{i}" for i in range(1, 21)] + [f"J{i}" for i in range(1, 13)] + [f"AGG{i}" for i in range(1, 21)]
        + [f"W{i}" for i in range(1, 9)] + [f"ORD{i}" for i in range(1, 4)] + [f"SET{i}" for i in range(1, 4)]
        + [f"DOM{i}" for i in range(1, 15)] + [f"QC{i}" for i in range(1, 11)] + [f"VER{i}" for i in range(1, 8)]
    )
    assert [w for w in wanted if w not in entry.queries()] == []


def test_every_query_has_sql():
    assert sorted(registry.QUERIES) == sorted(ORACLES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
