"""Corpus queries that SQL can express, against DuckDB over the whole small tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import TABLES, rows_of
from tracemill.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    result = db.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, got) == rows_of(columns, result.fetchall())


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_exact_dedup_stays_on_the_jvm(spark):
    plan = QUERIES["op6_exact_dedup"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
