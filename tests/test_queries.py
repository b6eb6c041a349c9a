"""Every registered query against its SQL, and the shape of the plans."""

import re

import duckdb
import pytest

import __spark_entry__ as contract
from verification.oracle import ORACLE
from verification.queries import QUERIES
from verification.warehouse import TABLES

FOLDER = "/root/testdata/sf0.001"
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "DATE": "date",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def comparable(rows, columns):
    def value(v):
        return round(v, 6) if isinstance(v, float) else v

    picked = [tuple(value(r[c]) for c in sorted(columns)) for r in rows]
    return sorted(picked, key=lambda t: tuple((v is None, str(v)) for v in t))


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    result = duck.execute(contract.oracle_sql()[name])
    columns = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    assert {f.name: f.dataType.simpleString() for f in df.schema} == columns
    theirs = [dict(zip(columns, row)) for row in result.fetchall()]
    plan = physical(df)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan
    ours = df.collect()
    assert comparable(ours, columns) == comparable(theirs, columns)


def test_scans_are_pruned_and_filtered(spark):
    plan = physical(QUERIES["month_slice"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "o_comment" not in plan and "o_orderpriority" not in plan
    daily = physical(QUERIES["daily_rides"](spark, FOLDER))
    assert not re.search(r"ReadSchema: struct<[^>]*props", daily)


def test_rides_are_not_shuffled_row_by_row(spark):
    """Cleaning joins a small lookup by broadcast; aggregation starts before the first exchange."""
    t1 = physical(QUERIES["clean_rides"](spark, FOLDER))
    assert "BroadcastHashJoin" in t1 and "hashpartitioning" not in t1
    daily = physical(QUERIES["daily_join"](spark, FOLDER))
    rides = daily[: daily.index("events.parquet")]
    assert rides.rindex("partial_count") > rides.rindex("Exchange hashpartitioning(date")


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and df.columns[0] == "date" and len(df.columns) == 13
