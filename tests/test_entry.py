"""Every registered query against its SQL equivalent, and the shape of its plan."""

import os
import re
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WRITES = {"load_append", "load_truncate", "save_csv", "save_log", "load_common_columns", "transfer_log", "transfer_status",
          "transfer_report", "copy_log", "run_full", "run_failing", "run_decimals", "transfer_resumed", "run_metadata", "run_views", "run_listed", "run_data"}
# Those of the optional subpackage have tests of their own.
QUERIES = {name: query for name, query in entry.queries().items() if name != "pipeline" and not re.match(r"op\d+_", name)}

# DuckDB types by the Spark types they are compared with.
SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _shown(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return "NULL"
    if isinstance(value, (bool, str)):
        return str(value)
    return repr(float(value)) if hasattr(value, "__float__") else str(value)


def _table(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted(tuple(map(_shown, row)) for row in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    answer = duck.sql(entry.oracle_sql()[name])
    assert _table(df.toPandas()) == _table(answer.df())
    wanted = dict(zip(answer.columns, map(str, answer.types)))
    assert {c: SAME_TYPE[t] for c, t in df.dtypes} == wanted


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_plan(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan
    for spec in re.findall(r"Window \[.*", plan):
        partition = re.search(r"\], \[([^\]]*)\], \[", spec)
        assert partition is None or partition.group(1), "window without partition keys"


def test_every_query_has_an_equivalent():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    rows = {r.source_table_name: r for r in entry.entry(spark).collect()}
    assert len(rows) == 13
    assert rows["REGION"].target_table_name == "TABLE NOT EXIST" and rows["ORDERS"].is_success == "N"
