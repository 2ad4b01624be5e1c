"""Every registered query against its SQL on the smallest tables."""

import math
import os
from collections import Counter

import duckdb
import pytest
from conftest import SF_DIR, physical_plan

from __spark_entry__ import entry
from kimberlite.catalog.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS FROM '{SF_DIR}/{file}'")
    return connection


def plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert len(QUERIES) >= 60


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    names = sorted(df.columns)
    found = Counter(tuple(plain(v) for v in r) for r in df.select(*names).collect())
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == names
    order = [columns.index(n) for n in names]
    assert found == Counter(tuple(plain(r[i]) for i in order) for r in result.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", ["gold_line_surrogate_key", "gold_dim_supplier", "gold_allocate_sales"])
def test_no_query_gathers_rows_in_one_task(spark, name):
    plan = physical_plan(QUERIES[name](spark, SF_DIR))
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan and "PythonUDF" not in plan


def test_scans_read_only_needed_columns(spark):
    plan = QUERIES["gold_first_purchase"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    plan = QUERIES["silver_positive_id_filter"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "GreaterThan(c_custkey,0)" in plan and "EqualTo(c_mktsegment,BU" in plan
