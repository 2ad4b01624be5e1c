"""What queries leave in the scratch folder while their result is read."""

import datetime
import os
import re

import pytest

from __spark_entry__ import queries
from conftest import physical_plan
from kimberlite.catalog import models
from kimberlite.catalog.bronze import SOURCES, bronze
from kimberlite.sources.raw import ingest, list_raw
from kimberlite.sources.scratch import scratch_root


def staged(spark):
    folder = f"{scratch_root(spark)}/kimberlite"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


@pytest.fixture
def tables(spark, tmp_path):
    """Two customers and parts; part 2 is there twice, order 3 has no lines, a line no part."""
    day = datetime.datetime
    made = {
        "region": ([(0, "R0"), (1, "R1")], "r_regionkey int, r_name string"),
        "nation": ([(0, "N0", 0), (1, "N1", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": (
            [(1, "Customer#1", 0, 5.0, "BUILDING"), (2, "Customer#2", 1, 6.0, "AUTOMOBILE")],
            "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        ),
        "part": (
            [(1, "red", "Brand#1", "PROMO", 3, 10.0), (2, "blue", "Brand#2", "SMALL", 7, 20.0), (2, "blue", "Brand#2", "SMALL", 7, 20.0)],
            "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        ),
        "orders": (
            [(i, c, "O", t, day(1997 + i, 3, 1), "1-URGENT" if i == 4 else "2-HIGH") for i, c, t in [(1, 1, 90.0), (2, 2, 50.0), (3, 9, 7.0)]],
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
        ),
        "lineitem": (
            [(o, p, 1, n, 2.0, 10.0 * n, 0.05, 0.0, "N", "O", day(1998, 5, 1)) for o, p, n in [(1, 1, 1), (1, 2, 2), (2, None, 1), (2, 1, 2)]],
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
            " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        ),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_the_sales_fact_ends_with_one_step_of_its_own(spark, tables):
    """Steps before the last are staged and gone: their tables, and what they shuffled."""
    before = staged(spark)
    fact = queries()["gold_fact_sales"](spark, tables)
    left = {re.sub("-[0-9a-f]{32}", "", n) for n in staged(spark) - before}
    assert left <= {"parts", "numbered"}
    assert "Window" not in physical_plan(fact)
    columns = ["order_id", "line_number", "part_key", "customer_key", "cost", "sales_amount"]
    rows = sorted((*r[:5], float(r[5])) for r in fact.select(*columns).collect())
    # A part that is there twice repeats the line, with its amounts, and each of its costs.
    assert rows == [
        (1, 1, 3, 1, 6.5, 18.0),
        (1, 2, 1, 1, 13.0, 36.0),
        (1, 2, 2, 1, 13.0, 36.0),
        (1, 3, 1, 1, 13.0, 36.0),
        (1, 3, 2, 1, 13.0, 36.0),
        (2, 1, -1, 2, None, 16.6667),
        (2, 2, 3, 2, 7.0, 33.3333),
        (3, 1, -1, -1, None, 7.0),
    ]


def test_the_internet_fact_leaves_only_numbered_lines_and_keys(spark, tables):
    before = staged(spark)
    fact = queries()["gold_fact_internet_sales"](spark, tables)
    left = {re.sub("-[0-9a-f]{32}", "", n) for n in staged(spark) - before}
    assert left == {"lines", "numbered"}
    assert fact.count() == 5


def test_raw_files_of_a_load_are_compressed_and_read_back(spark, tables, tmp_path):
    folder = f"{tmp_path}/raw"
    models.raw_files(spark, tables, folder)
    parts = [n for _, _, names in os.walk(folder) for n in names if n.startswith("part-")]
    assert parts and all(n.endswith(".csv.gz") for n in parts)
    found = list_raw(spark, folder, models.RAW)
    assert set(found) == set(SOURCES)
    for name in ("SalesSalesOrderHeader", "PersonAddress"):
        made = bronze(spark, tables, name).drop("_ingestion_ts")
        read = ingest(spark, found[name], pattern=models.RAW).select(*made.columns)
        assert made.count() == read.count() and not made.exceptAll(read).count()
