"""Each operator on the test tables themselves."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kimberlite.catalog.models import calendar_sql, comparable, sql_dimension, sql_hash
from kimberlite.catalog.registry import query, table
from kimberlite.functions import clean
from kimberlite.functions.calendar import smart_date_key
from kimberlite.functions.digest import row_hash
from kimberlite.functions.exact import to_decimal
from kimberlite.operators.allocate import EXACT, allocate, number_lines
from kimberlite.operators.dimension import Dimension, build_dimension, date_dimension_for
from kimberlite.operators.hot import left_join_many
from kimberlite.operators.keys import lookup_key, surrogate_key
from kimberlite.operators.ordering import ascending, descending
from kimberlite.operators.pick import any_by, first_by, latest_by
from kimberlite.operators.validity import valid_at
from kimberlite.plans.silver import size_band, size_band_sql
from kimberlite.sources.raw import ingest, list_raw, read_raw, with_lineage
from kimberlite.sources.scratch import discard, scratch_root, stage, stage_alone

# Numbers the lines of an order; line numbers alone repeat.
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


# ------------------------------------------------------------ bronze, silver


@query(
    "bronze_text_lineage",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
              CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment || ', "' || c_name || '"' AS c_note,
              'customer.csv' AS _source_file
       FROM customer""",
)
def bronze_text_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written as delimited text and read back as text, with quoted fields."""
    path = f"{scratch_root(spark)}/kimberlite/raw-{uuid.uuid4().hex}/customer.csv"
    note = F.concat("c_mktsegment", F.lit(', "'), "c_name", F.lit('"'))
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", note.alias("c_note")
    )
    rows.write.option("header", True).option("escape", '"').csv(path)
    return with_lineage(read_raw(spark, path), "customer.csv").drop("_ingestion_ts")


@query(
    "bronze_many_files",
    """SELECT 'parties.v1' AS table_name, CAST(c_custkey AS VARCHAR) AS key, c_name AS name,
              c_mktsegment || ';' AS note, c_custkey % 2 = 0 AS first_half
       FROM customer
       UNION ALL
       SELECT 'parties.v2', CAST(s_suppkey AS VARCHAR), s_name, ' kept ', true FROM supplier""",
)
def bronze_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw folders with dots in their names; files of one have other column orders and delimiters."""
    root = f"{scratch_root(spark)}/kimberlite/raw-{uuid.uuid4().hex}"
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.concat("c_mktsegment", F.lit(";")).alias("note"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.lit(" kept ").alias("note")
    )

    def write(df: DataFrame, name: str, delimiter: str) -> None:
        writer = df.write.mode("append").option("header", True).option("sep", delimiter)
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        writer.csv(f"{root}/{name}")

    even = F.col("key") % 2 == 0
    write(customers.filter(even), "parties.v1", ",")
    write(customers.filter(~even).select("note", "key", "name"), "parties.v1", "|")
    write(suppliers, "parties.v2", ",")
    found = [
        ingest(spark, path).withColumn("table_name", F.lit(name)) for name, path in list_raw(spark, root).items()
    ]
    rows = found[0].unionByName(found[1])
    half = (F.col("table_name") == "parties.v2") | (F.col("key").cast("bigint") % 2 == 0)
    return rows.select("table_name", "key", "name", "note", half.alias("first_half"))


@query(
    "silver_typed_clean",
    """SELECT CAST(CAST(c_custkey AS VARCHAR) || '.0' AS INTEGER) AS customer_id,
              upper(trim('  ' || c_name || ' ')) AS customer_name,
              nullif(trim(CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' ELSE c_mktsegment END), '')
                AS segment,
              CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE) AS balance,
              CAST(CASE WHEN c_acctbal > 0 THEN 'True' ELSE '0' END AS BOOLEAN) AS in_credit,
              CAST('1998-0' || CAST(c_custkey % 9 + 1 AS VARCHAR) || '-05' AS DATE) AS registered_on,
              CAST('1998-01-05 10:17:21.587' AS TIMESTAMP) AS changed_at,
              CAST(c_acctbal AS VARCHAR) AS balance_text
       FROM customer""",
)
def silver_typed_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "customer").select(
        F.concat(F.col("c_custkey").cast("string"), F.lit(".0")).alias("id"),
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "  ").otherwise(F.col("c_mktsegment")).alias("seg"),
        F.col("c_acctbal").cast("string").alias("bal"),
        F.when(F.col("c_acctbal") > 0, "True").otherwise("0").alias("pos"),
        F.concat(
            F.lit("1998-0"), (F.col("c_custkey") % 9 + 1).cast("string"), F.lit("-05")
        ).alias("day"),
        F.lit("1998-01-05 10:17:21.587").alias("at"),
    )
    return text.select(
        clean.whole("id").alias("customer_id"),
        clean.upper_text("name").alias("customer_name"),
        clean.blank_to_null("seg").alias("segment"),
        clean.number("bal").alias("balance"),
        clean.flag("pos").alias("in_credit"),
        clean.day("day").alias("registered_on"),
        clean.instant("at").alias("changed_at"),
        clean.raw("bal").alias("balance_text"),
    )


@query(
    "silver_size_band",
    f"SELECT p_partkey, {size_band_sql('CAST(p_size AS VARCHAR)')} AS size_band FROM part",
)
def silver_size_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    return table(spark, sf_dir, "part").select("p_partkey", size_band(size).alias("size_band"))


@query(
    "silver_digits_all",
    "SELECT event_id, regexp_replace(props, '[^0-9]', '', 'g') AS digits FROM events",
)
def silver_digits_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", clean.digits("props").alias("digits"))


@query(
    "silver_digits_first",
    """SELECT event_id, regexp_replace(props, '[^0-9]', '') AS from_props,
              regexp_replace(CAST(ts AS VARCHAR), '[^0-9]', '') AS from_ts
       FROM events""",
)
def silver_digits_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        clean.digits_after_first_strip("props").alias("from_props"),
        clean.digits_after_first_strip(F.col("ts").cast("string")).alias("from_ts"),
    )


@query(
    "silver_latest_by_key",
    """SELECT user_id, event_type, max(ts) AS ts, arg_max(event_id, ts) AS event_id,
              arg_max(value, ts) AS value
       FROM events GROUP BY user_id, event_type""",
)
def silver_latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return latest_by(events, ["user_id", "event_type"], "ts")


@query(
    "silver_latest_by_normalised_key",
    """SELECT DISTINCT ON (k) event_id, ts, props
       FROM (SELECT *, regexp_replace(props, '[^0-9]', '', 'g') AS k FROM events)
       ORDER BY k, ts DESC, event_id""",
)
def silver_latest_by_normalised_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", "props", clean.digits("props").alias("number")
    )
    return latest_by(events, ["number"], "ts", ["event_id"]).drop("number")


@query(
    "silver_arbitrary_dedup",
    """SELECT DISTINCT ON (l_orderkey, l_linenumber) l_orderkey, l_linenumber, l_partkey, l_suppkey,
              l_extendedprice, l_quantity
       FROM lineitem
       ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity""",
)
def silver_arbitrary_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", *LINE_ORDER, "l_quantity"
    )
    return any_by(lines, ["l_orderkey", "l_linenumber"])


@query(
    "silver_positive_id_filter",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey > 0 AND c_mktsegment = 'BUILDING'",
)
def silver_positive_id_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .filter((F.col("c_custkey") > 0) & (F.col("c_mktsegment") == "BUILDING"))
        .select("c_custkey", "c_name")
    )


# ---------------------------------------------------------------- dimensions

SEGMENT = Dimension(
    key="segment_key",
    columns=["segment"],
    order=["segment"],
    digest=[("segment", "")],
    unknown={"segment": "UNKNOWN"},
)
PRIORITY = Dimension(
    key="promotion_key",
    columns=["promotion_name", "first_day", "orders"],
    order=["promotion_name"],
    digest=[("promotion_name", ""), ("first_day", ""), ("orders", "0")],
    unknown={"promotion_name": "UNKNOWN"},
    unknown_hash=b"NA",
)
REGION = Dimension(
    key="region_key",
    columns=["region_id", "region_name"],
    order=["region_id"],
    digest=[("region_id", ""), ("region_name", "")],
    unknown={"region_id": -1, "region_name": "UNKNOWN"},
)
NATION = Dimension(
    key="nation_key",
    columns=["nation_id", "nation_name", "region_key"],
    order=["nation_id"],
    digest=[("nation_name", ""), ("region_key", "-1")],
    unknown={"nation_id": -1, "nation_name": "UNKNOWN", "region_key": -1},
)
SUPPLIER = Dimension(
    key="supplier_key",
    columns=["supplier_id", "supplier_name", "balance", "nation_key"],
    order=["supplier_name", "supplier_id"],
    digest=[("supplier_name", ""), ("balance", "0.0"), ("nation_key", "-1")],
    unknown={"supplier_id": -1, "supplier_name": "UNKNOWN", "nation_key": -1},
)
PLACE = Dimension(
    key="geography_key",
    columns=["segment", "nation_name", "region_name", "region_key"],
    order=["region_name", "nation_name", "segment"],
    tie_break=["nation_id"],
    digest=[("nation_name", ""), ("region_name", ""), ("region_key", "-1")],
    unknown={"segment": "UNKNOWN", "nation_name": "UNKNOWN", "region_key": -1},
)
BRAND = Dimension(
    key="brand_key",
    columns=["brand"],
    order=["brand"],
    digest=[("brand", "")],
    unknown={"brand": "UNKNOWN"},
)
PART = Dimension(
    key="part_key",
    columns=["part_id", "part_name", "brand_key", "price", "size_text"],
    order=["part_name"],
    tie_break=["part_id"],
    digest=[("brand_key", "-1"), ("part_name", ""), ("price", "0.0"), ("size_text", "")],
    unknown={"part_id": -1, "part_name": "UNKNOWN", "brand_key": -1},
)
BUYER = Dimension(
    key="customer_key",
    columns=["customer_id", "customer_label", "geography_key", "first_purchase", "last_order_id"],
    order=["customer_id"],
    digest=[
        ("customer_label", ""),
        ("geography_key", "-1"),
        ("first_purchase", "1900-01-01"),
        ("last_order_id", ""),
    ],
    unknown={"customer_id": -1, "customer_label": "UNKNOWN", "geography_key": -1},
)

_CTE = {
    "dim_region": sql_dimension(
        REGION, "SELECT r_regionkey AS region_id, r_name AS region_name FROM region"
    ),
    "dim_nation": sql_dimension(
        NATION,
        """SELECT n_nationkey AS nation_id, n_name AS nation_name, ifnull(region_key, -1) AS region_key
           FROM nation LEFT JOIN dim_region ON region_id = n_regionkey""",
    ),
    "dim_supplier": sql_dimension(
        SUPPLIER,
        """SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_acctbal AS balance,
                  ifnull(nation_key, -1) AS nation_key
           FROM supplier LEFT JOIN dim_nation ON nation_id = s_nationkey""",
    ),
    "dim_place": sql_dimension(
        PLACE,
        """SELECT segment, nation_id, n_name AS nation_name, r_name AS region_name,
                  ifnull(region_key, -1) AS region_key
           FROM (SELECT c_mktsegment AS segment, c_nationkey AS nation_id FROM customer GROUP BY ALL)
           LEFT JOIN nation ON n_nationkey = nation_id
           LEFT JOIN region ON r_regionkey = n_regionkey
           LEFT JOIN dim_region ON region_id = n_regionkey""",
    ),
    "dim_brand": sql_dimension(BRAND, "SELECT DISTINCT p_brand AS brand FROM part"),
    "dim_part": sql_dimension(
        PART,
        """SELECT p_partkey AS part_id, p_name AS part_name, p_retailprice AS price, size_text,
                  ifnull(brand_key, -1) AS brand_key
           FROM part LEFT JOIN dim_brand ON brand = p_brand
           LEFT JOIN (SELECT DISTINCT p_size AS s, 'size ' || p_size AS size_text FROM part
                      WHERE p_type = 'PROMO') ON s = p_size AND p_type = 'PROMO'""",
    ),
    "dim_customer": sql_dimension(
        BUYER,
        """SELECT c_custkey AS customer_id, concat_ws(' ', c_name, nullif(c_mktsegment, 'BUILDING'))
                    AS customer_label,
                  ifnull(geography_key, -1) AS geography_key, first_purchase, last_order_id
           FROM customer
           LEFT JOIN nation ON n_nationkey = c_nationkey
           LEFT JOIN dim_place ON segment = c_mktsegment AND nation_name = n_name
           LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_purchase,
                             max(o_orderkey) AS last_order_id
                      FROM orders GROUP BY ALL) ON o_custkey = c_custkey""",
    ),
}


def _dim_sql(*names: str) -> str:
    ctes = ", ".join(f"{n} AS ({_CTE[n]})" for n in names)
    return f"WITH {ctes} SELECT * FROM {names[-1]}"


def dim_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name")
    )
    return build_dimension(body, REGION)


def dim_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").withColumnsRenamed(
        {"n_nationkey": "nation_id", "n_name": "nation_name"}
    )
    regions = dim_region(spark, sf_dir)
    return build_dimension(
        lookup_key(nations, regions, {"n_regionkey": "region_id"}, "region_key"), NATION
    )


def dim_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").withColumnsRenamed(
        {"s_suppkey": "supplier_id", "s_name": "supplier_name", "s_acctbal": "balance"}
    )
    nations = dim_nation(spark, sf_dir)
    return build_dimension(
        lookup_key(suppliers, nations, {"s_nationkey": "nation_id"}, "nation_key"), SUPPLIER
    )


def dim_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = (
        table(spark, sf_dir, "customer")
        .select(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation_id"))
        .distinct()
    )
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation_id"), F.col("n_name").alias("nation_name"), "n_regionkey"
    )
    regions = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region_name")
    )
    body = pairs.join(nations, "nation_id", "left").join(regions, "n_regionkey", "left")
    body = lookup_key(body, dim_region(spark, sf_dir), {"n_regionkey": "region_id"}, "region_key")
    return build_dimension(body, PLACE)


def dim_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    brands = build_dimension(parts.select(F.col("p_brand").alias("brand")).distinct(), BRAND)
    texts = (
        parts.filter(F.col("p_type") == "PROMO")
        .select("p_size", "p_type", F.concat(F.lit("size "), F.col("p_size")).alias("size_text"))
        .distinct()
    )
    body = lookup_key(
        parts.join(texts, ["p_size", "p_type"], "left"), brands, {"p_brand": "brand"}, "brand_key"
    ).withColumnsRenamed({"p_partkey": "part_id", "p_name": "part_name", "p_retailprice": "price"})
    return build_dimension(body, PART)


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    first = orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.min(F.col("o_orderdate").cast("date")).alias("first_purchase")
    )
    last = first_by(
        orders.select(
            F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("last_order_id")
        ),
        ["customer_id"],
        descending("last_order_id"),
    )
    label = F.concat_ws(" ", "c_name", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name")
    )
    body = (
        table(spark, sf_dir, "customer")
        .withColumn("customer_label", label)
        .withColumnRenamed("c_custkey", "customer_id")
        .join(nations, "c_nationkey", "left")
    )
    body = lookup_key(
        body,
        dim_place(spark, sf_dir),
        {"c_mktsegment": "segment", "n_name": "nation_name"},
        "geography_key",
    )
    body = body.join(first, "customer_id", "left").join(last, "customer_id", "left")
    return build_dimension(body, BUYER)


@query(
    "gold_dim_simple",
    sql_dimension(SEGMENT, "SELECT DISTINCT c_mktsegment AS segment FROM customer"),
)
def gold_dim_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segment")).distinct()
    return comparable(build_dimension(body, SEGMENT))


@query(
    "gold_dim_priority",
    sql_dimension(
        PRIORITY,
        """SELECT o_orderpriority AS promotion_name, min(CAST(o_orderdate AS DATE)) AS first_day,
                  count(*) AS orders
           FROM orders GROUP BY ALL""",
    ),
)
def gold_dim_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("promotion_name"))
        .agg(
            F.min(F.col("o_orderdate").cast("date")).alias("first_day"),
            F.count(F.lit(1)).alias("orders"),
        )
    )
    return comparable(build_dimension(body, PRIORITY))


@query("gold_dim_region", _dim_sql("dim_region"))
def gold_dim_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(dim_region(spark, sf_dir))


@query("gold_dim_nation", _dim_sql("dim_region", "dim_nation"))
def gold_dim_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(dim_nation(spark, sf_dir))


@query("gold_dim_supplier", _dim_sql("dim_region", "dim_nation", "dim_supplier"))
def gold_dim_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(dim_supplier(spark, sf_dir))


@query("gold_dim_place", _dim_sql("dim_region", "dim_place"))
def gold_dim_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(dim_place(spark, sf_dir))


@query("gold_dim_part", _dim_sql("dim_brand", "dim_part"))
def gold_dim_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(dim_part(spark, sf_dir))


@query("gold_dim_buyer", _dim_sql("dim_region", "dim_place", "dim_customer"))
def gold_dim_buyer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(dim_customer(spark, sf_dir))


@query("gold_order_calendar", calendar_sql("orders", "o_orderdate"))
def gold_order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date dimension over the years the orders cover."""
    return date_dimension_for(table(spark, sf_dir, "orders"), "o_orderdate")


@query(
    "gold_line_surrogate_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
              row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                          l_extendedprice) AS line_key
       FROM lineitem""",
)
def gold_line_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense keys over the largest table."""
    lines = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_orderkey", *LINE_ORDER)
    order = ascending("l_shipdate", "l_orderkey", *LINE_ORDER)
    return surrogate_key(lines, order, "line_key").drop("l_shipdate")


# -------------------------------------------------------- aggregates, top one


@query(
    "gold_first_purchase",
    """SELECT o_custkey AS customer_id, min(CAST(o_orderdate AS DATE)) AS first_purchase
       FROM orders GROUP BY o_custkey""",
)
def gold_first_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(F.min(F.col("o_orderdate").cast("date")).alias("first_purchase"))
    )


@query(
    "gold_top1_asc",
    """SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_orderdate
       FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey""",
)
def gold_top1_asc(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return first_by(orders, ["o_custkey"], ascending("o_orderdate", "o_orderkey"))


@query(
    "gold_top1_desc",
    """SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice
       FROM orders GROUP BY o_custkey""",
)
def gold_top1_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return first_by(orders, ["o_custkey"], descending("o_orderkey"))


# ------------------------------------------------------- lines of an order

def order_lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Orders left join their lines."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), "o_custkey", "o_orderdate", "o_totalprice"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), *LINE_ORDER, *columns
    )
    return left_join_many(orders, lines, "order_id")


_ORDER_LINES = """
    SELECT o_orderkey AS order_id, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,
           o_totalprice, o_custkey, CAST(o_orderdate AS DATE) AS d,
           row_number() OVER (PARTITION BY o_orderkey
                              ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)
             AS line_number,
           count(*) OVER (PARTITION BY o_orderkey) AS line_count,
           l_extendedprice / sum(CAST(l_extendedprice AS DECIMAL(18, 8))) OVER (PARTITION BY o_orderkey)
             AS line_share
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey"""


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return number_lines(order_lines(spark, sf_dir), "order_id", ascending(*LINE_ORDER), "l_extendedprice")


@query(
    "gold_header_detail_left",
    f"""SELECT order_id, l_linenumber, l_partkey, l_suppkey, l_extendedprice, line_number, line_count
        FROM ({_ORDER_LINES})""",
)
def gold_header_detail_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(spark, sf_dir).select("order_id", *LINE_ORDER, "line_number", "line_count")


@query("gold_order_share", f"SELECT order_id, line_number, line_share FROM ({_ORDER_LINES})")
def gold_order_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(spark, sf_dir).select("order_id", "line_number", "line_share")


@query(
    "gold_line_changed_at",
    """SELECT o_orderkey AS order_id, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
              CASE WHEN l_shipdate > o_orderdate THEN l_shipdate ELSE o_orderdate END AS changed_at
       FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
)
def gold_line_changed_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later of the order's and the line's time; an order without lines keeps its own."""
    changed = F.greatest("o_orderdate", "l_shipdate").alias("changed_at")
    return order_lines(spark, sf_dir, "l_shipdate").select("order_id", *LINE_ORDER, changed)


def _allocation_sql(amount: str, name: str) -> str:
    header = f"CAST({amount} AS DECIMAL(18, 8))"
    return f"""
        WITH l AS (SELECT *, CAST(line_share * {header} AS DECIMAL(18, 4)) AS part
                   FROM ({_ORDER_LINES}))
        SELECT order_id, line_number, CAST(CASE WHEN line_number < line_count THEN part
                 ELSE {header} - (SELECT ifnull(sum(part), 0) FROM l AS e
                                  WHERE e.order_id = l.order_id AND e.line_number < e.line_count)
               END AS DECIMAL(18, 4)) AS {name}
        FROM l"""


def _allocated(spark: SparkSession, sf_dir: str, factor: float, name: str) -> DataFrame:
    amount = F.col("o_totalprice") * factor if factor != 1 else F.col("o_totalprice")
    lines = order_lines(spark, sf_dir).withColumn("_amount", to_decimal(amount, *EXACT))
    done = allocate(lines, "order_id", ascending(*LINE_ORDER), "l_extendedprice", {name: "_amount"})
    return done.select("order_id", "line_number", name)


@query("gold_allocate_sales", _allocation_sql("o_totalprice", "sales_amount"))
def gold_allocate_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _allocated(spark, sf_dir, 1, "sales_amount")


@query("gold_allocate_tax", _allocation_sql("(o_totalprice * 0.08::DOUBLE)", "tax_amount"))
def gold_allocate_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _allocated(spark, sf_dir, 0.08, "tax_amount")


@query("gold_allocate_freight", _allocation_sql("(o_totalprice * 0.025::DOUBLE)", "freight"))
def gold_allocate_freight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _allocated(spark, sf_dir, 0.025, "freight")


_SKEWED = "CASE WHEN l_orderkey % 3 = 0 THEN NULL WHEN l_orderkey % 3 = 1 THEN 1 ELSE l_orderkey END"


@query(
    "gold_allocate_skewed",
    f"""WITH l AS (
          SELECT {_SKEWED} AS k, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                 CAST(1000000 + ifnull(k, 0) AS DECIMAL(18, 8)) AS amount
          FROM lineitem),
        n AS (
          SELECT *, row_number() OVER w AS line_number, count(*) OVER g AS line_count,
                 CAST(l_extendedprice / CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 8))) OVER g AS DOUBLE)
                      * CAST(amount AS DOUBLE) AS DECIMAL(18, 4)) AS part
          FROM l
          WINDOW g AS (PARTITION BY k),
                 w AS (PARTITION BY k ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)),
        s AS (SELECT k, sum(part) AS spent FROM n WHERE line_number < line_count GROUP BY k)
        SELECT n.k, l_orderkey, l_linenumber, line_number, line_count,
               CAST(if(line_number < line_count, part, amount - ifnull(spent, 0)) AS DECIMAL(18, 4)) AS share
        FROM n LEFT JOIN s ON s.k IS NOT DISTINCT FROM n.k""",
)
def gold_allocate_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts spread over groups of which two, one of them NULL, hold a third of all lines each."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.expr(_SKEWED).alias("k"), "l_orderkey", *LINE_ORDER
    )
    amount = to_decimal((F.coalesce("k", F.lit(0)) + 1_000_000).cast("double"), *EXACT)
    order = ascending("l_orderkey", *LINE_ORDER)
    done = allocate(lines.withColumn("amount", amount), "k", order, "l_extendedprice", {"share": "amount"})
    return done.select("k", "l_orderkey", "l_linenumber", "line_number", "line_count", "share")


# --------------------------------------------------- validity, keys, hashes

_MANY_KEYS = "CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_custkey END"


@query(
    "gold_long_history_join",
    f"""WITH o AS (SELECT {_MANY_KEYS} AS k, o_orderkey,
                          CAST(o_orderdate AS TIMESTAMP) + (o_orderkey % 24) * INTERVAL 1 HOUR AS t FROM orders),
             h AS (SELECT k, o_orderkey AS entry, t AS s,
                          CASE WHEN o_orderkey % 500 <> 0
                               THEN t + (o_orderkey % 7) * (o_orderkey % 11) * INTERVAL 5 HOUR END AS e FROM o)
        SELECT o.k, o.o_orderkey, entry
        FROM o LEFT JOIN h ON h.k = o.k AND t - INTERVAL 2 HOUR >= s AND (e IS NULL OR t - INTERVAL 2 HOUR <= e)""",
)
def gold_long_history_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histories that overlap and change within a day; one key has a third of all rows and entries."""
    hours = F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    orders = table(spark, sf_dir, "orders").select(
        F.expr(_MANY_KEYS).alias("k"),
        "o_orderkey",
        (F.col("o_orderdate").cast("timestamp_ntz") + hours).alias("t"),
    )
    length = F.make_dt_interval(hours=((F.col("o_orderkey") % 7) * (F.col("o_orderkey") % 11) * 5).cast("int"))
    history = orders.select(
        F.col("k").alias("h"),
        F.col("o_orderkey").alias("entry"),
        F.col("t").alias("s"),
        F.when(F.col("o_orderkey") % 500 != 0, F.col("t") + length).alias("e"),
    )
    rows = orders.withColumn("t", F.col("t") - F.make_dt_interval(hours=F.lit(2)))
    found = valid_at(rows, history, key="k", history_key="h", at="t", start="s", end="e", columns=["entry"])
    return found.select("k", "o_orderkey", "entry")


@query(
    "gold_open_history_join",
    """WITH h AS (SELECT o_orderpriority AS k, o_orderkey AS entry, CAST(o_orderdate AS DATE) AS s,
                         CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderdate AS DATE) + 90 END AS e FROM orders),
            p AS (SELECT DISTINCT k, CAST(date_trunc('quarter', s) AS DATE) AS t FROM h)
       SELECT p.k, t, count(entry) AS entries, CAST(sum(entry) AS BIGINT) AS keys
       FROM p LEFT JOIN h ON h.k = p.k AND t >= s AND (e IS NULL OR t <= e) GROUP BY ALL""",
)
def gold_open_history_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histories of which most entries are open, thousands for one key: what holds at each quarter's first day."""
    day = F.col("o_orderdate").cast("date")
    history = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("k"),
        F.col("o_orderkey").alias("entry"),
        day.alias("s"),
        F.when(F.col("o_orderkey") % 4 == 0, F.date_add(day, 90)).alias("e"),
    )
    quarters = history.select("k", F.trunc("s", "quarter").alias("t")).distinct()
    found = valid_at(quarters, history, key="k", at="t", start="s", end="e", columns=["entry"])
    return found.groupBy("k", "t").agg(F.count("entry").alias("entries"), F.sum("entry").alias("keys"))


def cost_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cost per part and year; the last one is open, the first year has none."""
    year = F.col("y").cast("string")
    return (
        table(spark, sf_dir, "part")
        .select("p_partkey", "p_retailprice", F.explode(F.sequence(F.lit(1996), F.lit(2001))).alias("y"))
        .select(
            F.col("p_partkey").alias("part_id"),
            F.concat(year, F.lit("-01-01")).cast("timestamp_ntz").alias("start_date"),
            F.when(F.col("y") < 2001, F.concat(year, F.lit("-12-31")))
            .cast("timestamp_ntz")
            .alias("end_date"),
            (F.col("p_retailprice") * (F.col("y") - 1985) / 20).alias("cost"),
        )
    )


_COST = """
    SELECT p_partkey AS part_id, make_timestamp(y, 1, 1, 0, 0, 0) AS start_date,
           CASE WHEN y < 2001 THEN make_timestamp(y, 12, 31, 0, 0, 0) END AS end_date,
           p_retailprice * (y - 1985) / 20 AS cost
    FROM (SELECT *, unnest(range(1996, 2002)) AS y FROM part)"""


@query(
    "gold_cost_interval_join",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
               CAST(l_shipdate AS DATE) AS ship_date,
               cost, l_quantity * cost AS total_cost
        FROM lineitem LEFT JOIN ({_COST}) AS h
          ON part_id = l_partkey AND CAST(l_shipdate AS DATE) >= start_date
         AND (end_date IS NULL OR CAST(l_shipdate AS DATE) <= end_date)""",
)
def gold_cost_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        *LINE_ORDER,
        "l_quantity",
        F.col("l_shipdate").cast("date").alias("ship_date"),
    )
    joined = valid_at(
        lines,
        cost_history(spark, sf_dir),
        key="l_partkey",
        history_key="part_id",
        at="ship_date",
        start="start_date",
        end="end_date",
        columns=["cost"],
    )
    return joined.withColumn("total_cost", F.col("l_quantity") * F.col("cost")).drop("l_quantity")


_RICH = "SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_acctbal AS balance, 1 AS nation_key FROM supplier WHERE s_acctbal > 0"


@query(
    "gold_fk_unknown",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
               ifnull(supplier_key, -1) AS supplier_key,
               CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS ship_date_key
        FROM lineitem LEFT JOIN (SELECT *, row_number() OVER (ORDER BY supplier_name, supplier_id)
                                   AS supplier_key FROM ({_RICH})) ON supplier_id = l_suppkey""",
)
def gold_fk_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of suppliers that are not in the dimension get the unknown key."""
    suppliers = (
        table(spark, sf_dir, "supplier")
        .filter(F.col("s_acctbal") > 0)
        .select(
            F.col("s_suppkey").alias("supplier_id"),
            F.col("s_name").alias("supplier_name"),
            F.col("s_acctbal").alias("balance"),
            F.lit(1).alias("nation_key"),
        )
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        *LINE_ORDER,
        smart_date_key(F.col("l_shipdate")).alias("ship_date_key"),
    )
    dimension = build_dimension(suppliers, SUPPLIER)
    return lookup_key(lines, dimension, {"l_suppkey": "supplier_id"}, "supplier_key")


HASHED = [
    ("l_orderkey", ""),
    ("l_linenumber", ""),
    ("l_quantity", ""),
    ("unit_price", ""),
    ("tiny", ""),
    ("huge", ""),
    ("exact", ""),
    ("l_returnflag", ""),
    ("returned", "false"),
    ("ship_date", "1900-01-01"),
]


@query(
    "gold_row_hash",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, {sql_hash(HASHED)} AS row_hash
        FROM (SELECT *, l_extendedprice / l_quantity AS unit_price, l_extendedprice * 1e-9 AS tiny,
                     l_extendedprice * 54321.0::DOUBLE AS huge,
                     CAST(l_extendedprice AS DECIMAL(18, 8)) AS exact,
                     nullif(l_returnflag = 'R', false) AS returned, CAST(l_shipdate AS DATE) AS ship_date
              FROM lineitem)""",
)
def gold_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    rows = table(spark, sf_dir, "lineitem").withColumns(
        {
            "unit_price": price / F.col("l_quantity"),
            "tiny": price * 1e-9,
            "huge": price * 54321.0,
            "exact": to_decimal(price, *EXACT),
            "returned": F.nullif(F.col("l_returnflag") == "R", F.lit(False)),
            "ship_date": F.col("l_shipdate").cast("date"),
        }
    )
    return rows.select(
        "l_orderkey", *LINE_ORDER, F.lower(F.hex(row_hash(rows, HASHED))).alias("row_hash")
    )


FACT_HASHED = [
    ("part_key", "-1"),
    ("customer_key", "-1"),
    ("order_date_key", ""),
    ("line_number", ""),
    ("quantity", ""),
    ("extended_amount", ""),
    ("cost", ""),
    ("total_cost", ""),
    ("sales_amount", ""),
    ("tax_amount", ""),
    ("freight", ""),
]


@query(
    "gold_fact_sales",
    f"""WITH dim_brand AS ({_CTE['dim_brand']}), dim_part AS ({_CTE['dim_part']}),
             dim_region AS ({_CTE['dim_region']}), dim_place AS ({_CTE['dim_place']}),
             dim_customer AS ({_CTE['dim_customer']}),
             line AS (
               SELECT x.*, cost
               FROM ({_ORDER_LINES}) AS x
               LEFT JOIN ({_COST}) AS h
                 ON part_id = l_partkey AND d >= start_date
                AND d <= ifnull(end_date, TIMESTAMP '9999-01-01')),
             sales AS ({_allocation_sql("o_totalprice", "sales_amount")}),
             tax AS ({_allocation_sql("(o_totalprice * 0.08::DOUBLE)", "tax_amount")}),
             freight AS ({_allocation_sql("(o_totalprice * 0.025::DOUBLE)", "freight")}),
             f AS (
               SELECT order_id, line_number, ifnull(part_key, -1) AS part_key,
                      ifnull(customer_key, -1) AS customer_key,
                      CAST(strftime(d, '%Y%m%d') AS INTEGER) AS order_date_key, l_quantity AS quantity,
                      CAST(l_extendedprice AS DECIMAL(18, 8)) AS extended_amount, cost,
                      l_quantity * cost AS total_cost, sales_amount, tax_amount, freight
               FROM line JOIN sales USING (order_id, line_number) JOIN tax USING (order_id, line_number)
               JOIN freight USING (order_id, line_number)
               LEFT JOIN dim_part ON part_id = l_partkey
               LEFT JOIN dim_customer ON customer_id = o_custkey)
        SELECT *, {sql_hash(FACT_HASHED)} AS _hash FROM f""",
)
def gold_fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and lines as a fact: cost at the order date, allocated amounts, keys, hash."""
    total = F.col("o_totalprice")
    history = cost_history(spark, sf_dir)

    def with_costs() -> DataFrame:
        lines = order_lines(spark, sf_dir, "l_quantity")
        lines = lines.withColumn("order_date", F.col("o_orderdate").cast("date")).drop("o_orderdate")
        return valid_at(
            stage(lines, "order_lines"),
            history,
            key="l_partkey",
            history_key="part_id",
            at="order_date",
            start="start_date",
            end="end_date",
            columns=["cost"],
        )

    def allocated() -> DataFrame:
        costs = stage_alone(spark, with_costs, "costs")
        lines = costs.withColumns(
            {
                "_sales": to_decimal(total, *EXACT),
                "_tax": to_decimal(total * 0.08, *EXACT),
                "_freight": to_decimal(total * 0.025, *EXACT),
            }
        )
        lines = allocate(
            lines.drop("o_totalprice"),
            "order_id",
            ascending(*LINE_ORDER),
            "l_extendedprice",
            {"sales_amount": "_sales", "tax_amount": "_tax", "freight": "_freight"},
        )
        discard(costs)
        return lines.drop("line_count", "line_total_of_group", "line_share", "_sales", "_tax", "_freight")

    def with_parts() -> DataFrame:
        lines = stage_alone(spark, allocated, "allocated").drop("l_linenumber", "l_suppkey")
        return lookup_key(lines, dim_part(spark, sf_dir), {"l_partkey": "part_id"}, "part_key")

    # Every step shuffles whole lines: its result is staged, and what it shuffled and read is gone before the next.
    rows = stage_alone(spark, with_parts, "parts")
    rows = lookup_key(rows, dim_customer(spark, sf_dir), {"o_custkey": "customer_id"}, "customer_key")
    fact = rows.select(
        "order_id",
        "line_number",
        "part_key",
        "customer_key",
        smart_date_key(F.col("order_date")).alias("order_date_key"),
        F.col("l_quantity").alias("quantity"),
        to_decimal(F.col("l_extendedprice"), *EXACT).alias("extended_amount"),
        "cost",
        (F.col("l_quantity") * F.col("cost")).alias("total_cost"),
        "sales_amount",
        "tax_amount",
        "freight",
    )
    return fact.withColumn("_hash", F.lower(F.hex(row_hash(fact, FACT_HASHED))))
