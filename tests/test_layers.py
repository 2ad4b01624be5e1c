import logging
import math
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F
from raw_files import RAW

from kimberlite.catalog.models import comparable, with_tables
from kimberlite.plans import bi, gold, silver
from kimberlite.plans.layers import (
    LakeTables,
    LayerFailed,
    run_all,
    run_bronze,
    run_gold,
    run_in_order,
    run_layer,
    run_silver,
)
from kimberlite.sources.lake import BRONZE, GOLD, SILVER, Lake
from kimberlite.sources.raw import guess_delimiter, has_multiline_fields, ingest, list_raw, read_raw


def write_raw(folder, names=RAW):
    folder.mkdir(parents=True, exist_ok=True)
    for name in names:
        (folder / f"{name}.csv").write_text(RAW[name], encoding="utf-8")
    return str(folder)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    raw = write_raw(root / "raw")
    counts = run_all(spark, raw, str(root))
    sources = {
        f"b_{n}": f"SELECT * FROM read_csv('{raw}/{n}.csv', all_varchar = true, header = true)"
        for n in RAW
    }
    return Lake(spark, str(root)), counts, sources


def expected(table, sources):
    result = duckdb.connect().execute(with_tables(f"SELECT * FROM {table}", sources))
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(row[i] for i in order) for row in result.fetchall())


def found(df):
    df = comparable(df)
    return sorted(df.columns), Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("name", [e.name for e in silver.ENTITIES])
def test_silver_table(loaded, name):
    lake, counts, sources = loaded
    table = lake.read(SILVER, name)
    assert found(table) == expected(f"s_{name}", sources)
    assert counts[SILVER][name] == table.count()
    assert {"_ingestion_ts", "_transform_ts"} <= set(table.columns)
    assert "_source_file" not in table.columns


# Written out by hand, not from the specs that both sides of the other tests share.
_NEWEST = "QUALIFY row_number() OVER (PARTITION BY {} ORDER BY CAST(ModifiedDate AS TIMESTAMP) DESC) = 1"
PINNED = {
    (SILVER, "sales_currency"): f"""
        SELECT upper(trim(CurrencyCode)) AS currency_code, upper(trim(Name)) AS currency_name,
               CAST(ModifiedDate AS TIMESTAMP) AS modified_date
        FROM b_SalesCurrency {_NEWEST.format("upper(trim(CurrencyCode))")}""",
    (SILVER, "sales_customer"): f"""
        SELECT CAST(CustomerID AS INTEGER) AS customer_id, CAST(PersonID AS INTEGER) AS person_id,
               CAST(StoreID AS INTEGER) AS store_id, CAST(TerritoryID AS INTEGER) AS territory_id,
               trim(AccountNumber) AS account_number, CAST(ModifiedDate AS TIMESTAMP) AS modified_date
        FROM b_SalesCustomer {_NEWEST.format("CAST(CustomerID AS INTEGER)")}""",
    (SILVER, "production_product_cost_history"): f"""
        SELECT CAST(ProductID AS INTEGER) AS product_id, CAST(StartDate AS TIMESTAMP) AS start_date,
               CAST(EndDate AS TIMESTAMP) AS end_date, CAST(StandardCost AS DOUBLE) AS standard_cost,
               CAST(ModifiedDate AS TIMESTAMP) AS modified_date
        FROM b_ProductionProductCostHistory {_NEWEST.format("CAST(ProductID AS INTEGER), StartDate")}""",
    (SILVER, "sales_order_detail"): f"""
        SELECT CAST(SalesOrderID AS INTEGER) AS sales_order_id,
               CAST(SalesOrderDetailID AS INTEGER) AS sales_order_detail_id,
               trim(CarrierTrackingNumber) AS carrier_tracking_number,
               CAST(OrderQty AS INTEGER) AS order_quantity, CAST(ProductID AS INTEGER) AS product_id,
               CAST(SpecialOfferID AS INTEGER) AS special_offer_id, CAST(UnitPrice AS DOUBLE) AS unit_price,
               CAST(UnitPriceDiscount AS DOUBLE) AS unit_price_discount,
               CAST(LineTotal AS DOUBLE) AS line_total, CAST(ModifiedDate AS TIMESTAMP) AS modified_date
        FROM b_SalesSalesOrderDetail
        {_NEWEST.format("CAST(SalesOrderID AS INTEGER), CAST(SalesOrderDetailID AS INTEGER)")}""",
    (GOLD, "dim_currency"): """
        SELECT row_number() OVER (ORDER BY currency_alternate_key) AS currency_key, *,
               sha256(currency_alternate_key || '||' || currency_name) AS _hash
        FROM (SELECT DISTINCT upper(trim(CurrencyCode)) AS currency_alternate_key,
                     upper(trim(Name)) AS currency_name FROM b_SalesCurrency)
        UNION ALL SELECT -1, '-1', 'UNKNOWN', NULL""",
    (GOLD, "dim_product_category"): """
        SELECT row_number() OVER (ORDER BY product_category_alternate_key) AS product_category_key, *,
               sha256(product_category_alternate_key || '||' || product_category_name) AS _hash
        FROM (SELECT CAST(ProductCategoryID AS INTEGER) AS product_category_alternate_key,
                     trim(Name) AS product_category_name
              FROM b_ProductionProductCategory
              QUALIFY row_number() OVER (PARTITION BY CAST(ProductCategoryID AS INTEGER)
                                         ORDER BY CAST(ModifiedDate AS TIMESTAMP) DESC) = 1)
        UNION ALL SELECT -1, -1, 'UNKNOWN', '4e41'""",
}


@pytest.mark.parametrize("layer, name", PINNED)
def test_table_against_sql_written_out(loaded, layer, name):
    lake, _, sources = loaded
    names, rows = found(lake.read(layer, name))
    result = duckdb.connect().execute(with_tables(PINNED[layer, name], sources))
    columns = [d[0] for d in result.description]
    assert sorted(columns) == names
    assert rows == Counter(tuple(r[columns.index(n)] for n in names) for r in result.fetchall())


def test_calendar(loaded):
    lake, counts, sources = loaded
    table = lake.read(GOLD, "dim_date")
    assert found(table) == expected("g_dim_date", sources)
    assert counts[GOLD]["dim_date"] == table.count() == 3652


@pytest.mark.parametrize("name", [m.name for m in gold.MODELS if m.name != "dim_date"])
def test_gold_table(loaded, name):
    lake, counts, sources = loaded
    table = lake.read(GOLD, name)
    assert found(table) == expected(f"g_{name}", sources)
    assert counts[GOLD][name] == table.count()
    types = dict(table.dtypes)
    assert types["_hash"] == "binary" and types["_insert_ts"] == types["_update_ts"] == "timestamp"


def test_bronze_keeps_text_and_lineage(loaded):
    lake, counts, _ = loaded
    address = lake.read(BRONZE, "PersonAddress")
    assert {t for c, t in address.dtypes if c != "_ingestion_ts"} == {"string"}
    assert {r[0] for r in address.select("_source_file").distinct().collect()} == {"PersonAddress.csv"}
    first = address.filter("AddressID = '1'").first()
    assert first.AddressLine1 == " 1 Main St\nFloor 2 "
    korea = lake.read(BRONZE, "PersonCountryRegion").filter("CountryRegionCode = 'KR'").first()
    assert korea.Name == "Korea, Republic of"
    assert counts[BRONZE]["PersonCountryRegion"] == 5


def test_keys_are_dense_and_facts_find_their_dimensions(loaded):
    lake, _, _ = loaded
    fact = lake.read(GOLD, "fact_internet_sales")
    for name, key in (
        ("dim_product", "product_key"),
        ("dim_customer", "customer_key"),
        ("dim_promotion", "promotion_key"),
        ("dim_currency", "currency_key"),
        ("dim_sales_territory", "territory_key"),
    ):
        keys = sorted(r[0] for r in lake.read(GOLD, name).select(key).collect())
        assert keys == [-1, *range(1, len(keys))]
        assert {r[0] for r in fact.select(key).collect()} <= set(keys)
        assert fact.filter(F.col(key) == -1).count() > 0 or name == "dim_currency"
    assert {r[0] for r in fact.filter("sales_order_number = 'SO101'").select("ship_date_key").collect()} == {None}


def test_allocated_amounts_add_up(loaded):
    lake, _, _ = loaded
    header = lake.read(SILVER, "sales_order_header").filter("is_online_order")
    sums = (
        lake.read(GOLD, "fact_internet_sales")
        .groupBy("sales_order_number")
        .agg(F.sum("sales_amount").alias("a"), F.sum("tax_amount").alias("b"), F.sum("freight").alias("c"))
    )
    rows = header.alias("h").join(sums, "sales_order_number").select("h.*", "a", "b", "c").collect()
    assert len(rows) == 7  # one of them has no id
    for r in rows:
        for whole, parts in ((r.sub_total, r.a), (r.tax_amount, r.b), (r.freight, r.c)):
            assert math.isclose(whole, float(parts), abs_tol=1e-9)


def test_second_run_replaces_the_tables(loaded):
    lake, counts, _ = loaded
    assert run_silver(lake, [silver.BY_NAME["sales_currency"]]) == {"sales_currency": 3}
    assert run_gold(lake, [gold.BY_NAME["dim_currency"]]) == {"dim_currency": 4}
    assert LakeTables(lake).gold("dim_currency").count() == counts[GOLD]["dim_currency"]


def test_a_period_reads_its_partitions_of_the_fact(loaded):
    lake, counts, sources = loaded
    written = run_gold(lake, [gold.BY_NAME["dim_date"]])
    fact = LakeTables(lake).gold("fact_internet_sales")
    parts = Lake(lake.spark, f"{lake.root}/partitioned")
    parts.overwrite(fact, GOLD, "fact_internet_sales", ["order_date_key"])
    for name in ("dim_date", "dim_sales_territory"):
        assert parts.overwrite(lake.read(GOLD, name), GOLD, name) == counts[GOLD][name]
    assert written == {"dim_date": 3652}
    report = bi.sales_overview(
        LakeTables(parts), by=["month_number_of_year"], where=F.col("calendar_year") == 2013, slicers=["calendar_year"]
    )
    plan = report._jdf.queryExecution().toString()
    scans = [line for line in plan.split("\n") if "sales_amount" in line and "PartitionFilters" in line]
    assert scans and all("dynamicpruning" in line.split("PartitionFilters")[1] for line in scans)
    assert {r.month_number_of_year for r in report.collect()} == {5}


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert lake.overwrite(spark.range(3), GOLD, "t") == 3
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        lake.overwrite(broken, GOLD, "t")
    assert lake.read(GOLD, "t").count() == 3
    assert [p.name for p in (tmp_path / GOLD).iterdir() if not p.name.startswith(".")] == ["t.parquet"]


def test_a_failing_table_does_not_stop_the_others(spark, tmp_path, caplog):
    raw = write_raw(tmp_path / "raw", ["SalesCurrency", "SalesSpecialOffer"])
    (tmp_path / "raw" / "Bad.csv").write_text("a,b\n1,2,3\n")
    lake = Lake(spark, str(tmp_path))
    with caplog.at_level(logging.INFO), pytest.raises(LayerFailed) as failed:
        run_bronze(lake, raw)
    assert set(failed.value.failures) == {"Bad"}
    assert failed.value.rows == {"SalesCurrency": 3, "SalesSpecialOffer": 2}
    assert "bronze.SalesCurrency: 3 rows" in caplog.text
    with pytest.raises(LayerFailed) as failed:
        run_silver(lake)
    assert set(failed.value.rows) == {"sales_currency", "sales_special_offer"}
    with pytest.raises(LayerFailed) as failed:
        run_gold(lake)
    assert set(failed.value.rows) == {"dim_currency", "dim_promotion", "dim_date"}
    assert failed.value.failures["fact_internet_sales"] == "an input failed"


def test_inputs_run_first():
    seen = []
    done, failures = run_in_order(["c", "b", "a"], {"c": ["b"], "b": ["a"]}, seen.append)
    assert seen == ["a", "b", "c"] and set(done) == {"a", "b", "c"} and not failures
    with pytest.raises(ValueError):
        run_in_order(["a"], {"a": ["missing"]}, seen.append)


def test_partitioned_fact(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rows = spark.range(10).withColumn("year", F.col("id") % 2)
    assert lake.overwrite(rows, GOLD, "fact", partition_by=["year"]) == 10
    assert lake.read(GOLD, "fact").filter("year = 1").count() == 5


def test_raw_files_and_folders_are_found(spark, tmp_path):
    raw = write_raw(tmp_path / "raw", ["SalesCurrency"])
    spark.range(50).selectExpr("id AS a", "id AS b").repartition(3).write.option("header", True).csv(
        f"{raw}/Parts.csv"
    )
    (tmp_path / "raw" / "notes.txt").write_text("x")
    tables = list_raw(spark, raw)
    assert list(tables) == ["Parts", "SalesCurrency"]
    assert read_raw(spark, tables["Parts"]).count() == 50
    assert ingest(spark, tables["SalesCurrency"]).columns[-2:] == ["_ingestion_ts", "_source_file"]


def test_delimiter_and_multiline_detection(spark, tmp_path):
    raw = write_raw(tmp_path / "raw")
    assert guess_delimiter(spark, f"{raw}/SalesSalesTerritory.csv") == ";"
    assert guess_delimiter(spark, f"{raw}/SalesCurrency.csv") == ","
    assert has_multiline_fields(spark, f"{raw}/PersonAddress.csv")
    assert not has_multiline_fields(spark, f"{raw}/PersonCountryRegion.csv")


def test_empty_and_quoted_empty_fields_are_null(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b,c\n,"",x\n')
    assert tuple(read_raw(spark, str(tmp_path / "t.csv")).first()) == (None, None, "x")


def test_names_of_raw_tables(spark, tmp_path):
    raw = tmp_path / "raw"
    for name in ("Sales.v1", "Sales.v2"):
        (raw / name).mkdir(parents=True)
        (raw / name / "a.csv").write_text("a\n1\n")
    (raw / "Orders.x.csv").write_text("a\n1\n")
    assert set(list_raw(spark, str(raw))) == {"Sales.v1", "Sales.v2", "Orders.x"}
    (raw / "Orders.x.csv.csv").mkdir()
    (raw / "Orders.x.csv.csv" / "b.csv").write_text("a\n1\n")
    assert set(list_raw(spark, str(raw))) == {"Sales.v1", "Sales.v2", "Orders.x", "Orders.x.csv"}
    (raw / "Orders.x").mkdir()
    (raw / "Orders.x" / "b.csv").write_text("a\n1\n")
    with pytest.raises(ValueError, match="Orders.x"):
        list_raw(spark, str(raw))


def test_files_of_a_table_are_matched_by_their_headers(spark, tmp_path):
    folder = tmp_path / "a b%c.d"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,2\n")
    (folder / "2.csv").write_text("b;a\n9;8\n")
    (folder / "3.csv").write_text('a,b\n5,"x\ny"\n')
    (folder / "4.csv").write_text("")
    rows = ingest(spark, str(folder)).select("a", "b", "_source_file").collect()
    assert {tuple(r) for r in rows} == {("1", "2", "1.csv"), ("8", "9", "2.csv"), ("5", "x\ny", "3.csv")}
    (folder / "5.csv").write_text("a,c\n1,2\n")
    with pytest.raises(Exception, match="c"):
        ingest(spark, str(folder))
