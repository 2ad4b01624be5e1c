"""Report queries over the gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kimberlite.functions.exact import to_decimal
from kimberlite.plans.gold import Tables

PERIOD = ("calendar_year", "calendar_semester", "calendar_quarter", "month_number_of_year")


def sales_lines(t: Tables, columns: Sequence[str]) -> DataFrame:
    """Fact rows with the wanted attributes; only the dimensions that hold one are joined."""
    rows = t.gold("fact_internet_sales")
    wanted = set(columns)
    if wanted & set(PERIOD):
        dates = t.gold("dim_date").select(F.col("date_key").alias("order_date_key"), *PERIOD)
        rows = rows.join(dates, "order_date_key", "left")
    if wanted & {"country_region_name", "territory_group"}:
        territories = t.gold("dim_sales_territory").select(
            "territory_key", "country_region_name", "territory_group"
        )
        rows = rows.join(territories, "territory_key", "left")
    product_levels = {
        "product_category_name": 3,
        "product_subcategory_name": 2,
        "product_model": 1,
        "product_name": 1,
    }
    depth = max((product_levels[c] for c in wanted if c in product_levels), default=0)
    if depth >= 1:
        products = t.gold("dim_product").select(
            "product_key", "product_name", "product_model", "product_subcategory_key"
        )
        rows = rows.join(products, "product_key", "left")
    if depth >= 2:
        subcategories = t.gold("dim_product_subcategory").select(
            "product_subcategory_key", "product_subcategory_name", "product_category_key"
        )
        rows = rows.join(subcategories, "product_subcategory_key", "left")
    if depth >= 3:
        categories = t.gold("dim_product_category").select(
            "product_category_key", "product_category_name"
        )
        rows = rows.join(categories, "product_category_key", "left")
    return rows


def measures() -> list[Column]:
    return [
        F.sum("sales_amount").cast("decimal(38,4)").alias("sales"),
        F.count_distinct("sales_order_number").alias("orders"),
        F.sum("order_quantity").alias("quantity"),
    ]


def sales_overview(
    t: Tables,
    by: Sequence[str] = ("calendar_year", "country_region_name"),
    where: Column | None = None,
    slicers: Sequence[str] = (),
) -> DataFrame:
    """Sales, orders and quantity per period and country; ``where`` may use ``slicers``."""
    rows = sales_lines(t, [*by, *slicers])
    if where is not None:
        rows = rows.filter(where)
    return rows.groupBy(*by).agg(*measures())


def profitability(
    t: Tables,
    by: Sequence[str] = ("calendar_year", "product_category_name"),
    where: Column | None = None,
    slicers: Sequence[str] = (),
) -> DataFrame:
    """Sales, product cost, margin and margin share; lines without a cost count as zero cost."""
    rows = sales_lines(t, [*by, *slicers])
    if where is not None:
        rows = rows.filter(where)
    totals = rows.groupBy(*by).agg(
        F.sum("sales_amount").cast("decimal(28,4)").alias("sales"),
        F.coalesce(F.sum(to_decimal(F.col("total_product_cost"), 18, 4)), F.lit(0))
        .cast("decimal(28,4)")
        .alias("cost"),
    )
    margin = (F.col("sales") - F.col("cost")).cast("decimal(28,4)")
    return totals.withColumn("margin", margin).withColumn(
        "margin_pct", F.try_divide(F.col("margin").cast("double"), F.col("sales").cast("double"))
    )


def customer_sales(t: Tables) -> DataFrame:
    """Sales per customer with name and country; the fact is summed before any join.

    An order has one customer, so its orders can be counted before the join.
    """
    totals = t.gold("fact_internet_sales").groupBy("customer_key").agg(*measures())
    customers = t.gold("dim_customer").select("customer_key", "customer_name", "geography_key")
    places = t.gold("dim_geography").select("geography_key", "country_region_name")
    return (
        totals.join(customers.hint("merge"), "customer_key", "left")
        .join(places, "geography_key", "left")
        .select("customer_key", "customer_name", "country_region_name", "sales", "orders", "quantity")
    )


def product_sales(
    t: Tables,
    by: Sequence[str] = ("product_category_name", "product_subcategory_name", "product_model"),
    where: Column | None = None,
    slicers: Sequence[str] = (),
) -> DataFrame:
    """Sales down the product hierarchy."""
    return sales_overview(t, by, where, slicers)
