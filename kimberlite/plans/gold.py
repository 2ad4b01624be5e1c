"""The gold models: nine dimensions and the sales fact."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kimberlite.functions.calendar import smart_date_key
from kimberlite.functions.digest import row_hash
from kimberlite.functions.exact import to_decimal
from kimberlite.operators.allocate import EXACT, allocate
from kimberlite.operators.dimension import Dimension, build_dimension, date_dimension, load_times
from kimberlite.operators.hot import left_join_many
from kimberlite.operators.keys import UNKNOWN_KEY, lookup_key
from kimberlite.operators.ordering import ascending, descending
from kimberlite.operators.pick import first_by
from kimberlite.operators.validity import valid_at
from kimberlite.sources.scratch import discard, stage, stage_alone

UNKNOWN = "UNKNOWN"
# Fixed values.
CALENDAR_FIRST, CALENDAR_LAST = "2005-01-01", "2014-12-31"
DEFAULT_CURRENCY = "USD"
INDIVIDUAL = "IN"
HOME_ADDRESS = 2
DESCRIPTION_CULTURE = "EN"


class Tables(Protocol):
    """Where a model finds its inputs."""

    spark: SparkSession

    def silver(self, name: str) -> DataFrame: ...

    def gold(self, name: str) -> DataFrame: ...


# ---------------------------------------------------------------- dimensions

CURRENCY = Dimension(
    key="currency_key",
    columns=["currency_alternate_key", "currency_name"],
    order=["currency_alternate_key"],
    digest=[("currency_alternate_key", ""), ("currency_name", "")],
    unknown={"currency_alternate_key": "-1", "currency_name": UNKNOWN},
)


def dim_currency(t: Tables) -> DataFrame:
    body = t.silver("sales_currency").withColumnRenamed("currency_code", "currency_alternate_key")
    return build_dimension(body, CURRENCY)


def dim_date(t: Tables) -> DataFrame:
    return date_dimension(t.spark, CALENDAR_FIRST, CALENDAR_LAST)


CATEGORY = Dimension(
    key="product_category_key",
    columns=["product_category_alternate_key", "product_category_name"],
    order=["product_category_alternate_key"],
    digest=[("product_category_alternate_key", ""), ("product_category_name", "")],
    unknown={"product_category_alternate_key": -1, "product_category_name": UNKNOWN},
    unknown_hash=b"NA",
)


def dim_product_category(t: Tables) -> DataFrame:
    body = t.silver("product_category").withColumnRenamed(
        "product_category_id", "product_category_alternate_key"
    )
    return build_dimension(body, CATEGORY)


PROMOTION = Dimension(
    key="promotion_key",
    columns=[
        "promotion_alternate_key",
        "promotion_name",
        "discount_pct",
        "promotion_type",
        "promotion_category",
        "start_date",
        "end_date",
        "min_quantity",
        "max_quantity",
    ],
    order=["promotion_alternate_key"],
    digest=[
        ("promotion_name", ""),
        ("discount_pct", ""),
        ("promotion_type", ""),
        ("promotion_category", ""),
        ("start_date", ""),
        ("end_date", ""),
        ("min_quantity", ""),
        ("max_quantity", ""),
    ],
    unknown={"promotion_alternate_key": -1, "promotion_name": UNKNOWN},
)


def dim_promotion(t: Tables) -> DataFrame:
    body = t.silver("sales_special_offer").withColumnsRenamed(
        {
            "special_offer_id": "promotion_alternate_key",
            "description": "promotion_name",
            "type": "promotion_type",
            "category": "promotion_category",
            "min_qty": "min_quantity",
            "max_qty": "max_quantity",
        }
    )
    return build_dimension(body, PROMOTION)


TERRITORY = Dimension(
    key="territory_key",
    columns=["territory_alternate_key", "territory_name", "country_region_name", "territory_group"],
    order=["territory_alternate_key"],
    digest=[("territory_name", ""), ("country_region_name", ""), ("territory_group", "")],
    unknown={
        "territory_alternate_key": -1,
        "territory_name": UNKNOWN,
        "country_region_name": UNKNOWN,
        "territory_group": UNKNOWN,
    },
)


def _countries(t: Tables) -> DataFrame:
    return t.silver("person_country_region").select("country_region_code", "country_region_name")


def dim_sales_territory(t: Tables) -> DataFrame:
    body = (
        t.silver("sales_territory")
        .join(_countries(t), "country_region_code", "left")
        .withColumnRenamed("territory_id", "territory_alternate_key")
    )
    return build_dimension(body, TERRITORY)


GEOGRAPHY = Dimension(
    key="geography_key",
    columns=[
        "sales_territory_key",
        "city",
        "state_province_code",
        "state_province_name",
        "country_region_code",
        "country_region_name",
        "postal_code",
    ],
    order=["country_region_code", "state_province_code", "city", "postal_code"],
    tie_break=["state_province_id"],
    digest=[
        ("state_province_name", ""),
        ("country_region_name", ""),
        ("sales_territory_key", "-1"),
    ],
    unknown={
        "sales_territory_key": -1,
        "city": UNKNOWN,
        "state_province_name": UNKNOWN,
        "country_region_name": UNKNOWN,
    },
)


def dim_geography(t: Tables) -> DataFrame:
    cities = t.silver("person_address").select("postal_code", "city", "state_province_id").distinct()
    states = t.silver("person_state_province").select(
        "state_province_id",
        "state_province_code",
        "state_province_name",
        F.col("country_region_code").alias("_country"),
        "territory_id",
    )
    countries = _countries(t).withColumn("_country", F.col("country_region_code"))
    body = cities.join(states, "state_province_id", "left").join(countries, "_country", "left")
    body = lookup_key(
        body,
        t.gold("dim_sales_territory"),
        {"territory_id": "territory_alternate_key"},
        "territory_key",
        alias="sales_territory_key",
    )
    return build_dimension(body, GEOGRAPHY)


SUBCATEGORY = Dimension(
    key="product_subcategory_key",
    columns=[
        "product_subcategory_alternate_key",
        "product_subcategory_name",
        "product_category_key",
    ],
    order=["product_subcategory_alternate_key"],
    digest=[("product_subcategory_name", ""), ("product_category_id", "-1")],
    unknown={
        "product_subcategory_alternate_key": -1,
        "product_subcategory_name": UNKNOWN,
        "product_category_key": -1,
    },
    unknown_hash=b"NA",
)


def dim_product_subcategory(t: Tables) -> DataFrame:
    body = lookup_key(
        t.silver("production_product_subcategory").withColumnRenamed(
            "product_subcategory_id", "product_subcategory_alternate_key"
        ),
        t.gold("dim_product_category"),
        {"product_category_id": "product_category_alternate_key"},
        "product_category_key",
    )
    return build_dimension(body, SUBCATEGORY)


PRODUCT = Dimension(
    key="product_key",
    columns=[
        "product_alternate_key",
        "product_subcategory_key",
        "product_name",
        "product_model",
        "description",
        "weight_unit_measure_code",
        "size_unit_measure_code",
        "finished_goods_flag",
        "color",
        "safety_stock_level",
        "reorder_point",
        "product_size",
        "product_size_range",
        "product_weight",
        "days_to_manufacture",
        "product_line",
        "product_class",
        "product_style",
    ],
    order=["product_alternate_key"],
    tie_break=["product_id"],
    digest=[
        ("product_subcategory_key", "-1"),
        ("product_name", ""),
        ("product_model", ""),
        ("description", ""),
        ("weight_unit_measure_code", ""),
        ("size_unit_measure_code", ""),
        ("finished_goods_flag", "false"),
        ("color", ""),
        ("safety_stock_level", "0"),
        ("reorder_point", "0"),
        ("product_size", ""),
        ("product_size_range", ""),
        ("product_weight", "0.0"),
        ("days_to_manufacture", "0"),
        ("product_line", ""),
        ("product_class", ""),
        ("product_style", ""),
    ],
    unknown={
        "product_alternate_key": "-1",
        "product_subcategory_key": -1,
        "product_name": UNKNOWN,
        "product_model": UNKNOWN,
        "description": UNKNOWN,
    },
)


def dim_product(t: Tables) -> DataFrame:
    texts = (
        t.silver("production_product_and_description")
        .filter(F.upper("culture_id") == DESCRIPTION_CULTURE)
        .select("product_id", "product_model", "description")
    )
    body = t.silver("production_product").join(texts.hint("merge"), "product_id", "left")
    body = lookup_key(
        body,
        t.gold("dim_product_subcategory"),
        {"product_subcategory_id": "product_subcategory_alternate_key"},
        "product_subcategory_key",
    ).withColumnRenamed("product_number", "product_alternate_key")
    return build_dimension(body, PRODUCT)


CUSTOMER = Dimension(
    key="customer_key",
    columns=[
        "geography_key",
        "customer_alternate_key",
        "customer_name",
        "title",
        "first_name",
        "middle_name",
        "last_name",
        "name_style",
        "birth_date",
        "marital_status",
        "suffix",
        "gender",
        "email_address",
        "yearly_income",
        "total_children",
        "number_children_at_home",
        "education",
        "occupation",
        "home_owner_flag",
        "number_cars_owned",
        "address_line1",
        "address_line2",
        "phone_number",
        "date_first_purchase",
    ],
    order=["customer_alternate_key"],
    tie_break=["business_entity_id", "customer_id"],
    digest=[
        ("geography_key", "-1"),
        ("customer_name", ""),
        ("title", ""),
        ("first_name", ""),
        ("middle_name", ""),
        ("last_name", ""),
        ("name_style", "false"),
        ("birth_date", "1900-01-01"),
        ("marital_status", ""),
        ("suffix", ""),
        ("gender", ""),
        ("email_address", ""),
        ("yearly_income", ""),
        ("total_children", "0"),
        ("number_children_at_home", "0"),
        ("education", ""),
        ("occupation", ""),
        ("home_owner_flag", ""),
        ("number_cars_owned", "0"),
        ("address_line1", ""),
        ("address_line2", ""),
        ("phone_number", ""),
        ("date_first_purchase", "1900-01-01"),
    ],
    unknown={
        "geography_key": -1,
        "customer_alternate_key": "-1",
        "customer_name": UNKNOWN,
    },
)


def home_addresses(t: Tables) -> DataFrame:
    """The newest home address of each entity with its geography key."""
    links = t.silver("person_business_entity_address").filter(
        F.col("address_type_id") == HOME_ADDRESS
    )
    addresses = t.silver("person_address").select(
        "address_id",
        F.col("address_id").alias("found_address_id"),
        "address_line1",
        "address_line2",
        "city",
        "postal_code",
        "state_province_id",
    )
    newest = first_by(
        links.select("business_entity_id", "address_id").join(addresses.hint("merge"), "address_id", "left"),
        ["business_entity_id"],
        descending("found_address_id", "address_id"),
    )
    states = t.silver("person_state_province").select(
        "state_province_id", "state_province_code", "country_region_code"
    )
    placed = newest.join(states, "state_province_id", "left")
    placed = lookup_key(
        placed,
        t.gold("dim_geography"),
        {
            "city": "city",
            "postal_code": "postal_code",
            "state_province_code": "state_province_code",
            "country_region_code": "country_region_code",
        },
        "geography_key",
        default=None,
    )
    return placed.select("business_entity_id", "address_line1", "address_line2", "geography_key")


def dim_customer(t: Tables) -> DataFrame:
    """Individuals; the narrow parts are joined first, the customers on the entity id last."""
    persons = (
        t.silver("person_person")
        .filter(F.col("person_type") == INDIVIDUAL)
        .select(
            "business_entity_id",
            F.concat_ws(" ", "first_name", "middle_name", "last_name").alias("customer_name"),
            "title",
            "first_name",
            "middle_name",
            "last_name",
            "name_style",
            "suffix",
        )
    )
    first_purchase = (
        t.silver("sales_order_header")
        .groupBy("customer_id")
        .agg(F.min("order_date").alias("date_first_purchase"))
    )
    customers = (
        t.silver("sales_customer")
        .select(
            F.col("person_id").alias("business_entity_id"),
            "customer_id",
            F.col("account_number").alias("customer_alternate_key"),
        )
        .filter(F.col("business_entity_id").isNotNull())
    )
    # A row per customer or person is not for the driver to gather, however small as files.
    customers = customers.join(first_purchase.hint("merge"), "customer_id", "left")
    # Both sides of the last join are read twice by it; staged, they are built once and apart.
    customers = stage(customers, "customers")
    phones = first_by(
        t.silver("person_phone"),
        ["business_entity_id"],
        ascending("modified_date", "phone_number", "phone_number_type_id"),
    ).select("business_entity_id", "phone_number")
    emails = first_by(
        t.silver("person_email_address"),
        ["business_entity_id"],
        descending("email_address_id") + ascending("email_address"),
    ).select("business_entity_id", "email_address")
    demographics = t.silver("person_demographics").drop("_ingestion_ts", "_transform_ts")

    body = persons
    for part in (home_addresses(t), demographics, phones, emails):
        body = body.join(part.hint("merge"), "business_entity_id", "left")
    persons = stage(body, "persons")
    body = left_join_many(persons, customers, "business_entity_id")
    body = body.withColumn(
        "geography_key", F.coalesce("geography_key", F.lit(UNKNOWN_KEY).cast("bigint"))
    )
    dimension = build_dimension(body, CUSTOMER)
    for staged in (persons, customers):  # numbering has staged its rows
        discard(staged)
    return dimension


# ---------------------------------------------------------------------- fact

FACT_COLUMNS = [
    "product_key",
    "order_date_key",
    "due_date_key",
    "ship_date_key",
    "customer_key",
    "promotion_key",
    "currency_key",
    "territory_key",
    "sales_order_number",
    "sales_order_line_number",
    "revision_number",
    "order_quantity",
    "unit_price",
    "extended_amount",
    "unit_price_discount_pct",
    "discount_amount",
    "product_standard_cost",
    "total_product_cost",
    "sales_amount",
    "tax_amount",
    "freight",
    "carrier_tracking_number",
    "customer_po_number",
]
FACT_DATES = ["order_date", "due_date", "ship_date"]
# Every fact column but the dates is hashed; keys are never NULL.
FACT_DIGEST = [(c, "") for c in FACT_COLUMNS]

_SPREAD = {"sales_amount": "_sub_total", "tax_amount": "_tax", "freight": "_freight"}


def _orders(t: Tables, header: DataFrame) -> DataFrame:
    """Orders with their amounts and dimension keys, resolved once per order, not per line."""
    rows = header.select(
        "sales_order_id",
        "order_date",
        "due_date",
        "ship_date",
        "sales_order_number",
        "revision_number",
        F.col("purchase_order_number").alias("customer_po_number"),
        "customer_id",
        "currency_rate_id",
        "territory_id",
        to_decimal(F.col("sub_total"), *EXACT).alias("_sub_total"),
        to_decimal(F.col("tax_amount"), *EXACT).alias("_tax"),
        to_decimal(F.col("freight"), *EXACT).alias("_freight"),
    )
    accounts = lookup_key(
        t.silver("sales_customer").select("customer_id", "account_number"),
        t.gold("dim_customer"),
        {"account_number": "customer_alternate_key"},
        "customer_key",
        default=None,
        many=True,
    )
    rows = lookup_key(rows, accounts, {"customer_id": "customer_id"}, "customer_key", many=True)
    rates = t.silver("sales_currency_rate").select("currency_rate_id", "to_currency_code")
    rows = rows.join(rates, "currency_rate_id", "left").withColumn(
        "to_currency_code", F.coalesce("to_currency_code", F.lit(DEFAULT_CURRENCY))
    )
    rows = lookup_key(
        rows,
        t.gold("dim_currency"),
        {"to_currency_code": "currency_alternate_key"},
        "currency_key",
    )
    rows = lookup_key(
        rows,
        t.gold("dim_sales_territory"),
        {"territory_id": "territory_alternate_key"},
        "territory_key",
    )
    return rows.drop("customer_id", "currency_rate_id", "to_currency_code", "territory_id")


_LOOKED_UP = ["product_id", "special_offer_id", "order_date"]


def _resolved(t: Tables, lines: DataFrame) -> DataFrame:
    """What each different product, offer and order date of the lines stands for.

    The lookups run over the different combinations, not over the lines, and the
    lines then take all of it in one join. Overlapping cost entries give several
    rows: such a line is repeated before it is allocated.
    """
    wanted = lines.select(*_LOOKED_UP).distinct()
    products = lookup_key(
        t.silver("production_product").select("product_id", "product_number"),
        t.gold("dim_product"),
        {"product_number": "product_alternate_key"},
        "product_key",
        default=None,
        many=True,
    )
    wanted = lookup_key(wanted, products, {"product_id": "product_id"}, "product_key", many=True)
    wanted = lookup_key(
        wanted,
        t.gold("dim_promotion"),
        {"special_offer_id": "promotion_alternate_key"},
        "promotion_key",
    )
    # Read four times by the validity join; staged, the lines and lookups stay out of its plan.
    wanted = stage(wanted, "wanted")
    costs = t.silver("production_product_cost_history")
    wanted = valid_at(
        wanted,
        costs.withColumn("_cost_start", F.col("start_date")),
        key="product_id",
        at="order_date",
        start="start_date",
        end="end_date",
        columns=["standard_cost", "_cost_start"],
    )
    return wanted.withColumnsRenamed({c: f"_of_{c}" for c in _LOOKED_UP})


def fact_internet_sales(t: Tables) -> DataFrame:
    """Online order lines with dimension keys; header amounts are spread over the lines.

    An order without lines, or without an id, is one row with the order's columns.
    """
    order = "sales_order_id"
    header = t.silver("sales_order_header").filter(F.col("is_online_order"))
    detail = t.silver("sales_order_detail").select(
        order,
        "sales_order_detail_id",
        "carrier_tracking_number",
        "order_quantity",
        "product_id",
        "special_offer_id",
        "unit_price",
        "unit_price_discount",
        "line_total",
    )

    def ordered() -> DataFrame:
        # Read four times by the join; staged, their lookups run once and stay out of the plan of the lines.
        return left_join_many(stage(_orders(t, header), "orders"), detail, order)

    def resolved() -> DataFrame:
        lines = stage_alone(t.spark, ordered, "order_lines")
        resolved = _resolved(t, lines)
        # Every line has its row there; an inner join is split at large keys on both sides.
        same = [lines[c].eqNullSafe(resolved[f"_of_{c}"]) for c in _LOOKED_UP]
        return lines.join(resolved, same).drop(*[f"_of_{c}" for c in _LOOKED_UP])

    # Every step shuffles whole lines: its result is staged, and what it shuffled and read is gone before the next.
    lines = stage_alone(t.spark, resolved, "resolved")
    by_line = ascending("sales_order_detail_id", "_cost_start")
    allocated = allocate(lines, order, by_line, "line_total", _SPREAD)
    discard(lines)
    lines = allocated
    quantity = F.col("order_quantity")
    fact = lines.select(
        "product_key",
        smart_date_key(F.col("order_date")).alias("order_date_key"),
        smart_date_key(F.col("due_date")).alias("due_date_key"),
        smart_date_key(F.col("ship_date")).alias("ship_date_key"),
        "customer_key",
        "promotion_key",
        "currency_key",
        "territory_key",
        "sales_order_number",
        F.col("line_number").alias("sales_order_line_number"),
        "revision_number",
        "order_quantity",
        "unit_price",
        to_decimal(F.col("line_total"), *EXACT).alias("extended_amount"),
        F.col("unit_price_discount").alias("unit_price_discount_pct"),
        (quantity * F.col("unit_price") * F.col("unit_price_discount")).alias("discount_amount"),
        F.col("standard_cost").alias("product_standard_cost"),
        (quantity * F.col("standard_cost")).alias("total_product_cost"),
        "sales_amount",
        "tax_amount",
        "freight",
        "carrier_tracking_number",
        "customer_po_number",
        *FACT_DATES,
    )
    return fact.select(
        *FACT_COLUMNS, *FACT_DATES, row_hash(fact, FACT_DIGEST).alias("_hash"), *load_times()
    )


# ------------------------------------------------------------------ registry


@dataclass(frozen=True)
class Model:
    name: str
    build: Callable[[Tables], DataFrame]
    silver: Sequence[str] = ()
    gold: Sequence[str] = ()


MODELS = [
    Model("dim_currency", dim_currency, ["sales_currency"]),
    Model("dim_date", dim_date),
    Model("dim_product_category", dim_product_category, ["product_category"]),
    Model("dim_promotion", dim_promotion, ["sales_special_offer"]),
    Model("dim_sales_territory", dim_sales_territory, ["sales_territory", "person_country_region"]),
    Model(
        "dim_geography",
        dim_geography,
        ["person_address", "person_state_province", "person_country_region"],
        ["dim_sales_territory"],
    ),
    Model(
        "dim_product_subcategory",
        dim_product_subcategory,
        ["production_product_subcategory"],
        ["dim_product_category"],
    ),
    Model(
        "dim_customer",
        dim_customer,
        [
            "person_person",
            "sales_customer",
            "person_business_entity_address",
            "person_address",
            "person_demographics",
            "person_phone",
            "person_email_address",
            "sales_order_header",
            "person_state_province",
        ],
        ["dim_geography"],
    ),
    Model(
        "dim_product",
        dim_product,
        ["production_product", "production_product_and_description"],
        ["dim_product_subcategory"],
    ),
    Model(
        "fact_internet_sales",
        fact_internet_sales,
        [
            "sales_order_header",
            "sales_order_detail",
            "production_product_cost_history",
            "sales_currency_rate",
            "production_product",
            "sales_customer",
        ],
        ["dim_product", "dim_customer", "dim_currency", "dim_promotion", "dim_sales_territory"],
    ),
]

BY_NAME = {m.name: m for m in MODELS}
