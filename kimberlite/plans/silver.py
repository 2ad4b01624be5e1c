"""The 20 silver entities: typed, trimmed, one row per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kimberlite.functions import clean
from kimberlite.operators.pick import any_by, latest_by

CLEANERS: dict[str, Callable[[str], Column]] = {
    "raw": clean.raw,
    "text": clean.text,
    "upper": clean.upper_text,
    "blank": clean.blank_to_null,
    "int": clean.whole,
    "double": clean.number,
    "bool": clean.flag,
    "date": clean.day,
    "ts": clean.instant,
    "digits": clean.digits,
    "digits_first": clean.digits_after_first_strip,
}


@dataclass(frozen=True)
class Entity:
    """A silver table.

    ``fields`` has one line per column: name, cleaner, raw column. Without
    ``newest`` any row of a key may stay. ``keep`` filters before the choice;
    ``helpers`` are used for the key but not written; ``derived`` columns are
    computed from cleaned ones and placed after the named column.
    """

    name: str
    source: str
    fields: str
    key: Sequence[str]
    newest: str | None = "modified_date"
    keep: Callable[[], Column] | None = None
    helpers: Sequence[str] = ()
    derived: dict[str, tuple[str, Callable[[], Column]]] = field(default_factory=dict)

    def parsed(self) -> list[tuple[str, str, str]]:
        return [tuple(line.split()) for line in self.fields.strip().splitlines()]

    def output(self) -> list[str]:
        names = [name for name, _, _ in self.parsed() if name not in self.helpers]
        for name, (after, _) in self.derived.items():
            names.insert(names.index(after) + 1, name)
        return names


def positive(name: str) -> Callable[[], Column]:
    return lambda: F.col(name) > 0


# Fixed values.
SIZE_BANDS = {
    "38-40 Cm": ["38", "40"],
    "42-46 Cm": ["42", "44", "46"],
    "48-52 Cm": ["48", "50", "52"],
    "54-58 Cm": ["54", "56", "58"],
    "60-62 Cm": ["60", "62"],
}
LETTER_SIZES = ["S", "M", "L", "XL"]
NO_SIZE = "NA"


def size_band(size: Column) -> Column:
    """Band of a product size; a size outside every band has none."""
    band = F.when(size.isNull(), NO_SIZE).when(size.isin(LETTER_SIZES), size)
    for name, sizes in SIZE_BANDS.items():
        band = band.when(size.isin(sizes), name)
    return band


def size_band_sql(size: str) -> str:
    """The same as SQL."""
    quoted = {name: ", ".join(f"'{s}'" for s in sizes) for name, sizes in SIZE_BANDS.items()}
    letters = ", ".join(f"'{s}'" for s in LETTER_SIZES)
    bands = " ".join(f"WHEN {size} IN ({sizes}) THEN '{name}'" for name, sizes in quoted.items())
    return f"CASE WHEN {size} IS NULL THEN '{NO_SIZE}' WHEN {size} IN ({letters}) THEN {size} {bands} END"


ENTITIES = [
    Entity(
        "person_address",
        "PersonAddress",
        """
        address_id         int   AddressID
        address_line1      text  AddressLine1
        address_line2      text  AddressLine2
        city               text  City
        state_province_id  int   StateProvinceID
        postal_code        text  PostalCode
        modified_date      ts    ModifiedDate
        """,
        key=["address_id"],
    ),
    Entity(
        "person_business_entity_address",
        "PersonBusinessEntityAddress",
        """
        business_entity_id  int  BusinessEntityID
        address_id          int  AddressID
        address_type_id     int  AddressTypeID
        modified_date       ts   ModifiedDate
        """,
        key=["business_entity_id", "address_id", "address_type_id"],
    ),
    Entity(
        "person_country_region",
        "PersonCountryRegion",
        """
        country_region_code  text  CountryRegionCode
        country_region_name  text  Name
        modified_date        ts    ModifiedDate
        """,
        key=["country_region_code"],
    ),
    Entity(
        "person_demographics",
        "SalesvPersonDemographics",
        """
        business_entity_id       int    BusinessEntityID
        birth_date               date   BirthDate
        marital_status           upper  MaritalStatus
        yearly_income            text   YearlyIncome
        gender                   upper  Gender
        total_children           int    TotalChildren
        number_children_at_home  int    NumberChildrenAtHome
        education                upper  Education
        occupation               upper  Occupation
        home_owner_flag          bool   HomeOwnerFlag
        number_cars_owned        int    NumberCarsOwned
        """,
        key=["business_entity_id"],
        newest=None,
        keep=positive("business_entity_id"),
    ),
    Entity(
        "person_email_address",
        "PersonEmailAddress",
        """
        business_entity_id  int   BusinessEntityID
        email_address_id    int   EmailAddressID
        email_address       text  EmailAddress
        modified_date       ts    ModifiedDate
        """,
        key=["business_entity_id", "email_address_id", "email_address"],
        keep=positive("business_entity_id"),
    ),
    Entity(
        "person_person",
        "PersonPerson",
        """
        business_entity_id  int    BusinessEntityID
        person_type         text   PersonType
        name_style          bool   NameStyle
        title               blank  Title
        first_name          blank  FirstName
        middle_name         blank  MiddleName
        last_name           blank  LastName
        suffix              blank  Suffix
        email_promotion     int    EmailPromotion
        modified_date       ts     ModifiedDate
        """,
        key=["business_entity_id"],
    ),
    Entity(
        "person_phone",
        "PersonPersonPhone",
        """
        business_entity_id    int           BusinessEntityID
        phone_number          text          PhoneNumber
        phone_number_type_id  int           PhoneNumberTypeID
        modified_date         ts            ModifiedDate
        phone_number_digits   digits_first  PhoneNumber
        """,
        key=["business_entity_id", "phone_number_digits", "phone_number_type_id"],
        keep=positive("business_entity_id"),
        helpers=["phone_number_digits"],
    ),
    Entity(
        "person_state_province",
        "PersonStateProvince",
        """
        state_province_id            int   StateProvinceID
        state_province_code          text  StateProvinceCode
        country_region_code          text  CountryRegionCode
        is_only_state_province_flag  raw   IsOnlyStateProvinceFlag
        state_province_name          text  Name
        territory_id                 int   TerritoryID
        modified_date                ts    ModifiedDate
        """,
        key=["state_province_id"],
    ),
    Entity(
        "product_category",
        "ProductionProductCategory",
        """
        product_category_id    int   ProductCategoryID
        product_category_name  text  Name
        modified_date          ts    ModifiedDate
        """,
        key=["product_category_id"],
    ),
    Entity(
        "production_product",
        "ProductionProduct",
        """
        product_id                int     ProductID
        product_name              upper   Name
        product_number            upper   ProductNumber
        make_flag                 bool    MakeFlag
        finished_goods_flag       bool    FinishedGoodsFlag
        color                     upper   Color
        safety_stock_level        int     SafetyStockLevel
        reorder_point             int     ReorderPoint
        standard_cost             double  StandardCost
        list_price                double  ListPrice
        product_size              upper   Size
        size_unit_measure_code    upper   SizeUnitMeasureCode
        weight_unit_measure_code  upper   WeightUnitMeasureCode
        product_weight            double  Weight
        days_to_manufacture       int     DaysToManufacture
        product_line              upper   ProductLine
        product_class             upper   Class
        product_style             upper   Style
        product_subcategory_id    int     ProductSubcategoryID
        sell_start_date           ts      SellStartDate
        sell_end_date             ts      SellEndDate
        discontinued_date         ts      DiscontinuedDate
        modified_date             ts      ModifiedDate
        """,
        key=["product_id"],
        derived={
            "product_size_range": ("product_size", lambda: size_band(F.col("product_size")))
        },
    ),
    Entity(
        "production_product_and_description",
        "ProductionvProductAndDescription",
        """
        product_id     int    ProductID
        product_name   upper  Name
        product_model  upper  ProductModel
        description    text   Description
        culture_id     upper  CultureID
        """,
        key=["product_id"],
        newest=None,
        keep=lambda: (F.col("product_id") > 0) & (F.col("culture_id") == "EN"),
    ),
    Entity(
        "production_product_cost_history",
        "ProductionProductCostHistory",
        """
        product_id     int     ProductID
        start_date     ts      StartDate
        end_date       ts      EndDate
        standard_cost  double  StandardCost
        modified_date  ts      ModifiedDate
        """,
        key=["product_id", "start_date"],
    ),
    Entity(
        "production_product_subcategory",
        "ProductionProductSubcategory",
        """
        product_subcategory_id    int   ProductSubcategoryID
        product_category_id       int   ProductCategoryID
        product_subcategory_name  text  Name
        modified_date             ts    ModifiedDate
        """,
        key=["product_subcategory_id"],
    ),
    Entity(
        "sales_currency",
        "SalesCurrency",
        """
        currency_code  upper  CurrencyCode
        currency_name  upper  Name
        modified_date  ts     ModifiedDate
        """,
        key=["currency_code"],
    ),
    Entity(
        "sales_currency_rate",
        "SalesCurrencyRate",
        """
        currency_rate_id    int   CurrencyRateID
        currency_rate_date  ts    CurrencyRateDate
        from_currency_code  text  FromCurrencyCode
        to_currency_code    text  ToCurrencyCode
        average_rate        raw   AverageRate
        end_of_day_rate     raw   EndOfDayRate
        modified_date       ts    ModifiedDate
        """,
        key=["currency_rate_id"],
    ),
    Entity(
        "sales_customer",
        "SalesCustomer",
        """
        customer_id     int   CustomerID
        person_id       int   PersonID
        store_id        int   StoreID
        territory_id    int   TerritoryID
        account_number  text  AccountNumber
        modified_date   ts    ModifiedDate
        """,
        key=["customer_id"],
    ),
    Entity(
        "sales_order_detail",
        "SalesSalesOrderDetail",
        """
        sales_order_id           int     SalesOrderID
        sales_order_detail_id    int     SalesOrderDetailID
        carrier_tracking_number  text    CarrierTrackingNumber
        order_quantity           int     OrderQty
        product_id               int     ProductID
        special_offer_id         int     SpecialOfferID
        unit_price               double  UnitPrice
        unit_price_discount      double  UnitPriceDiscount
        line_total               double  LineTotal
        modified_date            ts      ModifiedDate
        """,
        key=["sales_order_id", "sales_order_detail_id"],
    ),
    Entity(
        "sales_order_header",
        "SalesSalesOrderHeader",
        """
        sales_order_id             int     SalesOrderID
        revision_number            int     RevisionNumber
        order_date                 date    OrderDate
        due_date                   date    DueDate
        ship_date                  date    ShipDate
        order_status               int     Status
        is_online_order            bool    OnlineOrderFlag
        sales_order_number         text    SalesOrderNumber
        purchase_order_number      text    PurchaseOrderNumber
        account_number             text    AccountNumber
        customer_id                int     CustomerID
        sales_person_id            int     SalesPersonID
        territory_id               int     TerritoryID
        bill_to_address_id         int     BillToAddressID
        ship_to_address_id         int     ShipToAddressID
        ship_method_id             int     ShipMethodID
        credit_card_id             int     CreditCardID
        credit_card_approval_code  text    CreditCardApprovalCode
        currency_rate_id           int     CurrencyRateID
        sub_total                  double  SubTotal
        tax_amount                 double  TaxAmt
        freight                    double  Freight
        total_due                  double  TotalDue
        order_comment              text    Comment
        modified_date              ts      ModifiedDate
        """,
        key=["sales_order_id"],
    ),
    Entity(
        "sales_special_offer",
        "SalesSpecialOffer",
        """
        special_offer_id  int   SpecialOfferID
        description       text  Description
        discount_pct      raw   DiscountPct
        type              text  Type
        category          text  Category
        start_date        date  StartDate
        end_date          date  EndDate
        min_qty           raw   MinQty
        max_qty           raw   MaxQty
        modified_date     ts    ModifiedDate
        """,
        key=["special_offer_id"],
    ),
    Entity(
        "sales_territory",
        "SalesSalesTerritory",
        """
        territory_id         int   TerritoryID
        territory_name       text  Name
        country_region_code  text  CountryRegionCode
        territory_group      text  Group
        sales_ytd            raw   SalesYTD
        sales_last_year      raw   SalesLastYear
        cost_ytd             raw   CostYTD
        cost_last_year       raw   CostLastYear
        modified_date        ts    ModifiedDate
        """,
        key=["territory_id"],
    ),
]

BY_NAME = {e.name: e for e in ENTITIES}


def with_all_digits(entity: Entity) -> Entity:
    """The same entity comparing phone numbers by all their digits."""
    return Entity(
        **{**entity.__dict__, "fields": entity.fields.replace("digits_first", "digits")}
    )


def build_entity(bronze: DataFrame, entity: Entity) -> DataFrame:
    """Bronze text to one typed row per key, with its load and transform times."""
    rows = bronze.select(
        *[CLEANERS[kind](f"`{source}`").alias(name) for name, kind, source in entity.parsed()],
        "_ingestion_ts",
    )
    if entity.keep:
        rows = rows.filter(entity.keep())
    if entity.newest:
        rows = latest_by(rows, entity.key, entity.newest)
    else:
        rows = any_by(rows, entity.key)
    for name, (_, column) in entity.derived.items():
        rows = rows.withColumn(name, column())
    return rows.select(
        *entity.output(), "_ingestion_ts", F.current_timestamp().alias("_transform_ts")
    )
