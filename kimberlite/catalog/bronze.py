"""The 20 all-text bronze tables derived from the test tables.

Each statement is valid for Spark and for the SQL side and names its input
tables in braces, so both sides start from the same text. The text carries the
defects the silver layer has to clean: blanks, mixed case, ``14.0`` integers,
older versions of a key, ids that are not positive, missing references.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")


def _country(column: str) -> str:
    return f"'C' || lpad(CAST({column} AS STRING), 2, '0')"


def _currency(column: str) -> str:
    return f"CASE WHEN {column} = 0 THEN 'usd' ELSE 'c' || lpad(CAST({column} AS STRING), 2, '0') END"


_BRAND = "CAST(substr(p_brand, 7) AS INT)"
_TYPE = "ascii(substr(p_type, 2, 1))"
_SUBCATEGORY = f"{_BRAND} * 100 + {_TYPE}"
_PERCENT = "CAST(round(l_discount * 100) AS INT)"
_OFFER = f"CASE WHEN {_PERCENT} = 10 THEN 99 ELSE {_PERCENT} + 1 END"

SOURCES: dict[str, str] = {
    "PersonCountryRegion": f"""
        SELECT {_country('n_nationkey')} AS CountryRegionCode, '  ' || n_name || ' ' AS Name,
               '2008-04-30' AS ModifiedDate
        FROM {{nation}}
        UNION ALL
        SELECT {_country('n_nationkey')} || ' ', 'Old ' || n_name, '2007-01-15 05:06:07.089'
        FROM {{nation}}""",
    "PersonStateProvince": f"""
        SELECT CAST(n_nationkey + 1 AS STRING) AS StateProvinceID,
               'S' || CAST(n_nationkey AS STRING) || ' ' AS StateProvinceCode,
               {_country('n_nationkey')} AS CountryRegionCode,
               CASE WHEN n_regionkey = 0 THEN 'True' ELSE 'False' END AS IsOnlyStateProvinceFlag,
               n_name || ' Province' AS Name,
               CAST(n_regionkey + 1 AS STRING) AS TerritoryID,
               '2013-03-04 05:06:07.089' AS ModifiedDate
        FROM {{nation}}""",
    "ProductionProductCategory": f"""
        SELECT DISTINCT CASE WHEN p_type = 'PROMO' THEN '999' ELSE CAST({_TYPE} AS STRING) || '.0' END
                   AS ProductCategoryID,
               ' ' || p_type || ' ' AS Name, '2008-04-30' AS ModifiedDate
        FROM {{part}}""",
    "ProductionProductSubcategory": f"""
        SELECT DISTINCT CAST({_SUBCATEGORY} AS STRING) AS ProductSubcategoryID,
               CAST({_TYPE} AS STRING) AS ProductCategoryID,
               p_brand || ' ' || p_type AS Name, '2008-04-30' AS ModifiedDate
        FROM {{part}}""",
    "ProductionProductCostHistory": """
        SELECT CAST(p_partkey + 1 AS STRING) AS ProductID,
               CAST(y AS STRING) || '-01-01' AS StartDate,
               CASE WHEN y < 2014 THEN CAST(y AS STRING) || '-12-31' END AS EndDate,
               CAST(p_retailprice * (y - 1998) / 20 AS STRING) AS StandardCost,
               CAST(y AS STRING) || '-01-01' AS ModifiedDate
        FROM (SELECT p_partkey, p_retailprice, {years} AS y FROM {part}) AS p""",
    "SalesCurrency": f"""
        SELECT {_currency('n_nationkey')} AS CurrencyCode, ' ' || n_name || ' dollar' AS Name,
               '2008-04-30' AS ModifiedDate
        FROM {{nation}}""",
    "SalesCurrencyRate": f"""
        SELECT CAST(n_nationkey + 1 AS STRING) AS CurrencyRateID,
               '2011-05-31' AS CurrencyRateDate, 'USD' AS FromCurrencyCode,
               upper({_currency('n_nationkey')}) || ' ' AS ToCurrencyCode,
               '1.' || CAST(n_nationkey AS STRING) AS AverageRate,
               '1.5' || CAST(n_nationkey AS STRING) AS EndOfDayRate,
               '2011-05-31' AS ModifiedDate
        FROM {{nation}}""",
    "SalesSalesTerritory": f"""
        SELECT CAST(r_regionkey + 1 AS STRING) AS TerritoryID, r_name || ' ' AS Name,
               {_country('r_regionkey')} AS CountryRegionCode, ' Group ' || r_name AS "Group",
               '1200345.5' AS SalesYTD, '987654.25' AS SalesLastYear,
               '0.0' AS CostYTD, '0.0' AS CostLastYear, '2008-04-30' AS ModifiedDate
        FROM {{region}}""",
    "SalesSpecialOffer": f"""
        SELECT CAST(pct + 1 AS STRING) AS SpecialOfferID,
               'Discount ' || CAST(pct AS STRING) || ' ' AS Description,
               '0.' || lpad(CAST(pct AS STRING), 2, '0') AS DiscountPct,
               CASE WHEN pct = 0 THEN 'No Discount' ELSE 'Volume Discount' END AS Type,
               ' Reseller' AS Category, '1995-01-01' AS StartDate, '2001-12-31 00:00:00' AS EndDate,
               CAST(pct AS STRING) AS MinQty,
               CASE WHEN pct > 5 THEN CAST(pct AS STRING) || '.0' END AS MaxQty,
               '2011-04-01' AS ModifiedDate
        FROM (SELECT DISTINCT {_PERCENT} AS pct FROM {{lineitem}}) AS d""",
    "PersonAddress": """
        SELECT CAST(c_custkey + 1 AS STRING) AS AddressID, ' ' || c_name || ' Street ' AS AddressLine1,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'Unit 7 ' END AS AddressLine2,
               'City ' || CAST(c_custkey % 50 AS STRING) AS City,
               CAST(c_nationkey + 1 AS STRING) AS StateProvinceID,
               CASE WHEN c_mktsegment <> 'FURNITURE' THEN lpad(CAST(c_custkey % 7 AS STRING), 5, '0') END
                   AS PostalCode,
               '2010-03-01' AS ModifiedDate
        FROM {customer}""",
    "PersonBusinessEntityAddress": """
        SELECT CAST(c_custkey + 1 AS STRING) AS BusinessEntityID,
               CAST(c_custkey + 1 AS STRING) AS AddressID, '2' AS AddressTypeID,
               '2010-03-01' AS ModifiedDate
        FROM {customer}
        UNION ALL
        SELECT CAST(c_custkey + 1 AS STRING), CAST(c_custkey + 2 AS STRING),
               CASE WHEN c_nationkey < 12 THEN '2' ELSE '3' END, '2011-03-01'
        FROM {customer}""",
    "SalesvPersonDemographics": """
        SELECT CAST(c_custkey + 1 AS STRING) AS BusinessEntityID,
               '19' || CAST(50 + c_custkey % 50 AS STRING) || '-0' || CAST(1 + c_custkey % 9 AS STRING)
                   || '-15' AS BirthDate,
               CASE WHEN c_custkey % 2 = 0 THEN ' m' ELSE 's ' END AS MaritalStatus,
               '25001-50000 ' AS YearlyIncome, 'f' AS Gender,
               CAST(c_custkey % 5 AS STRING) || '.0' AS TotalChildren,
               CASE WHEN c_nationkey < 20 THEN CAST(c_custkey % 3 AS STRING) END AS NumberChildrenAtHome,
               'Bachelors ' AS Education, 'skilled manual' AS Occupation,
               CASE WHEN c_nationkey < 5 THEN 'True' WHEN c_nationkey < 20 THEN '0' END AS HomeOwnerFlag,
               CAST(c_custkey % 4 AS STRING) AS NumberCarsOwned
        FROM {customer}
        UNION ALL
        SELECT '0', '1950-01-01', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
        FROM {region}""",
    "PersonEmailAddress": """
        SELECT CAST(c_custkey + 1 AS STRING) AS BusinessEntityID,
               CAST(c_custkey * 2 + 1 AS STRING) AS EmailAddressID,
               'first' || CAST(c_custkey AS STRING) || '@example.com ' AS EmailAddress,
               '2012-01-01' AS ModifiedDate
        FROM {customer}
        UNION ALL
        SELECT CAST(c_custkey AS STRING), CAST(c_custkey * 2 + 2 AS STRING),
               'second' || CAST(c_custkey AS STRING) || '@example.com', '2012-02-01'
        FROM {customer}""",
    "PersonPerson": """
        SELECT CAST(c_custkey + 1 AS STRING) AS BusinessEntityID,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'SC ' ELSE 'IN ' END AS PersonType,
               'False' AS NameStyle,
               CASE WHEN c_nationkey < 10 THEN 'Mr. ' ELSE ' ' END AS Title,
               ' ' || substr(c_name, 1, 8) AS FirstName,
               CASE WHEN c_nationkey < 15 THEN 'M' ELSE '  ' END AS MiddleName,
               substr(c_name, 10) AS LastName, CAST(NULL AS STRING) AS Suffix,
               '2.0' AS EmailPromotion, '2014-06-01 00:00:00' AS ModifiedDate
        FROM {customer}
        UNION ALL
        SELECT CAST(c_custkey + 1 AS STRING), 'EM', 'True', 'Dr.', 'Old', 'Version', c_name, 'Jr.',
               '0', '2009-06-01'
        FROM {customer}""",
    "PersonPersonPhone": """
        SELECT CAST(c_custkey + 1 AS STRING) AS BusinessEntityID,
               '1 (11) 500 555-' || lpad(CAST(c_custkey AS STRING), 8, '0') AS PhoneNumber,
               '1' AS PhoneNumberTypeID, '2009-01-01' AS ModifiedDate
        FROM {customer}
        UNION ALL
        SELECT CAST(c_custkey + 1 AS STRING),
               '1-(11) 500 555-' || lpad(CAST(c_custkey AS STRING), 8, '0'), '1', '2010-01-01'
        FROM {customer}
        UNION ALL
        SELECT CAST(c_custkey + 1 AS STRING), ' 555-' || lpad(CAST(c_custkey AS STRING), 8, '0') || ' ',
               '2', CASE WHEN c_nationkey < 12 THEN '2008-01-01' ELSE '2012-01-01' END
        FROM {customer}""",
    "ProductionProduct": f"""
        SELECT CAST(p_partkey + 1 AS STRING) AS ProductID, ' ' || p_name AS Name,
               'pn-' || lpad(CAST(p_partkey AS STRING), 10, '0') || ' ' AS ProductNumber,
               '1' AS MakeFlag,
               CASE WHEN p_size < 10 THEN NULL WHEN p_size < 30 THEN 'True' ELSE 'False' END
                   AS FinishedGoodsFlag,
               substr(p_name, 1, 3) AS Color,
               CAST(p_size * 10 AS STRING) || '.0' AS SafetyStockLevel,
               CAST(p_size AS STRING) AS ReorderPoint,
               CAST(p_retailprice * 0.5 AS STRING) AS StandardCost,
               CAST(p_retailprice AS STRING) AS ListPrice,
               CASE WHEN p_size > 44 THEN NULL WHEN p_size = 1 THEN ' m ' WHEN p_size = 2 THEN 'xl'
                    WHEN p_size < 20 THEN CAST(p_size AS STRING)
                    ELSE CAST(p_size + 18 AS STRING) || ' ' END AS Size,
               'cm ' AS SizeUnitMeasureCode,
               CASE WHEN p_size < 25 THEN 'lb' END AS WeightUnitMeasureCode,
               CASE WHEN p_size < 25 THEN CAST(p_size * 0.25 AS STRING) END AS Weight,
               '1' AS DaysToManufacture, ' r' AS ProductLine, 'h' AS Class, 'u ' AS Style,
               CASE WHEN p_size < 48 THEN CAST({_SUBCATEGORY} AS STRING) || '.0' END
                   AS ProductSubcategoryID,
               '1994-05-31' AS SellStartDate,
               CASE WHEN p_size < 5 THEN '2001-05-29 00:00:00' END AS SellEndDate,
               CAST(NULL AS STRING) AS DiscontinuedDate, '2014-02-08 10:01:36.827' AS ModifiedDate
        FROM {{part}}""",
    "ProductionvProductAndDescription": """
        SELECT CAST(p_partkey + 1 AS STRING) AS ProductID, p_name AS Name,
               p_brand || ' model ' AS ProductModel, 'en ' AS CultureID,
               ' Best ' || p_name || ' for you ' AS Description
        FROM {part}
        UNION ALL
        SELECT CAST(p_partkey + 1 AS STRING), p_name, p_brand, 'fr', 'Le meilleur'
        FROM {part}
        UNION ALL
        SELECT '0', r_name, r_name, 'en', r_name
        FROM {region}""",
    "SalesCustomer": """
        SELECT CAST(c_custkey + 1 AS STRING) AS CustomerID,
               CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN CAST(c_custkey + 1 AS STRING) || '.0' END
                   AS PersonID,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '292.0' END AS StoreID,
               CAST(c_nationkey % 5 + 1 AS STRING) AS TerritoryID,
               'AW' || lpad(CAST(c_custkey AS STRING), 10, '0') || ' ' AS AccountNumber,
               '2013-10-11 12:13:14.156' AS ModifiedDate
        FROM {customer}
        UNION ALL
        SELECT CAST(c_custkey + 1 AS STRING), NULL, NULL, '1', 'OLD', '2010-09-12'
        FROM {customer}""",
    "SalesSalesOrderDetail": f"""
        SELECT CAST(l_orderkey + 1 AS STRING) AS SalesOrderID,
               CAST(l_linenumber AS STRING) AS SalesOrderDetailID,
               CASE WHEN l_returnflag <> 'N' THEN '4911-' || l_returnflag || ' ' END
                   AS CarrierTrackingNumber,
               CAST(CAST(l_quantity AS INT) AS STRING) || '.0' AS OrderQty,
               CAST(l_partkey + 1 AS STRING) AS ProductID, CAST({_OFFER} AS STRING) AS SpecialOfferID,
               CAST(l_extendedprice / l_quantity AS STRING) AS UnitPrice,
               CAST(l_discount AS STRING) AS UnitPriceDiscount,
               CAST(l_extendedprice AS STRING) AS LineTotal,
               CAST(l_shipdate AS STRING) AS ModifiedDate
        FROM {{lineitem}}""",
    "SalesSalesOrderHeader": """
        SELECT CASE WHEN o_orderkey % 5000 <> 4 THEN CAST(o_orderkey + 1 AS STRING) END AS SalesOrderID,
               '8' AS RevisionNumber,
               substr(CAST(day AS STRING), 1, 10) AS OrderDate,
               substr(CAST(day + INTERVAL 12 DAY AS STRING), 1, 10) AS DueDate,
               CASE WHEN o_orderstatus <> 'O' THEN substr(CAST(day + INTERVAL 7 DAY AS STRING), 1, 10) END
                   AS ShipDate,
               '5' AS Status,
               CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 5000 <> 4 THEN 'False' ELSE 'True' END
                   AS OnlineOrderFlag,
               'SO' || CAST(o_orderkey AS STRING) || ' ' AS SalesOrderNumber,
               CASE WHEN o_orderstatus = 'F' THEN ' PO' || CAST(o_orderkey AS STRING) END
                   AS PurchaseOrderNumber,
               '10-4020-' || CAST(o_custkey AS STRING) AS AccountNumber,
               CAST(o_custkey + 1 AS STRING) AS CustomerID,
               CASE WHEN o_orderstatus = 'F' THEN '279.0' END AS SalesPersonID,
               CAST(o_custkey % 6 + 1 AS STRING) AS TerritoryID,
               CAST(o_custkey + 1 AS STRING) AS BillToAddressID,
               CAST(o_custkey + 1 AS STRING) AS ShipToAddressID, '5' AS ShipMethodID,
               CAST(NULL AS STRING) AS CreditCardID, ' 105041Vi' AS CreditCardApprovalCode,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey % 40 + 1 AS STRING) || '.0' END
                   AS CurrencyRateID,
               CAST(o_totalprice AS STRING) AS SubTotal,
               CAST(o_totalprice * 0.08 AS STRING) AS TaxAmt,
               CAST(o_totalprice * 0.025 AS STRING) AS Freight,
               CAST(o_totalprice * 1.105 AS STRING) AS TotalDue,
               o_orderpriority || ' ' AS Comment, '2014-06-07' AS ModifiedDate
        FROM (SELECT *, CAST(o_orderdate AS DATE) + INTERVAL 13 YEAR AS day FROM {orders}) AS o""",
}

# One row per part and year; each side spells this its own way.
_SPARK_YEARS = "explode(sequence(2009, 2014))"
_ORACLE_YEARS = "unnest(range(2009, 2015))"


def bronze(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A bronze table as Spark derives it from the test tables."""
    sql = SOURCES[table].replace('"Group"', "`Group`")
    if "{years}" in sql:
        sql = sql.replace("{years}", _SPARK_YEARS)
    inputs = {
        t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql
    }
    return spark.sql(sql, **inputs).withColumn("_ingestion_ts", F.current_timestamp())


def bronze_sql(table: str) -> str:
    """The same table for the SQL side."""
    sql = SOURCES[table].replace("{years}", _ORACLE_YEARS)
    for t in TABLES:
        sql = sql.replace(f"{{{t}}}", t)
    return sql
