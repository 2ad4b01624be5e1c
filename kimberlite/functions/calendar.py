"""Calendar parts of a date and the smart date key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def smart_date_key(day: Column) -> Column:
    """Date as the int yyyymmdd; NULL stays NULL."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def semester(day: Column) -> Column:
    return F.when(F.month(day) <= 6, F.lit(1)).otherwise(F.lit(2))


def calendar_columns(day: Column) -> list[Column]:
    """The attributes of the date dimension; the fiscal year is the calendar year."""
    quarter = F.quarter(day).cast("bigint")
    year = F.year(day).cast("bigint")
    return [
        smart_date_key(day).alias("date_key"),
        day.alias("date_alternate_key"),
        F.dayofweek(day).cast("bigint").alias("day_number_of_week"),
        F.upper(F.date_format(day, "EEEE")).alias("day_name_of_week"),
        F.dayofmonth(day).cast("bigint").alias("day_number_of_month"),
        F.dayofyear(day).cast("bigint").alias("day_number_of_year"),
        F.weekofyear(day).cast("bigint").alias("week_number_of_year"),
        F.upper(F.date_format(day, "MMMM")).alias("month_name"),
        F.month(day).cast("bigint").alias("month_number_of_year"),
        quarter.alias("calendar_quarter"),
        year.alias("calendar_year"),
        semester(day).alias("calendar_semester"),
        quarter.alias("fiscal_quarter"),
        year.alias("fiscal_year"),
        semester(day).alias("fiscal_semester"),
    ]
