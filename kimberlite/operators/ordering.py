"""Sort orders with NULL last, whatever the direction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascending(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def descending(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names]
