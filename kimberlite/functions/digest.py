"""Change-detection hash of a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kimberlite.functions.exact import double_text

SEPARATOR = "||"


def as_text(df: DataFrame, name: str) -> Column:
    """A column as text that does not depend on the engine's number formatting."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return double_text(F.col(name).cast("double"))
    return F.col(name).cast("string")


def row_hash(df: DataFrame, fields: Sequence[tuple[str, str]]) -> Column:
    """SHA-256 bytes of the joined texts; each field comes with its text for NULL."""
    parts = [F.coalesce(as_text(df, name), F.lit(missing)) for name, missing in fields]
    return F.unhex(F.sha2(F.concat_ws(SEPARATOR, *parts), 256))
