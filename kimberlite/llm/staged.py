"""Results of operators that work in several steps."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kimberlite.sources.scratch import scratch_root, staging


def result(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """Write what ``make()`` returns to shared storage and delete the tables staged on the way.

    Calls don't nest: what is inside stages its tables with the outer call.
    """
    path = f"{scratch_root(spark)}/kimberlite/result-{uuid.uuid4().hex}"
    with staging(spark):
        made = make()
        made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


#: Rows of two or three plain columns that are broadcast at most: a few MB.
BROADCAST_ROWS = 200_000


def if_few(staged: DataFrame) -> DataFrame | None:
    """The staged table, marked for broadcast, if its rows are counted to be few; else None."""
    return F.broadcast(staged) if staged.count() <= BROADCAST_ROWS else None


def broadcast_if_few(staged: DataFrame) -> DataFrame:
    """The staged table, marked for broadcast if its rows are counted to be few; else it is shuffled."""
    few = if_few(staged)
    return staged if few is None else few
