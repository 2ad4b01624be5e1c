"""What a session needs before it runs the operators."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

import kimberlite

_shipped: set[str] = set()
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_DEFAULT_ROWS, _TEXT_ROWS = "10000", "1000"


def ship(spark: SparkSession) -> None:
    """Send the package's code to the workers, once per application, and keep Arrow batches small.

    Workers may not have the package installed. Rows are whole texts, so where the
    session has Spark's default of 10 000 rows for a batch it gets 1000.
    """
    if spark.conf.get(_BATCH_ROWS) == _DEFAULT_ROWS:
        spark.conf.set(_BATCH_ROWS, _TEXT_ROWS)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(kimberlite.__file__))
    copied = os.path.join(tempfile.mkdtemp(prefix="code-"), "package")
    shutil.copytree(package, os.path.join(copied, "kimberlite"), ignore=shutil.ignore_patterns("__pycache__"))
    spark.sparkContext.addPyFile(shutil.make_archive(copied, "zip", copied))
    _shipped.add(app)
