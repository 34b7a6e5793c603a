"""Registration of the corpus queries, reading of their tables and shipping of the package to the workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, so that tasks import it wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_binledger_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="binledger-code-"), "binledger_code.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in sorted(os.walk(_PACKAGE)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    context.addPyFile(path)
    context._binledger_shipped = True


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)`` under ``name``."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register
