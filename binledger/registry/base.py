"""Registration of named queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binledger.sources.retail import Retail

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as text: types every engine prints alike."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        out.append(column.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register a function of the billing stand-in under ``name``."""

    def register(fn: Callable[[Retail], DataFrame]):
        QUERIES[name] = lambda spark, folder: plain(fn(Retail(spark, folder)))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register
