"""Reading and writing warehouse tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: read_table(spark, f"{folder}/{name}.parquet") for name in names}


def literal_table(spark: SparkSession, columns: Mapping[str, Sequence[object]]) -> DataFrame:
    """Rows fixed in code. Arrow makes a local relation of them, whose known size lets Spark broadcast it."""
    return spark.createDataFrame(pa.table({name: pa.array(list(values)) for name, values in columns.items()}))


def read_jdbc(
    spark: SparkSession,
    url: str,
    query_or_table: str,
    options: Mapping[str, str] | None = None,
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Table or query of a database server; ``split`` = (numeric column, low, high, partitions) reads in parallel.

    Filters and column choices made on the result are pushed to the server.
    """
    is_query = " " in query_or_table.strip()
    source = f"({query_or_table}) q" if is_query else query_or_table
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", source).options(**dict(options or {}))
    if split:
        column, low, high, parts = split
        reader = reader.options(
            partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts)
        )
    return reader.load()


def align_to_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns of the target in its order and types: missing ones NULL, surplus ones gone."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def append_aligned(df: DataFrame, path: str, target: T.StructType, partition_by: tuple[str, ...] = ()) -> None:
    aligned = align_to_schema(df, target)
    if partition_by:
        aligned = aligned.hint("rebalance", *partition_by)  # files follow the data, not tasks times folders
    aligned.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite_months(df: DataFrame, path: str, month: str = "month_dt") -> None:
    """Replace only the months present in ``df``; a rerun of a month does not double it."""
    df.hint("rebalance", month).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(path)
