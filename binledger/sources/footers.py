"""Row counts and extremes from the statistics in Parquet footers, without reading a data page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_V1, _PUSHDOWN = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"


def read_with_statistics(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table whose ungrouped counts, minima and maxima Spark answers from the footers.

    Only the second version of the source pushes aggregates down; it is chosen for this table alone. Numbers, booleans and
    dates qualify. Spark raises where a footer lacks the statistics (a column that holds NaN, or NULL only, in some file), and
    reads the rows where the query filters, groups or computes first.
    """
    spark.conf.set(_PUSHDOWN, "true")  # has no effect on tables of the first version
    before = spark.conf.get(_V1)
    spark.conf.set(_V1, ",".join(s for s in before.split(",") if s.strip() != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(_V1, before)


def extremes(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """column_name, rows_total, rows_known, smallest, largest (as doubles) per column, from the footers."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        aggs += [F.count(c).alias(f"c{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    wide = read_with_statistics(spark, path).agg(*aggs)
    lines = [
        F.struct(F.lit(c).alias("column_name"), F.col("n").alias("rows_total"), F.col(f"c{i}").alias("rows_known"),
                 F.col(f"lo{i}").cast("double").alias("smallest"), F.col(f"hi{i}").cast("double").alias("largest"))
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*lines)))
