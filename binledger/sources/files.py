"""Delimited files in and out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binledger.functions.text import wave_date_of_file, wave_of_file


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType,
    header: bool = True,
    null_marker: str | None = None,
    multi_line: bool = True,
    bad_lines: str | None = None,
) -> DataFrame:
    """Typed read; columns go by position, so a file's own heading does not matter.

    A line that does not fit the schema fails the job, or is kept whole in the text column ``bad_lines`` where one is
    named. Quoted line breaks belong to their field; ``multi_line=False`` lets Spark split large files, and such a
    break then counts as a line that does not fit.
    """
    reader = spark.read.option("header", header).option("enforceSchema", True).option("multiLine", multi_line)
    if bad_lines is None:
        reader = reader.schema(schema).option("mode", "FAILFAST")
    else:
        kept = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        kept = T.StructType([*kept.fields, T.StructField(bad_lines, T.StringType())])
        reader = reader.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad_lines)
    if null_marker is not None:
        reader = reader.option("nullValue", null_marker)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Header on, NULL as empty; one sub-folder per value combination of ``partition_by``.

    Rows are brought together by folder first (a large folder over several tasks), so that the number of files follows
    the data and not tasks times folders.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").partitionBy(
        *partition_by
    ).csv(path)


def source_name(from_folder: bool = False) -> Column:
    """Name of the file a row came from, or of the folder when a drop is a folder of part files.

    A folder written by a partitioned sink is named ``column=value``; the value is the name then.
    """
    # the path is percent-encoded, but a plus sign in it stands for itself
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    name = F.element_at(F.split(path, "/"), -2 if from_folder else -1)
    return F.regexp_replace(name, "^[^=]*=", "") if from_folder else name


def with_file_columns(df: DataFrame, columns: Mapping[str, Column] | None = None, from_folder: bool = False) -> DataFrame:
    """Add ``file_name`` and the columns derived from it."""
    named = df.withColumn("file_name", source_name(from_folder))
    return named.withColumns(dict(columns)) if columns else named


def read_status_folders(
    spark: SparkSession, folders: Mapping[str, str], schema: str | T.StructType, from_folder: bool = False
) -> DataFrame:
    """One folder per status, many drops each: rows tagged with status, wave and wave date of their own drop."""
    parts = []
    for status, folder in folders.items():
        rows = (
            spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True)
            .option("multiLine", True).option("mode", "FAILFAST").csv(folder)
        )
        parts.append(
            with_file_columns(
                rows,
                {
                    "wave": wave_of_file(F.col("file_name")),
                    "wave_date": wave_date_of_file(F.col("file_name")),
                    "status": F.lit(status),
                },
                from_folder,
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)
