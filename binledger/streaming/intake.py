"""Incremental intake of dropped files.

The monthly append of new files is a file stream run to its end: each file is read once, what was
read is remembered in the checkpoint, and a rerun appends only what is new.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from binledger.sources.schemas import schema_of


def read_dropped(spark: SparkSession, folder: str, file_kind: str, max_files: int | None = None) -> DataFrame:
    """Stream of the folder's CSV lines with their file name; a line that does not fit fails the stream."""
    reader = spark.readStream.schema(schema_of(file_kind)).option("header", True)
    reader = reader.option("multiLine", True).option("mode", "FAILFAST")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(folder).withColumn("file_name", F.col("_metadata.file_name"))


def append_new_files(
    lines: DataFrame, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str
) -> None:
    """Append everything not yet read to the Parquet table ``target``.

    No count of lines is returned: Spark keeps the progress of the last batches only.
    """
    run = (
        transform(lines)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
