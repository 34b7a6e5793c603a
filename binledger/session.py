"""Session defaults and the shared staging folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Sequence
from functools import lru_cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_STAGE_ROOT = "spark.checkpoint.dir"


# Settings the jobs are tuned with; a cluster session may take them over.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    # split a hot join key even where a grouping on the same key follows
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the JVM interprets generated methods above 8000 bytes for ever; fall back to plain operators there
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


#: Unless this is false, a join deals both sides anew by all of its keys, even where they lie dealt alike by one of them.
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def join_as_dealt(spark: SparkSession) -> None:
    """From now on, joins of this session leave sides where they are that lie dealt alike by some of the join's keys."""
    spark.conf.set(_ALL_KEYS, "false")


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "binledger") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config(map=RECOMMENDED)
        # a table of n compressed bytes hashes to many times n; one local JVM builds it in a single thread
        .config("spark.sql.autoBroadcastJoinThreshold", "1mb")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BINLEDGER_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )


def stage_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of its own, which goes when the process ends.
    """
    root = spark.conf.get(_STAGE_ROOT, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{_STAGE_ROOT} must name a folder shared by all executors")
    return _own_root()


@lru_cache(1)
def _own_root() -> str:
    root = tempfile.mkdtemp(prefix="binledger-stage-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


_STAGED: list[str] = []


def new_stage_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used; ``clear_stage`` deletes it."""
    path = f"{stage_root(spark)}/{label}-{uuid4().hex}"
    _STAGED.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Used where a value must not change when a task is recomputed (row positions) and where several
    branches read one expensive result. The table survives the loss of any executor. It stays until
    ``clear_stage``, as results that are not computed yet may read it.
    """
    path = new_stage_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_TABLES: list[str] = []


def stage_bucketed(
    df: DataFrame, label: str, keys: Sequence[str], buckets: int | None = None, arranged: bool = False
) -> DataFrame:
    """Write ``df`` once in buckets of ``keys``, sorted inside, and continue from the table.

    Spark knows the layout: joins of tables with as many buckets of the same keys, and groupings by these keys and any
    more, need no exchange. The default number is that of the shuffle partitions. ``arranged`` says that ``df`` is
    already distributed by the keys, by a join on them for instance, so that it is written without another exchange.
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_stage_path(spark, label)
    name = f"staged_{uuid4().hex}"
    spread = df if arranged else df.repartition(count, *keys)
    spread.write.bucketBy(count, *keys).sortBy(*keys).format("parquet").option("compression", "zstd").option("path", path).saveAsTable(name)
    _TABLES.append(name)
    return spark.table(name)


def clear_stage(spark: SparkSession) -> int:
    """Delete what this process has staged, once its results are written; returns the number of folders."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _TABLES:
        spark.sql(f"drop table if exists {_TABLES.pop()}")
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        gone += path.getFileSystem(conf).delete(path, True)
    return gone
