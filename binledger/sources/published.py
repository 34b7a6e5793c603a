"""Tables that change in one step: readers see all of a write or nothing of it.

Data go to a folder of their own first. Then a small file that lists the folders of the new version takes the next number,
by a rename that fails where the number is taken. The highest number is the table. A write that fails leaves a folder that
no version lists; a writer that loses a number to another one reads that version and takes the next. A reader keeps the
folders its version lists, until ``vacuum`` deletes what no recent version holds.

``<path>/versions/0000000007`` holds one line of JSON per entry: the schema first, then a folder below ``<path>/data`` each.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binledger.sources.tables import align_to_schema

Entries = list[str]
_NOTE = "#"  # an entry that is no folder


class _Store:
    """The few file operations a version needs, in whatever file system the path names."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = path.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, below: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{below}" if below else self.root)

    def names(self, below: str) -> list[str]:
        at = self.path(below)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, below: str) -> str:
        stream = self.fs.open(self.path(below))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, below: str, text: str) -> bool:
        """Create a file with this text in one step; False where it exists."""
        waiting = self.path(f"waiting/{uuid4().hex}")
        stream = self.fs.create(waiting, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        target = self.path(below)
        self.fs.mkdirs(target.getParent())
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        none = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self.fs.makeQualified(waiting), self.fs.makeQualified(target), none)
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                raise
            self.fs.delete(waiting, False)
            return False


def _versions(store: _Store) -> list[int]:
    return [int(n) for n in store.names("versions")]


def _load(store: _Store, version: int) -> tuple[T.StructType, Entries]:
    first, *rest = store.read(f"versions/{version:010d}").splitlines()
    return T.StructType.fromJson(json.loads(first)), [json.loads(line) for line in rest]


def _commit(store: _Store, schema: T.StructType, change: Callable[[Entries], Entries]) -> int:
    """Publish ``change`` of the newest version; returns the number it took."""
    while True:
        known = _versions(store)
        newest = known[-1] if known else 0
        entries = change(_load(store, newest)[1] if newest else [])
        text = "\n".join([schema.json(), *map(json.dumps, entries)])
        if store.write_new(f"versions/{newest + 1:010d}", text):
            return newest + 1


def _write(store: _Store, df: DataFrame, month: str | None) -> Entries:
    """Data files below a new folder; a partitioned write has an entry per month."""
    load = f"load={uuid4().hex}"
    target = f"{store.root}/data/{load}"
    if month is None:
        df.write.parquet(target)
        return [load]
    df.hint("rebalance", month).write.partitionBy(month).parquet(target)
    return [f"{load}/{name}" for name in store.names(f"data/{load}") if name.startswith(f"{month}=")]


def publish_append(df: DataFrame, path: str, target: T.StructType | None = None, month: str | None = None) -> int:
    """Add rows, aligned to ``target`` or else to the columns the table has; returns the version."""
    store = _Store(df.sparkSession, path)
    known = _versions(store)
    schema = target or (_load(store, known[-1])[0] if known else df.schema)
    added = _write(store, align_to_schema(df, schema), month)
    return _commit(store, schema, lambda entries: entries + added)


def publish_months(df: DataFrame, path: str, month: str = "month_dt", note: tuple[str, str] | None = None) -> int:
    """Replace the months that ``df`` holds, all at once, and keep the others; returns the version.

    A ``note`` (name, text) is published in the same step and replaces one of that name.
    """
    store = _Store(df.sparkSession, path)
    added = _write(store, df, month)
    new = {e.rsplit("/", 1)[-1] for e in added}

    def change(entries: Entries) -> Entries:
        kept = [e for e in entries if e.rsplit("/", 1)[-1] not in new]
        if note:
            kept = [e for e in kept if not e.startswith(f"{_NOTE}{note[0]}=")] + [f"{_NOTE}{note[0]}={note[1]}"]
        return kept + added

    return _commit(store, df.schema, change)


def read_note(spark: SparkSession, path: str, name: str) -> str | None:
    """The note of this name in the newest version."""
    store = _Store(spark, path)
    known = _versions(store)
    entries = _load(store, known[-1])[1] if known else []
    return next((e.partition("=")[2] for e in entries if e.startswith(f"{_NOTE}{name}=")), None)


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version, or a given one that has not been cleared yet."""
    store = _Store(spark, path)
    known = _versions(store)
    if not known:
        raise FileNotFoundError(f"nothing is published at {path}")
    schema, entries = _load(store, version or known[-1])
    entries = [e for e in entries if not e.startswith(_NOTE)]
    if not entries:
        return spark.createDataFrame([], schema)
    typed = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
    reader = spark.read.schema(typed).option("basePath", f"{store.root}/data")
    return reader.parquet(*[f"{store.root}/data/{e}" for e in entries]).select(*[F.col(f"`{f.name}`") for f in schema.fields])


def vacuum(spark: SparkSession, path: str, keep: int = 2, hours: float = 24) -> int:
    """Delete all but the last ``keep`` versions and the data that none of these lists; returns the folders deleted.

    Folders younger than ``hours`` stay, as a write that is not published yet may own them.
    """
    store = _Store(spark, path)
    known = _versions(store)
    kept = known[-keep:]
    for version in known[:-keep]:
        store.fs.delete(store.path(f"versions/{version:010d}"), False)
    listed = {e for v in kept for e in _load(store, v)[1]}
    limit = (time.time() - hours * 3600) * 1000
    gone = 0
    for load in store.names("data"):
        inner = [f"{load}/{n}" for n in store.names(f"data/{load}") if "=" in n] or [load]
        for entry in inner:
            at = store.path(f"data/{entry}")
            if entry not in listed and load not in listed and store.fs.getFileStatus(at).getModificationTime() <= limit:
                gone += store.fs.delete(at, True)
    return gone
