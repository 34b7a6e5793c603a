"""Versions that appear in one step, and answers from footers."""

import pytest
from pyspark.sql import functions as F

from binledger.sources import footers, published


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, data):
    return spark.createDataFrame(data, "month_dt int, v int").repartition(4)


def failing(spark, data):
    """Fails in the task of the largest value, when others may be done."""
    return frame(spark, data).withColumn("v", F.when(F.col("v") > 900, F.raise_error(F.lit("stop"))).otherwise(F.col("v")))


def test_a_failed_write_leaves_the_old_state(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, path)
    assert published.publish_months(frame(spark, [(1, 10), (1, 11), (2, 20)]), path) == 1
    before = published.read_published(spark, path)
    for write in (published.publish_months, published.publish_append):
        with pytest.raises(Exception, match="stop"):
            write(failing(spark, [(1, 12), (3, 30), (3, 999)]), path)
        assert rows(published.read_published(spark, path)) == [(1, 10), (1, 11), (2, 20)]
    assert published.publish_months(frame(spark, [(2, 21), (3, 30)]), path) == 2
    assert rows(published.read_published(spark, path)) == [(1, 10), (1, 11), (2, 21), (3, 30)]
    # who reads the older version goes on reading it
    assert rows(before) == rows(published.read_published(spark, path, 1)) == [(1, 10), (1, 11), (2, 20)]
    assert published.publish_append(frame(spark, [(1, 13)]), path, month="month_dt") == 3
    assert rows(published.read_published(spark, path)) == [(1, 10), (1, 11), (1, 13), (2, 21), (3, 30)]


def test_vacuum_deletes_what_no_kept_version_lists(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in range(4):
        published.publish_months(frame(spark, [(1, v), (2, v)] if v < 3 else [(2, v)]), path)
    with pytest.raises(Exception, match="stop"):
        published.publish_append(failing(spark, [(1, 999)]), path)
    assert published.vacuum(spark, path, keep=1) == 0  # too young
    assert published.vacuum(spark, path, keep=1, hours=-1) >= 5
    assert rows(published.read_published(spark, path)) == [(1, 2), (2, 3)]
    assert published.publish_append(frame(spark, [(5, 5)]), path, month="month_dt") == 5


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    published.publish_append(frame(spark, [(1, 1)]), path)
    known, seen = published._versions, []

    def late(store):
        found = known(store)
        if not seen:  # another writer publishes between this one's look and its own rename
            seen.append(found)
            published.publish_append(frame(spark, [(2, 2)]), path)
        return found

    data = frame(spark, [(3, 3)])
    store = published._Store(spark, path)
    added = published._write(store, data, None)
    monkeypatch.setattr(published, "_versions", late)
    assert published._commit(store, data.schema, lambda entries: entries + added) == 3
    assert rows(published.read_published(spark, path)) == [(1, 1), (2, 2), (3, 3)]


def test_appends_are_aligned_and_empty_tables_read(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish_append(frame(spark, []), path)
    assert rows(published.read_published(spark, path)) == []
    published.publish_append(spark.createDataFrame([("7", "x")], "v string, other string"), path)
    assert rows(published.read_published(spark, path)) == [(None, 7)]


def test_extremes_come_from_the_footers(spark, data, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 2.5, None), (None, -1.0, None), (7, 3.0, None)], "a int, b double, c long").coalesce(1).write.parquet(path)
    out = footers.extremes(spark, path, ["a", "b"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [" in plan and "MIN(a)" in plan and "FileScan" not in plan
    assert sorted(tuple(r) for r in out.collect()) == [("a", 3, 2, 1.0, 7.0), ("b", 3, 3, -1.0, 3.0)]
    with pytest.raises(Exception, match="No min/max"):
        footers.extremes(spark, path, ["c"]).collect()
    # other reads keep the first version of the source
    assert "FileScan parquet" in spark.read.parquet(path)._jdf.queryExecution().executedPlan().toString()


def test_late_lines_merge_to_the_whole_and_batches_count_once(spark, tmp_path):
    from binledger.plans.incremental import late_merger, merge_late

    def lines(data):
        return spark.createDataFrame(data, "k string, month_dt int, v long")

    batches = [[("a", 1, 5), ("a", 1, 6), ("b", 2, 7)], [("a", 2, 1)], [], [("a", 1, 1), ("c", 3, 2), (None, 3, 4), (None, 3, None)]]
    path = str(tmp_path / "t")
    merge = late_merger(path, ["k"], ["v"])
    for n, some in enumerate(batches):
        merge(lines(some), n)
        merge(lines(some), n)  # delivered again
        whole = lines([x for b in batches[: n + 1] for x in b]).groupBy("k", "month_dt").agg(F.sum("v").alias("v"))
        got = published.read_published(spark, path).select("k", "month_dt", "v")
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
    assert not merge_late(lines(batches[1]), path, ["k"], ["v"], batch=1)
    # months that no late line touches keep their files
    before = published.read_published(spark, path).where("month_dt = 2").inputFiles()
    merge(lines([("z", 9, 1)]), 9)
    assert set(before) <= set(published.read_published(spark, path).inputFiles())
