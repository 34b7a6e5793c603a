"""The as-of join of many versions and the Bloom pre-filter."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from binledger.operators import joins

OPEN = dt.date(9999, 12, 31)


def brute(left, dim, how):
    out = []
    for k, at in left:
        met = [(k, at, e, d, v) for kk, e, d, v in dim if k is not None and kk == k and None not in (at, e, d) and e <= at <= d]
        out += met or ([(k, at, None, None, None)] if how == "left" else [])
    return sorted(out, key=str)


def day(n):
    return dt.date(2000, 1, 1) + dt.timedelta(n)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("few", [0, 3, joins.FEW_VERSIONS])
def test_asof_equals_the_plain_range_join(spark, few, how):
    draw = random.Random(few)
    dim = []
    for k in range(6):
        for _ in range([0, 1, 5, 40, 40, 40][k]):
            begin = draw.randint(0, 900)
            end = OPEN if draw.random() < 0.1 else day(begin + draw.choice([0, 1, 30, 700, -5]))
            dim.append((k, day(begin), end, draw.randint(1, 99)))
    dim += [(4, None, day(3), 1), (4, day(3), None, 2), (None, day(0), OPEN, 3)]
    left = [(draw.randint(0, 6), day(draw.randint(-50, 1500))) for _ in range(300)] + [(3, None), (None, day(5)), (5, OPEN)]
    a = spark.createDataFrame(left, "k int, at date")
    b = spark.createDataFrame(dim, "k int, eff_dt date, disc_dt date, v int")
    got = joins.asof_dim_join(a, b, ["k"], "at", how=how, few=few)
    assert got.columns == ["k", "at", "eff_dt", "disc_dt", "v"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(left, dim, how)


@pytest.mark.parametrize("kind", ["date", "timestamp", "int"])
def test_ten_thousand_versions_of_one_key_stay_linear(spark, kind):
    count = 10_000
    at = {"date": F.date_add(F.lit(dt.date(1990, 1, 1)), F.col("n")), "timestamp": F.timestamp_seconds(F.col("n") * 900),
          "int": F.col("n")}[kind]
    last = {"date": F.lit(OPEN), "timestamp": F.lit("9999-12-31").cast("timestamp"), "int": F.lit(99999999)}[kind]
    n = spark.range(count).select(F.col("id").cast("int").alias("n"))
    dim = n.select(F.lit("hot").alias("k"), at.alias("eff"), F.when(F.col("n") == count - 1, last).otherwise(at).alias("disc"), "n")
    probes = spark.range(30_000).select(F.lit("hot").alias("k"), (F.col("id") % count).cast("int").alias("n")).select("k", at.alias("at"))
    here, there = joins.binned_sides(probes, dim, ["k"], "at", "eff", "disc")
    met = here.join(there, (here["k"] == there["__d_k"]) & (here["__bin"] == there["__d_bin"])).count()
    assert there.count() <= 5 * count and met <= 5 * 30_000
    assert joins.asof_dim_join(probes, dim, ["k"], "at", "eff", "disc").where("n is not null").count() == 30_000


def test_bloom_filter_drops_rows_before_the_shuffle_and_none_that_is_listed(spark):
    wanted = spark.range(0, 40_000, 4).select(F.col("id").alias("k"), F.lit("x").alias("s"))
    wanted = wanted.unionByName(spark.sql("select cast(null as bigint) k, 'x' s"))
    many = spark.range(200_000).select((F.col("id") % 100_000).alias("k"), F.lit("x").alias("s"), "id")
    many = many.unionByName(spark.sql("select cast(null as bigint) k, 'x' s, -1L id"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        passed = joins.bloom_filtered(many, wanted, ["k", "s"])
        listed = joins.keep_listed(many, wanted, ["k", "s"])
        kept = joins.keep_listed_of_many(many, wanted, ["k", "s"])
        plan = kept._jdf.queryExecution().executedPlan().toString()
        # from the bottom: the filter's join lies below the exchange of the large side
        large = plan[: plan.index("BroadcastExchange")]
        assert large.index("SortMergeJoin") < large.index("Exchange hashpartitioning") < large.index("BroadcastHashJoin")
        assert kept.columns == many.columns
        assert sorted(r.id for r in kept.collect()) == sorted(r.id for r in listed.collect())
        assert 20_000 <= passed.count() <= 20_000 + 0.03 * 180_000
        # a filter that is bounded too tightly lets rows pass, and loses none
        tight = joins.keep_listed_of_many(many, wanted, ["k", "s"], most_bytes=1)
        assert tight.count() == 20_000
        assert joins.keep_listed_of_many(many, wanted.limit(0), ["k", "s"]).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_key_fallback_keeps_all_columns_of_the_rows(spark):
    left = spark.createDataFrame([("a", "mine", 1), ("b", "own", 2), (None, "none", 3)], "k string, note string, acct int")
    lookup = spark.createDataFrame([("a", "9", "x"), ("a", "8", "y"), ("c", "7", "z")], "lk string, acct string, note string")
    got = joins.key_fallback_join(left, lookup, "k", "lk", F.concat(F.lit("t"), "acct"), "out")
    assert got.columns == ["k", "note", "acct", "out"]
    assert sorted(map(tuple, got.collect()), key=str) == [("a", "mine", 1, "t8"), ("b", "own", 2, "b"), (None, "none", 3, None)]
    same = joins.key_fallback_join(left, lookup.withColumnRenamed("lk", "k"), "k", "k", F.col("acct"), "k")
    assert same.columns == ["k", "note", "acct"] and {r.k for r in same.collect()} == {"8", "b", None}
