import random

import pytest
from pyspark.sql import functions as F

from binledger.operators import grouping, joins, profile, ranking, rows, selection
from binledger.plans import pricing
from binledger.sources import files


def skewed(spark, n=900):
    """A third of the rows in one group, many equal scores, a group of one row and a NULL group."""
    rnd = random.Random(5)
    data = []
    for i in range(n):
        group = "hot" if i % 3 == 0 else f"g{rnd.randrange(20)}"
        data.append((i, group, rnd.randrange(10) / 2))
    data += [(n, "single", 1.0), (n + 1, None, 2.0), (n + 2, None, 1.0)]
    return spark.createDataFrame(data, "id long, grp string, score double"), data


def order():
    return [F.col("score").asc(), F.col("id").asc()]


def by_group(data):
    groups = {}
    for row in sorted(data, key=lambda r: (r[2], r[0])):
        groups.setdefault(row[1], []).append(row[0])
    return groups


def test_positions_match_a_sort(spark):
    df, data = skewed(spark)
    got = {r.id: (r.position, r.n) for r in ranking.with_position(df, order(), ["grp"], size="n").collect()}
    want = {i: (p, len(ids)) for ids in by_group(data).values() for p, i in enumerate(ids)}
    assert got == want
    ids = [r[0] for r in sorted(data, key=lambda r: (r[2], r[0]))]
    assert {r.id: r.row_id for r in ranking.row_ids(df, order()).collect()} == {i: p + 1 for p, i in enumerate(ids)}


def test_percentiles_and_tiles(spark):
    df, data = skewed(spark)
    pct = {r.id: r.pct_rank for r in ranking.percentile_rank(df, order(), ["grp"]).collect()}
    tile = {r.id: r.tile for r in ranking.ntile(df, 5, order(), ["grp"]).collect()}
    for ids in by_group(data).values():
        m = len(ids) - 1
        small, extra = divmod(len(ids), 5)
        sizes = [small + (t < extra) for t in range(5)]
        tiles = [t + 1 for t in range(5) for _ in range(sizes[t])]
        for p, i in enumerate(ids):
            assert tile[i] == tiles[p]
            want = 0.0 if m == 0 else 100 * p / m
            assert abs(pct[i] - want) <= 0.005 + 1e-9


def test_group_index_is_a_dense_rank(spark):
    df, data = skewed(spark)
    got = {r.id: r.group_index for r in ranking.group_index(df, ["score"], ["grp"]).collect()}
    scores = {}
    for i, g, s in data:
        scores.setdefault(g, set()).add(s)
    assert got == {i: sorted(scores[g]).index(s) + 1 for i, g, s in data}


def test_quantiles_match_interpolation(spark):
    df, data = skewed(spark)
    got = {(r.column_name, r.prob): r.value for r in selection.quantiles(df, ["score", "id"], [0.0, 0.25, 0.5, 1.0]).collect()}
    for name, at in (("score", 2), ("id", 0)):
        ordered = sorted(r[at] for r in data)
        for p in (0.0, 0.25, 0.5, 1.0):
            k = p * (len(ordered) - 1)
            lo, hi = ordered[int(k)], ordered[min(int(k) + (k % 1 > 0), len(ordered) - 1)]
            assert abs(got[(name, p)] - (lo + (hi - lo) * (k % 1))) < 1e-9


def test_group_size_counts_null_keys(spark):
    df, data = skewed(spark)
    got = {r.id: r.n for r in grouping.group_size(df, ["grp"], "n").collect()}
    assert len(got) == len(data) and got[901] == 2 and got[900] == 1 and got[0] == 300


def test_accept_reject_keeps_every_row(spark):
    df, data = skewed(spark)
    marked = rows.accept_reject(df, {"low": F.col("score") < 1, "no group": F.col("grp").isNull()})
    kept, out = rows.accepted(marked), rows.rejected(marked)
    assert kept.count() + out.count() == len(data)
    assert {r.reject_reason for r in out.collect()} == {"low", "no group"}


def test_funnel_never_grows_and_unknown_fails(spark):
    df, data = skewed(spark)
    got = [r.rows_left for r in rows.funnel(df, {"grp": F.col("grp") != "hot", "score": F.col("score") > 1}).orderBy("step_no").collect()]
    assert got[0] == len(data) and got[1] == len(data) - 300 - 2 and got[2] <= got[1]


def test_full_join_keeps_both_sides(spark):
    left = spark.createDataFrame([(1, 5, 10), (2, None, 20)], "k int, both int, l int")
    right = spark.createDataFrame([(2, 7, 30), (3, 8, 40)], "k int, both int, r int")
    got = {r.k: (r.both, r.l, r.r) for r in joins.full_join_coalesce(left, right, ["k"], ["both"], default_zero=["l", "r"]).collect()}
    assert got == {1: (5, 10, 0), 2: (7, 20, 30), 3: (8, 0, 40)}


def test_code_enrich_dedups_and_reports_unmatched(spark):
    codes = spark.createDataFrame([("STT", " A", "a b", "A"), ("STT", "A", "zz", "A"), ("STT", "B", "b", "I")], "domain string, code string, description string, status string")
    table = joins.code_domain(codes, "STT", "stop", "stop_desc", [("cfr", "com format")])
    df = spark.createDataFrame([(1, "A"), (2, "B"), (3, "cfr")], "id int, stop string")
    out = joins.code_enrich(df, {"stop": table})
    assert {r.id: r.stop_desc for r in out.collect()} == {1: "ab", 2: None, 3: "com format"}
    assert [r.id for r in joins.unmatched_codes(out, ["stop_desc"]).collect()] == [2]


def test_small_sides_only_are_broadcast(spark):
    plan = lambda d: spark.range(10_000_000).join(d, "id")._jdf.queryExecution().executedPlan().toString()
    small, large = spark.range(1000).groupBy("id").count(), spark.range(600_000).withColumn("x", F.rand())
    kept = plan(joins.if_small(small))
    assert "BroadcastHashJoin" in kept and "SinglePartition" not in kept and "HashAggregate" not in kept
    assert "BroadcastHashJoin" not in plan(joins.if_small(large))


def test_subtotals_equal_their_details(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 7), ("b", 3, 1)], "k string, id int, v int")
    out = grouping.detail_with_subtotals(df, ["k"], ["v"]).collect()
    assert {r.k: r.v for r in out if r.row_kind == "subtotal"} == {"a": 12, "b": 1} and len(out) == 5


def test_crosstab_totals_add_up(spark):
    df = spark.createDataFrame([("r1", "x"), ("r1", None), (None, "y"), ("r2", "y")], "r string, c string")
    out = {r.r: r.asDict() for r in grouping.crosstab_totals(df, "r", "c", ["x", "y"]).collect()}
    for row in out.values():
        assert row["Grand Total"] == row["x"] + row["y"] + row["(blank)"] + row["(other)"]
    unlisted = spark.createDataFrame([("r1", "x"), ("r1", "zz")], "r string, c string")
    (r1,) = [r.asDict() for r in grouping.crosstab_totals(unlisted, "r", "c", ["x", "y"]).collect() if r.r == "r1"]
    assert (r1["x"], r1["y"], r1["(other)"], r1["Grand Total"]) == (1, 0, 1, 2)
    assert out["Grand Total"]["Grand Total"] == 4 and out["(blank)"]["y"] == 1


def test_strict_sum_needs_every_value(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "k string, v int")
    assert {r.k: r.s for r in df.groupBy("k").agg(grouping.strict_sum(F.col("v")).alias("s")).collect()} == {"a": None, "b": 2}


def test_mean_impute_and_null_profile(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double")
    assert sorted(r.x for r in profile.mean_impute(df, "x").collect()) == [1.0, 1.5, 2.0]
    assert [tuple(r) for r in profile.null_profile(df, ["x"]).collect()] == [("x", 3, 1)]


def test_asof_join_fans_out_only_on_overlap(spark):
    left = spark.createDataFrame([(1, 5), (1, 50), (2, 5)], "k int, at int")
    dim = spark.createDataFrame([(1, 0, 9, "old"), (1, 10, 99, "new")], "k int, eff_dt int, disc_dt int, v string")
    got = sorted((r.k, r.at, r.v) for r in joins.asof_dim_join(left, dim, ["k"], "at").collect())
    assert got == [(1, 5, "old"), (1, 50, "new"), (2, 5, None)]


def test_accounts_without_a_site_are_kept(spark):
    df = spark.createDataFrame([("a", None), ("b", "1"), ("b", "2"), ("c", "1"), ("c", None), ("c", "2")], "acct string, site string")
    assert {r.acct for r in grouping.at_most_sites(df, ["acct"], "site", 2).collect()} == {"a", "b"}


def test_a_repeated_month_fails(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 9)], "k string, m int, v int")
    assert grouping.month_columns(df, ["k"], "m", [1, 2], {"v": "v"}).first().asDict() == {"k": "a", "active_1": 1, "v_1": 5, "active_2": 1, "v_2": 9}
    with pytest.raises(Exception, match="two rows"):
        grouping.month_columns(df.unionAll(df), ["k"], "m", [1, 2], {"v": "v"}).collect()


def test_lookups_never_multiply_rows(spark):
    df = spark.createDataFrame([("x",), ("y",)], "raw string")
    twice = spark.createDataFrame([("x", "2"), ("x", "1")], "long_key string, short string")
    got = joins.key_fallback_join(df, twice, "raw", "long_key", F.col("short"), "out").collect()
    assert sorted((r.raw, r.out) for r in got) == [("x", "1"), ("y", "y")]
    lines = spark.createDataFrame([("residential", 1, 10.0, 11.0), ("commercial", 1, 10.0, 11.0)], "target string, acct int, charge_rate double, new_rate double")
    tested = spark.createDataFrame([(1, 0.1), (1, 0.2)], "acct int, uplift double")
    got = {r.target: r.new_rate for r in pricing.uplift_apply(lines, tested, ["acct"]).collect()}
    assert abs(got["residential"] - 13.0) < 1e-9 and got["commercial"] == 11.0


def test_csv_keeps_line_breaks_and_reports_bad_lines(spark, tmp_path):
    path = str(tmp_path / "texts")
    files.write_csv(spark.createDataFrame([(1, "two\nlines"), (2, 'a "quote", b')], "k int, v string"), path)
    assert sorted((r.k, r.v) for r in files.read_csv(spark, path, "k int, v string").collect()) == [(1, "two\nlines"), (2, 'a "quote", b')]
    (tmp_path / "bad.csv").write_text("k,v\n1,a\nabc,b\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        files.read_csv(spark, str(tmp_path / "bad.csv"), "k int, v string").collect()
    got = files.read_csv(spark, str(tmp_path / "bad.csv"), "k int, v string", bad_lines="line").collect()
    assert [(r.k, r.line) for r in got] == [(1, None), (None, "abc,b")]


def test_csv_null_marker_and_no_header(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1,NA\nNA,b\n")
    got = files.read_csv(spark, str(tmp_path / "x.csv"), "k int, v string", header=False, null_marker="NA").collect()
    assert [(r.k, r.v) for r in got] == [(1, None), (None, "b")]


def test_partitioned_sink_writes_few_files(spark, tmp_path):
    rows = spark.range(0, 400, 1, 16).select((F.col("id") % 5).alias("area"), F.col("id").alias("v"))
    files.write_csv(rows, str(tmp_path / "areas"), ["area"])
    assert len(list((tmp_path / "areas").glob("area=*/part-*.csv"))) <= 10
