"""Stage counts taken while a job runs."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from binledger.operators.audit import StageAudit, left_after
from binledger.operators.rows import funnel
from binledger.session import stage


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_of_stages_across_joins_and_groupings(spark):
    left = spark.range(1000).withColumn("k", F.col("id") % 10)
    right = spark.range(7).withColumnRenamed("id", "k")
    audit = StageAudit()
    joined = audit.watch(left, {"input": F.count(F.lit(1))}).join(right, "k")
    rules = {"even": F.col("id") % 2 == 0, "small": F.when(F.col("id") < 900, F.col("id") < 100)}
    joined = audit.watch(joined, {"joined": F.count(F.lit(1)), **left_after(rules)})
    grouped = joined.where(rules["even"] & rules["small"]).groupBy("k").agg(F.count("*").alias("n"))
    grouped = audit.watch(grouped, {"groups": F.count(F.lit(1)), **left_after({"of_ten": F.col("n") >= 10}, F.col("n"))})
    plan = plan_of(grouped)
    bare = left.join(right, "k").where(rules["even"] & rules["small"]).groupBy("k").agg(F.count("*").alias("n"))
    assert plan.count("Exchange") == plan_of(bare).count("Exchange") and plan.count("Range") == 2
    written = stage(grouped, "audited")
    assert audit.counts() == {"input": 1000, "joined": 700, "even": 400, "small": 40, "groups": 4, "of_ten": 40}
    assert [tuple(r) for r in audit.table(spark).orderBy("step_no").collect()][:2] == [(0, "input", 1000), (1, "joined", 700)]
    assert written.count() == 4
    # the same rules over the flat table, by the pass of its own
    flat = {r.step: r.rows_left for r in funnel(left.join(right, "k"), rules).collect()}
    assert flat == {"input": 700, "even": 400, "small": 40}


def test_empty_frames_and_repeated_names(spark):
    audit = StageAudit()
    none = spark.range(0).withColumn("n", F.lit(3))
    none = audit.watch(none, {"input": F.count(F.lit(1)), **left_after({"all": F.lit(True)}, F.col("n"))})
    with pytest.raises(ValueError):
        audit.watch(none, {"all": F.count(F.lit(1))})
    stage(none, "audited")
    assert audit.counts() == {"input": 0, "all": 0}


def test_takers_of_any_wave_count(spark):
    from binledger.plans import campaign

    base = "div_nbr string, acct_nbr string, treatment string, tenure_months double, date_signed date, revenue_annual decimal(18,2), "
    base += "total_yard_month double, future_revenue_per_bill double, revenue_per_bill double, active_1 int, rate_1 double, "
    rows = [("d", str(i), "PILOT", 20.0, None, Decimal(10), 1.0, None, 1.0, 1, 5.0, *[int(i == w) for w in range(5)]) for i in range(6)]
    panel = spark.createDataFrame(rows, base + ", ".join(f"wave_{w} int" for w in range(5)))
    out = campaign.campaign_summary(panel, [1], ["rate"], "rate")
    assert out.agg(F.sum("num_takers")).first()[0] == 5
    assert campaign.campaign_summary(panel, [1], ["rate"], "rate", ["wave_4"]).agg(F.sum("num_takers")).first()[0] == 1
    assert campaign.campaign_summary(panel, [1], ["rate"], "rate", []).agg(F.sum("num_takers")).first()[0] == 0
