"""Staged tables with a layout, and the three facts brought together by one aggregation."""

import pytest
from pyspark.sql import functions as F

from binledger.operators.joins import FEW_LOOKED_UP, looked_up
from binledger.plans import container as job
from binledger.registry import container as registry
from binledger.session import clear_stage, join_as_dealt, stage_bucketed
from binledger.sources.retail import LaidOutRetail, Retail


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_joins_and_groupings_by_the_layout_need_no_exchange(spark):
    left = spark.range(5000).withColumns({"k": F.col("id") % 97, "m": F.col("id") % 12})
    right = spark.range(120).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, b = stage_bucketed(left, "left", ["k"]), stage_bucketed(right, "right", ["k"])
        joined = a.join(b, "k").groupBy("k", "m").agg(F.sum("v").alias("v"))
        assert "Exchange" not in plan_of(joined)
        bare = left.join(right, "k").groupBy("k", "m").agg(F.sum("v").alias("v"))
        assert plan_of(bare).count("Exchange") == 2 and rows(joined) == rows(bare)
        # written as it lies after a join on the key
        again = stage_bucketed(left.join(right, "k"), "again", ["k"], arranged=True)
        assert "Exchange" not in plan_of(again.groupBy("k").count()) and again.count() == 5000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith("staged_")]
    assert names and clear_stage(spark) >= 3
    assert not [t.name for t in spark.catalog.listTables() if t.name in names]


@pytest.fixture(scope="module")
def laid_out(spark, data):
    return LaidOutRetail(spark, data)


def test_the_laid_out_tables_hold_the_same_rows(spark, data, laid_out):
    plain = Retail(spark, data)
    for name in ("invoice_detail", "service_detail", "charge_rates", "dim_container_grp", "dim_acct"):
        a, b = getattr(plain, name), getattr(laid_out, name)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name
    both = laid_out.invoice_detail.join(laid_out.dim_container_grp, "container_grp_sk").groupBy("container_grp_sk").count()
    assert "hashpartitioning(container_grp_sk" not in plan_of(both) and "hashpartitioning(l_orderkey" not in plan_of(both)


@pytest.mark.parametrize("case", ["as it is", "several rates of a grain", "no invoices", "no services", "no rates"])
def test_three_facts_equal_two_full_joins(spark, laid_out, case):
    r = laid_out
    some = F.col("container_grp_sk") % 7 < 3
    invoice, service = r.invoice_detail.where(some), r.service_detail.where(F.col("container_grp_sk") % 5 < 3)
    rate = registry.snapshot(r).where(F.col("month_dt") < 199604)
    if case == "several rates of a grain":
        rate = rate.unionByName(rate.where("month_dt < 199603").withColumn("erf_rate_pct", F.lit(9).cast("decimal(5,2)")))
    invoice = invoice.limit(0) if case == "no invoices" else invoice
    service = service.limit(0) if case == "no services" else service
    rate = rate.limit(0) if case == "no rates" else rate
    dims = (r.dim_acct, r.dim_container_grp)
    inv = job.invoice_monthly(
        invoice, *dims, r.dim_charge_cd, r.dim_corp_hier, r.dim_rate_hist, r.dim_contract_fee, after_month=199500)
    srv = job.service_monthly(service, *dims, r.dim_service_cd, r.dim_corp_hier, from_day=19950301)
    wanted = job.with_rates(job.invoice_and_service(inv, srv), rate)
    got = job.three_facts(
        invoice, service, rate, *dims, r.dim_charge_cd, r.dim_service_cd, r.dim_corp_hier, r.dim_rate_hist, r.dim_contract_fee,
        199500, 19950301)
    assert set(got.columns) == set(wanted.columns)
    left, right = rows(registry_plain(got)), rows(registry_plain(wanted))
    assert left == right and len(left) > 0


def registry_plain(df):
    from binledger.registry.base import plain

    return plain(df)


def test_the_final_table_needs_few_exchanges(spark, data):
    final = registry.final_table(Retail(spark, data))
    plan = plan_of(final)
    assert plan.count("Exchange hashpartitioning") <= 9


@pytest.mark.parametrize("case", ["several fee versions", "no invoices", "no services", "no rates"])
def test_three_facts_meet_per_container_and_unfold_last(spark, laid_out, case):
    r = laid_out
    some = F.col("container_grp_sk") % 7 < 3
    invoice, service = r.invoice_detail.where(some), r.service_detail.where(F.col("container_grp_sk") % 5 < 3)
    invoice = invoice.limit(0) if case == "no invoices" else invoice
    service = service.limit(0) if case == "no services" else service
    charges = r.charge_rates.limit(0) if case == "no rates" else r.charge_rates.where(F.col("close_date") < 19980101)
    # containers without a site on the invoices' side, which meet nothing
    cont = r.dim_container_grp.withColumn("site_nbr", F.when(F.col("container_grp_sk") % 11 > 0, F.col("site_nbr")))
    fees = r.dim_contract_fee
    if case == "several fee versions":
        fees = fees.unionByName(fees.withColumn("erf_rate_pct", F.lit(9).cast("decimal(5,2)")).withColumn("is_current", F.lit(0)))
    dims = (r.dim_acct, cont)
    snap = lambda *more: job.monthly_rate_snapshot(
        charges, cont, r.dim_acct, r.dim_corp_hier, fees, registry.FIRST_MONTH, registry.LAST_MONTH, *more)
    facts = lambda rate, *more: job.three_facts(
        invoice, service, rate, *dims, r.dim_charge_cd, r.dim_service_cd, r.dim_corp_hier, r.dim_rate_hist, fees, 199500, 19950301, *more)
    unfolded = facts(snap())
    flagged = unfolded.join(job.account_fee_flags(r.dim_acct_fee), ["div_nbr", "acct_nbr"], "left")
    folded = facts(snap(False, r.dim_acct_fee), r.dim_acct_fee)
    left, right = rows(registry_plain(folded)), rows(registry_plain(flagged))
    assert left == right and len(left) > 0
    plan = folded._jdf.queryExecution().optimizedPlan().toString()
    # nothing is joined or grouped behind the months
    assert "explode(sequence" in plan and "Join" not in plan[: plan.index("explode(sequence")] and "Aggregate" not in plan[: plan.index("explode(sequence")]


@pytest.fixture
def nothing_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_lookups_move_pairs_and_not_the_rows(spark, nothing_broadcast):
    join_as_dealt(spark)
    lines = spark.range(3000).select(
        F.when(F.col("id") % 50 > 0, F.col("id") % 211).alias("box"), F.when(F.col("id") % 60 > 0, F.col("id") % 7).alias("rate"), F.repeat(F.lit("x"), 9).alias("wide"))
    # a rate that comes twice, one that is missing and a NULL
    rates = spark.createDataFrame([(0, 5), (1, 6), (1, 7), (2, None), (4, 9), (5, 9), (6, 9), (None, 1)], "rate long, price int")
    laid = stage_bucketed(lines, "lines", ["box"])
    wanted = rows(lines.join(rates, "rate").where("box is not null"))
    for few in (0, 100):
        got = looked_up(laid, rates, "rate", "box", few=few)
        assert rows(got.where("box is not null")) == wanted
    narrow = looked_up(laid, rates, "rate", "box", few=0).groupBy("box", "rate").agg(F.max("wide"), F.sum("price"))
    exchanges = [line for line in plan_of(narrow).splitlines() if "Exchange" in line]
    # pairs and rates to each other, what was found back; the lines stay
    assert len(exchanges) == 3 and sum("REPARTITION_BY_NUM" in line for line in exchanges) == 1
    beside = looked_up(laid, rates, "rate", "box", lines.select("box", "rate").where("box is not null"), 0)
    assert rows(beside) == wanted


@pytest.mark.parametrize("few", [0, FEW_LOOKED_UP])
def test_facts_are_dealt_by_account_once(spark, data, few):
    plan = plan_of(registry.final_table(Retail(spark, data), few)).splitlines()
    keys = [line.split("hashpartitioning(")[1] for line in plan if "Exchange hashpartitioning" in line]
    by_account = [k for k in keys if k.startswith("div_nbr") and "acct_nbr" in k and "REPARTITION_BY_NUM" in k]
    # invoices with services and charges, and those of the containers and accounts that are not broadcast
    assert 2 <= len(by_account) <= 4
    # neither sums nor charges move by the month, the surrogate keys or the whole natural key
    assert not [k for k in keys if "site_nbr" in k or "month" in k or "revenue_period" in k or "corp_hier_sk" in k]


@pytest.mark.parametrize("few", [0, 10**6])
def test_three_facts_from_odd_lookups(spark, laid_out, few):
    r = laid_out
    join_as_dealt(spark)
    key = F.col("container_grp_sk")
    invoice = r.invoice_detail.where(key % 3 > 0).withColumn("rate_sk", F.when(key % 10 > 0, F.col("rate_sk")))
    service = r.service_detail.where(key % 5 < 3).withColumn("acct_sk", F.when(key % 9 > 0, F.col("acct_sk") + F.when(key % 8 == 0, 1).otherwise(0)))
    twice = lambda df, condition: df.unionByName(df.where(condition))
    rates = twice(r.dim_rate_hist.where("rate_sk % 6 > 0"), "rate_sk % 4 = 0")
    accounts = twice(r.dim_acct.where("acct_sk % 7 > 0"), "acct_sk % 5 = 0")
    fees = twice(r.dim_contract_fee, "contract_nbr = '1'").unionByName(
        r.dim_contract_fee.where("contract_nbr = '0'").withColumns({"erf_rate_pct": F.lit(None).cast("decimal(5,2)"), "is_frf_locked": F.lit(1)}))
    rate = registry.snapshot(r).where(F.col("month_dt") < 199604)
    inv = job.invoice_monthly(
        invoice, accounts, r.dim_container_grp, r.dim_charge_cd, r.dim_corp_hier, rates, fees, after_month=199500)
    srv = job.service_monthly(service, accounts, r.dim_container_grp, r.dim_service_cd, r.dim_corp_hier, from_day=19950301)
    wanted = job.with_rates(job.invoice_and_service(inv, srv), rate)
    got = job.three_facts(
        invoice, service, rate, accounts, r.dim_container_grp, r.dim_charge_cd, r.dim_service_cd, r.dim_corp_hier, rates, fees,
        199500, 19950301, few=few)
    left, right = rows(registry_plain(got)), rows(registry_plain(wanted))
    assert left == right and len(left) > 0
