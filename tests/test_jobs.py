import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from binledger.functions.labels import LADDER_NEW_MARKETS
from binledger.plans import campaign, container, engagement, pricing
from binledger.sources.files import read_status_folders, with_file_columns
from binledger.sources.schemas import schema_of
from binledger.sources.tables import align_to_schema, append_aligned, overwrite_months
from binledger.streaming.intake import append_new_files, read_dropped

OPEN = dt.date(9999, 12, 31)


def snapshot_tables(spark, charges, start=dt.date(2015, 1, 1), close=OPEN, opened=dt.date(2015, 1, 1), acct_close=OPEN):
    rates = spark.createDataFrame(
        [("001", "0000001", "00001", "1", code, "R", "F", "T1", Decimal(rate), eff, cld, "0", "y", None) for code, rate, eff, cld in charges],
        schema_of("charge_rates"))
    cont = spark.createDataFrame(
        [(1, "001", "0000001", "00001", "1", 3, 4, "FL", 0, start, close, "0", "0", "10", "P", "10", 12, 1, 1, "WEEK", 1)], schema_of("dim_container_grp"))
    acct = spark.createDataFrame([(1, "001", "0000001", opened, acct_close, 0, 1)], schema_of("dim_acct"))
    hier = spark.createDataFrame([(1, "R", "A1", "AREA", "4001", "D", "BU1", "desc", "001", "DIV", "10", "Commercial", 1)], schema_of("dim_corp_hier"))
    fees = spark.createDataFrame([], schema_of("dim_contract_fee"))
    out = container.monthly_rate_snapshot(rates, cont, acct, hier, fees, dt.date(2016, 1, 1), dt.date(2016, 4, 1))
    return {r.month_dt: r for r in out.collect()}


def test_rate_snapshot_month_bounds(spark):
    got = snapshot_tables(spark, [("BCR", "10.00", 20160201, 20160301), ("BCS", "2.00", 20150101, 0)])
    assert sorted(got) == [201601, 201602, 201603, 201604]
    # a charge starting on the first counts in that month; one ending on the first does not
    assert [got[m].bcr_rt for m in sorted(got)] == [0, 10, 0, 0]
    assert [got[m].bcs_rt for m in sorted(got)] == [2, 2, 2, 2]
    assert got[201601].bcr_active_cont_eom == 0 and got[201602].bcr_active_cont_bom == 3
    # closing on the first of March, the charge still counts at the end of February and is lost in no month
    assert got[201602].bcr_active_cont_eom == 3 and got[201602].bcr_new_cnt == 3
    assert all(r.bcr_lost_cnt == 0 for r in got.values())


def test_rate_snapshot_open_and_close_in_the_month(spark):
    got = snapshot_tables(spark, [("BSP", "5.00", 20160115, 20160220)], start=dt.date(2016, 1, 10), close=dt.date(2016, 2, 15))
    assert sorted(got) == [201601, 201602]
    jan, feb = got[201601], got[201602]
    assert (jan.open_container, jan.bcr_rt, jan.bcr_new_cnt, jan.bcr_active_cont_eom) == (1, 0, 0, 3)
    assert (feb.closed_container, feb.bcr_rt, feb.bcr_lost_cnt, feb.bcr_active_cont_eom) == (1, 5, 3, 0)


def test_invalid_validity_is_left_out(spark):
    assert snapshot_tables(spark, [("BCR", "1.00", 20160301, 20160201)]) == {}
    assert snapshot_tables(spark, [("BCR", "1.00", 20160231, 0)]) == {}


def test_every_account_has_one_treatment(spark):
    accounts = spark.range(2000).select(F.lpad(F.col("id").cast("string"), 7, "0").alias("acct_nbr"), F.lit("001").alias("div_nbr"))
    out = campaign.assign_treatment(accounts, "salt").groupBy("treatment").count().collect()
    counts = {r.treatment: r["count"] for r in out}
    assert sum(counts.values()) == 2000 and set(counts) == {"HO", "A11", "A12", "A21", "A22"}
    assert 300 < counts["HO"] < 500
    again = campaign.assign_treatment(accounts, "salt").groupBy("treatment").count().collect()
    assert {r.treatment: r["count"] for r in again} == counts


def test_price_ladder_rounds_each_step(spark):
    accounts = spark.createDataFrame([("A11", Decimal("720.00")), ("A21", Decimal("540.00")), ("HO", Decimal("99.00"))], "treatment string, base_revenue decimal(18,2)")
    got = {r.treatment: (r.year_1, r.year_2, r.year_3) for r in campaign.price_ladder(accounts).collect()}
    assert got == {"A11": (60, Decimal("62.40"), Decimal("64.90")), "A21": (45, Decimal("49.50"), Decimal("54.45")), "HO": (0, None, None)}


def test_itemised_ladder_one_unpriced_line_leaves_none(spark):
    ddl = "div_nbr string, acct_nbr string, treatment string, rcf int, charge_code string, charge_rate decimal(18,2)"
    rows = [("1", "a", "A11", 12, "BCR", Decimal("10.00")), ("1", "a", "A11", 12, "DEL", Decimal("5.00")), ("1", "a", "A11", 12, "BCR", Decimal("0.00")),
            ("1", "h", "HO", 4, "DEL", Decimal("6.00")), ("1", "i", "HO", 4, "BCR", Decimal("6.00")), ("1", "i", "HO", 4, "DEL", Decimal("6.00"))]
    got = {r.acct_nbr: (r.year_1, r.year_2, r.year_3) for r in campaign.price_ladder_itemised(spark.createDataFrame(rows, ddl), LADDER_NEW_MARKETS).collect()}
    assert got["a"] == (15.0, 15.6, 16.24) and got["h"] == (2.0, 2.0, 2.0) and got["i"] == (4.0, None, None)


def test_container_revenue_counts_equal_rates(spark):
    charges = spark.createDataFrame(
        [("1", "a", "s", "g", "BCR", "R", m, "T", Decimal(r), 20160101, 0, "0", "Y", None) for m, r in (("Q", "2.00"), ("Q", "2.00"), ("F", "2.00"), ("F", "3.00"))],
        schema_of("charge_rates"))
    cont = spark.createDataFrame([(1, "1", "a", "s", "g", 4, 4, "FL", 0, dt.date(2015, 1, 1), OPEN, "0", "0", "10", "P", "10", 12, 1, 1, "WEEK", 1)], schema_of("dim_container_grp"))
    row = campaign.container_revenue(charges, cont, 20160701).collect()[0]
    assert (row.dup_cc, row.revenue_per_bill, row.revenue_annual) == (3, Decimal("21.00"), Decimal("252.00"))


def test_waves_newest_signature_and_send_dates(spark):
    panel = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    takers = spark.createDataFrame([(1, 1, dt.date(2016, 7, 22)), (1, 3, dt.date(2016, 10, 6))], "id int, wave int, date_signed date")
    declined = spark.createDataFrame([(2,), (2,)], "id int")
    barred = spark.createDataFrame([(2, 2), (3, 3)], "id int, wave int")
    days = {1: dt.date(2016, 7, 21), 2: dt.date(2016, 8, 31), 3: dt.date(2016, 10, 5)}
    got = {r.id: r for r in campaign.merge_waves(panel, takers, declined, barred, days, "id").collect()}
    assert len(got) == 3 and got[1].date_signed == dt.date(2016, 10, 6) and (got[1].wave_1, got[1].wave_2, got[1].wave_3) == (1, 0, 1)
    assert (got[2].declined, got[2].wave_2_dt, got[2].wave_3_dt) == (1, None, None)
    assert (got[3].wave_2_dt, got[3].wave_3_dt) == (days[2], None)


def test_engagement_positive_row_wins_and_opt_out_splits(spark):
    rows = [("9", "opened"), ("9", "not_opened"), ("9", "not_clicked"), ("9", "opt_out"), ("8", "not_opened"), (None, "opened")]
    lists = spark.createDataFrame([(a, s, "Y", "N") for a, s in rows], "account string, status string, recycle string, solid_waste string")
    got = sorted((r.acct_new, r.opt_out or 0, r.open, r.click) for r in engagement.consolidate(lists).collect())
    assert got == [("8", 0, 0, None), ("9", 0, 1, 0), ("9", 1, None, None)]


def test_price_dates_cross_the_year():
    d = pricing.PriceDates(dt.date(2016, 11, 1))
    assert (d.commercial, d.residential, d.review_pattern, d.year_start) == (dt.date(2017, 1, 1), dt.date(2017, 3, 1), "11/__/2016", "20160101")


def test_uplift_adds_to_the_increase(spark):
    upload = spark.createDataFrame([("001", 5, 10.0, 11.0), ("001", 6, 10.0, 11.0)], "comp string, acct long, charge_rate double, new_rate double")
    tags = pricing.uplift_tags(spark.createDataFrame([("x_1_5", 0.05)], "account_tag string, uplift double"))
    got = {r.acct: round(r.new_rate, 6) for r in pricing.uplift_apply(upload, tags).collect()}
    assert got == {5: 11.5, 6: 11.0}


def test_dropped_rows_add_up(spark):
    rows = spark.createDataFrame([(201601, "001", "4001"), (201602, "001", "4001"), (201601, "001", "4999")], "month_dt int, div_nbr string, cur_div_nbr string")
    fees = spark.createDataFrame([(201601, "001", Decimal(1), Decimal(1), 1, 1)], schema_of("dim_division_fee"))
    hier = spark.createDataFrame([(1, "R", "A1", "AREA", "4001", "D", "BU1", None, "001", "DIV", "10", "INDUSTRIAL", 1)], schema_of("dim_corp_hier"))
    got = {r.outcome: r.rows for r in container.dropped_rows(rows, fees, hier).collect()}
    assert got == {"kept": 1, "no division fee": 1, "outside hierarchy": 1}


def test_status_drops_carry_their_own_wave_date(spark, tmp_path):
    for status, name in (("opened", "campaign results wave 01 7.21.16.csv"), ("clicked", "campaign results wave 02 8.31.16.csv")):
        (tmp_path / status).mkdir()
        (tmp_path / status / name).write_text("Account,Recycle,SolidWaste\n123,Y,N\n")
    folders = {s: str(tmp_path / s) for s in ("opened", "clicked")}
    got = sorted((r.status, r.wave, r.wave_date) for r in read_status_folders(spark, folders, "account string, recycle string, solid_waste string").collect())
    assert got == [("clicked", "02", "8.31.16"), ("opened", "01", "7.21.16")]
    assert with_file_columns(spark.read.csv(folders["opened"])).select("file_name").distinct().count() == 1


def test_months_are_replaced_not_doubled(spark, tmp_path):
    path = str(tmp_path / "months")
    both = spark.createDataFrame([(201601, 1), (201602, 2)], "month_dt int, v int")
    overwrite_months(both, path)
    overwrite_months(spark.createDataFrame([(201602, 9)], "month_dt int, v int"), path)
    assert sorted((r.month_dt, r.v) for r in spark.read.parquet(path).collect()) == [(201601, 1), (201602, 9)]


def test_append_aligns_to_the_target(spark, tmp_path):
    target = schema_of("monthly_residential")
    rows = spark.createDataFrame([("x", 201601, "a", "1")], "extra string, month_dt int, acct_nbr string, div_nbr string")
    assert align_to_schema(rows, target).columns == target.fieldNames()
    append_aligned(rows, str(tmp_path / "t"), target)
    append_aligned(rows, str(tmp_path / "t"), target)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_file_intake_reads_each_file_once(spark, tmp_path):
    drop, target, mark = (str(tmp_path / n) for n in ("drop", "target", "mark"))
    (tmp_path / "drop").mkdir()
    head = ",".join(f"c{i}" for i in range(21))
    line = "1,28,5,1,{g},FL,1,4.00,1,N,BCR,R,F,10.00,10.4550,03/01/2017,3,64,N,,"
    (tmp_path / "drop" / "a.csv").write_text(f"{head}\n{line.format(g=1)}\n{line.format(g='')}\n")
    job = lambda lines: pricing.intake(lines, dt.datetime(2017, 3, 1))
    append_new_files(read_dropped(spark, drop, "price_intake"), job, target, mark)
    (tmp_path / "drop" / "b.csv").write_text(f"{head}\n{line.format(g=2)}\n")
    append_new_files(read_dropped(spark, drop, "price_intake"), job, target, mark)
    append_new_files(read_dropped(spark, drop, "price_intake"), job, target, mark)
    got = sorted((r.file_name, r.comp, r.cgrp, r.new_rate, r.unique_key) for r in spark.read.parquet(target).collect())
    assert got == [("a.csv", "028", 1, Decimal("10.46"), "028511BCR"), ("b.csv", "028", 2, Decimal("10.46"), "028512BCR")]


def test_retention_campaign_edges(spark):
    """Site limit, district, closed container and revenue rules on a handful of rows."""
    ddl = "div_nbr string, acct_nbr string, site_nbr string, district_cd string, pickup_lifts int, pickup_length int, pickup_unit string, close_dt date, revenue_per_bill decimal(18,2)"
    ok = Decimal("5.00")
    rows = [("1", "few", str(s), "10", 1, 1, "WEEK", OPEN, Decimal("5.00")) for s in range(3)]
    rows += [("1", "many", str(s), "10", 1, 1, "WEEK", OPEN, Decimal("5.00")) for s in range(4)]
    rows += [("1", "dist", "1", "91", 1, 1, "WEEK", OPEN, ok), ("1", "closed", "1", "10", 1, 1, "WEEK", dt.date(2016, 7, 7), ok),
             ("1", "free", "1", "10", 1, 1, "WEEK", OPEN, Decimal("0.00")), ("1", "idle", "1", "10", 0, 1, "WEEK", OPEN, ok),
             ("1", "unknown", "1", "10", 1, 1, "UNKNOWN", OPEN, ok)]
    kept = campaign.eligible_containers(spark.createDataFrame(rows, ddl), dt.date(2016, 7, 7)).select("acct_nbr").distinct().collect()
    assert [r.acct_nbr for r in kept] == ["few"]


def test_latest_charge_by_stamp_then_start(spark):
    at = lambda d: dt.datetime(2016, 1, d)
    rows = [("1", "a", "s", "g", "BCR", "R", "F", "T", Decimal(r), eff, 0, "0", "Y", at(d)) for r, eff, d in (("1.00", 20160101, 1), ("2.00", 20160101, 2), ("3.00", 20160201, 2))]
    got = campaign.latest_charges(spark.createDataFrame(rows, schema_of("charge_rates"))).collect()
    assert [r.charge_rate for r in got] == [Decimal("3.00")]


def test_rate_change_split_leaves_out_holdouts_and_codes(spark):
    rows = [("1", a, "s", "g", code, "R", "F", "T", Decimal(r), eff, cld, "0", "Y", None)
            for a, code, r, eff, cld in (("a", "BCR", "1.00", 20160101, 0), ("a", "BCR", "1.04", 20170101, 0), ("a", "DEL", "5.00", 20170101, 0), ("h", "BCR", "1.00", 20170101, 0), ("b", "BCR", "7.00", 20160101, 0))]
    takers = spark.createDataFrame([("1", "a", "A11"), ("1", "h", "HO"), ("1", "b", "A22")], "div_nbr string, acct_nbr string, treatment string")
    charges = spark.createDataFrame(rows, schema_of("charge_rates"))
    got = [(r.acct_nbr, r.charge_code, r.current_rate, r.future_rate, r.percent_increase) for r in campaign.rate_change_split(charges, takers, 20160820, campaign.KEPT_RATE_CODES).collect()]
    assert got == [("a", "BCR", Decimal("1.00"), Decimal("1.04"), Decimal("0.04"))]
    assert campaign.rate_change_split(charges, takers, 20160820).count() == 2


def test_broker_lines_are_numbered(spark):
    ddl = "broker_kind string, div_nbr string, acct_nbr string, site_nbr string, group_nbr string, charge_code string, charge_rate double, rec_rate double"
    rows = [("BRK", " 28", "9 ", "1", "2", "BCR", 10.0, 10.456), ("RTR", "28", "5", "1", "2", "BCR", 10.0, 11.0), ("X", "28", "1", "1", "1", "BCR", 1.0, 2.0)]
    got = sorted(tuple(r)[:8] for r in pricing.broker_upload(spark.createDataFrame(rows, ddl), pricing.PriceDates(dt.date(2017, 1, 1))).collect())
    assert got == [(1, "028", 9, "00001", 2, "BCR", 10.0, 10.46), (2, "028", 5, "00001", 2, "BCR", 10.0, 11.0)]


def test_only_fees_valid_on_the_day_count(spark):
    rows = [("1", "a", "FRF", 1, 1, dt.date(2015, 1, 1), dt.date(2016, 1, 1), 0), ("1", "a", "FRF", 0, 1, dt.date(2016, 1, 2), OPEN, 1),
            ("1", "b", "EVR", 1, 1, dt.date(2017, 1, 1), OPEN, 1)]
    got = campaign.fee_flags_wide(spark.createDataFrame(rows, schema_of("dim_acct_fee")), dt.date(2016, 7, 1)).collect()
    assert [(r.acct_nbr, r.FRF, r.EVR) for r in got] == [("a", 0, None)]


def test_closed_charges(spark):
    days = [("kept", 20160201, 20160301), ("early", 20151231, 20160301), ("open", 20160201, 0), ("late", 20160201, 20170101), ("edge", 20160101, 20160301)]
    rows = [("1", a, "s", "g", "BCR", "R", "F", "T", Decimal("1.00"), eff, cld, "0", "Y", None) for a, eff, cld in days]
    got = campaign.closed_charges(spark.createDataFrame(rows, schema_of("charge_rates")), 20160101, 20160601).collect()
    assert [r.acct_nbr for r in got] == ["kept"]


def test_contract_rows_are_one_per_site(spark):
    lines = spark.createDataFrame([("1", "a", "s1"), ("1", "a", "s1"), ("1", "a", "s2"), ("1", "b", "s1")], "div_nbr string, acct_nbr string, site_nbr string")
    contracts = spark.createDataFrame([("1", "a", "RM1")], "div_nbr string, acct_nbr string, contract_number string")
    assert sorted((r.site_nbr, r.rate_lines) for r in campaign.contract_rows(contracts, lines).collect()) == [("s1", 2), ("s2", 1)]


def test_staged_tables_can_be_deleted(spark):
    from binledger.session import clear_stage, stage

    kept = stage(spark.range(5), "gone")
    (file,) = {f.rpartition("/")[0] for f in kept.inputFiles()}
    assert clear_stage(spark) >= 1
    assert not __import__("os").path.exists(file.removeprefix("file://").removeprefix("file:"))


def test_account_profile_equals_its_parts(spark):
    ddl = """div_nbr string, acct_nbr string, site_nbr string, district_cd string, pickup_lifts int, pickup_length int, pickup_unit string,
     close_dt date, revenue_per_bill decimal(18,2), revenue_annual decimal(18,2), recurring_charge_freq int, container_cd string, container_size int"""
    rows = []
    for i in range(300):
        rows.append((f"{i % 3}", f"a{i % 37}", None if i % 11 == 0 else f"s{i % 5}", "91" if i % 13 == 0 else "10", i % 4, i % 3, "UNKNOWN" if i % 17 == 0 else "WEEK",
                     OPEN if i % 7 else dt.date(2016, 1, 1), Decimal(i % 9), Decimal(12 * (i % 9)), 12 if i % 2 else 4, ("FR", "YW", "FL", None)[i % 4], i % 8))
    revenue = spark.createDataFrame(rows, ddl)
    day = dt.date(2016, 7, 7)
    parts = campaign.eligible_containers(revenue, day)
    want = campaign.account_revenue(parts).join(campaign.waste_category(parts), campaign.ACCOUNT)
    columns = ["div_nbr", "acct_nbr", "lifts_per_week", "base_revenue", "base_revenue_per_bill", "base_rev_per_lift", "waste_category", "close_dt"]
    got = campaign.account_profile(revenue, day)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect())) and got.count() > 5
    largest = {r.acct_nbr: r.rcf for r in campaign.account_frequency(parts).collect()}
    assert {r.acct_nbr: r.m for r in got.groupBy("acct_nbr").agg(F.max("rcf").alias("m")).collect()} == largest


def test_uplift_on_summary_rows(spark):
    rows = spark.createDataFrame([("001", 7, 0.1, 10.0), ("001", 8, 0.1, 10.0), ("002", 7, None, 5.0)], "comp string, acct int, pct_of_pi double, charge_rate double")
    uplifts = spark.createDataFrame([("001", 7, 0.05), ("001", 7, 0.02)], "comp string, acct int, uplift double")
    got = {(r.comp, r.acct): r for r in pricing.uplift_summary(rows, uplifts, ["comp", "acct"]).collect()}
    assert len(got) == 3 and abs(got["001", 7].uplifted_rate - 11.5) < 1e-9 and got["001", 7].uplift == 0.05
    assert got["001", 8].uplifted_pct == 0.1 and got["002", 7].uplifted_rate is None


def test_uploads_under_contract(spark):
    line = ("001", "0000001", "00001", "1", "BCR", Decimal("10.00"), "R", "F", 20200101, dt.date(2020, 3, 1), "PILOT", "10", 12)
    names = "div_nbr string, acct_nbr string, site_nbr string, container_grp_nbr string, charge_code string, charge_rate decimal(18,2), " \
        "charge_type string, charge_method string, effective_date int, date_signed date, treatment string, rev_distrib_cd string, recurring_charge_freq int"
    lines = spark.createDataFrame([line, (*line[:2], "00002", *line[3:]), (*line[:3], "2", *line[4:11], None, 12), (*line[:3], "3", *line[4:12], None)], names)
    contracts = spark.createDataFrame([("001", "0000001", "00001", "RM2"), ("001", "0000001", "00001", "RM1")], "div_nbr string, acct_nbr string, site_nbr string, contract_number string")
    tax = lines.select(*campaign.CONTAINER, "charge_code", "charge_rate", "charge_type", "charge_method", F.lit("T").alias("tax_app_code"))
    got = campaign.rate_change_upload(lines, tax, contracts=contracts).collect()
    assert [(r.container_grp_nbr, r.contract_number) for r in got] == [("1", "RM1")]
    assert campaign.rate_change_upload(lines, tax).count() == 4


def test_rate_snapshot_unfolds_months_last(spark):
    """No grouping waits for the rows of all months: charges are grouped, months unfold from the groups."""
    rates, cont = spark.createDataFrame([], schema_of("charge_rates")), spark.createDataFrame([], schema_of("dim_container_grp"))
    acct, hier = spark.createDataFrame([], schema_of("dim_acct")), spark.createDataFrame([], schema_of("dim_corp_hier"))
    fees = spark.createDataFrame([], schema_of("dim_contract_fee"))
    out = container.monthly_rate_snapshot(rates, cont, acct, hier, fees, dt.date(2016, 1, 1), dt.date(2016, 4, 1))
    plan = out._jdf.queryExecution().analyzed().toString()
    assert 0 < plan.index("Generate explode(sequence(") < plan.index("Aggregate [")


def test_rate_snapshot_fee_versions_and_close_days(spark):
    """Months of one charge with a fee, with two, and without; a close day that is no calendar day."""
    rates = spark.createDataFrame(
        [("001", "0000001", "00001", "1", "BCR", "R", "F", "T1", Decimal("10.00"), 20160101, 20160431, "0", "y", None)], schema_of("charge_rates"))
    cont = spark.createDataFrame(
        [(1, "001", "0000001", "00001", "1", 3, 4, "FL", 0, dt.date(2015, 1, 1), OPEN, "0", "0", "10", "P", "10", 12, 1, 1, "WEEK", 1)], schema_of("dim_container_grp"))
    acct = spark.createDataFrame([(1, "001", "0000001", dt.date(2015, 1, 1), OPEN, 0, 1)], schema_of("dim_acct"))
    hier = spark.createDataFrame([(1, "R", "A1", "AREA", "4001", "D", "BU1", "desc", "001", "DIV", "10", "Commercial", 1)], schema_of("dim_corp_hier"))
    names = ["div_nbr", "contract_nbr", "contract_grp_nbr", "erf_rate_pct", "eff_dt", "disc_dt"]
    versions = [("001", "0", "0", Decimal("1.00"), dt.date(2015, 1, 1), dt.date(2016, 2, 1)), ("001", "0", "0", Decimal("2.00"), dt.date(2016, 2, 1), dt.date(2016, 3, 15))]
    kinds = {f.name: f.dataType for f in schema_of("dim_contract_fee").fields}
    fees = align_to_schema(spark.createDataFrame(versions, names).withColumn("erf_rate_pct", F.col("erf_rate_pct").cast(kinds["erf_rate_pct"])), schema_of("dim_contract_fee"))
    out = container.monthly_rate_snapshot(rates, cont, acct, hier, fees, dt.date(2016, 1, 1), dt.date(2016, 6, 1)).collect()
    got = sorted((r.month_dt, None if r.erf_rate_pct is None else int(r.erf_rate_pct), int(r.bcr_rt), r.bcr_active_cont_eom) for r in out)
    assert got == [(201601, 1, 10, 3), (201601, 2, 10, 3), (201602, 2, 10, 3), (201603, None, 10, 3), (201604, None, 10, 0)]
