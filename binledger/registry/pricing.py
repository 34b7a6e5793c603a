"""Price-increase, engagement, profile, model and file queries."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binledger.functions.dates import SPREADSHEET_ORIGIN, month_key
from binledger.functions.money import kg_to_pounds, pounds_to_kg
from binledger.functions.text import pad_key
from binledger.operators import profile
from binledger.operators.joins import if_small
from binledger.plans import engagement, ml, pricing
from binledger.plans.campaign import ACCOUNT
from binledger.registry.base import query
from binledger.registry.standin_sql import doubles, pad, with_tables
from binledger.session import new_stage_path
from binledger.sources.files import read_csv, read_status_folders, rename_by_position, write_csv
from binledger.sources.footers import extremes, read_with_statistics
from binledger.sources.published import publish_months, read_published
from binledger.sources.retail import Retail
from binledger.sources.tables import append_aligned, overwrite_months

DATES = pricing.PriceDates(dt.date(2000, 2, 1))
RULES = pricing.SheetRules(large_code="S1", entered_area="AMERICA")

_PRICES_CTE = f"""select r_name as area, 'BU' || {pad('c_nationkey', 3)} as bu, {pad('c_nationkey', 3)} as div_nbr, {pad('o_custkey', 7)} as acct_nbr,
 {pad('substr(o_orderpriority, 1, 1)', 5)} as site_nbr, cast(o_orderkey as varchar) as group_nbr,
 case o_orderstatus when 'O' then 'cfr' when 'P' then 'S1' else 'S2' end as stop_cd, 'R' || substr(o_orderpriority, 1, 1) as rate_type,
 lower(c_mktsegment) as district,
 case o_orderpriority when '1-URGENT' then 'BCR' when '2-HIGH' then 'FRX' when '3-MEDIUM' then 'BCR' when '4-NOT SPECIFIED' then 'RCC' else 'BSP' end as charge_cd,
 case when o_orderstatus = 'O' then 12 else 4 end as rcf, cast(floor(o_totalprice / 40000) as integer) as container_size,
 cast(cast(floor(o_totalprice / 5000) as decimal(9,0)) * 0.84 as decimal(18,2)) as curr_charge_rate,
 strftime(o_orderdate, '%Y%m%d') as eff_date,
 strftime(o_orderdate + (case o_orderpriority when '1-URGENT' then 3 when '5-LOW' then 1 else 12 end) * interval 1 month, '%m/%d/%Y') as nrd
 from placed_orders join nations on n_nationkey = c_nationkey"""
_PRICE_TABLES = ("placed_orders", "nations")


def prices(r: Retail) -> DataFrame:
    status, priority, price = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    nation = if_small(r.nations.select("n_nationkey", "r_name"))
    ahead = F.when(priority == "1-URGENT", 3).when(priority == "5-LOW", 1).otherwise(12)
    return r.placed_orders.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("r_name").alias("area"),
        F.concat(F.lit("BU"), pad_key(F.col("c_nationkey"), 3)).alias("bu"),
        pad_key(F.col("c_nationkey"), 3).alias("div_nbr"),
        pad_key(F.col("o_custkey"), 7).alias("acct_nbr"),
        pad_key(F.substring(priority, 1, 1), 5).alias("site_nbr"),
        F.col("o_orderkey").cast("string").alias("group_nbr"),
        F.when(status == "O", "cfr").when(status == "P", "S1").otherwise("S2").alias("stop_cd"),
        F.concat(F.lit("R"), F.substring(priority, 1, 1)).alias("rate_type"),
        F.lower("c_mktsegment").alias("district"),
        F.when(priority.isin("1-URGENT", "3-MEDIUM"), "BCR").when(priority == "2-HIGH", "FRX").when(priority == "4-NOT SPECIFIED", "RCC").otherwise("BSP").alias("charge_cd"),
        F.when(status == "O", 12).otherwise(4).alias("rcf"),
        F.floor(price / 40000).cast("int").alias("container_size"),
        (F.floor(price / 5000).cast("decimal(9,0)") * F.lit(Decimal("0.84"))).cast("decimal(18,2)").alias("curr_charge_rate"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("eff_date"),
        F.date_format(F.add_months(F.col("o_orderdate").cast("date"), ahead), "MM/dd/yyyy").alias("nrd"),
    )


@query(
    "pi_population",
    with_tables(
        """select distinct area, bu, div_nbr, acct_nbr, site_nbr, group_nbr, stop_cd, charge_cd, rcf, cast(curr_charge_rate as double) as curr_charge_rate, eff_date, nrd
        from prices where div_nbr not in ('971', '384', '972') and charge_cd not in ('RCC', 'NCH', 'EVR', 'NRS', 'ADM') and charge_cd not like 'FR%'
        and curr_charge_rate > 0 and curr_charge_rate <> 1.68 and ((stop_cd <> 'cfr' and eff_date < '20000601') or (stop_cd = 'cfr' and eff_date < '20000401'))
        and eff_date < '20000101' and nrd like '02/__/2000' and not (bu = 'BU007' and district in ('building', 'household') and rcf = 12)""",
        *_PRICE_TABLES, extra={"prices": _PRICES_CTE}),
)
def _pi_population(r: Retail):
    exclusion = (F.col("bu") == "BU007") & F.col("district").isin("building", "household") & (F.col("rcf") == 12)
    return pricing.population(prices(r), DATES, exclusion).select(
        "area", "bu", "div_nbr", "acct_nbr", "site_nbr", "group_nbr", "stop_cd", "charge_cd", "rcf", "curr_charge_rate", "eff_date", "nrd")


_SHEET_CTE = """select *, case when monthly_gain = 0 then current_revenue else 0.0::double end as base_not_increased,
  case when monthly_gain > 0 then current_revenue else 0.0::double end as base_increased from (
 select *, revenue_after - current_revenue as monthly_gain from (
 select *, new_charge_rate / nullif(charge_rate, 0) - 1 as pi_pct, case when entered = 0 then current_revenue else (new_charge_rate * rcf / 12) * active_cust end as revenue_after,
  case when entered <> 0 then entered - monthly_rate end as change_in_rate from (
 select *, entered * 12 / rcf as new_charge_rate, entered - monthly_rate as variance, proposed_revenue - current_revenue as revenue_increase from (
 select *, case when area = 'AMERICA' then ceil(case when current_revenue < 15 then current_revenue * 1.2::double when current_revenue < 24 then current_revenue * 1.15::double
   else current_revenue * 1.1::double end / 0.25::double) * 0.25::double else 0.0::double end as entered from (
 select *, active_cust * monthly_rate as current_revenue, active_cust * suggested as proposed_revenue, suggested / nullif(monthly_rate, 0) - 1 as increase_pct from (
 select *, case when new_monthly - monthly_rate < 0.75::double then monthly_rate + 0.75::double else ceil(new_monthly / 0.25::double) * 0.25::double end as suggested from (
 select *, monthly_rate * (1 + case when stop_code = 'S1' and container_size > 1 then 0.06::double else 0.04::double end) as new_monthly from (
 select area, bu, div_nbr, acct_nbr, site_nbr, group_nbr, stop_cd as stop_code, rate_type, district, charge_cd as charge_code, rcf,
  cast(curr_charge_rate as double) * rcf / 12 as monthly_rate, cast(curr_charge_rate as double) as charge_rate, container_size, 1 as active_cust
 from prices) a) b) c) d) e) f) g) h"""
_SHEET_EXTRA = {"prices": _PRICES_CTE, "sheet": _SHEET_CTE}
_SHEET_MONEY = ["monthly_rate", "charge_rate", "new_monthly", "suggested", "increase_pct", "current_revenue", "proposed_revenue", "entered", "new_charge_rate",
                "variance", "revenue_increase", "pi_pct", "revenue_after", "change_in_rate", "monthly_gain", "base_not_increased", "base_increased"]


@query(
    "pricing_sheet",
    with_tables(f"select area, bu, acct_nbr, group_nbr, {doubles(*_SHEET_MONEY)} from sheet", *_PRICE_TABLES, extra=_SHEET_EXTRA),
)
def _pricing_sheet(r: Retail):
    return pricing.pricing_sheet(pricing.sheet_rows(prices(r)), RULES).select("area", "bu", "acct_nbr", "group_nbr", *_SHEET_MONEY)


_KEYS = ", ".join(pricing.SHEET_KEYS)
_INDEX_CTE = f"select *, dense_rank() over (partition by area, bu order by {_KEYS}) as sheet_index from sheet"


@query(
    "group_index",
    with_tables("select area, bu, group_nbr, sheet_index from indexed", *_PRICE_TABLES, extra={**_SHEET_EXTRA, "indexed": _INDEX_CTE}),
)
def _group_index(r: Retail):
    return pricing.indexed_sheet(pricing.sheet_rows(prices(r))).select("area", "bu", "group_nbr", "sheet_index")


@query(
    "detail_with_subtotals",
    with_tables(
        f"""select area, bu, sheet_index, group_nbr, charge_code, rcf, monthly_rate, cast(active_cust as bigint) as active_cust, 'detail' as row_kind from indexed
        union all select area, bu, sheet_index, null, charge_code, rcf, monthly_rate, cast(sum(active_cust) as bigint), 'subtotal' from indexed
        group by area, bu, sheet_index, {_KEYS}""", *_PRICE_TABLES, extra={**_SHEET_EXTRA, "indexed": _INDEX_CTE}),
)
def _detail_with_subtotals(r: Retail):
    sheet = pricing.sheet_with_subtotals(pricing.indexed_sheet(pricing.sheet_rows(prices(r))))
    return sheet.select("area", "bu", "sheet_index", "group_nbr", "charge_code", "rcf", "monthly_rate", "active_cust", "row_kind")


_UPLOAD_CTE = f"""select case when stop_code = 'cfr' then 'commercial' else 'residential' end as target, div_nbr as comp, cast(acct_nbr as bigint) as acct,
 site_nbr as site, group_nbr as cgrp, charge_code, charge_rate, case when stop_code = 'cfr' then greatest(new_charge_rate, charge_rate) else new_charge_rate end as new_rate,
 case when stop_code = 'cfr' then '04/01/2000' else '06/01/2000' end as effective_date, '3' as tran_code, '64' as rsn_code
 from sheet where stop_code = 'cfr' or charge_rate < new_charge_rate"""


def upload(r: Retail) -> DataFrame:
    return pricing.upload_split(pricing.pricing_sheet(pricing.sheet_rows(prices(r)), RULES), DATES)


@query("upload_split", with_tables("select * from upload", *_PRICE_TABLES, extra={**_SHEET_EXTRA, "upload": _UPLOAD_CTE}))
def _upload_split(r: Retail):
    return upload(r)


@query(
    "uplift_apply",
    with_tables(
        """select target, comp, acct, cgrp, charge_rate, case when target = 'residential' then
         charge_rate + charge_rate * ((new_rate - charge_rate) / nullif(charge_rate, 0) + coalesce(c_acctbal / 100000, 0.0::double)) else new_rate end as new_rate
        from upload left join (select * from customer where c_acctbal > 5000) c on c.c_custkey = acct and """ + pad("c_nationkey", 3) + " = comp",
        *_PRICE_TABLES, extra={**_SHEET_EXTRA, "upload": _UPLOAD_CTE}),
)
def _uplift_apply(r: Retail):
    tags = r.table("customer").where(F.col("c_acctbal") > 5000).select(
        F.concat_ws("_", F.lit("x"), F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string")).alias("account_tag"),
        (F.col("c_acctbal") / 100000).alias("uplift"))
    return pricing.uplift_apply(upload(r), pricing.uplift_tags(tags)).select("target", "comp", "acct", "cgrp", "charge_rate", "new_rate")


@query(
    "uplift_summary",
    with_tables(
        """select target, comp, acct, cgrp, pct, coalesce(up, 0) as uplift, pct + coalesce(up, 0) as uplifted_pct,
         charge_rate * (1 + (pct + coalesce(up, 0))) as uplifted_rate
         from (select *, (new_rate - charge_rate) / nullif(charge_rate, 0) as pct from upload where target = 'residential') u
         left join (select c_custkey, c_nationkey, c_acctbal / 100000 as up from customer where c_acctbal > 5000) c
          on c_custkey = acct and """ + pad("c_nationkey", 3) + " = comp",
        *_PRICE_TABLES, extra={**_SHEET_EXTRA, "upload": _UPLOAD_CTE}),
)
def _uplift_summary(r: Retail):
    """Residential lines with their increase, the tested uplift and the rate that both give."""
    tags = r.table("customer").where(F.col("c_acctbal") > 5000).select(
        F.concat_ws("_", F.lit("x"), F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string")).alias("account_tag"),
        (F.col("c_acctbal") / 100000).alias("uplift"))
    old, new = F.col("charge_rate"), F.col("new_rate")
    rows = upload(r).where("target = 'residential'").withColumn("pct", F.try_divide(new - old, old))
    return pricing.uplift_summary(rows, pricing.uplift_tags(tags), ["comp", "acct"], "pct").select(
        "target", "comp", "acct", "cgrp", "pct", "uplift", "uplifted_pct", "uplifted_rate")


_FIELD_CTE = """select c_nationkey, o_custkey, o_orderkey, o_orderpriority, o_orderstatus, o_orderdate,
 cast(cast(floor(o_totalprice / 5000) as decimal(9,0)) * 0.84 as decimal(18,2)) as charge_rate from placed_orders"""


def field_lines(r: Retail) -> DataFrame:
    rate = (F.floor(F.col("o_totalprice") / 5000).cast("decimal(9,0)") * F.lit(Decimal("0.84"))).cast("decimal(18,2)")
    group = F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey").cast("string")).when(F.col("o_orderpriority") != "5-LOW", "none")
    return r.placed_orders.select(
        F.col("c_nationkey").cast("string").alias("comp"), F.col("o_custkey").cast("string").alias("acct"),
        F.substring("o_orderpriority", 1, 1).alias("site"), group.alias("cgrp"), F.lit("BCR").alias("charge_code"),
        rate.alias("charge_rate"), (rate * F.lit(Decimal("1.0455"))).cast("decimal(18,4)").alias("new_rate"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("effective_date"))


@query(
    "pi_intake",
    with_tables(
        f"""select {pad('c_nationkey', 3)} as comp, cast(o_custkey as integer) as acct, cast(substr(o_orderpriority, 1, 1) as integer) as site, cast(o_orderkey as integer) as cgrp,
        {pad('c_nationkey', 3)} || cast(o_custkey as varchar) || substr(o_orderpriority, 1, 1) || cast(o_orderkey as varchar) || 'BCR' as unique_key,
        cast(round(cast(charge_rate * 1.0455 as decimal(18,4)), 2) as double) as new_rate, strftime(o_orderdate, '%m/%d/%Y') as effective_date
        from field where o_orderstatus <> 'F'""", "placed_orders", extra={"field": _FIELD_CTE}),
)
def _pi_intake(r: Retail):
    return pricing.intake(field_lines(r), dt.datetime(2000, 2, 1)).select("comp", "acct", "site", "cgrp", "unique_key", "new_rate", "effective_date")


@query(
    "pi_backdate",
    with_tables(
        """select coalesce(reject_reason, 'accepted') as outcome, l.comp, l.charge_code, x.tax_app_code, count(*) as lines, cast(sum(l.charge_rate) as double) as rates, '2001-02-28' as close_date from (
        select *, case when close_date = 0 and adj_flag = '1' then 'no line number' when charge_type = 'W' then 'no account' end as reject_reason, div_nbr as comp from charge_rates) l
        left join (select div_nbr, acct_nbr, site_nbr, container_grp_nbr, charge_code, charge_rate, charge_type, charge_method, min(tax_app_code) as tax_app_code
         from charge_rates where upper(current_ind) = 'Y' and adj_flag = '0' group by all) x on reject_reason is null and x.div_nbr = l.div_nbr and x.acct_nbr = l.acct_nbr
         and x.site_nbr = l.site_nbr and x.container_grp_nbr = l.container_grp_nbr and x.charge_code = l.charge_code and x.charge_rate = l.charge_rate
         and x.charge_type = l.charge_type and x.charge_method = l.charge_method group by 1, 2, 3, 4""", "charge_rates"),
)
def _pi_backdate(r: Retail):
    c = r.charge_rates
    lines = c.select(
        F.when((F.col("close_date") != 0) | (F.col("adj_flag") != "1"), 1).alias("line_no"), F.col("div_nbr").alias("comp"),
        F.when(F.col("charge_type") != "W", F.col("acct_nbr")).alias("acct"), F.col("site_nbr").alias("site"), F.col("container_grp_nbr").alias("cgrp"),
        "charge_code", F.col("charge_type").alias("type"), F.col("charge_method").alias("method"), "charge_rate",
        (F.col("charge_rate") * F.lit(Decimal("1.04"))).alias("new_rate"))
    return pricing.backdated(lines, c, dt.date(2001, 3, 1)).groupBy(
        F.coalesce("reject_reason", F.lit("accepted")).alias("outcome"), "comp", "charge_code", "tax_app_code").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("charge_rate").alias("rates"), F.max("close_date").alias("close_date"))


@query(
    "unit_convert",
    """select p_partkey, cast(round(cast(p_size as decimal(9,2)) * 2.20462, 2) as double) as pounds, cast(round(cast(p_retailprice as decimal(9,2)) * 0.453592, 2) as double) as kg from part""",
)
def _unit_convert(r: Retail):
    return r.table("part").select(
        "p_partkey", kg_to_pounds(F.col("p_size").cast("decimal(9,2)")).alias("pounds"), pounds_to_kg(F.col("p_retailprice").cast("decimal(9,2)")).alias("kg"))


# --- engagement -----------------------------------------------------------------------------------

_STATUS = {"view": "opened", "click": "clicked", "error": "not_opened", "purchase": "not_clicked", "signup": "opt_out"}
_LISTS_CTE = f"""select case when user_id < 100 then '4' || {pad('c_nationkey', 3)} || {pad('user_id', 7)} else 'raw-' || cast(user_id as varchar) || '-' || cast(day(ts) as varchar) end as account, event_type,
 case when c_mktsegment in ('BUILDING', 'HOUSEHOLD') then 1 else 0 end as recycle, case when c_mktsegment <> 'MACHINERY' then 1 else 0 end as solid_waste,
 cast((day(ts) - 1) // 7 + 1 as integer) as wave from events left join customer on c_custkey = user_id"""


def status_lists(r: Retail) -> DataFrame:
    """Events as status lists; low users carry the long account number, the others a text of their own per day."""
    status = F.coalesce(*[F.when(F.col("event_type") == e, s) for e, s in _STATUS.items()])
    long_acct = F.concat(F.lit("4"), pad_key(F.col("c_nationkey"), 3), pad_key(F.col("user_id"), 7))
    yes_no = lambda c: F.when(c, "Y").otherwise("N")
    customer = r.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return r.table("events").join(customer, F.col("user_id") == F.col("c_custkey"), "left").select(
        F.when(F.col("user_id") < 100, long_acct).otherwise(
            F.concat_ws("-", F.lit("raw"), F.col("user_id").cast("string"), F.dayofmonth("ts").cast("string"))).alias("account"),
        status.alias("status"), yes_no(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD")).alias("recycle"),
        yes_no(F.col("c_mktsegment") != "MACHINERY").alias("solid_waste"),
        (F.floor((F.dayofmonth("ts") - 1) / 7) + 1).cast("int").alias("wave"))


@query(
    "engagement_consolidated",
    with_tables(
        """select coalesce(l.div_nbr || '-' || l.acct_nbr, account) as acct_new, cast(recycle as bigint) as recycle, cast(solid_waste as bigint) as solid_waste,
        cast(opt_out as double) as opt_out, cast(max(open) as double) as open, cast(max(click) as double) as click from (
         select account, recycle, solid_waste, case when event_type = 'signup' then 1 end as opt_out, case event_type when 'view' then 1 when 'error' then 0 end as open,
          case event_type when 'click' then 1 when 'purchase' then 0 end as click from lists) x
        left join (select '4' || div_nbr || acct_nbr as long_acct, div_nbr, acct_nbr from dim_acct) l on l.long_acct = x.account group by 1, 2, 3, 4""",
        "dim_acct", extra={"lists": _LISTS_CTE}),
)
def _engagement(r: Retail):
    lookup = r.dim_acct.select(
        engagement.long_account(F.concat(F.lit("4"), "div_nbr"), F.col("acct_nbr")).alias("long_acct"), *ACCOUNT)
    out = engagement.consolidate(status_lists(r), lookup)
    return out.select("acct_new", F.col("recycle").cast("long").alias("recycle"), F.col("solid_waste").cast("long").alias("solid_waste"),
                      *[F.col(c).cast("double").alias(c) for c in ("opt_out", "open", "click")])


# --- files ----------------------------------------------------------------------------------------


def _folder(r: Retail, label: str) -> str:
    return new_stage_path(r.spark, label)


@query(
    "src_files_with_name_cols",
    with_tables(
        """select status, wave, '1.' || cast(cast(wave as integer) * 7 as varchar) || '.24' as wave_date, count(*) as rows_read, cast(sum(recycle) as bigint) as recycle from (
        select case event_type when 'view' then 'opened' when 'click' then 'clicked' when 'error' then 'not_opened' when 'purchase' then 'not_clicked' else 'opt_out' end as status,
         '0' || cast(wave as varchar) as wave, recycle from lists) x group by 1, 2, 3""", extra={"lists": _LISTS_CTE}),
)
def _src_files(r: Retail):
    """Status lists written as one drop per status and wave, read back with columns from the drop's name."""
    root = _folder(r, "engagement")
    wave = F.col("wave").cast("string")
    name = F.concat(F.lit("campaign_results_wave_0"), wave, F.lit("_1."), (F.col("wave") * 7).cast("string"), F.lit(".24"))
    write_csv(status_lists(r).withColumn("drop", name).drop("wave"), root, ["status", "drop"])
    folders = {s: f"{root}/status={s}" for s in _STATUS.values()}
    read = read_status_folders(r.spark, folders, "account string, recycle string, solid_waste string", from_folder=True)
    return read.groupBy("status", "wave", "wave_date").agg(
        F.count(F.lit(1)).alias("rows_read"), F.sum(F.when(F.col("recycle") == "Y", 1).otherwise(0)).alias("recycle"))


@query(
    "src_csv_roundtrip",
    """select o_orderkey, case when o_orderstatus <> 'P' then o_orderstatus end as status, cast(cast(o_totalprice as decimal(18,2)) as double) as price,
    cast(cast(o_orderdate as date) as varchar) as day from orders""",
)
def _csv_roundtrip(r: Retail):
    path = _folder(r, "orders-csv")
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    write_csv(r.table("orders").select("o_orderkey", status.alias("status"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"), F.col("o_orderdate").cast("date").alias("day")), path)
    return read_csv(r.spark, path, "o_orderkey long, status string, price decimal(18,2), day date")


@query(
    "src_csv_na_marker",
    """select l_linenumber as line, case when l_returnflag <> 'N' then l_returnflag end as flag, count(*) as n,
    cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as price from lineitem group by 1, 2""",
)
def _csv_na_marker(r: Retail):
    """A file without heading that writes missing values as a marker of its own; columns named by position."""
    path = _folder(r, "lines-csv")
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).otherwise("NA")
    lines = r.table("lineitem").select("l_linenumber", flag, F.col("l_extendedprice").cast("decimal(18,2)"))
    lines.write.option("header", False).csv(path)
    back = rename_by_position(read_csv(r.spark, path, "a int, b string, c decimal(18,2)", header=False, null_marker="NA", multi_line=False), ["line", "flag", "price"])
    return back.groupBy("line", "flag").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"))


@query(
    "sink_append_months",
    """select month, cast(max(case when month % 2 = 0 then 2 else 1 end) as integer) as version, count(*) * 2 as n, cast(null as varchar) as missing
    from (select year(o_orderdate) * 100 + month(o_orderdate) as month from orders) x group by 1""",
)
def _append_months(r: Retail):
    """Two aligned appends of all months, then the even months are replaced (and appended to) once more."""
    path = _folder(r, "months")
    target = T.StructType.fromDDL("month int, version int, missing string, o_orderkey long")
    rows = r.table("orders").select((F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("month"), "o_orderkey", F.lit(1).alias("version"), F.lit("x").alias("surplus"))
    append_aligned(rows, path, target, ("month",))
    append_aligned(rows, path, target, ("month",))
    even = rows.where("month % 2 = 0").withColumn("version", F.lit(2))
    overwrite_months(even.unionByName(even).select("month", "version", F.lit(None).cast("string").alias("missing"), "o_orderkey"), path, "month")
    back = r.spark.read.schema(target).parquet(path)
    return back.groupBy("month").agg(F.max("version").alias("version"), F.count(F.lit(1)).alias("n"), F.max("missing").alias("missing"))


@query("returned_dates", "select o_orderkey, cast(cast(o_orderdate as date) as varchar) as nrd from orders where o_orderstatus <> 'P' union all select o_orderkey, null from orders where o_orderstatus = 'P'")
def _returned_dates(r: Retail):
    """Review dates as a returned sheet holds them: ISO text, day serials, or something else."""
    day = F.col("o_orderdate").cast("date")
    serial = F.datediff(day, F.lit(SPREADSHEET_ORIGIN)).cast("string")
    iso = F.date_format(day, "yyyy-MM-dd'T'00:00")
    text = F.when(F.col("o_orderstatus") == "O", iso).when(F.col("o_orderstatus") == "F", serial).otherwise("soon")
    return pricing.returned_dates(r.table("orders").select("o_orderkey", text.alias("nrd")))


@query(
    "sink_partitioned",
    with_tables(
        "select area, bu, count(*) as rows_written, cast(sum(curr_charge_rate) as double) as rates from prices group by 1, 2", *_PRICE_TABLES, extra={"prices": _PRICES_CTE}),
)
def _sink_partitioned(r: Retail):
    path = _folder(r, "areas")
    write_csv(prices(r).select("acct_nbr", "curr_charge_rate", "area", "bu"), path, ["area", "bu"])
    back = read_csv(r.spark, path, "acct_nbr string, curr_charge_rate decimal(18,2), area string, bu string")
    return back.groupBy("area", "bu").agg(F.count(F.lit(1)).alias("rows_written"), F.sum("curr_charge_rate").alias("rates"))


# --- profiles and models --------------------------------------------------------------------------


@query("global_max", "select max(l_extendedprice) as largest from lineitem")
def _global_max(r: Retail):
    return read_with_statistics(r.spark, f"{r.folder}/lineitem.parquet").agg(F.max("l_extendedprice").alias("largest"))


_MEASURED = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "footer_extremes",
    " union all ".join(
        f"select '{c}' as column_name, count(*) as rows_total, count({c}) as rows_known, cast(min({c}) as double) as smallest, cast(max({c}) as double) as largest from lineitem"
        for c in _MEASURED),
)
def _footer_extremes(r: Retail):
    return extremes(r.spark, f"{r.folder}/lineitem.parquet", _MEASURED)


@query(
    "publish_months",
    """select cast(strftime(o_orderdate, '%Y%m') as integer) as month_dt, count(*) as orders,
    cast(sum(cast(o_totalprice as decimal(18,2))) * case when year(min(o_orderdate)) = 1996 then 2 else 1 end as double) as total
    from orders group by 1""",
)
def _publish_months(r: Retail):
    """All months published, one year's months published again with other figures: the newest version holds each once."""
    path = _folder(r, "published")
    orders = r.table("orders").select(
        month_key(F.col("o_orderdate")).alias("month_dt"), "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    publish_months(orders, path)
    corrected = orders.where("month_dt div 100 = 1996").withColumn("price", (F.col("price") * 2).cast("decimal(18,2)"))
    publish_months(corrected, path)
    return read_published(r.spark, path).groupBy("month_dt").agg(F.count(F.lit(1)).alias("orders"), F.sum("price").alias("total"))


_PROFILED = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@query(
    "null_profile",
    with_tables(
        " union all ".join(f"select '{c}' as column_name, count(*) as rows_total, count(*) - count({c}) as rows_missing from holed" for c in _PROFILED),
        extra={"holed": "select event_id, ts, user_id, nullif(event_type, 'error') as event_type, case when value >= 10 then value end as value, case when event_type <> 'view' then props end as props from events"}),
)
def _null_profile(r: Retail):
    holed = r.table("events").select(
        "event_id", "ts", "user_id", F.nullif("event_type", F.lit("error")).alias("event_type"), F.when(F.col("value") >= 10, F.col("value")).alias("value"),
        F.when(F.col("event_type") != "view", F.col("props")).alias("props"))
    return profile.null_profile(holed, _PROFILED)


_DESCRIBED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "describe_numeric",
    " union all ".join(
        f"""select '{c}' as column_name, count({c}) as n, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std, min(x) as min, quantile_cont(x, 0.25) as q25,
        quantile_cont(x, 0.5) as q50, quantile_cont(x, 0.75) as q75, max(x) as max from (select {c}, {c}::double + 0.0::double as x from lineitem) t""" for c in _DESCRIBED),
)
def _describe(r: Retail):
    # adding 0.0 makes one zero of the two
    out = profile.describe_numeric(r.table("lineitem").select(*[(F.col(c) + 0.0).alias(c) for c in _DESCRIBED]), _DESCRIBED)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query(
    "mean_impute",
    """select o_orderkey, coalesce(price, (select round(avg(cast(price as decimal(18,4))), 4) from holed)) as price from holed""".replace(
        "from holed", "from (select o_orderkey, case when o_orderstatus <> 'F' then o_totalprice end as price from orders) h"),
)
def _mean_impute(r: Retail):
    holed = r.table("orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("price"))
    return profile.mean_impute(holed, "price")


_WORDS = ["the", "ion", "de", "ou"]


@query(
    "word_occurrences",
    " union all ".join(
        f"select lang, source, '{w}' as word, cast(sum((length(text) - length(replace(text, '{w}', ''))) // {len(w)}) as bigint) as hits from documents group by 1, 2" for w in _WORDS),
)
def _word_occurrences(r: Retail):
    return profile.word_occurrences(r.table("documents"), "text", _WORDS, ["lang", "source"])


_CELL = "lang || '_' || toxic"


_CELLS_SQL = f"""select cell, count(*) as n, cast(sum(quality) as bigint) as good, sum(quality) between 1 and count(*) - 1 as mixed
 from (select {_CELL} as cell, quality from documents join labels using (doc_id)) x group by 1"""


@query(
    "ml_logistic",
    f"""select cell, n, good, round(case when mixed then ln(good / (n - good)) end, 2) as log_odds,
    round(case when mixed then sqrt(1.0::double / good + 1.0::double / (n - good)) end, 4) as std_error,
    round(case when mixed then ln(good / (n - good)) / sqrt(1.0::double / good + 1.0::double / (n - good)) end, 2) as z_value
    from ({_CELLS_SQL}) c""",
)
def _ml_logistic(r: Retail):
    """Quality by language and toxicity, one term per cell: estimates and their errors are those of the cells' log-odds.

    A cell of one class has no finite estimate; it takes no part in the fit and keeps its counts.
    """
    rows = r.table("documents").join(r.table("labels"), "doc_id").select(F.expr(_CELL).alias("cell"), "quality")
    cells = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum("quality").alias("good"))
    mixed = rows.join(cells.where("good between 1 and n - 1"), "cell", "left_semi")
    terms = ml.logistic_summary(mixed, "quality ~ cell - 1").select(
        F.regexp_replace("term", "^cell_", "").alias("cell"), F.round("coefficient", 2).alias("log_odds"),
        F.round("std_error", 4).alias("std_error"), F.round("z_value", 2).alias("z_value"))
    return cells.join(terms, "cell", "left")


@query(
    "ml_logistic_fit",
    f"""select round(-2 * (total_good * ln(total_good / total) + (total - total_good) * ln((total - total_good) / total)), 3) as null_deviance,
    total - 1 as null_degrees, round(-2 * inside, 3) as residual_deviance, total - cells as residual_degrees, round(-2 * inside + 2 * cells, 3) as aic
    from (select cast(sum(n) as bigint) as total, cast(sum(good) as bigint) as total_good, count(*) as cells,
     sum(good * ln(good / n) + (n - good) * ln((n - good) / n)) as inside from ({_CELLS_SQL}) c where mixed) t""",
)
def _ml_logistic_fit(r: Retail):
    """Deviances and AIC of the model with one term per cell."""
    rows = r.table("documents").join(r.table("labels"), "doc_id").select(F.expr(_CELL).alias("cell"), "quality")
    cells = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum("quality").alias("good"))
    mixed = rows.join(cells.where("good between 1 and n - 1"), "cell", "left_semi")
    return ml.logistic_fit(mixed, "quality ~ cell").select(
        *[F.round(c, 3).alias(c) for c in ("null_deviance", "residual_deviance", "aic")], "null_degrees", "residual_degrees")


@query("ml_logistic_terms")
def _ml_logistic_terms(r: Retail):
    """Quality label by length and language: estimate, error, z and p of every term."""
    rows = r.table("documents").join(r.table("labels"), "doc_id").select(
        F.col("quality").alias("label_quality"), (F.col("n_chars") / 1000.0).alias("kchars"), "lang", "toxic")
    ready = ml.prepare(rows, ["label_quality", "kchars", "lang", "toxic"], "kchars", ["lang"])
    return ml.logistic_summary(ready, "label_quality ~ kchars + lang + toxic")


@query(
    "ml_tree",
    "select event_id, cast(day(ts) > 15 as integer) as late, cast(day(ts) > 15 as integer) as prediction from events where event_id % 10 = 0",
)
def _ml_tree(r: Retail):
    """Half of the month from the day and the hour; the day separates the labels, so the held-out answer is known."""
    rows = r.table("events").select(
        "event_id", F.dayofmonth("ts").alias("day"), F.hour("ts").alias("hour"), (F.dayofmonth("ts") > 15).cast("int").alias("late"))
    held_out = rows.where("event_id % 10 = 0").select("event_id")
    return ml.tree_predictions(rows, ["day", "hour"], "late", held_out, "event_id")


@query("ml_tree_vectors")
def _ml_tree_vectors(r: Retail):
    """Label of the first vector of each label, predicted from all the others."""
    rows = r.table("embeddings")
    held_out = rows.groupBy("label").agg(F.min("vec_id").alias("vec_id")).select("vec_id")
    return ml.tree_predictions(rows, "embedding", "label", held_out, "vec_id")
