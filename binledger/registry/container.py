"""Container refresh queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from binledger.functions.dates import OPEN_END, active_between, consistent_validity, month_key
from binledger.functions.labels import account_status
from binledger.functions.money import fee_multiplier
from binledger.functions.text import code_in
from binledger.operators.joins import FEW_LOOKED_UP, asof_dim_join, code_domain, code_enrich, if_small, keep_listed, keep_listed_of_many, left_join_on_filter
from binledger.operators.rows import live_rows
from binledger.plans import container as job
from binledger.plans.incremental import merge_late
from binledger.registry.base import query
from binledger.registry.standin_sql import bigints, doubles, pad, with_tables, ym
from binledger.session import join_as_dealt, new_stage_path
from binledger.sources.published import read_published
from binledger.sources.retail import FIRST_MONTH, LAST_MONTH, LaidOutRetail, Retail

AFTER_MONTH, FROM_DAY = 199500, 19950101

_G = "month_dt, div_nbr, cur_div_nbr, acct_nbr, site_nbr, container_grp_nbr"
_INV = ("BCR", "BSP", "BCE", "BCS", "NCC", "CEX", "EXC")
_EXT = ("NCC", "CEX", "EXC")


def _by_code(codes, value, suffix):
    """Totals of the lines of each code, from rows that carry their code as ``code``."""
    return ", ".join(f"coalesce(sum({value}) filter (code = '{c}'), 0) as {c.lower()}_{suffix}" for c in codes)


def _month(day):
    return f"cast(strftime({day}, '%Y%m') as integer)"


# places once per container group: all that a line takes from the wide tables, months as numbers
_PLACES = f"""select container_grp_sk, div_nbr, acct_nbr, site_nbr, container_grp_nbr, container_cnt as units, container_size as size, is_franchise = 1 as franchise,
 contract_nbr, contract_grp_nbr, {_month('close_dt')} as shut, {_month('orig_start_dt')} as start from dim_container_grp where container_size between 1 and 10"""
_HOLDERS = f"select acct_sk, is_national_account = 1 as national, {_month('acct_close_dt')} as gone, {_month('acct_open_dt')} as came from dim_acct"
_SHARED = """max(units) as container_cnt, max(size) as container_size, coalesce(bool_or(franchise), false)::int as is_franchise,
 coalesce(bool_or(national), false)::int as is_national_account, min(shut) as cont_close_mo, min(start) as cont_start_mo, min(gone) as act_close_mo, min(came) as act_open_mo"""

INV_CTE = f"""with places as ({_PLACES}), holders as ({_HOLDERS}),
 terms as (select div_nbr, contract_nbr, contract_grp_nbr, erf_rate_pct, frf_rate_pct, is_erf_locked = 1 as el, is_frf_locked = 1 as fl, is_erf_on_frf = 1 as ef
  from dim_contract_fee where is_current = 1),
 lines as (select i.revenue_period as month_dt, p.*, h.*, cur_div_nbr, upper(charge_cd) as code, revenue_amt, qty_billed, rate_amt, is_credit = 1 as credit
  from invoice_detail i semi join (select charge_cd_sk from dim_charge_cd where upper(charge_cd) in ('BCR','BSP','BCE','NCC','CEX','EXC','BCS')) w using (charge_cd_sk)
  join dim_charge_cd using (charge_cd_sk) join places p using (container_grp_sk) join holders h on h.acct_sk = i.acct_sk
  join dim_corp_hier using (corp_hier_sk) join dim_rate_hist using (rate_sk)
  where is_updated + is_deleted + is_merged + is_split = 0 and i.revenue_period > {AFTER_MONTH}),
 grouped as (select month_dt, div_nbr, cur_div_nbr, acct_nbr, site_nbr, container_grp_nbr, {_SHARED}, max(erf_rate_pct) as erf_rate_pct, max(frf_rate_pct) as frf_rate_pct,
  coalesce(bool_or(el), false)::int as is_erf_locked, coalesce(bool_or(fl), false)::int as is_frf_locked, coalesce(bool_or(ef), false)::int as is_erf_on_frf,
  sum(revenue_amt) as inv_rev, coalesce(sum(revenue_amt) filter (credit), 0) as credit_rev,
  {_by_code(_INV, 'revenue_amt', 'rev')}, {_by_code(_EXT, 'rate_amt', 'rate')}, {_by_code(_EXT, 'qty_billed', 'qty_bill_inv')}
  from lines left join terms using (div_nbr, contract_nbr, contract_grp_nbr) group by all)
 select *, (act_open_mo is not distinct from month_dt)::int as new_acct, (act_close_mo is not distinct from month_dt)::int as lost_acct,
  (cont_close_mo is not distinct from month_dt)::int as closed_container, (cont_start_mo is not distinct from month_dt)::int as open_container from grouped"""

SRV_CTE = f"""with places as ({_PLACES}), holders as ({_HOLDERS}),
 visits as (select service_day // 100 as month_dt, p.*, h.*, cur_div_nbr, upper(service_cd) as code, s.container_cnt as served
  from service_detail s join dim_service_cd using (service_cd_sk) join places p using (container_grp_sk) join holders h on h.acct_sk = s.acct_sk
  join dim_corp_hier using (corp_hier_sk)
  where service_day >= {FROM_DAY} and is_deleted + is_updated = 0 and upper(service_cd) in ('CEX','NCC','EXC'))
 select month_dt, div_nbr, cur_div_nbr, acct_nbr, site_nbr, container_grp_nbr, {_SHARED}, {_by_code(_EXT, 'served', 'cnt_srvc')},
  coalesce(bool_or(came = month_dt), false)::int as new_acct, coalesce(bool_or(gone = month_dt), false)::int as lost_acct,
  coalesce(bool_or(shut = month_dt), false)::int as closed_container, bool_and(coalesce(start = month_dt, false))::int as open_container
 from visits group by all"""

_EITHER = ["is_franchise", "is_national_account", "container_cnt", "container_size", "cont_close_mo", "cont_start_mo",
           "act_close_mo", "act_open_mo", "new_acct", "lost_acct", "closed_container", "open_container"]
_INV_MONEY = ["inv_rev", "credit_rev"] + [f"{c.lower()}_rev" for c in _INV] + [
    f"{c.lower()}_{m}" for m in ("rate", "qty_bill_inv") for c in _EXT]
_SRV_CNT = [f"{c.lower()}_cnt_srvc" for c in _EXT]
_FEES = ["erf_rate_pct", "frf_rate_pct", "is_erf_locked", "is_frf_locked", "is_erf_on_frf"]

IS_CTE = "select " + ", ".join(
    [f"coalesce(i.{c}, s.{c}) as {c}" for c in _G.split(", ") + _EITHER]
    + [f"coalesce(i.{c}, 0) as {c}" for c in _INV_MONEY]
    + [f"coalesce(s.{c}, 0) as {c}" for c in _SRV_CNT]
    + [f"i.{c}" for c in _FEES]
) + " from inv i full join srv s on " + " and ".join(f"i.{c} = s.{c}" for c in _G.split(", "))

_INV_TABLES = ("invoice_detail", "dim_acct", "dim_container_grp", "dim_charge_cd", "dim_corp_hier", "dim_rate_hist", "dim_contract_fee")
_SRV_TABLES = ("service_detail", "dim_acct", "dim_container_grp", "dim_service_cd", "dim_corp_hier")
_INTS = ["container_cnt", "container_size", "is_franchise", "is_national_account", "cont_close_mo", "cont_start_mo",
         "act_close_mo", "act_open_mo", "new_acct", "lost_acct", "closed_container", "open_container"]


def invoices(r: Retail):
    return job.invoice_monthly(
        r.invoice_detail, r.dim_acct, r.dim_container_grp, r.dim_charge_cd, r.dim_corp_hier, r.dim_rate_hist,
        r.dim_contract_fee, after_month=AFTER_MONTH,
    )


def services(r: Retail):
    return job.service_monthly(
        r.service_detail, r.dim_acct, r.dim_container_grp, r.dim_service_cd, r.dim_corp_hier, from_day=FROM_DAY
    )


def inv_srvc(r: Retail):
    return job.invoice_and_service(invoices(r), services(r))


def snapshot(r: Retail, unfold: bool = True, account_fees=None):
    return job.monthly_rate_snapshot(
        r.charge_rates, r.dim_container_grp, r.dim_acct, r.dim_corp_hier, r.dim_contract_fee, FIRST_MONTH, LAST_MONTH, unfold, account_fees
    )


def final_table(r: Retail, few: int = FEW_LOOKED_UP):
    r = LaidOutRetail(r.spark, r.folder)
    join_as_dealt(r.spark)
    rows = job.three_facts(
        r.invoice_detail, r.service_detail, snapshot(r, False, r.dim_acct_fee), r.dim_acct, r.dim_container_grp, r.dim_charge_cd, r.dim_service_cd,
        r.dim_corp_hier, r.dim_rate_hist, r.dim_contract_fee, AFTER_MONTH, FROM_DAY, r.dim_acct_fee, few,
    )
    return job.final_of(rows, r.dim_acct_fee, r.dim_division_fee, r.dim_corp_hier)


@query(
    "invoice_monthly",
    with_tables(
        f"select {_G.replace('month_dt', 'cast(month_dt as integer) as month_dt')}, {bigints(*_INTS)}, "
        f"{doubles(*_FEES, *_INV_MONEY)} from inv",
        *_INV_TABLES, extra={"inv": INV_CTE},
    ),
)
def _invoice_monthly(r: Retail):
    return invoices(r).withColumns({c: F.col(c).cast("double") for c in _FEES}).withColumns(
        {c: F.col(c).cast("long") for c in _INTS})


@query(
    "service_monthly",
    with_tables(f"select {_G}, {bigints(*_INTS, *_SRV_CNT)} from srv", *_SRV_TABLES, extra={"srv": SRV_CTE}),
)
def _service_monthly(r: Retail):
    return services(r).withColumns({c: F.col(c).cast("long") for c in _INTS + _SRV_CNT})


@query(
    "inv_srvc_full_join",
    with_tables(
        f"select {_G}, {bigints(*_INTS, *_SRV_CNT)}, {doubles(*_FEES, *_INV_MONEY)} from both_sides",
        *_INV_TABLES, *_SRV_TABLES, extra={"inv": INV_CTE, "srv": SRV_CTE, "both_sides": IS_CTE},
    ),
)
def _inv_srvc(r: Retail):
    return inv_srvc(r).withColumns({c: F.col(c).cast("double") for c in _FEES}).withColumns(
        {c: F.col(c).cast("long") for c in _INTS + _SRV_CNT})


@query(
    "filter_live_rows",
    with_tables(
        """select revenue_period, count(*) as live_lines, cast(sum(revenue_amt) as double) as live_revenue
        from invoice_detail where is_updated = 0 and is_deleted = 0 and is_merged = 0 and is_split = 0
        group by revenue_period""", "invoice_detail"),
)
def _filter_live_rows(r: Retail):
    return live_rows(r.invoice_detail).groupBy("revenue_period").agg(
        F.count(F.lit(1)).alias("live_lines"), F.sum("revenue_amt").alias("live_revenue"))


_ROWS_EXISTS = ["bcr_exists", "bce_exists", "bsp_exists", "bcs_exists"]
_SNAP_COUNTS = ["bcr_active_cont_bom", "bcr_active_cont_eom", "bcr_new_cnt", "bcr_lost_cnt", *_ROWS_EXISTS]

# every validity as one span of days: a place from the later opening to the earlier closing, a charge to its end
SNAP_CTE = f"""with stands as (
  select g.div_nbr, g.acct_nbr, g.site_nbr, g.container_grp_nbr, g.contract_nbr, g.contract_grp_nbr, g.container_cnt, g.container_size, g.is_franchise,
   a.is_national_account, h.cur_div_nbr, g.orig_start_dt, g.close_dt, a.acct_open_dt, a.acct_close_dt,
   greatest(g.orig_start_dt, a.acct_open_dt) as opens, least(g.close_dt, a.acct_close_dt) as shuts
  from dim_container_grp g join dim_acct a using (div_nbr, acct_nbr) join dim_corp_hier h on h.div_nbr = g.div_nbr and h.rev_distrib_cd = g.rev_distrib_cd
  where g.is_current + a.is_current + h.is_current = 3),
 charges as (
  select div_nbr, acct_nbr, site_nbr, container_grp_nbr, upper(charge_code) as code, upper(charge_code) <> 'BCS' as base, charge_rate,
   cast(strptime(effective_date::varchar, '%Y%m%d') as date) as since,
   case close_date when 0 then date '9999-12-31' else cast(strptime(close_date::varchar, '%Y%m%d') as date) end as till
  from charge_rates where upper(current_ind) = 'Y' and adj_flag = '0' and upper(charge_code) in ('BCR', 'BSP', 'BCE', 'BCS')),
 here as (
  select s.*, c.m, c.e, code, base, charge_rate, since <= m and till > m and shuts > m as live, opens <= m and shuts > m as there,
   since <= e and till >= e and opens <= e and shuts > e as live_after, opens < m as older, opens <= m as opened,
   date_trunc('month', since) = m as starts, date_trunc('month', till) = m as ends
  from stands s join charges using (div_nbr, acct_nbr, site_nbr, container_grp_nbr)
  join calendar c on greatest(opens, since) < c.e and least(shuts, till) > c.m
  where since < shuts and till >= since)
 select {_month('m')} as month_dt, z.div_nbr, cur_div_nbr, z.acct_nbr, z.site_nbr, z.container_grp_nbr,
  {_month('close_dt')} as cont_close_mo, {_month('orig_start_dt')} as cont_start_mo, {_month('acct_close_dt')} as act_close_mo, {_month('acct_open_dt')} as act_open_mo,
  bool_or(date_trunc('month', acct_open_dt) = m)::int as new_acct, bool_or(date_trunc('month', acct_close_dt) = m)::int as lost_acct,
  bool_or(date_trunc('month', close_dt) = m)::int as closed_container, bool_and(date_trunc('month', orig_start_dt) = m)::int as open_container,
  container_cnt, container_size, is_franchise, is_national_account, erf_rate_pct, frf_rate_pct, is_erf_locked, is_frf_locked, is_erf_on_frf,
  coalesce(sum(charge_rate) filter (base and live and older), 0) as bcr_rt, coalesce(sum(charge_rate) filter (not base and live and older), 0) as bcs_rt,
  coalesce(max(container_cnt) filter (base and live and opened), 0) as bcr_active_cont_bom, coalesce(max(container_cnt) filter (base and live_after), 0) as bcr_active_cont_eom,
  coalesce(max(container_cnt) filter (base and starts and there), 0) as bcr_new_cnt, coalesce(max(container_cnt) filter (base and ends and there), 0) as bcr_lost_cnt,
  {', '.join(f"coalesce(max(container_cnt) filter (code = '{c}'), 0) as {c.lower()}_exists" for c in ('BCR', 'BCE', 'BSP', 'BCS'))}
 from here z left join dim_contract_fee f on f.div_nbr = z.div_nbr and f.contract_nbr = z.contract_nbr and f.contract_grp_nbr = z.contract_grp_nbr
  and z.e between f.eff_dt and f.disc_dt group by all"""

CAL_CTE = """select cast(m as date) as m, cast(m + interval 1 month as date) as e,
 year(m) * 10000 + month(m) * 100 + 1 as mi,
 year(m + interval 1 month) * 10000 + month(m + interval 1 month) * 100 + 1 as ei
 from (select unnest(generate_series(date '1995-01-01', date '2001-12-01', interval 1 month)) as m) s"""

_SNAP_TABLES = ("charge_rates", "dim_container_grp", "dim_acct", "dim_corp_hier", "dim_contract_fee")
_SNAP_EXTRA = {"calendar": CAL_CTE, "snap": SNAP_CTE}


@query(
    "monthly_rate_snapshot",
    with_tables(
        f"select {_G}, {bigints(*_INTS, *_SNAP_COUNTS)}, {doubles(*_FEES, 'bcr_rt', 'bcs_rt')} from snap",
        *_SNAP_TABLES, extra=_SNAP_EXTRA,
    ),
)
def _snapshot(r: Retail):
    return snapshot(r).withColumns({c: F.col(c).cast("double") for c in _FEES}).withColumns(
        {c: F.col(c).cast("long") for c in _INTS + _SNAP_COUNTS})


@query(
    "active_charges",
    with_tables(
        """select div_nbr, charge_code, count(*) as charges, cast(sum(charge_rate) as double) as rate_total from charge_rates
        where effective_date < 19980401 and (close_date > 19980301 or close_date = 0)
        and (close_date >= effective_date or close_date = 0) group by 1, 2""", "charge_rates"),
)
def _active_charges(r: Retail):
    eff, cld = F.col("effective_date"), F.col("close_date")
    active = active_between(eff, cld, F.lit(19980301), F.lit(19980401)) & consistent_validity(eff, cld)
    return r.charge_rates.where(active).groupBy("div_nbr", "charge_code").agg(
        F.count(F.lit(1)).alias("charges"), F.sum("charge_rate").alias("rate_total"))


_RATE_ONLY = ["bcr_rt", "bcs_rt", *_SNAP_COUNTS]
_RATE_FIRST = ["cont_close_mo", "cont_start_mo", "act_open_mo", "act_close_mo", "container_size", "new_acct", "lost_acct",
               "closed_container", "open_container"]
_INV_FIRST = ["is_franchise", "is_national_account", "container_cnt", *_FEES]
ALL_CTE = "select " + ", ".join(
    [f"coalesce(i.{c}, r.{c}) as {c}" for c in _G.split(", ") + _INV_FIRST]
    + [f"coalesce(r.{c}, i.{c}) as {c}" for c in _RATE_FIRST]
    + [f"coalesce(i.{c}, 0) as {c}" for c in _INV_MONEY + _SRV_CNT]
    + [f"coalesce(r.{c}, 0) as {c}" for c in _RATE_ONLY]
) + " from both_sides i full join snap r on " + " and ".join(f"i.{c} = r.{c}" for c in _G.split(", "))

ACCT_FEE_CTE = """select div_nbr, acct_nbr,
 max(case when fee_type = 'FRF' and is_fee_charged = 1 and is_acct_fee_enabled = 1 then 1 else 0 end) as frf_charged,
 max(case when fee_type = 'EVR' and is_fee_charged = 1 and is_acct_fee_enabled = 1 then 1 else 0 end) as erf_charged
 from dim_acct_fee where is_current = 1 and fee_type in ('FRF', 'EVR') group by 1, 2"""


def _eff(kind):
    return f"""cast(case when coalesce(is_{kind}_locked, 0) = 1
      then {kind}_rate_pct * 0.01 * coalesce({kind}_charged, 1) * coalesce(is_{kind}_enabled, 1)
      else div_{kind}_pct * is_{kind}_enabled * 0.01 * coalesce({kind}_charged, 1) end as decimal(8,4))"""


PRICED_CTE = f"""select x.*, {_eff('erf')} as erf_rate, {_eff('frf')} as frf_rate,
 cast(div_erf_pct * is_erf_enabled * 0.01 as decimal(8,4)) as full_erf, cast(div_frf_pct * is_frf_enabled * 0.01 as decimal(8,4)) as full_frf,
 coalesce(is_erf_on_frf, 0) as erf_on_frf_2
 from (select f.*, af.frf_charged, af.erf_charged, d.erf_rate as div_erf_pct, d.frf_rate as div_frf_pct, d.is_erf_enabled, d.is_frf_enabled
  from all_rows f left join acct_fee af on f.acct_nbr = af.acct_nbr and f.div_nbr = af.div_nbr
  join dim_division_fee d on d.month_dt = f.month_dt and d.div_nbr = f.div_nbr) x"""

HIER_SQL = """select distinct cur_region_nm, cur_area_nbr, cur_area_nm, cur_div_nbr, cur_div_nm,
 cur_bu_nbr || ' ' || cur_bu_desc as bu_name, div_nbr, div_nm from dim_corp_hier
 where is_current = 1 and (lower(cur_lob_category) like '%commercial%' or lower(cur_lob_category) like '%industrial%')
 and not (lower(cur_area_nm) like 'divested')"""

_MULT = "case when erf_on_frf_2 = 1 then (1 + frf_rate) * (1 + erf_rate) else cast(1 + erf_rate + frf_rate as decimal(19,8)) end"
_STATUS = """case when new_acct = 1 and lost_acct = 0 then 'NEW ACCOUNT' when lost_acct = 1 then 'LOST ACCOUNT'
 when new_acct = 0 and lost_acct = 0 and open_container = 1 and closed_container = 0 then 'EXISTING - NEW CONTAINER'
 when new_acct = 0 and lost_acct = 0 and closed_container = 1 then 'EXISTING - CLOSED CONTAINER'
 when new_acct = 0 and lost_acct = 0 and closed_container = 0 and open_container = 1 then 'EXISTING - OPEN CONTAINER'
 when new_acct = 0 and lost_acct = 0 and open_container = 0 and closed_container = 0 then 'EXISTING - NO CHANGE' end"""

FINAL_CTE = f"""select month_dt, cur_region_nm, cur_area_nbr, cur_area_nm, cur_div_nbr, cur_div_nm, bu_name, div_nm, div_nbr,
 acct_nbr, site_nbr, container_grp_nbr, is_franchise, is_national_account,
 {", ".join(f"{c.lower()}_{m}" for m in ("rev", "rate", "qty_bill_inv", "cnt_srvc") for c in _EXT)},
 bcr_active_cont_bom, bcr_active_cont_eom, bcr_new_cnt, bcr_lost_cnt, new_acct, lost_acct, closed_container, open_container,
 base as bcr_rev_inv_base, mult * cast(base as decimal(18,2)) as bcr_rev_inv_fees,
 {", ".join(f"mult * cast({c.lower()}_{m} as decimal(18,2)) as {c.lower()}_{m}_inv_fees" for m in ("rate", "rev") for c in _EXT)},
 bcr_rt * container_cnt as bcr_rt_base, bcs_rt * container_cnt as bcs_rt_base,
 mult * cast(bcr_rt * container_cnt as decimal(18,2)) as bcr_rt_fees, mult * cast(bcs_rt * container_cnt as decimal(18,2)) as bcs_rt_fees,
 case when bcr_exists + bce_exists + bcs_exists + bsp_exists > 0 then 1 else 0 end as bcr_exists,
 mult - 1 as fees_pct, {_STATUS} as acct_status
 from (select p.*, {_MULT} as mult, bcr_rev + bsp_rev + bce_rev + bcs_rev as base,
  h.cur_region_nm, h.cur_area_nbr, h.cur_area_nm, h.cur_div_nm, h.bu_name, h.div_nm
  from priced p join hier h on h.cur_div_nbr = p.cur_div_nbr and h.div_nbr = p.div_nbr) y"""

_FINAL_EXTRA = {"inv": INV_CTE, "srv": SRV_CTE, "both_sides": IS_CTE, **_SNAP_EXTRA, "all_rows": ALL_CTE,
                "acct_fee": ACCT_FEE_CTE, "priced": PRICED_CTE, "hier": HIER_SQL, "final_rows": FINAL_CTE}
_FINAL_TABLES = (*_INV_TABLES, *_SRV_TABLES, *_SNAP_TABLES, "dim_acct_fee", "dim_division_fee")
_FINAL_TEXT = ["cur_region_nm", "cur_area_nbr", "cur_area_nm", "cur_div_nbr", "cur_div_nm", "bu_name", "div_nm", "div_nbr"]
_FINAL_INTS = ["bcr_active_cont_bom", "bcr_active_cont_eom", "bcr_new_cnt", "bcr_lost_cnt"]
_FLAGS = ["is_franchise", "is_national_account", "bcr_exists"]
_FINAL_MONEY = (
    ["bcr_rev_inv_base", "bcr_rev_inv_fees"]
    + [f"{c.lower()}_{m}" for m in ("rev", "rate", "rate_inv_fees", "rev_inv_fees", "qty_bill_inv", "cnt_srvc") for c in _EXT]
    + ["bcr_rt_base", "bcs_rt_base", "bcr_rt_fees", "bcs_rt_fees"]
)
_OPEN_FLAGS = ["new_acct", "lost_acct", "closed_container", "open_container"]


@query(
    "final_container_table",
    with_tables(
        f"select month_dt, {', '.join(_FINAL_TEXT)}, acct_nbr, site_nbr, container_grp_nbr, acct_status, "
        f"{bigints(*_FLAGS, *_FINAL_INTS, *_OPEN_FLAGS)}, {doubles(*_FINAL_MONEY, 'fees_pct')} from final_rows",
        *_FINAL_TABLES, extra=_FINAL_EXTRA,
    ),
)
def _final_container_table(r: Retail):
    return final_table(r).withColumns({c: F.col(c).cast("long") for c in _FLAGS + _FINAL_INTS + _OPEN_FLAGS}).withColumns(
        {f"{c.lower()}_cnt_srvc": F.col(f"{c.lower()}_cnt_srvc").cast("double") for c in _EXT})


@query(
    "final_summary",
    with_tables(
        f"""select month_dt, {', '.join(_FINAL_TEXT)}, acct_status, {bigints(*_FLAGS)},
        {', '.join(f'cast(sum({c}) as bigint) as {c}' for c in _FINAL_INTS)},
        {', '.join(f'cast(sum({c}) as double) as {c}' for c in _FINAL_MONEY)} from final_rows
        group by {', '.join(['month_dt', *_FINAL_TEXT, 'acct_status', *_FLAGS])}""",
        *_FINAL_TABLES, extra=_FINAL_EXTRA,
    ),
)
def _final_summary(r: Retail):
    return job.final_summary(final_table(r)).withColumns({c: F.col(c).cast("long") for c in _FLAGS}).withColumns(
        {f"{c.lower()}_cnt_srvc": F.col(f"{c.lower()}_cnt_srvc").cast("double") for c in _EXT})


@query("hierarchy_distinct", with_tables(HIER_SQL, "dim_corp_hier"))
def _hierarchy(r: Retail):
    return job.hierarchy_distinct(r.dim_corp_hier)


@query(
    "fee_flags_join",
    with_tables(
        """select a.div_nbr, a.acct_nbr, cast(f.frf_charged as double) as frf_charged, cast(f.erf_charged as double) as erf_charged
        from dim_acct a left join acct_fee f on a.div_nbr = f.div_nbr and a.acct_nbr = f.acct_nbr""",
        "dim_acct", "dim_acct_fee", extra={"acct_fee": ACCT_FEE_CTE}),
)
def _fee_flags_join(r: Retail):
    flags = job.account_fee_flags(r.dim_acct_fee)
    return r.dim_acct.select("div_nbr", "acct_nbr").join(flags, ["div_nbr", "acct_nbr"], "left").select(
        "div_nbr", "acct_nbr", F.col("frf_charged").cast("double").alias("frf_charged"),
        F.col("erf_charged").cast("double").alias("erf_charged"))


# one row per container with its contract's fees, in the month the container started
_CONTAINER_FEES = f"""select {ym('orig_start_dt')} as month_dt, g.div_nbr, g.acct_nbr, g.container_grp_nbr, f.erf_rate_pct, f.frf_rate_pct,
 f.is_erf_locked, f.is_frf_locked, f.is_erf_on_frf from dim_container_grp g left join dim_contract_fee f
 on g.div_nbr = f.div_nbr and g.contract_nbr = f.contract_nbr and g.contract_grp_nbr = f.contract_grp_nbr and f.is_current = 1"""
_FEE_EXTRA = {"all_rows": _CONTAINER_FEES, "acct_fee": ACCT_FEE_CTE, "priced": PRICED_CTE}
_FEE_TABLES = ("dim_container_grp", "dim_contract_fee", "dim_acct_fee", "dim_division_fee")


def _container_fees(r: Retail):
    joined = left_join_on_filter(
        r.dim_container_grp, if_small(r.dim_contract_fee.drop("eff_dt", "disc_dt")),
        ["div_nbr", "contract_nbr", "contract_grp_nbr"], F.col("is_current") == 1)
    rows = joined.select(
        month_key(F.col("orig_start_dt")).alias("month_dt"), "div_nbr", "acct_nbr", "container_grp_nbr", *_FEES)
    return job.fee_rates(rows, r.dim_acct_fee, r.dim_division_fee)


@query(
    "fee_rates",
    with_tables(
        f"select month_dt, div_nbr, acct_nbr, container_grp_nbr, {doubles('erf_rate', 'frf_rate', 'full_erf', 'full_frf')} from priced",
        *_FEE_TABLES, extra=_FEE_EXTRA),
)
def _fee_rates(r: Retail):
    return _container_fees(r).select(
        "month_dt", "div_nbr", "acct_nbr", "container_grp_nbr", "erf_rate", "frf_rate", "full_erf", "full_frf")


@query(
    "fee_multiplier",
    with_tables(
        f"""select div_nbr, month_dt, count(*) as containers, cast(sum({_MULT}) as double) as multiplier_total,
        cast(min({_MULT}) as double) as multiplier_min, cast(max({_MULT}) as double) as multiplier_max from priced group by 1, 2""",
        *_FEE_TABLES, extra=_FEE_EXTRA),
)
def _fee_multiplier(r: Retail):
    factor = fee_multiplier(F.col("is_erf_on_frf"), F.col("frf_rate"), F.col("erf_rate"))
    return _container_fees(r).groupBy("div_nbr", "month_dt").agg(
        F.count(F.lit(1)).alias("containers"), F.sum(factor).alias("multiplier_total"),
        F.min(factor).alias("multiplier_min"), F.max(factor).alias("multiplier_max"))


@query(
    "left_join_on_filter",
    with_tables(
        """select g.div_nbr, g.contract_nbr, count(*) as containers, count(f.erf_rate_pct) as with_fee,
        cast(sum(f.erf_rate_pct) as double) as erf_total
        from dim_container_grp g left join dim_contract_fee f on g.div_nbr = f.div_nbr and g.contract_nbr = f.contract_nbr
        and g.contract_grp_nbr = f.contract_grp_nbr and f.is_current = 1 group by 1, 2""",
        "dim_container_grp", "dim_contract_fee"),
)
def _left_join_on_filter(r: Retail):
    return left_join_on_filter(
        r.dim_container_grp, if_small(r.dim_contract_fee), ["div_nbr", "contract_nbr", "contract_grp_nbr"], F.col("is_current") == 1,
    ).groupBy("div_nbr", "contract_nbr").agg(
        F.count(F.lit(1)).alias("containers"), F.count("erf_rate_pct").alias("with_fee"), F.sum("erf_rate_pct").alias("erf_total"))


@query(
    "asof_dim_join",
    with_tables(
        """select g.div_nbr, g.contract_nbr, year(g.orig_start_dt) as start_year, count(*) as containers, count(f.frf_rate_pct) as with_fee,
        cast(sum(f.frf_rate_pct) as double) as frf_total
        from dim_container_grp g left join dim_contract_fee f on g.div_nbr = f.div_nbr and g.contract_nbr = f.contract_nbr
        and f.eff_dt <= g.orig_start_dt and f.disc_dt >= g.orig_start_dt group by 1, 2, 3""",
        "dim_container_grp", "dim_contract_fee"),
)
def _asof_dim_join(r: Retail):
    dim = if_small(r.dim_contract_fee.select("div_nbr", "contract_nbr", "frf_rate_pct", "eff_dt", "disc_dt"))
    left = r.dim_container_grp.select("div_nbr", "contract_nbr", "orig_start_dt")
    return asof_dim_join(left, dim, ["div_nbr", "contract_nbr"], "orig_start_dt").groupBy(
        "div_nbr", "contract_nbr", F.year("orig_start_dt").alias("start_year")
    ).agg(F.count(F.lit(1)).alias("containers"), F.count("frf_rate_pct").alias("with_fee"), F.sum("frf_rate_pct").alias("frf_total"))


@query(
    "account_status",
    with_tables(
        f"""select month_dt, {_STATUS} as acct_status, count(*) as containers from inv group by 1, 2""",
        *_INV_TABLES, extra={"inv": INV_CTE}),
)
def _account_status(r: Retail):
    status = account_status(F.col("new_acct"), F.col("lost_acct"), F.col("open_container"), F.col("closed_container"))
    return invoices(r).groupBy("month_dt", status.alias("acct_status")).agg(F.count(F.lit(1)).alias("containers"))


@query(
    "account_trace",
    with_tables(
        f"""select c.div_nbr, c.acct_nbr, site_nbr, container_grp_nbr, charge_code, effective_date, close_date,
        cast(charge_rate as double) as charge_rate, tax_app_code
        from charge_rates c join (select {pad('o_custkey', 7)} as acct_nbr from orders group by o_custkey
          order by sum(cast(o_totalprice as decimal(18,2))) desc, o_custkey limit 1) t on t.acct_nbr = c.acct_nbr""",
        "charge_rates"),
)
def _account_trace(r: Retail):
    """Charge lines of the account with the largest revenue, in date order."""
    best = (
        r.table("orders").groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spent"))
        .orderBy(F.col("spent").desc(), "o_custkey").limit(1)
    )
    account = best.join(r.dim_acct, best["o_custkey"] == r.dim_acct["acct_sk"]).select("div_nbr", "acct_nbr")
    return job.account_trace(r.charge_rates, account, ["effective_date", "close_date", "charge_code"]).select(
        "div_nbr", "acct_nbr", "site_nbr", "container_grp_nbr", "charge_code", "effective_date", "close_date", "charge_rate", "tax_app_code")


@query(
    "topn_preview",
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber, cast(l_extendedprice as double) as l_extendedprice from lineitem
    order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity limit 1000""",
)
def _topn_preview(r: Retail):
    keys = [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    return r.table("lineitem").orderBy(*keys).limit(1000).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")


@query(
    "like_filters",
    """select p_type, p_brand, count(*) as parts from part where lower(p_name) like '%ring%' and p_brand not like 'Brand#1_'
    and (lower(p_type) like '%economy%' or lower(p_type) like 's%') group by 1, 2""",
)
def _like_filters(r: Retail):
    kind = F.col("p_type")
    kept = F.col("p_name").ilike("%RING%") & ~F.col("p_brand").like("Brand#1_") & (kind.ilike("%economy%") | kind.ilike("S%"))
    return r.table("part").where(kept).groupBy("p_type", "p_brand").agg(F.count(F.lit(1)).alias("parts"))


_CODE_TABLE = """select 'STT' as domain, ' ' || o_orderstatus as code, 'status ' || o_orderstatus as description,
  case when o_orderstatus = 'P' then 'I' else 'A' end as status from orders
 union all select 'RAT', o_orderpriority, lower(o_orderpriority), 'A' from orders"""


@query(
    "code_enrich",
    with_tables(
        """select o_orderstatus as stop_code, stop_desc, replace(o_orderpriority, ' ', '') as rate_type, rate_desc,
        count(*) as orders, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
        from orders left join (select replace(code, ' ', '') as stop_code, min(replace(description, ' ', '')) as stop_desc
          from codes where domain = 'STT' and status = 'A' group by 1 union all select 'cfr', 'com format') s on s.stop_code = o_orderstatus
        left join (select replace(code, ' ', '') as rate_type, min(replace(description, ' ', '')) as rate_desc
          from codes where domain = 'RAT' and status = 'A' group by 1 union all select 'cfr', 'com format') t
          on t.rate_type = replace(o_orderpriority, ' ', '') group by 1, 2, 3, 4""",
        extra={"codes": _CODE_TABLE}),
)
def _code_enrich(r: Retail):
    orders = r.table("orders")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    codes = orders.select(
        F.lit("STT").alias("domain"), F.concat(F.lit(" "), status).alias("code"),
        F.concat(F.lit("status "), status).alias("description"), F.when(status == "P", "I").otherwise("A").alias("status"),
    ).unionByName(orders.select(
        F.lit("RAT").alias("domain"), priority.alias("code"), F.lower(priority).alias("description"), F.lit("A").alias("status")))
    literal = [("cfr", "com format")]
    rows = orders.select(status.alias("stop_code"), F.regexp_replace(priority, " ", "").alias("rate_type"), "o_totalprice")
    enriched = code_enrich(rows, {
        "stop_code": code_domain(codes, "STT", "stop_code", "stop_desc", literal),
        "rate_type": code_domain(codes, "RAT", "rate_type", "rate_desc", literal),
    })
    return enriched.groupBy("stop_code", "stop_desc", "rate_type", "rate_desc").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))


@query(
    "semi_inclusion",
    with_tables(
        """select div_nbr, charge_code, count(*) as lines, cast(sum(charge_rate) as double) as total from charge_rates
        where (div_nbr, charge_code) in (select div_nbr, charge_code from charge_rates where adj_flag = '1' and upper(current_ind) = 'N')
        and upper(charge_code) in ('BCR','BSP','BCE','NCC','CEX','EXC','BCS') group by 1, 2""", "charge_rates"),
)
def _semi_inclusion(r: Retail):
    """Lines of (division, code) pairs that occur in the adjusted, outdated lines."""
    wanted = r.charge_rates.where((F.col("adj_flag") == "1") & (F.upper("current_ind") == "N")).select("div_nbr", "charge_code").distinct()
    kept = keep_listed(r.charge_rates.where(code_in(F.col("charge_code"), job.INVOICE_CODES)), wanted, ["div_nbr", "charge_code"])
    return kept.groupBy("div_nbr", "charge_code").agg(F.count(F.lit(1)).alias("lines"), F.sum("charge_rate").alias("total"))


@query(
    "semi_inclusion_of_many",
    with_tables(
        """select div_nbr, charge_code, count(*) as lines, cast(sum(charge_rate) as double) as total from charge_rates
        where (div_nbr, acct_nbr, site_nbr, container_grp_nbr) in (select (div_nbr, acct_nbr, site_nbr, container_grp_nbr) from charge_rates
         where adj_flag = '1' and upper(current_ind) = 'N') group by 1, 2""", "charge_rates"),
)
def _semi_inclusion_of_many(r: Retail):
    """Lines of containers that have an adjusted, outdated line; the list of containers grows with the lines."""
    key = ["div_nbr", "acct_nbr", "site_nbr", "container_grp_nbr"]
    wanted = r.charge_rates.where((F.col("adj_flag") == "1") & (F.upper("current_ind") == "N")).select(*key).distinct()
    kept = keep_listed_of_many(r.charge_rates.select(*key, "charge_code", "charge_rate"), wanted, key)
    return kept.groupBy("div_nbr", "charge_code").agg(F.count(F.lit(1)).alias("lines"), F.sum("charge_rate").alias("total"))


@query(
    "asof_many_versions",
    f"""with days as (select c_nationkey as nation, o_orderdate::date as day, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as level
      from orders join customer on o_custkey = c_custkey group by 1, 2),
     lines as (select c_nationkey as nation, l_shipdate::date as shipped from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey)
     select l.nation, year(shipped) as ship_year, count(*) as lines, round(sum(level), 2) as level, max(day)::varchar as newest
     from lines l asof left join days d on l.nation = d.nation and l.shipped >= d.day group by 1, 2""",
)
def _asof_many_versions(r: Retail):
    """Every shipped line with its nation's order level of the latest order day; a nation has a version per order day."""
    day = F.col("o_orderdate").cast("date")
    days = r.placed_orders.groupBy(F.col("c_nationkey").alias("nation"), day.alias("eff_dt")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("level"))
    following = Window.partitionBy("nation").orderBy("eff_dt")
    # a nation has at most one version per calendar day
    dim = days.withColumn("disc_dt", F.coalesce(F.date_sub(F.lead("eff_dt").over(following), 1), F.lit(OPEN_END)))
    lines = r.placed_lines.select(F.col("c_nationkey").alias("nation"), F.col("l_shipdate").cast("date").alias("shipped"))
    return asof_dim_join(lines, dim, ["nation"], "shipped").groupBy("nation", F.year("shipped").alias("ship_year")).agg(
        F.count(F.lit(1)).alias("lines"), F.round(F.sum("level"), 2).alias("level"), F.max("eff_dt").alias("newest"))


@query(
    "incremental_refresh",
    """select c_nationkey as nation, cast(strftime(l_shipdate, '%Y%m') as integer) as month_dt, count(*) as lines,
    cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as amount
    from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey group by 1, 2""",
)
def _incremental_refresh(r: Retail):
    """Lines per nation and ship month, merged in three batches as their orders become old enough: equal to the whole."""
    lines = r.placed_lines.select(
        F.col("c_nationkey").alias("nation"), month_key(F.col("l_shipdate")).alias("month_dt"), F.lit(1).cast("long").alias("lines"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"), F.year("o_orderdate").alias("year"))
    path = new_stage_path(r.spark, "incremental")
    arrival = F.when(F.col("year") < 1996, 0).when(F.col("year") < 1998, 1).otherwise(2)
    for batch in (0, 1, 1, 2):  # the second one is delivered twice
        merge_late(lines.where(F.coalesce(arrival, F.lit(2)) == batch), path, ["nation"], ["lines", "amount"], batch=batch)
    return read_published(r.spark, path)
