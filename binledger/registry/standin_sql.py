"""The billing stand-in tables of ``binledger.sources.retail`` written again as DuckDB CTEs."""

from __future__ import annotations

from binledger.sources.retail import LINE_CODES

_CODES = ", ".join(f"('{k}', '{v}')" for k, v in LINE_CODES.items())


def pad(expr: str, width: int) -> str:
    return f"lpad(cast({expr} as varchar), cast(greatest({width}, length(cast({expr} as varchar))) as integer), '0')"


def ym(expr: str) -> str:
    return f"cast(year({expr}) * 100 + month({expr}) as integer)"


def ymd(expr: str) -> str:
    return f"cast(year({expr}) * 10000 + month({expr}) * 100 + day({expr}) as integer)"


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "placed_orders": ((), "select * from orders join customer on o_custkey = c_custkey"),
    "placed_lines": (("placed_orders",), "select * from lineitem join placed_orders on l_orderkey = o_orderkey"),
    "invoice_detail": (
        ("placed_lines",),
        f"""select {ym('l_shipdate')} as revenue_period, o_custkey as acct_sk, l_orderkey as container_grp_sk,
        cast(c_nationkey as bigint) * 10 + case when c_mktsegment = 'BUILDING' then 1 else 0 end as corp_hier_sk,
        l_returnflag || cast(l_linenumber as varchar) as charge_cd_sk, l_partkey as rate_sk,
        cast(l_extendedprice as decimal(18,2)) as revenue_amt, cast(l_quantity as decimal(18,2)) as qty_billed,
        case when l_returnflag = 'R' then 1 else 0 end as is_credit,
        case when cast(l_discount as decimal(4,2)) = 0.10 then 1 else 0 end as is_updated,
        case when cast(l_tax as decimal(4,2)) = 0.08 then 1 else 0 end as is_deleted,
        case when l_quantity = 50 then 1 else 0 end as is_merged,
        case when l_quantity = 1 then 1 else 0 end as is_split from placed_lines""",
    ),
    "service_detail": (
        ("placed_lines",),
        f"""select {ymd('l_shipdate')} as service_day, o_custkey as acct_sk, l_orderkey as container_grp_sk,
        cast(c_nationkey as bigint) * 10 + case when c_mktsegment = 'BUILDING' then 1 else 0 end as corp_hier_sk,
        l_returnflag || cast(l_linenumber as varchar) as service_cd_sk, cast(l_quantity as integer) as container_cnt,
        case when cast(l_discount as decimal(4,2)) = 0.10 then 1 else 0 end as is_updated,
        case when cast(l_tax as decimal(4,2)) = 0.08 then 1 else 0 end as is_deleted from placed_lines""",
    ),
    "dim_acct": (
        (),
        f"""select c_custkey as acct_sk, {pad('c_nationkey', 3)} as div_nbr, {pad('c_custkey', 7)} as acct_nbr,
        acct_open_dt, acct_close_dt, case when c_mktsegment = 'HOUSEHOLD' then 1 else 0 end as is_national_account,
        1 as is_current from customer left join (select o_custkey, cast(min(o_orderdate) as date) as acct_open_dt,
        cast(max(o_orderdate) as date) as acct_close_dt from orders group by o_custkey) s on c_custkey = o_custkey""",
    ),
    "dim_container_grp": (
        ("placed_orders",),
        f"""select o_orderkey as container_grp_sk, {pad('c_nationkey', 3)} as div_nbr, {pad('o_custkey', 7)} as acct_nbr,
        {pad('substr(o_orderpriority, 1, 1)', 5)} as site_nbr, cast(o_orderkey as varchar) as container_grp_nbr,
        cast(floor(o_totalprice / 100000) as integer) + 1 as container_cnt,
        cast(floor(o_totalprice / 40000) as integer) as container_size,
        case when o_orderstatus = 'F' then 'FR' when o_totalprice < 100000 then 'YW'
             when o_totalprice < 400000 then 'FL' end as container_cd,
        case when o_orderpriority = '5-LOW' then 1 else 0 end as is_franchise,
        cast(o_orderdate as date) as orig_start_dt,
        case o_orderstatus when 'F' then cast(o_orderdate as date) + 90 when 'P' then cast(o_orderdate as date) + 900
             else date '9999-12-31' end as close_dt,
        cast(cast(floor(o_totalprice / 100000) as integer) as varchar) as contract_nbr, '0' as contract_grp_nbr,
        case when c_mktsegment = 'BUILDING' then '31' else '10' end as rev_distrib_cd,
        case when o_orderpriority = '1-URGENT' then 'X' else 'P' end as acct_type,
        case when o_totalprice >= 450000 then '91' else '10' end as district_cd,
        case when o_orderstatus = 'O' then 12 else 4 end as recurring_charge_freq,
        cast(floor(o_totalprice / 100000) as integer) as pickup_lifts,
        case when o_orderstatus = 'P' then 2 else 1 end as pickup_length,
        case when c_mktsegment = 'MACHINERY' and o_totalprice < 150000 then 'UNKNOWN' else 'WEEK' end as pickup_unit, 1 as is_current from placed_orders""",
    ),
    "dim_charge_cd": ((), f"select * from (values {_CODES}) t(charge_cd_sk, charge_cd)"),
    "dim_service_cd": ((), f"select * from (values {_CODES}) t(service_cd_sk, service_cd)"),
    "dim_rate_hist": ((), "select p_partkey as rate_sk, cast(p_retailprice as decimal(18,2)) as rate_amt from part"),
    "nations": ((), "select * from nation join region on n_regionkey = r_regionkey"),
    "dim_corp_hier": (
        ("nations",),
        f"""select cast(n_nationkey as bigint) * 10 + case when rev_distrib_cd = '31' then 1 else 0 end as corp_hier_sk,
        r_name as cur_region_nm, 'A' || cast(n_regionkey as varchar) as cur_area_nbr,
        case when n_name = 'NATION_24' then 'Divested' else r_name || ' AREA' end as cur_area_nm,
        '4' || {pad('n_nationkey', 3)} as cur_div_nbr, n_name as cur_div_nm, 'BU' || {pad('n_nationkey', 3)} as cur_bu_nbr,
        case when n_name <> 'NATION_7' then lower(n_name) end as cur_bu_desc, {pad('n_nationkey', 3)} as div_nbr,
        'DIV ' || n_name as div_nm, rev_distrib_cd,
        case when rev_distrib_cd = '31' then 'Small Industrial' when r_name = 'AFRICA' then 'Commercial'
             when r_name = 'AMERICA' then 'COMMERCIAL' when r_name = 'ASIA' then 'Residential'
             when r_name = 'EUROPE' then 'commercial hauling' else 'Commercial' end as cur_lob_category,
        case when rev_distrib_cd = '31' and r_name = 'MIDDLE EAST' then 0 else 1 end as is_current
        from nations, (values ('10'), ('31')) v(rev_distrib_cd)""",
    ),
    "dim_contract_fee": (
        (),
        f"""select div_nbr, contract_nbr, '0' as contract_grp_nbr, erf_rate_pct, frf_rate_pct, is_erf_locked, is_frf_locked,
        is_erf_on_frf, date '1995-01-01' as eff_dt,
        case when contract_nbr = '2' then date '1998-06-30' else date '9999-12-31' end as disc_dt,
        case when contract_nbr = '2' then 0 else 1 end as is_current
        from (select {pad('s_nationkey', 3)} as div_nbr,
          cast(cast(floor(greatest(s_acctbal, 0) / 2000) as integer) as varchar) as contract_nbr,
          cast(max(cast(floor(s_acctbal / 1000) + 1 as decimal(3,0)) * 0.50) as decimal(5,2)) as erf_rate_pct,
          cast(max(cast(floor(s_acctbal / 1000) + 1 as decimal(3,0)) * 0.75) as decimal(5,2)) as frf_rate_pct,
          max(case when s_acctbal > 3000 then 1 else 0 end) as is_erf_locked,
          max(case when s_acctbal > 6000 then 1 else 0 end) as is_frf_locked,
          max(case when s_acctbal > 5000 then 1 else 0 end) as is_erf_on_frf from supplier group by 1, 2) g""",
    ),
    "dim_acct_fee": (
        (),
        " union all ".join(
            f"""select {pad('c_nationkey', 3)} as div_nbr, {pad('c_custkey', 7)} as acct_nbr, '{kind}' as fee_type,
            case when {charged} then 1 else 0 end as is_fee_charged,
            case when {enabled} then 1 else 0 end as is_acct_fee_enabled, date '1995-01-01' as eff_dt,
            case when {current} then date '9999-12-31' else date '1998-12-31' end as disc_dt,
            case when {current} then 1 else 0 end as is_current from customer"""
            for kind, charged, enabled, current in (
                ("FRF", "c_acctbal > 0", "c_mktsegment <> 'MACHINERY'", "c_mktsegment <> 'FURNITURE'"),
                ("EVR", "c_acctbal > 2000", "true", "true"),
                ("INV", "c_mktsegment in ('BUILDING', 'HOUSEHOLD')", "true", "true"),
            )
        ),
    ),
    "dim_division_fee": (
        ("nations",),
        f"""select {ym('m')} as month_dt, {pad('n_nationkey', 3)} as div_nbr,
        cast((n_regionkey + 1) * 1.25 as decimal(5,2)) as erf_rate, cast((n_regionkey + 2) * 1.10 as decimal(5,2)) as frf_rate,
        case when r_name <> 'ASIA' then 1 else 0 end as is_erf_enabled, 1 as is_frf_enabled
        from nations, (select unnest(generate_series(date '1995-01-01', date '2001-12-01', interval 1 month)) as m) c
        where r_name <> 'AFRICA' or m >= date '1996-01-01'""",
    ),
    "division_fee_rate": (
        ("nations",),
        f"""select {pad('n_nationkey', 3)} as div_nbr, cast((n_regionkey + 2) * 1.10 as decimal(5,2)) as frf_rate,
        cast((n_regionkey + 1) * 1.25 as decimal(5,2)) as erf_rate, cast(n_regionkey + 4.50 as decimal(5,2)) as admin_fee,
        case when r_name in ('AFRICA', 'EUROPE') then 1 else 0 end as erf_on_frf from nations""",
    ),
    "charge_rates": (
        ("placed_lines", "dim_charge_cd"),
        f"""select {pad('c_nationkey', 3)} as div_nbr, {pad('o_custkey', 7)} as acct_nbr,
        {pad('substr(o_orderpriority, 1, 1)', 5)} as site_nbr, cast(o_orderkey as varchar) as container_grp_nbr,
        charge_cd as charge_code, case when l_returnflag = 'N' then 'W' else 'R' end as charge_type,
        case when l_linestatus = 'F' then 'Q' else 'F' end as charge_method,
        'T' || cast(l_linenumber as varchar) as tax_app_code, cast(l_extendedprice as decimal(18,2)) as charge_rate,
        {ymd('least(o_orderdate, l_shipdate)')} as effective_date,
        case when l_linestatus = 'O' then 0 else {ymd('greatest(o_orderdate, l_shipdate)')} end as close_date,
        case when cast(l_tax as decimal(4,2)) = 0.08 then '1' else '0' end as adj_flag,
        case when cast(l_discount as decimal(4,2)) = 0.10 then 'N' when l_returnflag = 'N' then 'y' else 'Y' end as current_ind,
        l_shipdate as stamped_at
        from placed_lines left join dim_charge_cd on charge_cd_sk = l_returnflag || cast(l_linenumber as varchar)""",
    ),
}


def with_tables(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the named stand-in tables (and what they need) and by ``extra`` CTEs."""
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        needs, sql = CTES[name]
        for n in needs:
            add(n)
        ordered.setdefault(name, sql)

    for name in names:
        add(name)
    ordered.update(extra or {})
    head = ", ".join(f"{n} as ({sql})" for n, sql in ordered.items())
    return f"with {head} {body}" if head else body


def doubles(*names: str) -> str:
    return ", ".join(f"cast({n} as double) as {n}" for n in names)


def bigints(*names: str) -> str:
    return ", ".join(f"cast({n} as bigint) as {n}" for n in names)
