"""Schemas of the billing warehouse tables and of the exchanged files.

Money is decimal, validity ends are ``9999-12-31`` for dates and 0 for ``yyyymmdd`` ints.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = "decimal(18,2)"

TABLES: dict[str, str] = {
    "invoice_detail": f"""revenue_period int, acct_sk long, container_grp_sk long, charge_cd_sk string,
        corp_hier_sk long, rate_sk long, revenue_amt {MONEY}, qty_billed {MONEY}, is_credit int,
        is_updated int, is_deleted int, is_merged int, is_split int""",
    "service_detail": """service_day int, service_cd_sk string, container_grp_sk long, corp_hier_sk long,
        acct_sk long, container_cnt int, is_deleted int, is_updated int""",
    "dim_acct": """acct_sk long, div_nbr string, acct_nbr string, acct_open_dt date, acct_close_dt date,
        is_national_account int, is_current int""",
    "dim_container_grp": """container_grp_sk long, div_nbr string, acct_nbr string, site_nbr string,
        container_grp_nbr string, container_cnt int, container_size int, container_cd string, is_franchise int,
        orig_start_dt date, close_dt date, contract_nbr string, contract_grp_nbr string, rev_distrib_cd string,
        acct_type string, district_cd string, recurring_charge_freq int, pickup_lifts int, pickup_length int,
        pickup_unit string, is_current int""",
    "dim_corp_hier": """corp_hier_sk long, cur_region_nm string, cur_area_nbr string, cur_area_nm string,
        cur_div_nbr string, cur_div_nm string, cur_bu_nbr string, cur_bu_desc string, div_nbr string,
        div_nm string, rev_distrib_cd string, cur_lob_category string, is_current int""",
    "dim_charge_cd": "charge_cd_sk string, charge_cd string",
    "dim_service_cd": "service_cd_sk string, service_cd string",
    "dim_rate_hist": f"rate_sk long, rate_amt {MONEY}",
    "dim_contract_fee": """div_nbr string, contract_nbr string, contract_grp_nbr string, erf_rate_pct decimal(5,2),
        frf_rate_pct decimal(5,2), is_erf_locked int, is_frf_locked int, is_erf_on_frf int, eff_dt date,
        disc_dt date, is_current int""",
    "dim_acct_fee": """div_nbr string, acct_nbr string, fee_type string, is_fee_charged int,
        is_acct_fee_enabled int, eff_dt date, disc_dt date, is_current int""",
    "dim_division_fee": """month_dt int, div_nbr string, erf_rate decimal(5,2), frf_rate decimal(5,2),
        is_erf_enabled int, is_frf_enabled int""",
    "division_fee_rate": """div_nbr string, frf_rate decimal(5,2), erf_rate decimal(5,2), admin_fee decimal(9,2),
        erf_on_frf int""",
    "charge_rates": f"""div_nbr string, acct_nbr string, site_nbr string, container_grp_nbr string,
        charge_code string, charge_type string, charge_method string, tax_app_code string, charge_rate {MONEY},
        effective_date int, close_date int, adj_flag string, current_ind string, stamped_at timestamp""",
    "review_date": "div_nbr string, acct_nbr string, review_day int, stamped_at timestamp",
    "code_table": "domain string, code string, description string, status string",
    "monthly_residential": f"div_nbr string, acct_nbr string, month_dt int, rate_per_month {MONEY}, revenue_amt {MONEY}",
}

FILES: dict[str, str] = {
    "price_intake": """line_no int, comp string, acct string, site string, cgrp string, cont_type string, qty int,
        size decimal(9,2), lifts string, compactor string, charge_code string, type string, method string,
        charge_rate decimal(18,2), new_rate decimal(18,4), effective_date string, tran_code string,
        rsn_code string, na string, uom string, wmt string""",
    "engagement": "account string, recycle string, solid_waste string",
    "executed_contracts": "account string, email string, date_signed string",
    "uplift": "account_tag string, uplift double",
}


def schema_of(name: str) -> T.StructType:
    ddl = TABLES.get(name) or FILES[name]
    return T.StructType.fromDDL(ddl)
