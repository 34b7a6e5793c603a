"""Residential retention campaign: audience, scoring, treatment, prices, contracts and results."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binledger.functions.dates import current_charge, date_of_day_key, day_key, month_key, tenure_months, tenure_years
from binledger.functions.labels import (
    ASSIGN_DEFAULT,
    HOLDOUT,
    LADDER_DEFAULT,
    hash_uniform,
    ladder_rate,
    offer_label,
    percentile_label,
    tenure_group,
    tenure_stratum,
    treatment_group,
    waste_stream,
)
from binledger.functions.money import (
    fee_load,
    lifts_per_week,
    raised,
    revenue_annual,
    revenue_per_bill,
    revenue_per_lift,
    yards_per_month,
)
from binledger.functions.text import base36, clean_email, email_reject_reason, postal_parts
from binledger.operators.audit import StageAudit, left_after, watched
from binledger.operators.grouping import any_flag, arg_max, at_most_sites, latest_row, month_columns, strict_sum, wide_flags
from binledger.operators.joins import drop_listed, if_small
from binledger.operators.ranking import ntile, percentile_rank, row_ids
from binledger.operators.rows import unless
from binledger.session import stage
from binledger.sources.tables import literal_table

ACCOUNT = ["div_nbr", "acct_nbr"]
CONTAINER = [*ACCOUNT, "site_nbr", "container_grp_nbr"]
FEE_KINDS = ("FRF", "EVR", "INV")

# Charge codes whose rate the itemised ladder keeps.
KEPT_RATE_CODES = ("NCC", "NCH", "RCC", "FRX", "FRE", "RSC", "DON", "YAR", "RC1", "DEL", "DSP", "NRS")

# Operating cost and depreciation per lift, by division and (newer markets) by company.
UNIT_COST_BY_DIVISION = {
    "923": ("1.76", "0.24"),
    "858": ("1.48", "0.46"),
    "899": ("1.29", "0.30"),
    "894": ("1.26", "0.31"),
    "282": ("1.01", "0.12"),
    "320": ("1.54", "0.24"),
    "865": ("1.92", "0.33"),
}
UNIT_COST_BY_COMPANY = {
    "3211": ("1.86", "0.34"),
    "3282": ("1.05", "0.12"),
    "4320": ("1.40", "0.24"),
    "3508": ("1.09", "0.19"),
    "4318": ("1.67", "0.12"),
    "4324": ("1.60", "0.24"),
}


# --- audience -------------------------------------------------------------------------------------


def clean_audience(customers: DataFrame, own_domain: str, email: str = "email") -> DataFrame:
    """Cleaned address plus ``reject_reason`` (NULL when usable); no row is lost."""
    cleaned = customers.withColumn(email, clean_email(F.col(email)))
    return cleaned.withColumn("reject_reason", email_reject_reason(F.col(email), own_domain))


def audience_steps(
    own_domain: str,
    divisions: Sequence[str] | None = None,
    excluded_zips: Sequence[str] = (),
    excluded_city: tuple[str, str] | None = None,
    residential_only: bool = True,
) -> dict[str, Column]:
    """Named keep-conditions of the audience in order, for ``funnel`` or a plain filter.

    The campaign variants differ only in which of the market filters they pass.
    """
    steps: dict[str, Column] = {}
    if residential_only:
        steps["eligible"] = (
            (F.col("franchise") == "N") & (F.col("national_acct") == "N") & (F.col("acct_type") != "Temp") & (F.col("email") != "")
        )
    steps["valid_email"] = email_reject_reason(clean_email(F.col("email")), own_domain).isNull()
    if divisions is not None:
        steps["market"] = F.col("div_nbr").isin(list(divisions))
    if excluded_zips:
        steps["zip"] = unless(postal_parts(F.col("postal_code"))[0].isin(list(excluded_zips)))
    if excluded_city:
        city, state = excluded_city
        steps["city"] = unless((F.upper("city") == city.upper()) & (F.col("state") == state))
    return steps


def without_opt_outs(rows: DataFrame, notes: DataFrame, on: Sequence[str] = ("div_nbr", "acct_nbr")) -> DataFrame:
    return drop_listed(rows, notes, on)


def next_review_dates(reviews: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Newest review row per account; accounts whose newest day is no calendar day drop out."""
    newest = latest_row(reviews, ACCOUNT, ["stamped_at"], tie)
    return newest.withColumn("review_dt", date_of_day_key(F.col("review_day"))).where(F.col("review_dt").isNotNull())


# --- revenue --------------------------------------------------------------------------------------


def container_revenue(
    charges: DataFrame,
    containers: DataFrame,
    day: int,
    excluded_acct_types: Sequence[str] = ("X", "T"),
    contract_grp: str = "0",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Current recurring charges per container group: bill and yearly revenue, largest repeat of one rate.

    Equal rates are counted while they are summed, so no window over the charge lines is needed.
    """
    live = charges.where(
        (F.col("charge_type") == "R")
        & current_charge(F.col("effective_date"), F.col("close_date"), day)
        & (F.upper("current_ind") == "Y")
    )
    per_rate = live.groupBy(*CONTAINER, "charge_method", "charge_rate").agg(F.count(F.lit(1)).alias("__n"))
    dims = containers.where(
        (F.col("is_current") == 1) & ~F.col("acct_type").isin(*excluded_acct_types) & (F.col("contract_grp_nbr") == contract_grp)
    ).select(*CONTAINER, "container_cnt", "recurring_charge_freq", *keep)
    per_bill = revenue_per_bill(F.col("charge_method"), F.col("charge_rate"), F.col("container_cnt"))
    billed = per_rate.join(dims, CONTAINER).withColumn("bill", per_bill)
    by_rate = billed.groupBy(*CONTAINER, "container_cnt", "recurring_charge_freq", *keep, "charge_rate").agg(
        F.sum("__n").alias("dup_cc"),
        F.sum(F.col("bill") * F.col("__n")).alias("revenue_per_bill"),
        F.sum(revenue_annual(F.col("bill"), F.col("recurring_charge_freq")) * F.col("__n")).alias("revenue_annual"),
    )
    return by_rate.groupBy(*CONTAINER, "container_cnt", "recurring_charge_freq", *keep).agg(
        F.max("dup_cc").alias("dup_cc"),
        F.sum("revenue_per_bill").alias("revenue_per_bill"),
        F.sum("revenue_annual").alias("revenue_annual"),
    )


def eligible_containers(
    revenue: DataFrame, open_after: dt.date, site_limit: int = 3, excluded_district: str = "91"
) -> DataFrame:
    """Containers outside the excluded district, of accounts with few sites, known pickups, still open, earning something."""
    placed = revenue.where(F.col("district_cd") != excluded_district)
    small = at_most_sites(placed, ACCOUNT, "site_nbr", site_limit)
    return small.where(
        (F.col("pickup_lifts") != 0)
        & (F.col("pickup_length") != 0)
        & (F.col("pickup_unit") != "UNKNOWN")
        & (F.col("close_dt") > F.lit(open_after))
        & (F.col("revenue_per_bill") > 0)
    )


def account_profile(
    revenue: DataFrame,
    open_after: dt.date,
    site_limit: int = 3,
    excluded_district: str = "91",
    audit: StageAudit | None = None,
) -> DataFrame:
    """Everything the campaign asks of an account's eligible containers, in one grouping per site and one per account.

    Equal to ``account_revenue``, ``waste_category`` and ``account_frequency`` over ``eligible_containers``, without
    computing the containers again for each: what is not eligible is left out of the sums but still counts as a site.
    An ``audit`` gets the containers left after each rule.
    """
    rules = {
        "pickups_known": (F.col("pickup_lifts") != 0) & (F.col("pickup_length") != 0) & (F.col("pickup_unit") != "UNKNOWN"),
        "open": F.col("close_dt") > F.lit(open_after),
        "earning": F.col("revenue_per_bill") > 0,
    }
    ok = reduce(lambda a, b: a & b, rules.values())
    in_district = F.col("district_cd") != excluded_district
    revenue = watched(audit, revenue, {"priced": F.count(F.lit(1)), "district": F.count(F.when(in_district, 1))})
    counted = {"few_sites": F.count(F.lit(1)), **left_after(rules)} if audit else {}
    stream = waste_stream(F.col("container_cd"))
    kept = {
        "lifts_per_week": (F.sum, lifts_per_week(F.col("pickup_lifts"), F.col("pickup_length"))),
        "base_revenue": (F.sum, F.col("revenue_annual")),
        "base_revenue_per_bill": (F.sum, F.col("revenue_per_bill")),
        "rcf": (F.max, F.col("recurring_charge_freq")),
        "yards": (F.max, yards_per_month(F.col("pickup_lifts"), F.col("pickup_length"), F.col("container_size"))),
        "close_dt": (F.max, F.col("close_dt")),
        **{s: (F.max, F.when(stream == s, s)) for s in ("SW", "RCY", "YW")},
    }
    sites = revenue.where(in_district).groupBy(*ACCOUNT, "site_nbr").agg(
        F.count(F.when(ok, 1)).alias("__n"),
        *[f(F.when(ok, c)).alias(name) for name, (f, c) in kept.items()],
        *[c.alias(f"__{step}") for step, c in counted.items()],
    )
    accounts = sites.groupBy(*ACCOUNT).agg(
        F.count(F.lit(1)).alias("__sites"), F.sum("__n").alias("__n"), *[f(name).alias(name) for name, (f, _) in kept.items()],
        *[F.sum(f"__{step}").alias(f"__{step}") for step in counted],
    )
    small = F.col("__sites") <= site_limit
    accounts = watched(audit, accounts, {s: F.coalesce(F.sum(F.when(small, F.col(f"__{s}"))), F.lit(0)) for s in counted})
    few = accounts.where((F.col("__sites") <= site_limit) & (F.col("__n") > 0))
    out = few.withColumns(
        {
            "waste_category": F.concat_ws("/", "SW", "RCY", "YW"),
            "base_rev_per_lift": revenue_per_lift(F.col("base_revenue").cast("double"), F.col("lifts_per_week")),
        }
    )
    return out.drop("__sites", "__n", "SW", "RCY", "YW", *[f"__{step}" for step in counted])


def account_frequency(containers: DataFrame) -> DataFrame:
    """Largest billing frequency over all sites of an account."""
    return containers.groupBy("acct_nbr").agg(F.max("recurring_charge_freq").alias("rcf"))


def account_revenue(containers: DataFrame) -> DataFrame:
    """Lifts, revenue and revenue per lift per account."""
    weekly = lifts_per_week(F.col("pickup_lifts"), F.col("pickup_length"))
    summed = containers.groupBy(*ACCOUNT).agg(
        F.sum(weekly).alias("lifts_per_week"),
        F.sum("revenue_annual").alias("base_revenue"),
        F.sum("revenue_per_bill").alias("base_revenue_per_bill"),
    )
    return summed.withColumn(
        "base_rev_per_lift", revenue_per_lift(F.col("base_revenue").cast("double"), F.col("lifts_per_week"))
    )


def waste_category(containers: DataFrame) -> DataFrame:
    """Waste streams of an account as one label (SW/RCY/YW order) and its latest close date."""
    stream = waste_stream(F.col("container_cd"))
    flags = [F.max(F.when(stream == s, s)).alias(s) for s in ("SW", "RCY", "YW")]
    grouped = containers.groupBy(*ACCOUNT).agg(*flags, F.max("close_dt").alias("close_dt"))
    return grouped.select(*ACCOUNT, F.concat_ws("/", "SW", "RCY", "YW").alias("waste_category"), "close_dt")


def fee_flags_wide(account_fees: DataFrame, as_of: dt.date) -> DataFrame:
    """Fees of an account that are valid on the day, one column per kind."""
    valid = account_fees.where((F.col("eff_dt") <= F.lit(as_of)) & (F.col("disc_dt") >= F.lit(as_of)))
    return wide_flags(valid, ACCOUNT, "fee_type", FEE_KINDS, "is_fee_charged")


def load_account_fees(accounts: DataFrame, flags: DataFrame, division_rates: DataFrame) -> DataFrame:
    """Yearly and per-bill revenue with admin fee, FRF and ERF.

    The per-bill ERF builds on the per-bill FRF; the original adds the yearly one there by mistake.
    """
    joined = accounts.join(flags, ACCOUNT, "left").join(if_small(division_rates), "div_nbr", "left")
    money = lambda name: F.col(name).cast("decimal(18,2)")

    def load(revenue: Column, admin: Column) -> dict[str, Column]:
        return fee_load(
            revenue, admin, F.col("FRF"), F.col("frf_rate"), F.col("EVR"), F.col("erf_rate"), F.col("INV"), F.col("erf_on_frf")
        )

    yearly = load(money("base_revenue"), F.col("admin_fee"))
    admin_per_bill = (F.col("admin_fee") / F.col("rcf")).cast("decimal(9,4)")
    bill = load(money("base_revenue_per_bill"), admin_per_bill)
    return joined.withColumns(
        {
            "revenue_with_admin": yearly["with_admin"],
            "frf_charge": yearly["frf"],
            "erf_charge": yearly["erf"],
            "revenue": yearly["total"],
            "revenue_per_bill": bill["total"],
        }
    ).drop("frf_rate", "erf_rate", "admin_fee", "erf_on_frf")


# --- scores, treatment, prices --------------------------------------------------------------------


def with_profitability(
    accounts: DataFrame, unit_costs: Mapping[str, tuple[str, str]], key: str = "div_nbr", per_lift: str = "rev_per_lift"
) -> DataFrame:
    """Revenue per lift less operating cost and depreciation; an unlisted key costs nothing."""
    spark = accounts.sparkSession
    costs = literal_table(
        spark,
        {key: list(unit_costs), "unit_cost": [float(c) for c, _ in unit_costs.values()], "depreciation": [float(d) for _, d in unit_costs.values()]},
    )
    # one row per listed key: the table is as large as the mapping in code
    joined = accounts.join(F.broadcast(costs), key, "left").fillna(0.0, ["unit_cost", "depreciation"])
    return joined.withColumn("profitability", F.col(per_lift) - F.col("unit_cost") - F.col("depreciation"))


def with_tenure(accounts: DataFrame, as_of: dt.date, opened: str = "acct_open_dt") -> DataFrame:
    return accounts.withColumns(
        {"tenure_years": tenure_years(F.col(opened), as_of), "tenure_months": tenure_months(F.col(opened), as_of)}
    )


def with_strata(accounts: DataFrame, division: str = "div_nbr", score: str = "profitability", tie: str = "acct_nbr") -> DataFrame:
    """Tenure band, percentile rank inside (division, band) and its label."""
    banded = accounts.withColumn("cat_tenure", tenure_stratum(F.col("tenure_years")))
    order = [F.col(score).asc(), F.col(tie).asc()]
    ranked = percentile_rank(banded, order, [division, "cat_tenure"], "local_rank")
    return ranked.withColumn("cat_rank", percentile_label(F.col("local_rank")))


def assign_treatment(accounts: DataFrame, salt: str, keys: Sequence[str] = ("div_nbr", "acct_nbr"), thresholds=ASSIGN_DEFAULT) -> DataFrame:
    """Reproducible random group per account; every account gets exactly one."""
    return accounts.withColumn("draw", hash_uniform(salt, *[F.col(k) for k in keys])).withColumn(
        "treatment", treatment_group(F.col("draw"), thresholds)
    )


def price_ladder(accounts: DataFrame, increases: Mapping[str, Decimal] = LADDER_DEFAULT, annual: str = "base_revenue") -> DataFrame:
    """Monthly price of three years; each step builds on the rounded step before. The holdout keeps its price."""
    group = F.col("treatment")
    year_1 = F.when(group == HOLDOUT, F.lit(Decimal(0))).otherwise((F.col(annual).cast("decimal(18,2)") / 12).cast("decimal(24,6)"))
    rate = ladder_rate(group, dict(increases))
    return (
        accounts.withColumn("year_1", year_1)
        .withColumn("year_2", raised(F.col("year_1"), rate))
        .withColumn("year_3", raised(F.col("year_2"), rate))
    )


def price_ladder_itemised(lines: DataFrame, increases: Mapping[str, Decimal], rate: str = "charge_rate") -> DataFrame:
    """Ladder per charge line, summed per account and brought to a month.

    Excluded codes keep their rate in every group; other lines of a holdout have no price, and one such
    line leaves the account without one. Year 3 compounds the unrounded year 2.
    """
    base = F.col(rate)
    step = ladder_rate(F.col("treatment"), dict(increases))
    grown = base * step + base
    kept = F.col("charge_code").isin(*KEPT_RATE_CODES)
    priced = lines.where(base > 0).withColumns(
        {
            "year_2": F.when(kept, base).otherwise(raised(base, step)),
            "year_3": F.when(kept, base).otherwise(F.round(grown + grown * step, 2)),
        }
    )
    bills = F.lit(12.0) / F.col("rcf")
    return priced.groupBy(*ACCOUNT, "treatment", "rcf").agg(
        strict_sum(F.col("year_2")).alias("year_2"), strict_sum(F.col("year_3")).alias("year_3"), F.sum(base).alias("year_1")
    ).withColumns({y: F.col(y).cast("double") / bills for y in ("year_1", "year_2", "year_3")})


YARD_WASTE_MIXES = ("SW/YW", "YW", "RCY/YW", "SW/RCY/YW")


def retention_campaign(
    profile: DataFrame,
    accounts: DataFrame,
    account_fees: DataFrame,
    division_rates: DataFrame,
    unit_costs: Mapping[str, tuple[str, str]],
    as_of: dt.date,
    salt: str,
    min_tenure_months: float = 18,
    thresholds=ASSIGN_DEFAULT,
    increases: Mapping[str, Decimal] = LADDER_DEFAULT,
    audit: StageAudit | None = None,
) -> DataFrame:
    """From ``account_profile`` to one priced row per account; the frequency is that of the account number's largest site.

    An ``audit`` gets the accounts left after each rule; its counts are whole when this returns.
    """
    # the profile feeds the account rows and the frequencies, and ranking samples its input: written once
    profile = stage(profile, "profile")
    largest = profile.groupBy("acct_nbr").agg(F.max("rcf").alias("rcf"))
    scored = profile.drop("rcf", "yards").join(largest, "acct_nbr")
    known = scored.join(accounts.select(*ACCOUNT, "acct_open_dt"), ACCOUNT)
    long_enough = F.col("tenure_months") > min_tenure_months
    aged = watched(audit, with_tenure(known, as_of), {"accounts": F.count(F.lit(1)), "tenure": F.count(F.when(long_enough, 1))})
    tenured = aged.where(long_enough)
    loaded = load_account_fees(tenured, fee_flags_wide(account_fees, as_of), division_rates)
    per_lift = revenue_per_lift(F.col("revenue").cast("double"), F.col("lifts_per_week"))
    scored = with_profitability(loaded.withColumn("rev_per_lift", per_lift), unit_costs)
    rules = {
        "revenue": F.col("revenue_per_bill") > 0,
        "profit": F.col("profitability") > 0,
        "no_yard_waste": ~F.col("waste_category").isin(*YARD_WASTE_MIXES),
    }
    scored = watched(audit, scored, left_after(rules))
    # written before it is ranked, as ranking samples its input
    profitable = stage(scored.where(rules["revenue"] & rules["profit"]), "profitable")
    kept = with_strata(profitable).where(rules["no_yard_waste"])
    return price_ladder(assign_treatment(kept, salt, thresholds=thresholds), increases)


# --- contracts and rate changes -------------------------------------------------------------------


def contract_numbers(takers: DataFrame, wave: str, order: Sequence[str], signed: str = "date_signed", prefix: str = "RM") -> DataFrame:
    """Numbered contracts of a wave with a three-year term, by calendar and by 1095 days."""
    numbered = row_ids(takers, [F.col(c).asc() for c in order], "contract_row")
    return numbered.withColumns(
        {
            "contract_number": F.concat(F.lit(prefix + wave), base36(F.col("contract_row"))),
            "term": F.lit("36"),
            "expiration_years": F.add_months(F.col(signed), 36),
            "expiration_days": F.date_add(F.col(signed), 1095),
        }
    )


def contract_rows(contracts: DataFrame, lines: DataFrame) -> DataFrame:
    """A contract row for every site that the account's rate lines name."""
    sites = lines.groupBy(*ACCOUNT, "site_nbr").agg(F.count(F.lit(1)).alias("rate_lines"))
    return sites.join(contracts, ACCOUNT)


def future_rate(charges: DataFrame, start_from: int, closed_by: int) -> DataFrame:
    """Per container: sum of rates starting late enough and closed in time; NULL when there is none.

    ``older_form`` sums everything starting after the same day, open or not.
    """
    late = F.col("effective_date") >= start_from
    closed = (F.col("close_date") <= closed_by) & (F.col("close_date") != 0)
    return charges.groupBy(*CONTAINER).agg(
        F.sum(F.when(late & closed, F.col("charge_rate"))).alias("future_rate"),
        F.sum(F.when(F.col("effective_date") > start_from, F.col("charge_rate"))).alias("older_form"),
    )


def latest_charges(charges: DataFrame, tie: Sequence[str] = ("charge_rate", "close_date")) -> DataFrame:
    """Newest row per charge of a container, by stamp and then by start; the oldest campaign's idea of "current"."""
    keys = [*CONTAINER, "charge_code", "charge_type", "charge_method"]
    return latest_row(charges, keys, ["stamped_at", "effective_date"], tie)


def rate_change_split(charges: DataFrame, takers: DataFrame, day: int, excluded_codes: Sequence[str] = ()) -> DataFrame:
    """Takers' charges split into the rate valid on ``day`` and the one starting later; holdouts are left out.

    Keeps charges that have a future rate and states the group's increase. One variant of the upload
    passes ``KEPT_RATE_CODES`` as codes to leave out.
    """
    if excluded_codes:
        charges = charges.where(~F.col("charge_code").isin(*excluded_codes))
    digit = F.substring("treatment", 2, 1)
    rows = charges.join(takers.where(F.col("treatment") != HOLDOUT), ACCOUNT)
    eff, cld = F.col("effective_date"), F.col("close_date")
    now = ((eff <= day) & (cld >= day)) | ((eff < day) & (cld == 0))
    zero = F.lit(Decimal(0))
    summed = rows.groupBy(*CONTAINER, "charge_code", "charge_type", "charge_method", "treatment").agg(
        F.sum(F.when(now, F.col("charge_rate")).otherwise(zero)).alias("current_rate"),
        F.sum(F.when(eff > day, F.col("charge_rate")).otherwise(zero)).alias("future_rate"),
    )
    step = F.when(digit == "1", F.lit(Decimal("0.04"))).when(digit == "2", F.lit(Decimal("0.10")))
    return summed.where(F.col("future_rate") != 0).withColumn("percent_increase", step)


def rate_change_upload(
    lines: DataFrame,
    tax_codes: DataFrame,
    increases: Mapping[str, Decimal] = LADDER_DEFAULT,
    years: int = 1,
    contracts: DataFrame | None = None,
) -> DataFrame:
    """Upload rows: the new rate starts one year after the later of charge start and signature.

    ``years=2`` adds the follow-up file: same charge, one year later, raised once more. With ``contracts`` (account, site,
    contract_number) only lines of a site under contract go up, with its number, and lines without ``rev_distrib_cd``
    or ``recurring_charge_freq`` stay out. Of several contracts of a site the smallest number counts.
    """
    if contracts is not None:
        site = [*ACCOUNT, "site_nbr"]
        numbers = contracts.groupBy(*site).agg(F.min("contract_number").alias("contract_number"))
        lines = lines.dropna(subset=["rev_distrib_cd", "recurring_charge_freq"]).join(numbers, site)
    on = [*CONTAINER, "charge_code", "charge_rate", "charge_type", "charge_method"]
    step = ladder_rate(F.col("treatment"), dict(increases))
    started = F.greatest(date_of_day_key(F.col("effective_date")), F.col("date_signed"))
    tax_codes = tax_codes.groupBy(*on).agg(*[F.min(c).alias(c) for c in tax_codes.columns if c not in on])
    first = lines.join(tax_codes, on, "left").withColumns(
        {"new_effective": F.date_add(started, 365), "new_rate": raised(F.col("charge_rate"), step), "upload_year": F.lit(1)}
    )
    if years == 1:
        return first
    follow_up = {
        "effective_date": day_key(F.col("new_effective")),
        "new_effective": F.date_add("new_effective", 365),
        "charge_rate": F.col("new_rate"),
        "new_rate": raised(F.col("new_rate"), step),
        "upload_year": F.lit(2),
    }
    # both years from one row, so that the join is made once; a raised rate may have more digits
    second = first.withColumns(follow_up).select(first.columns)
    kinds = {f.name: f.dataType for f in first.unionByName(second).schema.fields}
    years_of = [
        F.struct(*[values.get(c, F.col(c)).cast(kinds[c]).alias(c) for c in first.columns]) for values in ({}, follow_up)
    ]
    return first.select(F.inline(F.array(*years_of)))


# --- waves and results ----------------------------------------------------------------------------


def merge_waves(panel: DataFrame, takers: DataFrame, declined: DataFrame, excluded: DataFrame, send_dates: Mapping[int, dt.date], key: str) -> DataFrame:
    """Taker flag per wave, signature of the newest wave, declined flag, send dates of waves not excluded before.

    ``takers`` holds key, wave, date_signed; ``excluded`` holds key and the wave excluded from.
    One grouped row per account replaces a join per wave.
    """
    waves = sorted(send_dates)
    wave = F.col("wave")
    signed = takers.groupBy(key).agg(
        *[any_flag(wave == w).alias(f"wave_{w}") for w in waves],
        *[F.min(F.when(wave == w, F.col("date_signed"))).alias(f"__signed_{w}") for w in waves],
    )
    barred = excluded.groupBy(key).agg(*[any_flag(wave <= w).alias(f"__barred_{w}") for w in waves])
    said_no = declined.select(key).distinct().withColumn("declined", F.lit(1))
    merged = panel.join(signed, key, "left").join(said_no, key, "left").join(barred, key, "left")
    newest_first = F.coalesce(*[F.col(f"__signed_{w}") for w in reversed(waves)])
    out = {"declined": F.coalesce("declined", F.lit(0)), "date_signed": newest_first}
    for w in waves:
        out[f"wave_{w}"] = F.coalesce(F.col(f"wave_{w}"), F.lit(0))
        out[f"wave_{w}_dt"] = F.when(F.coalesce(F.col(f"__barred_{w}"), F.lit(0)) == 0, F.lit(send_dates[w]))
    return merged.withColumns(out).drop(*[f"__{p}_{w}" for p in ("signed", "barred") for w in waves])


def closed_charges(charges: DataFrame, start_after: int, until: int) -> DataFrame:
    """Accounts with a charge that started after the first day and closed between it and the second."""
    closed = (F.col("close_date") > start_after) & (F.col("close_date") <= until)
    return charges.where((F.col("effective_date") > start_after) & closed).select(*ACCOUNT).distinct()


def exclusion_list(audience: DataFrame, takers: DataFrame, declined: DataFrame, changed: DataFrame, key: str, email: str) -> DataFrame:
    """Accounts not to be mailed again: takers, decliners and audience accounts with a closed charge."""
    answered = takers.select(key).unionByName(declined.select(key)).join(audience.select(key, email), key, "left")
    recent = audience.select(key, email).join(changed.select(key), key, "left_semi").where(F.col(email).isNotNull())
    return answered.unionByName(recent).distinct()


def campaign_panel(accounts: DataFrame, monthly: DataFrame, months: Sequence[int], values: Mapping[str, str]) -> DataFrame:
    """Accounts with status and value columns per month; (account, month) must be unique in ``monthly``."""
    wide = month_columns(monthly, ACCOUNT, "month_dt", months, values)
    added = [c for c in wide.columns if c not in ACCOUNT]
    return accounts.join(wide, ACCOUNT, "left").fillna(0, added)


def campaign_summary(
    panel: DataFrame, months: Sequence[int], values: Sequence[str], first_value: str, waves: Sequence[str] | None = None
) -> DataFrame:
    """Takers, revenue and active accounts per division, offer, revenue quintiles, tenure and future rate.

    A taker answered any of ``waves``, by default every column ``wave_<n>`` of the panel.
    """
    waves = [c for c in panel.columns if re.fullmatch(r"wave_\d+", c)] if waves is None else waves
    yards = F.col("total_yard_month")
    per_yard = lambda amount: F.when(yards == 0, F.lit(0.0)).otherwise(amount.cast("double") / yards)
    scored = panel.withColumns(
        {"__start": per_yard(F.col("revenue_annual")), "__first": per_yard(F.col(f"{first_value}_{months[0]}"))}
    )
    tie = F.col("acct_nbr").asc()
    scored = ntile(scored, 5, [F.col("__start").asc(), tie], ["div_nbr"], "revenue_group_start")
    scored = ntile(scored, 5, [F.col("__first").asc(), tie], ["div_nbr"], "revenue_group_first")
    taker = reduce(lambda a, b: a | b, [F.coalesce(F.col(w) == 1, F.lit(False)) for w in waves], F.lit(False))
    labelled = scored.withColumns(
        {
            "group_desc": offer_label(F.col("treatment")),
            "tenure_grp": tenure_group(F.col("tenure_months")),
            "taker": F.when(taker, 1).otherwise(0),
            "taker_signed": F.when(F.col("date_signed").isNotNull(), 1).otherwise(0),
            "future_rate": F.when(F.col("future_revenue_per_bill").isNotNull(), "Future Rate").otherwise("No Future Rate"),
            "future_rate_higher": F.when(F.col("future_revenue_per_bill") > F.col("revenue_per_bill"), 1).otherwise(0),
        }
    )
    keys = [
        "div_nbr", "group_desc", "revenue_group_start", "revenue_group_first", "tenure_grp", "taker", "taker_signed",
        "future_rate", "future_rate_higher",
    ]
    sums = [F.sum(f"{v}_{m}").alias(f"{v}_{m}") for m in months for v in ("active", *values)]
    return labelled.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("accts_start"),
        any_sum("taker", "taker_signed").alias("num_takers"),
        F.sum("revenue_annual").alias("revenue_annual_start"),
        (F.sum("revenue_annual").cast("double") / 12).alias("revenue_monthly_start"),
        F.sum("tenure_months").alias("total_tenure_months"),
        F.sum("total_yard_month").alias("total_yard_month"),
        *sums,
    )


def any_sum(*flags: str) -> Column:
    """Rows where at least one flag is set."""
    return F.sum(F.when(F.greatest(*[F.col(f) for f in flags]) > 0, 1).otherwise(0))


def monthly_revenue(orders: DataFrame, day: str, amount: str, keys: Sequence[str] = ("div_nbr", "acct_nbr")) -> DataFrame:
    """One row per account and month."""
    return orders.groupBy(*keys, month_key(F.col(day)).alias("month_dt")).agg(F.sum(amount).alias("rate_per_month"))


def largest_frequency_rows(containers: DataFrame, tie: Sequence[str]) -> DataFrame:
    """The container row that holds its account's largest billing frequency."""
    return arg_max(containers, ["acct_nbr"], "recurring_charge_freq", tie)
