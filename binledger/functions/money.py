"""Rates, fees and revenue as column expressions.

Amounts are meant to be decimals: every rule here is exact for decimal inputs.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

PERCENT = Decimal("0.01")
WEEKS_PER_YEAR = 52
POUNDS_PER_KG = Decimal("2.20462")
KG_PER_POUND = Decimal("0.453592")


def dec(value: str | int) -> Column:
    return F.lit(Decimal(str(value)))


def as_units(value: Column, scale: int) -> Column:
    """Decimal with ``scale`` digits as a whole number of its smallest unit; sums of it stay 8 bytes wide."""
    return (value.cast(f"decimal(18,{scale})") * F.lit(Decimal(10) ** scale)).cast("long")


def from_units(units: Column, scale: int) -> Column:
    """Back to a decimal of 18 digits, which a row holds as one long."""
    return (units.cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(18,{scale})")


def off_when(flag: Column, value: Column) -> Column:
    """``value`` times a 0/1 flag whose NULL counts as 1."""
    return F.when(F.coalesce(flag, F.lit(1)) == 1, value).otherwise(F.lit(Decimal(0)))


def division_fee_fraction(percent: Column, enabled: Column) -> Column:
    return F.when(enabled == 1, percent * F.lit(PERCENT)).when(enabled == 0, F.lit(Decimal(0)))


def effective_fee_rate(
    locked: Column, contract_pct: Column, division_pct: Column, enabled: Column, charged: Column
) -> Column:
    """Fee as a fraction: the contract's percent when locked, else the division's.

    A locked fee ignores a missing ``enabled``; an unlocked one needs it.
    """
    is_locked = F.coalesce(locked, F.lit(0))
    by_contract = off_when(enabled, contract_pct * F.lit(PERCENT))
    by_division = division_fee_fraction(division_pct, enabled)
    return F.when(is_locked == 1, off_when(charged, by_contract)).when(is_locked == 0, off_when(charged, by_division))


def fee_multiplier(erf_on_frf: Column, frf: Column, erf: Column) -> Column:
    """Factor from base to fee-loaded revenue; the flag compounds the two fees."""
    return F.when(F.coalesce(erf_on_frf, F.lit(0)) == 1, (1 + frf) * (1 + erf)).otherwise(1 + erf + frf)


def fee_load(
    revenue: Column,
    admin_fee: Column,
    frf_flag: Column,
    frf_pct: Column,
    erf_flag: Column,
    erf_pct: Column,
    inv_flag: Column,
    erf_on_frf: Column,
) -> dict[str, Column]:
    """Account fees on one revenue basis: admin first, then FRF, then ERF (on FRF when so set)."""
    zero = F.lit(Decimal(0))
    base = revenue + F.when(inv_flag == 1, admin_fee).when(inv_flag == 0, zero)
    frf = F.when(frf_flag == 1, base * (frf_pct * F.lit(PERCENT))).when(frf_flag == 0, zero)
    erf_base = F.when(erf_on_frf == 1, base + frf).when(erf_on_frf == 0, base + zero)
    erf = F.when(erf_flag == 1, erf_base * (erf_pct * F.lit(PERCENT))).when(erf_flag == 0, zero)
    return {"with_admin": base, "frf": frf, "erf": erf, "total": base + frf + erf}


def revenue_per_bill(method: Column, rate: Column, containers: Column) -> Column:
    """Method ``Q`` bills per container, any other per line."""
    return F.when(F.upper(method) == "Q", rate * containers).otherwise(rate)


def revenue_annual(per_bill: Column, frequency: Column) -> Column:
    return per_bill * frequency


def lifts_per_week(lifts: Column, period_length: Column) -> Column:
    return F.try_divide(lifts, period_length)


def revenue_per_lift(annual: Column, weekly_lifts: Column) -> Column:
    return F.try_divide(annual, weekly_lifts * WEEKS_PER_YEAR)


def yards_per_month(lifts: Column, period_length: Column, size: Column) -> Column:
    return F.try_divide(F.lit(1.0), period_length) * F.lit(52 / 12) * lifts * size


def ceil_to(value: Column, step: Decimal | Column) -> Column:
    """Smallest multiple of ``step`` not below ``value``."""
    step = F.lit(step) if isinstance(step, Decimal) else step
    return F.ceil(value / step) * step


def kg_to_pounds(kg: Column) -> Column:
    return F.round(kg * F.lit(POUNDS_PER_KG), 2)


def pounds_to_kg(pounds: Column) -> Column:
    return F.round(pounds * F.lit(KG_PER_POUND), 2)


def raised(rate: Column, percent: Column | Decimal, digits: int = 2) -> Column:
    percent = F.lit(percent) if isinstance(percent, Decimal) else percent
    return F.round(rate + rate * percent, digits)
