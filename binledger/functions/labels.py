"""Labels the jobs put on rows: account status, bands, offers, treatment groups."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

HOLDOUT = "HO"

# Lower bounds of the uniform draw per treatment group, highest first.
ASSIGN_DEFAULT = (("HO", 0.8), ("A11", 0.55), ("A12", 0.3), ("A21", 0.15), ("A22", 0.0))
ASSIGN_NEW_MARKETS = (("HO", 0.6667), ("A11", 0.5), ("A12", 0.3333), ("A21", 0.16667), ("A22", 0.0))

# Yearly increase per treatment group.
LADDER_DEFAULT = {"A11": Decimal("0.04"), "A12": Decimal("0.04"), "A21": Decimal("0.10"), "A22": Decimal("0.10")}
LADDER_NEW_MARKETS = {"A11": Decimal("0.06"), "A12": Decimal("0.06"), "A21": Decimal("0.12"), "A22": Decimal("0.12")}

# Container codes that count as recycling and as yard waste.
RECYCLING_CODES = ("FR", "BB", "RR", "IR", "RC", "AS", "AN", "AO")
YARD_WASTE_CODES = ("YC", "YW")


def account_status(new_acct: Column, lost_acct: Column, opened: Column, closed: Column) -> Column:
    """First match wins; a row without flags has no status."""
    existing = (new_acct == 0) & (lost_acct == 0)
    return (
        F.when((new_acct == 1) & (lost_acct == 0), "NEW ACCOUNT")
        .when(lost_acct == 1, "LOST ACCOUNT")
        .when(existing & (opened == 1) & (closed == 0), "EXISTING - NEW CONTAINER")
        .when(existing & (closed == 1), "EXISTING - CLOSED CONTAINER")
        .when(existing & (opened == 0) & (closed == 0), "EXISTING - NO CHANGE")
    )


def first_match(rules: list[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """CASE from (condition, label) pairs."""
    chain = reduce(lambda acc, rule: acc.when(*rule), rules[1:], F.when(*rules[0]))
    return chain if otherwise is None else chain.otherwise(otherwise)


def tenure_stratum(years: Column) -> Column:
    """Three bands of the campaign strata; the edges differ on purpose (3 in, 6 out)."""
    return first_match(
        [(years <= 3, "less than 3 yrs"), (years < 6, "3 to 6 years"), (years >= 6, "greater than 6 yrs")]
    )


def tenure_range(months: Column) -> Column:
    """Bands of the monthly panel. Month 36, gaps between bands and NULL fall in the last one."""
    return first_match(
        [
            (months < 36, "Less than 3 Years"),
            (months.between(37, 72), "Between 3 and 6 Years"),
            (months.between(73, 120), "Between 6 and 10 Years"),
            (months.between(121, 180), "Between 10 and 15 Years"),
        ],
        "Over 15 Years",
    )


def tenure_group(months: Column) -> Column:
    """Bands of the campaign summary; NULL is an error label of its own."""
    return first_match(
        [
            (months <= 18, "18 mo or less"),
            (months <= 36, "19 mo to 3 yrs"),
            (months <= 60, "3 to 6 yrs"),
            (months <= 108, "6 to 9 yrs"),
            (months > 108, "more than 9 yrs"),
        ],
        "err",
    )


def offer_label(group: Column) -> Column:
    return first_match(
        [
            (group.isin("A21", "A22"), "10% offer"),
            (group.isin("A11", "A12"), "4% offer"),
            (group == HOLDOUT, "Holdout"),
        ],
        "err",
    )


def percentile_label(rank: Column) -> Column:
    return first_match([(rank <= 25, "0-25%"), (rank <= 75, "25-75%"), (rank > 75, "75-100%")])


def waste_stream(container_code: Column) -> Column:
    """Recycling, yard waste or, for every other code and NULL, solid waste."""
    return (
        F.when(container_code.isin(*RECYCLING_CODES), "RCY").when(container_code.isin(*YARD_WASTE_CODES), "YW").otherwise("SW")
    )


def hash_uniform(salt: str, *keys: Column) -> Column:
    """Reproducible draw in [0, 1) from the row's key."""
    digest = F.md5(F.concat(F.lit(salt + "|"), F.concat_ws("|", *[k.cast("string") for k in keys])))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def treatment_group(draw: Column, thresholds=ASSIGN_DEFAULT) -> Column:
    return first_match([(draw >= bound, group) for group, bound in thresholds])


def ladder_rate(group: Column, increases: dict[str, Decimal]) -> Column:
    """Increase of the group as a fraction, NULL for the holdout."""
    return reduce(lambda acc, g: acc.when(group == g, F.lit(increases[g])), list(increases)[1:],
                  F.when(group == list(increases)[0], F.lit(increases[list(increases)[0]])))
