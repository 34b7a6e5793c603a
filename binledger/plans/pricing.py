"""Residential price increase: intake of field files, population, pricing sheet, upload files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binledger.functions.dates import serial_or_iso_date, us_date_text
from binledger.functions.money import ceil_to
from binledger.functions.text import pad_key
from binledger.operators.grouping import detail_with_subtotals
from binledger.operators.ranking import group_index, row_ids
from binledger.operators.rows import accept_reject, unless

COMMERCIAL_STOP = "cfr"

# Charge codes, divisions and the token rate the price increase leaves alone; upload codes.
SKIPPED_CODES = ("RCC", "NCH", "EVR", "NRS", "ADM")
SKIPPED_CODE_PREFIX = "FR"
SKIPPED_DIVISIONS = ("971", "384", "972")
TOKEN_RATE = Decimal("1.68")
TRANSACTION_CODE, REASON_CODE = "3", "64"

SHEET_KEYS = ["div_nbr", "stop_code", "rate_type", "district", "charge_code", "rcf", "monthly_rate", "charge_rate"]


@dataclass(frozen=True)
class PriceDates:
    """Dates of a run, all derived from its month."""

    run_month: dt.date

    def _shift(self, months: int) -> dt.date:
        at = self.run_month.year * 12 + self.run_month.month - 1 + months
        return dt.date(at // 12, at % 12 + 1, 1)

    @property
    def residential(self) -> dt.date:
        return self._shift(4)

    @property
    def commercial(self) -> dt.date:
        return self._shift(2)

    @property
    def review_pattern(self) -> str:
        return f"{self.run_month:%m}/__/{self.run_month:%Y}"

    @property
    def year_start(self) -> str:
        return f"{self.run_month:%Y}0101"


# --- intake ---------------------------------------------------------------------------------------


def intake(lines: DataFrame, stamp: dt.datetime) -> DataFrame:
    """Field lines with padded company, two-decimal rate, a natural key and a stamp; lines without a group drop out."""
    comp = pad_key(F.col("comp").try_cast("long"), 3)
    acct, site, group = (F.col(c).try_cast("int") for c in ("acct", "site", "cgrp"))
    day = F.try_to_date("effective_date", "MM/dd/yyyy")
    return lines.withColumns(
        {
            "comp": comp,
            "acct": acct,
            "site": site,
            "cgrp": group,
            "new_rate": F.round(F.col("new_rate"), 2).cast("decimal(18,2)"),
            "effective_date": us_date_text(day),
            "unique_key": F.concat(comp, *[c.cast("string") for c in (acct, site, group)], F.col("charge_code")),
            "stamped_at": F.lit(stamp),
        }
    ).where(F.col("cgrp").isNotNull())


def backdated(lines: DataFrame, charges: DataFrame, effective: dt.date) -> DataFrame:
    """Back-dated lines with the tax code of the current charge on eight keys and the day before as close date.

    ``reject_reason`` marks lines without number or account; they take no part in the join.
    """
    marked = accept_reject(lines, {"no line number": F.col("line_no").isNull(), "no account": F.col("acct").isNull()})
    keyed = marked.withColumns(
        {
            "comp": pad_key(F.col("comp").try_cast("long"), 3),
            "site": pad_key(F.col("site").try_cast("long"), 5),
            "charge_rate": F.round("charge_rate", 2).cast("decimal(18,2)"),
        }
    )
    # equal charges on all eight keys are one charge; of several tax codes the smallest counts
    live = charges.where((F.upper("current_ind") == "Y") & (F.col("adj_flag") == "0")).select(
        F.col("div_nbr").alias("k_comp"), F.col("acct_nbr").alias("k_acct"), F.col("site_nbr").alias("k_site"),
        F.col("container_grp_nbr").alias("k_cgrp"), F.col("charge_code").alias("k_charge_code"),
        F.col("charge_rate").cast("decimal(18,2)").alias("k_charge_rate"), F.col("charge_type").alias("k_type"),
        F.col("charge_method").alias("k_method"), "tax_app_code",
    )
    live = live.groupBy(*[c for c in live.columns if c != "tax_app_code"]).agg(F.min("tax_app_code").alias("tax_app_code"))
    names = ["comp", "acct", "site", "cgrp", "charge_code", "charge_rate", "type", "method"]
    match = [F.col(n) == F.col(f"k_{n}") for n in names] + [F.col("reject_reason").isNull()]
    joined = keyed.join(live, match, "left").drop(*[f"k_{n}" for n in names])
    return joined.withColumns(
        {"new_rate": F.round("new_rate", 2).cast("decimal(18,2)"), "close_date": F.lit(effective - dt.timedelta(days=1))}
    )


# --- population and sheet -------------------------------------------------------------------------


def population(prices: DataFrame, dates: PriceDates, exclusion: Column | None = None) -> DataFrame:
    """Charges whose review date lies in the run month and whose rate may be raised."""
    rate, changed = F.col("curr_charge_rate"), F.col("eff_date")
    commercial = F.lower("stop_cd") == COMMERCIAL_STOP
    as_text = lambda d: f"{d:%Y%m%d}"
    kept = (
        prices.where(
            ~F.col("div_nbr").isin(*SKIPPED_DIVISIONS)
            & ~F.col("charge_cd").isin(*SKIPPED_CODES)
            & ~F.col("charge_cd").like(SKIPPED_CODE_PREFIX + "%")
            & (rate > 0)
            & (rate != F.lit(TOKEN_RATE))
            & ((~commercial & (changed < as_text(dates.residential))) | (commercial & (changed < as_text(dates.commercial))))
            & (changed < dates.year_start)
            & F.col("nrd").like(dates.review_pattern)
        )
        .distinct()
    )
    return kept if exclusion is None else kept.where(unless(exclusion))


def sheet_rows(prices: DataFrame) -> DataFrame:
    """The columns of the pricing sheet; the sheet computes in doubles as a spreadsheet does."""
    rate = F.col("curr_charge_rate").cast("double")
    return prices.select(
        "area", "bu", "div_nbr", "acct_nbr", "site_nbr", "group_nbr",
        F.col("stop_cd").alias("stop_code"), "rate_type", "district", F.col("charge_cd").alias("charge_code"), "rcf",
        (rate * F.col("rcf") / 12).alias("monthly_rate"), rate.alias("charge_rate"), "container_size",
        F.lit(1).alias("active_cust"),
    )


@dataclass(frozen=True)
class SheetRules:
    """Parameters in the sheet's head: rounding step, base and large-container percent and the code of the latter."""

    step: float = 0.25
    base_pct: float = 0.04
    large_pct: float = 0.06
    large_code: str = ""
    least_increase: float = 0.75
    entered_area: str | None = None


def pricing_sheet(rows: DataFrame, rules: SheetRules) -> DataFrame:
    """The sheet's formulas as columns.

    ``entered`` is what the area types in; one area has it computed from its current revenue.
    """
    s, x, y, r = F.col("monthly_rate"), F.col("charge_rate"), F.col("active_cust"), F.col("rcf")
    large = (F.col("stop_code") == rules.large_code) & (F.col("container_size") > 1)
    stepped = lambda value, step: ceil_to(value, F.lit(step))
    out = rows.withColumn("new_monthly", s * (1 + F.when(large, F.lit(rules.large_pct)).otherwise(F.lit(rules.base_pct))))
    t = F.col("new_monthly")
    out = out.withColumn("suggested", F.when(t - s < rules.least_increase, s + rules.least_increase).otherwise(stepped(t, rules.step)))
    out = out.withColumns({"current_revenue": y * s, "proposed_revenue": y * F.col("suggested"), "increase_pct": F.try_divide(F.col("suggested"), s) - 1})
    z = F.col("current_revenue")
    if "entered" not in rows.columns:
        computed = stepped(F.when(z < 15, z * 1.2).when(z < 24, z * 1.15).otherwise(z * 1.1), 0.25)
        in_area = F.col("area") == rules.entered_area if rules.entered_area else F.lit(False)
        out = out.withColumn("entered", F.when(in_area, computed).otherwise(F.lit(0.0)))
    ac = F.col("entered")
    out = out.withColumns({"new_charge_rate": ac * 12 / r, "variance": ac - s, "revenue_increase": F.col("proposed_revenue") - z})
    ad = F.col("new_charge_rate")
    out = out.withColumns(
        {
            "pi_pct": F.try_divide(ad, x) - 1,
            "revenue_after": F.when(ac == 0, z).otherwise((ad * r / 12) * y),
            "change_in_rate": F.when(ac == 0, F.lit(None)).otherwise(ac - s),
        }
    )
    gain = F.col("revenue_after") - z
    return out.withColumns(
        {
            "monthly_gain": gain,
            "base_not_increased": F.when(gain == 0, z).otherwise(F.lit(0.0)),
            "base_increased": F.when(gain > 0, z).otherwise(F.lit(0.0)),
        }
    )


def indexed_sheet(rows: DataFrame) -> DataFrame:
    """Number the distinct price lines inside each area and business unit."""
    return group_index(rows, SHEET_KEYS, ["area", "bu"], "sheet_index")


def sheet_with_subtotals(indexed: DataFrame) -> DataFrame:
    """Sheet rows plus one row per index with its customer count."""
    return detail_with_subtotals(indexed, ["area", "bu", "sheet_index", *SHEET_KEYS], ["active_cust"])


# --- returned sheets and upload -------------------------------------------------------------------


def returned_dates(rows: DataFrame, column: str = "nrd") -> DataFrame:
    """Review dates of returned sheets, written as ISO text or as day serials."""
    return rows.withColumn(column, serial_or_iso_date(F.col(column)))


def upload_split(rows: DataFrame, dates: PriceDates) -> DataFrame:
    """Upload lines with a ``target`` file: residential keeps increases only, commercial never goes down."""
    commercial = F.lower("stop_code") == COMMERCIAL_STOP
    old, new = F.col("charge_rate"), F.col("new_charge_rate")
    kept = rows.where(commercial | (old < new))
    effective = F.when(commercial, F.lit(dates.commercial)).otherwise(F.lit(dates.residential))
    return kept.select(
        F.when(commercial, "commercial").otherwise("residential").alias("target"),
        pad_key(F.col("div_nbr").try_cast("long"), 3).alias("comp"),
        F.col("acct_nbr").try_cast("long").alias("acct"),
        pad_key(F.col("site_nbr").try_cast("long"), 5).alias("site"),
        F.col("group_nbr").alias("cgrp"),
        "charge_code",
        old.alias("charge_rate"),
        F.when(commercial, F.greatest(new, old)).otherwise(new).alias("new_rate"),
        us_date_text(effective).alias("effective_date"),
        F.lit(TRANSACTION_CODE).alias("tran_code"),
        F.lit(REASON_CODE).alias("rsn_code"),
    )


def broker_upload(rows: DataFrame, dates: PriceDates, kinds: Sequence[str] = ("RTR", "BRK")) -> DataFrame:
    """Numbered upload lines of commercial-format rows a broker or retention desk has priced already."""
    kept = rows.where(F.col("broker_kind").isin(*kinds))
    order = [F.col(c).asc_nulls_first() for c in ("div_nbr", "acct_nbr", "site_nbr", "group_nbr", "charge_code", "charge_rate", "rec_rate")]
    return row_ids(kept, order, "line_no").select(
        "line_no",
        pad_key(F.trim("div_nbr").try_cast("long"), 3).alias("comp"),
        F.trim("acct_nbr").try_cast("long").alias("acct"),
        pad_key(F.trim("site_nbr").try_cast("long"), 5).alias("site"),
        F.trim("group_nbr").try_cast("long").alias("cgrp"),
        "charge_code",
        "charge_rate",
        F.round("rec_rate", 2).alias("new_rate"),
        us_date_text(F.lit(dates.commercial)).alias("effective_date"),
        F.lit(TRANSACTION_CODE).alias("tran_code"),
        F.lit(REASON_CODE).alias("rsn_code"),
        F.lit("N").alias("na"),
    )


def uplift_tags(uplifts: DataFrame, tag: str = "account_tag") -> DataFrame:
    """Tags ``x_division_account`` split into padded company and account number."""
    parts = F.split(tag, "_")
    return uplifts.select(
        pad_key(F.get(parts, F.lit(1)).try_cast("long"), 3).alias("comp"),
        F.get(parts, F.lit(2)).try_cast("long").alias("acct"),
        "uplift",
    )


def uplift_apply(upload: DataFrame, uplifts: DataFrame, keys: Sequence[str] = ("comp", "acct")) -> DataFrame:
    """Add the tested uplift (none = 0) to the relative increase of residential lines; others pass unchanged.

    Of several uplifts of one account the largest counts. A frame without ``target`` is a residential file.
    """
    old, new = F.col("charge_rate"), F.col("new_rate")
    tested = uplifts.groupBy(*keys).agg(F.max("uplift").alias("uplift"))
    joined = upload.join(tested, list(keys), "left").withColumn("uplift", F.coalesce("uplift", F.lit(0.0)))
    raised = old + old * (F.try_divide(new - old, old) + F.col("uplift"))
    residential = F.col("target") == "residential" if "target" in upload.columns else F.lit(True)
    return joined.withColumn("new_rate", F.when(residential, raised).otherwise(new)).drop("uplift")


def uplift_summary(
    rows: DataFrame, uplifts: DataFrame, keys: Sequence[str], percent: str = "pct_of_pi", rate: str = "charge_rate"
) -> DataFrame:
    """Rows of the summary with ``uplift`` (none = 0), ``uplifted_pct`` and ``uplifted_rate``, the old rate raised by both.

    Of several uplifts of one account the largest counts, as in ``uplift_apply``.
    """
    tested = uplifts.groupBy(*keys).agg(F.max("uplift").alias("uplift"))
    joined = rows.join(tested, list(keys), "left").withColumn("uplift", F.coalesce("uplift", F.lit(0.0)))
    whole = F.col(percent).cast("double") + F.col("uplift")
    return joined.withColumns({"uplifted_pct": whole, "uplifted_rate": F.col(rate).cast("double") * (1 + whole)})
