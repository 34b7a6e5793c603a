"""Calendar columns: month and day keys, validity dates, spreadsheet dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = dt.date(9999, 12, 31)
SPREADSHEET_ORIGIN = dt.date(1899, 12, 30)


def month_key(day: Column) -> Column:
    """Date -> ``yyyymm`` int."""
    return F.year(day) * 100 + F.month(day)


def day_key(day: Column) -> Column:
    """Date -> ``yyyymmdd`` int."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_of_day_key(key: Column) -> Column:
    """``yyyymmdd`` -> ``yyyymm``; 0 stays 0."""
    return F.floor(key / 100).cast("int")


def date_of_day_key(key: Column) -> Column:
    """``yyyymmdd`` -> date, NULL when it is no calendar day."""
    return F.try_to_date(key.cast("string"), "yyyyMMdd")


def month_start(day: Column, shift: int = 0) -> Column:
    return F.add_months(F.trunc(day, "MM"), shift)


def whole_months_between(earlier: Column, later: Column) -> Column:
    """Calendar months from ``earlier`` to ``later``; the days are ignored."""
    return (F.year(later) * 12 + F.month(later)) - (F.year(earlier) * 12 + F.month(earlier))


def tenure_years(opened: Column, as_of: dt.date) -> Column:
    return F.datediff(F.lit(as_of), opened) / F.lit(365.0)


def tenure_months(opened: Column, as_of: dt.date) -> Column:
    return F.datediff(F.lit(as_of), opened) / F.lit(365.0 / 12)


def serial_or_iso_date(text: Column) -> Column:
    """Spreadsheet cell as text: ISO date when it holds a dash, else a day serial."""
    serial = text.try_cast("int")
    return F.when(text.contains("-"), F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")).otherwise(
        F.date_add(F.lit(SPREADSHEET_ORIGIN), serial)
    )


def us_date_text(day: Column) -> Column:
    return F.date_format(day, "MM/dd/yyyy")


def active_between(effective: Column, close: Column, start: Column, end: Column) -> Column:
    """Validity ints overlap the month ``[start, end)``; close 0 means still open."""
    return (effective < end) & ((close > start) | (close == 0))


def current_charge(effective: Column, close: Column, day: int) -> Column:
    return (effective <= day) & ((close > day) | (close == 0))


def consistent_validity(effective: Column, close: Column) -> Column:
    """A charge may not close before it starts."""
    return (close >= effective) | (close == 0)
