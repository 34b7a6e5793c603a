"""E-mail engagement: five status lists to one row per account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binledger.functions.text import account_key, pad_key
from binledger.operators.joins import key_fallback_join

# What each status list says about opening, clicking and opting out.
STATUS_FLAGS = {
    "opened": {"open": 1},
    "clicked": {"click": 1},
    "not_opened": {"open": 0},
    "not_clicked": {"click": 0},
    "opt_out": {"opt_out": 1},
}


def long_account(division: Column, account: Column) -> Column:
    """Company number followed by the seven-digit account."""
    return F.concat(division, pad_key(account, 7))


def consolidate(lists: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Highest open and click flag per account, product flags and opt-out.

    ``lists``: account, status, recycle and solid_waste as Y/N. A "did not" row lowers nothing: any
    positive row wins. Opt-out is part of the key, so an opted-out account may have a second row.
    ``lookup``: long_acct, div_nbr, acct_nbr.
    """
    flag = lambda name: F.coalesce(
        *[F.when(F.col("status") == s, F.lit(flags[name])) for s, flags in STATUS_FLAGS.items() if name in flags]
    )
    rows = lists.where(F.col("account").isNotNull()).select(
        "account",
        F.when(F.col("recycle") == "Y", 1).otherwise(0).alias("recycle"),
        F.when(F.col("solid_waste") == "Y", 1).otherwise(0).alias("solid_waste"),
        flag("open").alias("open"),
        flag("click").alias("click"),
        flag("opt_out").alias("opt_out"),
    )
    # few rows per account are left before the lookup is joined
    best = rows.groupBy("account", "recycle", "solid_waste", "opt_out").agg(F.max("open").alias("open"), F.max("click").alias("click"))
    if lookup is None:
        return best.withColumnRenamed("account", "acct_new")
    translated = account_key(F.col("div_nbr"), F.col("acct_nbr"))
    named = key_fallback_join(best, lookup, "account", "long_acct", translated, "acct_new")
    return named.groupBy("acct_new", "recycle", "solid_waste", "opt_out").agg(F.max("open").alias("open"), F.max("click").alias("click"))
