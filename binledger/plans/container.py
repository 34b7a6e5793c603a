"""Monthly container refresh: invoices, services and rates per container group, loaded with fees.

The grain everywhere is (month, division, current division, account, site, container group).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from binledger.functions.dates import active_between, consistent_validity, date_of_day_key, day_key, month_key, month_of_day_key
from binledger.functions.labels import account_status
from binledger.functions.money import as_units, division_fee_fraction, effective_fee_rate, fee_multiplier, from_units
from binledger.functions.text import code_in
from binledger.operators.grouping import any_flag, decimal_scale, every_flag, sums_by_code
from binledger.operators.joins import FEW_LOOKED_UP, full_join_coalesce, if_small, looked_up
from binledger.operators.rows import current_rows, live_rows

# Charge and service codes of the refresh.
BASE_CODES = ("BCR", "BSP", "BCE", "BCS")
EXTRA_CODES = ("NCC", "CEX", "EXC")
INVOICE_CODES = (*BASE_CODES, *EXTRA_CODES)
RATE_CODES = ("BCR", "BSP", "BCE")

AMOUNT = "decimal(18,4)"
GRAIN = ["month_dt", "div_nbr", "cur_div_nbr", "acct_nbr", "site_nbr", "container_grp_nbr"]
_NATURAL = ["div_nbr", "acct_nbr", "site_nbr", "container_grp_nbr"]
_ACCOUNT = ["div_nbr", "acct_nbr"]
_SKEYS = ["acct_sk", "container_grp_sk", "corp_hier_sk"]


def _dim_facts(containers: DataFrame, accounts: DataFrame, hierarchy: DataFrame) -> dict[str, DataFrame]:
    """The columns of each dimension the refresh needs; dates already as ``yyyymm``."""
    return {
        "container_grp_sk": containers.where(F.col("container_size").between(1, 10)).select(
            "container_grp_sk", "div_nbr", "acct_nbr", "site_nbr", "container_grp_nbr", "container_cnt",
            "container_size", "is_franchise", "contract_nbr", "contract_grp_nbr",
            month_key(F.col("close_dt")).alias("cont_close_mo"),
            month_key(F.col("orig_start_dt")).alias("cont_start_mo"),
        ),
        "acct_sk": accounts.select(
            "acct_sk", "is_national_account",
            month_key(F.col("acct_close_dt")).alias("act_close_mo"),
            month_key(F.col("acct_open_dt")).alias("act_open_mo"),
        ),
        "corp_hier_sk": if_small(hierarchy.select("corp_hier_sk", "cur_div_nbr")),
    }


def _shared_aggregates() -> list[Column]:
    return [
        F.max("container_cnt").alias("container_cnt"),
        F.max("container_size").alias("container_size"),
        any_flag(F.col("is_franchise") == 1).alias("is_franchise"),
        any_flag(F.col("is_national_account") == 1).alias("is_national_account"),
        F.min("cont_close_mo").alias("cont_close_mo"),
        F.min("cont_start_mo").alias("cont_start_mo"),
        F.min("act_close_mo").alias("act_close_mo"),
        F.min("act_open_mo").alias("act_open_mo"),
    ]


def _invoice_keys(
    invoices: DataFrame, charge_codes: DataFrame, rates: DataFrame, after_month: int, few: int | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """Invoice lines summed per month and surrogate keys, in whole units; and each measure's scale.

    ``few`` says that the lines lie dealt by container, where more than so many rates are looked up without moving them.
    """
    codes = charge_codes.where(code_in(F.col("charge_cd"), INVOICE_CODES))
    lines = (
        live_rows(invoices)
        .where(F.col("revenue_period") > after_month)
        .join(codes, "charge_cd_sk")
    )
    lines = lines.join(rates, "rate_sk") if few is None else looked_up(lines, rates, "rate_sk", "container_grp_sk", few=few)
    scale = {m: decimal_scale(lines, m) for m in ("revenue_amt", "rate_amt", "qty_billed")}
    lines = lines.withColumns({m: as_units(F.col(m), s) for m, s in scale.items()})
    code, amount = F.col("charge_cd"), F.col("revenue_amt")
    sums = [
        F.sum(amount).alias("inv_rev"),
        F.sum(F.when(F.col("is_credit") == 1, amount).otherwise(F.lit(0))).alias("credit_rev"),
        *sums_by_code(code, INVOICE_CODES, amount, "rev"),
        *sums_by_code(code, EXTRA_CODES, F.col("rate_amt"), "rate"),
        *sums_by_code(code, EXTRA_CODES, F.col("qty_billed"), "qty_bill_inv"),
    ]
    measures = {"inv_rev": "revenue_amt", "credit_rev": "revenue_amt"}
    measures |= {f"{c.lower()}_rev": "revenue_amt" for c in INVOICE_CODES}
    measures |= {f"{c.lower()}_rate": "rate_amt" for c in EXTRA_CODES}
    measures |= {f"{c.lower()}_qty_bill_inv": "qty_billed" for c in EXTRA_CODES}
    per_key = lines.groupBy("revenue_period", *_SKEYS).agg(*sums)
    return per_key, {m: scale[source] for m, source in measures.items()}


def _current_fees(contract_fees: DataFrame) -> DataFrame:
    return if_small(current_rows(contract_fees).drop("is_current", "eff_dt", "disc_dt"))


_CONTRACT = ["div_nbr", "contract_nbr", "contract_grp_nbr"]


def _fees_per_contract(contract_fees: DataFrame) -> DataFrame:
    """The current fees, one row per contract: largest rates, any lock, and in ``fee_rows`` how many there are."""
    return if_small(current_rows(contract_fees).groupBy(*_CONTRACT).agg(
        *[F.max(c).alias(c) for c in ("erf_rate_pct", "frf_rate_pct")],
        *[any_flag(F.col(c) == 1).alias(c) for c in ("is_erf_locked", "is_frf_locked", "is_erf_on_frf")],
        F.count(F.lit(1)).alias("fee_rows"),
    ))


def invoice_monthly(
    invoices: DataFrame,
    accounts: DataFrame,
    containers: DataFrame,
    charge_codes: DataFrame,
    hierarchy: DataFrame,
    rates: DataFrame,
    contract_fees: DataFrame,
    after_month: int = 201600,
) -> DataFrame:
    """Invoice lines rolled up to the grain, with one sum per charge code.

    Lines are summed per surrogate key first, so that the wide dimensions meet one row per container
    and month instead of every line. Sums run on whole units of the declared decimals.
    """
    per_key, measures = _invoice_keys(invoices, charge_codes, rates, after_month)
    for key, dim in _dim_facts(containers, accounts, hierarchy).items():
        per_key = per_key.join(dim, key)
    loaded = per_key.join(_current_fees(contract_fees), ["div_nbr", "contract_nbr", "contract_grp_nbr"], "left")

    grouped = loaded.groupBy(F.col("revenue_period").alias("month_dt"), *GRAIN[1:]).agg(
        *_shared_aggregates(),
        F.max("erf_rate_pct").alias("erf_rate_pct"),
        F.max("frf_rate_pct").alias("frf_rate_pct"),
        any_flag(F.col("is_erf_locked") == 1).alias("is_erf_locked"),
        any_flag(F.col("is_frf_locked") == 1).alias("is_frf_locked"),
        any_flag(F.col("is_erf_on_frf") == 1).alias("is_erf_on_frf"),
        *[from_units(F.sum(m), scale).alias(m) for m, scale in measures.items()],
    )
    in_month = lambda name: F.when(F.col(name) == F.col("month_dt"), 1).otherwise(0)
    return grouped.withColumns(
        {
            "new_acct": in_month("act_open_mo"),
            "lost_acct": in_month("act_close_mo"),
            "closed_container": in_month("cont_close_mo"),
            "open_container": in_month("cont_start_mo"),
        }
    )


def _service_keys(services: DataFrame, service_codes: DataFrame, from_day: int) -> DataFrame:
    """Service events counted per month and surrogate keys."""
    codes = service_codes.where(code_in(F.col("service_cd"), EXTRA_CODES))
    events = (
        live_rows(services, ("is_deleted", "is_updated"))
        .where(F.col("service_day") >= from_day)
        .join(codes, "service_cd_sk")
        .withColumn("month_dt", month_of_day_key(F.col("service_day")))
    )
    counted = events.withColumnRenamed("container_cnt", "served")
    return counted.groupBy("month_dt", *_SKEYS).agg(
        *sums_by_code(F.col("service_cd"), EXTRA_CODES, F.col("served"), "cnt_srvc")
    )


def service_monthly(
    services: DataFrame,
    accounts: DataFrame,
    containers: DataFrame,
    service_codes: DataFrame,
    hierarchy: DataFrame,
    from_day: int = 20160101,
) -> DataFrame:
    """Service events rolled up to the grain. ``open_container`` holds only when it does in every row."""
    per_key = _service_keys(services, service_codes, from_day)
    for key, dim in _dim_facts(containers, accounts, hierarchy).items():
        per_key = per_key.join(dim, key)
    month = F.col("month_dt")
    return per_key.groupBy(*GRAIN).agg(
        *_shared_aggregates(),
        *[F.sum(f"{c.lower()}_cnt_srvc").alias(f"{c.lower()}_cnt_srvc") for c in EXTRA_CODES],
        any_flag(F.col("act_open_mo") == month).alias("new_acct"),
        any_flag(F.col("act_close_mo") == month).alias("lost_acct"),
        any_flag(F.col("cont_close_mo") == month).alias("closed_container"),
        every_flag(F.col("cont_start_mo") == month).alias("open_container"),
    )


_EITHER_SIDE = [
    "is_franchise", "is_national_account", "container_cnt", "container_size", "cont_close_mo", "cont_start_mo",
    "act_close_mo", "act_open_mo", "new_acct", "lost_acct", "closed_container", "open_container",
]
_INVOICE_ONLY = (
    ["inv_rev", "credit_rev"]
    + [f"{c.lower()}_rev" for c in INVOICE_CODES]
    + [f"{c.lower()}_{m}" for m in ("rate", "qty_bill_inv") for c in EXTRA_CODES]
)
_SERVICE_ONLY = [f"{c.lower()}_cnt_srvc" for c in EXTRA_CODES]
_FEE_COLUMNS = ["erf_rate_pct", "frf_rate_pct", "is_erf_locked", "is_frf_locked", "is_erf_on_frf"]


def invoice_and_service(invoice: DataFrame, service: DataFrame) -> DataFrame:
    """Both roll-ups side by side; a measure is 0 where its side is absent, fees stay NULL."""
    return full_join_coalesce(
        invoice, service, GRAIN, prefer_left=_EITHER_SIDE, default_zero=[*_INVOICE_ONLY, *_SERVICE_ONLY]
    )


def months_of(first: dt.date, last: dt.date) -> Column:
    """All month starts from ``first`` to ``last`` as an array column."""
    return F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 month"))


def _month_at(year: Column, month: Column) -> Column:
    """Calendar months counted from year 0, so that they can be compared and unfolded."""
    return year * 12 + month - 1


def _month_index(day: Column) -> Column:
    return _month_at(F.year(day), F.month(day))


def _first_index(day: Column) -> Column:
    """First month whose first day is not before ``day``."""
    return _month_index(day) + F.when(F.dayofmonth(day) > 1, 1).otherwise(0)


def _last_index(day: Column) -> Column:
    """Last month whose first day is before ``day``."""
    return _month_index(day) - F.when(F.dayofmonth(day) == 1, 1).otherwise(0)


def _month_of_index(index: Column) -> Column:
    """Month counted from year 0 -> ``yyyymm`` int."""
    return F.floor(index / 12).cast("int") * 100 + index % 12 + 1


def _fee_spans(contract_fees: DataFrame, first: Column, last: Column) -> DataFrame:
    """Each contract's fee versions by the months ``f_from`` to ``f_to`` they hold at the end of, and its months without one."""
    key = ["f_div", "f_nbr", "f_grp"]
    versions = contract_fees.select(
        F.col("div_nbr").alias("f_div"), F.col("contract_nbr").alias("f_nbr"), F.col("contract_grp_nbr").alias("f_grp"), *_FEE_COLUMNS,
        F.when(F.col("eff_dt").isNotNull(), F.greatest(first, _first_index(F.col("eff_dt")) - 1)).alias("f_from"),
        F.when(F.col("disc_dt").isNotNull(), F.least(last, _month_index(F.col("disc_dt")) - 1)).alias("f_to"),
    ).where(F.col("f_from") <= F.col("f_to"))
    # one gap before each version that begins behind all earlier ones, and one behind the last
    earlier = Window.partitionBy(*key).orderBy("f_from").rowsBetween(Window.unboundedPreceding, -1)
    before = versions.select(
        *key, (F.coalesce(F.max("f_to").over(earlier), first - 1) + 1).alias("f_begin"), (F.col("f_from") - 1).alias("f_to"))
    behind = versions.groupBy(*key).agg((F.max("f_to") + 1).alias("f_begin")).withColumn("f_to", last)
    gaps = before.unionByName(behind).withColumnRenamed("f_begin", "f_from").where(F.col("f_from") <= F.col("f_to"))
    return versions.unionByName(gaps, allowMissingColumns=True)


_SPAN_KEYS = [
    *GRAIN[1:], "cont_close_mo", "cont_start_mo", "act_close_mo", "act_open_mo", "container_cnt", "container_size",
    "is_franchise", "is_national_account",
]


#: Tasks per shuffle partition where all facts of an account meet: their months unfold there to many times their bytes.
_TASKS_PER_PARTITION = 4


def account_tasks(df: DataFrame) -> int:
    """Into how many tasks what is dealt by account is dealt; one number for all facts, so that they meet without a shuffle."""
    return _TASKS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def rate_spans(
    charges: DataFrame,
    containers: DataFrame,
    accounts: DataFrame,
    hierarchy: DataFrame,
    contract_fees: DataFrame,
    first_month: dt.date,
    last_month: dt.date,
    account_fees: DataFrame | None = None,
    by_account: bool = False,
) -> DataFrame:
    """What ``monthly_rate_snapshot`` tells, before it is unfolded into months: a row per container group.

    ``spans`` holds the group's charges by the months they count in: valid from ``a`` to ``b``, rated from ``r``, active
    at the begin from ``o`` and at the end to ``z``, new in ``n`` and lost in ``l``. Charges with the same months are
    summed, so the calendar bounds their number however many charges a container has. ``account_fees`` add the fee flags
    of the account. Rows dealt ``by_account`` are so from the first shuffle to the last, and containers shuffle once, too.
    """
    natural = _NATURAL
    eff, cld = F.col("effective_date"), F.col("close_date")
    lines = charges.where(
        code_in(F.col("charge_code"), BASE_CODES)
        & (F.upper("current_ind") == "Y")
        & (F.col("adj_flag") == "0")
        & consistent_validity(eff, cld)
    )
    scale = decimal_scale(charges, "charge_rate")
    # a stated number of tasks: those Spark would merge by their compressed bytes unfold to many times these
    tasks = account_tasks(charges) if by_account else int(charges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # equal charges of a container are summed before they meet their dimensions, where these join them
    lines = lines.repartition(tasks, *(_ACCOUNT if by_account else natural)).groupBy(*natural, F.upper("charge_code").alias("charge_code"), "effective_date", "close_date").agg(
        F.sum(as_units(F.col("charge_rate"), scale)).alias("charge_rate")
    )

    cont = current_rows(containers).select(
        *natural, "container_cnt", "container_size", "is_franchise", "contract_nbr", "contract_grp_nbr",
        "rev_distrib_cd", "orig_start_dt", "close_dt",
    )
    acct = current_rows(accounts).select("div_nbr", "acct_nbr", "acct_open_dt", "acct_close_dt", "is_national_account")
    flags = [] if account_fees is None else _FLAG_COLUMNS
    if flags:
        acct = acct.join(account_fee_flags(account_fees), _ACCOUNT, "left")
    hier = if_small(current_rows(hierarchy).select("div_nbr", "rev_distrib_cd", "cur_div_nbr"))
    first, last = (F.lit(day.year * 12 + day.month - 1) for day in (first_month, last_month))
    fees = if_small(_fee_spans(contract_fees, first, last))

    if by_account:
        cont, acct = (side.repartition(tasks, *_ACCOUNT) for side in (cont, acct))
    places = cont.join(acct, _ACCOUNT).join(hier, ["div_nbr", "rev_distrib_cd"])
    opened, started = F.col("acct_open_dt"), F.col("orig_start_dt")
    aclose, cclose = F.col("acct_close_dt"), F.col("close_dt")
    start_day = date_of_day_key(eff)
    base = lines.join(places, natural).where(
        (start_day < aclose) & (start_day < cclose) & opened.isNotNull() & started.isNotNull())

    # a close day is a number that need not be a calendar day: months outside 1 to 12 end a year's edge
    month, day = F.floor(cld / 100).cast("int") % 100, cld % 100
    calendar = month.between(1, 12)
    close_at = _month_at(F.floor(cld / 10000).cast("int"), F.greatest(F.lit(1), F.least(F.lit(13), month)))
    valid_to = F.when(cld == 0, last).otherwise(close_at - F.when(calendar & (day > 1), 0).otherwise(1))
    full_to = F.when(cld == 0, last).otherwise(close_at - F.when(calendar & (day > 0), 1).otherwise(2))
    by_begin = F.greatest(_first_index(opened), _first_index(started))
    a = F.greatest(_month_index(start_day), _month_index(started), _month_index(opened), first)
    b = F.least(valid_to, _last_index(cclose), _last_index(aclose), last)
    spanned = base.withColumns({"a": a, "b": b}).where(F.col("a") <= F.col("b"))
    fee_key = [F.col("div_nbr") == F.col("f_div"), F.col("contract_nbr") == F.col("f_nbr"), F.col("contract_grp_nbr") == F.col("f_grp")]
    priced = spanned.join(fees, fee_key, "left").withColumns(
        {"a": F.greatest("a", F.coalesce("f_from", first)), "b": F.least("b", F.coalesce("f_to", last))}
    ).where(F.col("a") <= F.col("b"))
    in_months = lambda index: F.when(index.between(F.greatest("a", by_begin), F.col("b")), index).otherwise(-1)
    unending = F.col("b") + 1
    full_to = F.least(full_to, _last_index(aclose) - 1, _last_index(cclose) - 1)
    keyed = priced.withColumns(
        {
            "r": F.least(unending, F.greatest(
                "a", _first_index(start_day), _month_index(opened) + 1, _month_index(started) + 1)),
            "o": F.least(unending, F.greatest("a", _first_index(start_day), by_begin)),
            "z": F.greatest(F.col("a") - 1, F.least("b", full_to)),
            "n": in_months(_month_index(start_day)),
            "l": F.when((cld != 0) & calendar, in_months(close_at)).otherwise(-1),
            "cont_close_mo": month_key(cclose),
            "cont_start_mo": month_key(started),
            "act_close_mo": month_key(aclose),
            "act_open_mo": month_key(opened),
        }
    )
    key, months = [*_SPAN_KEYS, *_FEE_COLUMNS, *flags], ["charge_code", "a", "b", "r", "o", "z", "n", "l"]
    summed = keyed.groupBy(*key, *months).agg(F.sum("charge_rate").alias("units"))
    return summed.groupBy(*key).agg(
        F.collect_list(F.struct(*months, "units")).alias("spans", metadata={"scale": scale}), F.min("a").alias("first"), F.max("b").alias("last")
    )


def _span_measures(scale: int) -> dict[str, Column]:
    """The measures of month ``i`` from those of the group's spans that are valid in it, ``live``."""
    live, i, count = F.col("live"), F.col("i"), F.col("container_cnt")
    is_base = lambda s: s["charge_code"].isin(*RATE_CODES)

    def counted(held) -> Column:
        # the largest of the count where the condition holds and of 0 where not
        either = F.when(F.forall(live, held), count).otherwise(F.greatest(count, F.lit(0)))
        general = F.when(~F.exists(live, held), 0).otherwise(either)
        return F.when(count >= 0, F.when(F.exists(live, held), count).otherwise(0)).otherwise(general)

    def rated(held) -> Column:
        # as sum() does: what is unknown does not count, unless there is nothing else
        value = lambda s: F.when(held(s) & (s["r"] <= i), s["units"]).otherwise(F.lit(0).cast("long"))
        total = F.aggregate(live, F.lit(None).cast("long"), lambda acc, s: F.coalesce(acc + value(s), acc, value(s)))
        return from_units(total, scale)

    at = lambda field: lambda s: is_base(s) & (s[field] == i)
    coded = lambda name: lambda s: s["charge_code"] == name
    return {
        "bcr_rt": rated(is_base),
        "bcs_rt": rated(coded("BCS")),
        "bcr_active_cont_bom": counted(lambda s: is_base(s) & (s["o"] <= i)),
        "bcr_active_cont_eom": counted(lambda s: is_base(s) & (s["z"] >= i)),
        "bcr_new_cnt": counted(at("n")),
        "bcr_lost_cnt": counted(at("l")),
        **{f"{c.lower()}_exists": counted(coded(c)) for c in BASE_CODES},
    }


def _runs(groups: DataFrame, scale: int, *kept: str) -> DataFrame:
    """Runs of months, from ``i`` to ``till``, in which a group's measures stay; months without a charge are in none.

    The ``kept`` columns stay beside them. A row whose ``spans`` are NULL is one run of one month that has no number.
    """
    edges = F.flatten(F.transform("spans", lambda s: F.array(
        s["a"], s["r"], s["o"], s["z"] + 1, s["n"], s["n"] + 1, s["l"], s["l"] + 1, s["b"] + 1)))
    inside = F.filter(F.array_sort(F.array_distinct(edges)), lambda x: x.between(F.col("first"), F.col("last") + 1))
    pairs = F.zip_with(F.slice("edges", 1, F.size("edges") - 1), F.slice("edges", 2, F.size("edges") - 1), lambda x, y: F.struct(x.alias("i"), (y - 1).alias("till")))
    no_month = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("till")))
    runs = groups.withColumn("edges", inside).select("*", F.inline(F.when(F.col("spans").isNull(), no_month).otherwise(pairs)))
    runs = runs.withColumn("live", F.filter("spans", lambda s: (s["a"] <= F.col("i")) & (s["b"] >= F.col("i")))).where(F.col("spans").isNull() | (F.size("live") > 0))
    return runs.select(*_SPAN_KEYS, *_FEE_COLUMNS, *kept, "i", "till", *[c.alias(name) for name, c in _span_measures(scale).items()])


def _unfolded(runs: DataFrame) -> DataFrame:
    """A row per month of each run."""
    months = runs.withColumn("month_dt", F.explode(F.sequence("i", "till"))).withColumn("month_dt", _month_of_index(F.col("month_dt")))
    same_month = lambda name: F.when(F.col(name) == F.col("month_dt"), 1).otherwise(0)
    return months.drop("i", "till").withColumns(
        {
            "new_acct": same_month("act_open_mo"),
            "lost_acct": same_month("act_close_mo"),
            "closed_container": same_month("cont_close_mo"),
            "open_container": same_month("cont_start_mo"),
        }
    )


def monthly_rate_snapshot(
    charges: DataFrame,
    containers: DataFrame,
    accounts: DataFrame,
    hierarchy: DataFrame,
    contract_fees: DataFrame,
    first_month: dt.date,
    last_month: dt.date,
    unfold: bool = True,
    account_fees: DataFrame | None = None,
) -> DataFrame:
    """Base rates and container counts per grain for every month of a range, in one job.

    The dimensions are joined among themselves first, so the charges shuffle once for all of them. All grouping is done
    on charges; a container's row is unfolded into its months last, where no row waits for another. Without ``unfold``
    the rows stay as ``rate_spans`` gives them, dealt by account, for ``three_facts`` to unfold beside the other facts.
    """
    groups = rate_spans(charges, containers, accounts, hierarchy, contract_fees, first_month, last_month, account_fees, not unfold)
    if not unfold:
        return groups
    months = _unfolded(_runs(groups, decimal_scale(charges, "charge_rate")))
    flags = ["new_acct", "lost_acct", "closed_container", "open_container"]
    return months.select("month_dt", *_SPAN_KEYS, *_FEE_COLUMNS, *flags, *_RATE_MEASURES)


_RATE_MEASURES = [
    "bcr_rt", "bcs_rt", "bcr_active_cont_bom", "bcr_active_cont_eom", "bcr_new_cnt", "bcr_lost_cnt",
    *[f"{c.lower()}_exists" for c in BASE_CODES],
]


def rate_snapshot_totals(snapshot: DataFrame) -> DataFrame:
    """Check totals per month."""
    return snapshot.groupBy("month_dt").agg(
        F.sum("bcr_active_cont_bom").alias("bcr_bom"),
        F.sum("bcr_active_cont_eom").alias("bcr_eom"),
        F.sum("bcr_new_cnt").alias("bcr_new_cont"),
        F.sum("bcr_lost_cnt").alias("bcr_lost_cont"),
        F.count(F.lit(1)).alias("num"),
    )


_RATE_ONLY = [
    "bcr_rt", "bcs_rt", "bcr_active_cont_bom", "bcr_active_cont_eom", "bcr_new_cnt", "bcr_lost_cnt",
    "bcr_exists", "bce_exists", "bsp_exists", "bcs_exists",
]
_RATE_FIRST = [
    "cont_close_mo", "cont_start_mo", "act_open_mo", "act_close_mo", "container_size", "new_acct", "lost_acct",
    "closed_container", "open_container",
]


_INVOICE_FIRST = ["is_franchise", "is_national_account", "container_cnt", *_FEE_COLUMNS]


def with_rates(inv_srvc: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Full join of the roll-ups with the rate snapshot."""
    return full_join_coalesce(
        inv_srvc,
        snapshot,
        GRAIN,
        prefer_left=_INVOICE_FIRST,
        prefer_right=_RATE_FIRST,
        default_zero=[*_INVOICE_ONLY, *_SERVICE_ONLY, *_RATE_ONLY],
    )


def _with_folded_rates(inv_srvc: DataFrame, folded: DataFrame, account_fees: DataFrame | None) -> DataFrame:
    """What ``with_rates`` gives from the snapshot that ``rate_spans`` tells, which is unfolded here.

    Both sides become one row per container, with its months of invoices and services and its rated groups, and meet as
    such: no month is sorted or shuffled. Account fee flags join these rows, too. A container's months are then those of
    its groups, each with its invoices if there are any, and the invoiced months in which no group has a charge. The
    current division is compared there: a join by the keys the charges are dealt by needs no further exchange.
    """
    key, flags = _NATURAL, [] if account_fees is None else _FLAG_COLUMNS
    packed = lambda rows, name: rows.groupBy(*key, *[c for c in flags if c in rows.columns]).agg(
        F.collect_list(F.struct(*[c for c in rows.columns if c not in {*key, *flags}])).alias(name))
    invoiced = packed(inv_srvc, "invoiced")
    if flags:
        # of the accounts a task holds its share only, and the containers need no sort
        invoiced = invoiced.join(account_fee_flags(account_fees).hint("shuffle_hash"), _ACCOUNT, "left")
    met = full_join_coalesce(invoiced, packed(folded, "rated"), key, prefer_left=flags)

    # a month of no calendar is none of the unfolded ones
    index = lambda m: F.when((m % 100).between(1, 12), _month_at(F.floor(m / 100).cast("int"), m % 100))
    within = lambda m, begin, end: F.coalesce(index(m).between(begin, end), F.lit(False))
    valid = lambda x, g: F.exists(g["spans"], lambda s: within(x["month_dt"], s["a"], s["b"]))
    matched = lambda x: F.exists("rated", lambda g: (g["cur_div_nbr"] == x["cur_div_nbr"]) & valid(x, g))
    unrated = F.filter("invoiced", lambda x: ~F.coalesce(matched(x), F.lit(False)))
    group, month = (met.schema[c].dataType.elementType for c in ("rated", "invoiced"))
    either = lambda g, x: F.struct(g.cast(group).alias("g"), x.cast(month).alias("x"))
    parts = F.array_compact(F.flatten(F.array_compact(F.array(
        F.transform("rated", lambda g: either(g, F.lit(None))), F.transform(unrated, lambda x: either(F.lit(None), x))))))
    shares = met.select(*key, *flags, "invoiced", F.explode(parts).alias("part"))
    groups = shares.select(*key, *flags, "part.g.*", F.when(F.col("part.x").isNull(), F.filter(
        "invoiced", lambda x: x["cur_div_nbr"] == F.col("part.g.cur_div_nbr"))).alias("invoiced"), F.col("part.x").alias("alone"))
    runs = _runs(groups, folded.schema["spans"].metadata["scale"], *flags, "alone", "invoiced")
    # a run keeps its own invoices only, so that its months copy no others
    runs = runs.withColumn("invoiced", F.filter("invoiced", lambda x: within(x["month_dt"], F.col("i"), F.col("till"))))
    months = _unfolded(runs).withColumn("inv", F.coalesce(
        "alone", F.get(F.filter("invoiced", lambda x: x["month_dt"] == F.col("month_dt")), F.lit(0))))
    alone = F.col("alone").isNotNull()
    rate = lambda c: F.when(~alone, F.col(c))
    inv = lambda c: F.col("inv")[c]
    picked = {c: F.when(alone, inv(c)).otherwise(F.col(c)) for c in ("month_dt", "cur_div_nbr")}
    picked |= {c: F.coalesce(inv(c), F.col(c)) for c in _INVOICE_FIRST}
    picked |= {c: F.coalesce(rate(c), inv(c)) for c in _RATE_FIRST}
    picked |= {c: F.coalesce(inv(c), F.lit(0)) for c in [*_INVOICE_ONLY, *_SERVICE_ONLY]}
    picked |= {c: F.coalesce(F.col(c), F.lit(0)) for c in _RATE_ONLY}
    return months.select(*key, *[c.alias(name) for name, c in picked.items()], *flags)


def three_facts(
    invoices: DataFrame,
    services: DataFrame,
    snapshot: DataFrame,
    accounts: DataFrame,
    containers: DataFrame,
    charge_codes: DataFrame,
    service_codes: DataFrame,
    hierarchy: DataFrame,
    rates: DataFrame,
    contract_fees: DataFrame,
    after_month: int = 201600,
    from_day: int = 20160101,
    account_fees: DataFrame | None = None,
    few: int = FEW_LOOKED_UP,
) -> DataFrame:
    """What ``with_rates(invoice_and_service(...), snapshot)`` gives, with one aggregation in place of the first full join.

    A snapshot that is not unfolded meets the other facts per container and is unfolded last; ``account_fees`` then add
    the fee flags of the account, which ``fee_rates`` takes.

    Invoice and service lines are summed per surrogate key and stand in one table, a row per key whosesoever lines it has,
    that meets each dimension once. One grouping at the grain takes every column of either fact, and of the two values the
    first that is not NULL. The rows are dealt by account, as those of the snapshot are: the join with it needs no further
    exchange. More than ``few`` rates or accounts are looked up per container, so lines that lie dealt by container move
    only there, as sums.
    """
    inv_keys, measures = _invoice_keys(invoices, charge_codes, rates, after_month, few)
    srv_keys = _service_keys(services, service_codes, from_day)
    tag = lambda df, name: df.withColumn("tag", F.lit(name))
    either = tag(inv_keys.withColumnRenamed("revenue_period", "month_dt"), "I").unionByName(tag(srv_keys, "S"), True)
    # of each fact a key has one row at most
    rows = either.groupBy("month_dt", *_SKEYS).agg(
        *[F.max(m).alias(m) for m in [*measures, *_SERVICE_ONLY]], *[F.max(F.col("tag") == t).alias(f"has_{t}") for t in ("I", "S")])

    dims = _dim_facts(containers, accounts, hierarchy)
    keys = lambda df: df.select("container_grp_sk", "acct_sk")
    rows = rows.join(dims["container_grp_sk"], "container_grp_sk")
    rows = looked_up(rows, dims["acct_sk"], "acct_sk", "container_grp_sk", keys(invoices).unionByName(keys(services)), few)
    rows = rows.join(dims["corp_hier_sk"], "corp_hier_sk").drop(*_SKEYS)
    rows = rows.join(_fees_per_contract(contract_fees), _CONTRACT, "left").drop("contract_nbr", "contract_grp_nbr")
    rows = rows.repartition(account_tasks(invoices), *_ACCOUNT)

    month = F.col("month_dt")
    of = lambda name, value: F.when(F.col(f"has_{name}"), value)
    flag = lambda name, condition: F.max(of(name, F.when(condition, 1).otherwise(0)))
    grouped: dict[str, Column] = {}
    for t in ("I", "S"):
        grouped |= {
            f"{t}_is_franchise": flag(t, F.col("is_franchise") == 1),
            f"{t}_is_national_account": flag(t, F.col("is_national_account") == 1),
            **{f"{t}_{c}": F.max(of(t, F.col(c))) for c in ("container_cnt", "container_size")},
            **{f"{t}_{c}": F.min(of(t, F.col(c))) for c in ("cont_close_mo", "cont_start_mo", "act_close_mo", "act_open_mo")},
        }
    grouped |= {
        "S_new_acct": flag("S", F.col("act_open_mo") == month),
        "S_lost_acct": flag("S", F.col("act_close_mo") == month),
        "S_closed_container": flag("S", F.col("cont_close_mo") == month),
        "S_open_container": F.min(of("S", F.when(F.col("cont_start_mo") == month, 1).otherwise(0))),
        **{f"I_{c}": F.max(of("I", F.col(c))) for c in ("erf_rate_pct", "frf_rate_pct")},
        **{f"I_{c}": flag("I", F.col(c) == 1) for c in ("is_erf_locked", "is_frf_locked", "is_erf_on_frf")},
        # an invoice counts once with each fee of its contract
        **{m: from_units(F.sum(of("I", F.col(m) * F.coalesce("fee_rows", F.lit(1)))), scale) for m, scale in measures.items()},
        **{m: F.sum(of("S", F.col(m))) for m in _SERVICE_ONLY},
        "has_inv": F.max("has_I"),
    }
    whole = rows.groupBy(*GRAIN).agg(*[c.alias(name) for name, c in grouped.items()])
    in_month = lambda name: F.when(F.col("has_inv"), F.when(F.col(name) == month, 1).otherwise(0))
    whole = whole.withColumns(
        {
            "I_new_acct": in_month("I_act_open_mo"),
            "I_lost_acct": in_month("I_act_close_mo"),
            "I_closed_container": in_month("I_cont_close_mo"),
            "I_open_container": in_month("I_cont_start_mo"),
        }
    )
    either = {c: F.coalesce(f"I_{c}", f"S_{c}") for c in _EITHER_SIDE}
    measured = {c: F.coalesce(c, F.lit(0)) for c in [*_INVOICE_ONLY, *_SERVICE_ONLY]}
    fees = {c: F.col(f"I_{c}") for c in _FEE_COLUMNS}
    inv_srvc = whole.select(*GRAIN, *[c.alias(name) for name, c in (either | measured | fees).items()])
    return _with_folded_rates(inv_srvc, snapshot, account_fees) if "spans" in snapshot.columns else with_rates(inv_srvc, snapshot)


def account_fee_flags(account_fees: DataFrame) -> DataFrame:
    """Per account: is the FRF / the ERF charged."""
    charged = (F.col("is_fee_charged") == 1) & (F.col("is_acct_fee_enabled") == 1)
    return (
        current_rows(account_fees)
        .where(F.col("fee_type").isin("FRF", "EVR"))
        .groupBy("div_nbr", "acct_nbr")
        .agg(
            any_flag((F.col("fee_type") == "FRF") & charged).alias("frf_charged"),
            any_flag((F.col("fee_type") == "EVR") & charged).alias("erf_charged"),
        )
    )


_FLAG_COLUMNS = ["frf_charged", "erf_charged"]


def fee_rates(rows: DataFrame, account_fees: DataFrame, division_fees: DataFrame) -> DataFrame:
    """Effective fee fractions per row. Rows without a division fee of their month drop out.

    Rows that carry the flags of their account already, as those of ``three_facts`` may, do not meet the fees again.
    """
    flagged = rows if set(_FLAG_COLUMNS) <= set(rows.columns) else rows.join(account_fee_flags(account_fees), ["div_nbr", "acct_nbr"], "left")
    division = division_fees.select(
        "month_dt", "div_nbr", "is_erf_enabled", "is_frf_enabled",
        F.col("erf_rate").alias("div_erf_pct"), F.col("frf_rate").alias("div_frf_pct"),
    )
    priced = flagged.join(if_small(division), ["month_dt", "div_nbr"])

    def rate(kind: str) -> Column:
        return effective_fee_rate(
            F.col(f"is_{kind}_locked"), F.col(f"{kind}_rate_pct"), F.col(f"div_{kind}_pct"),
            F.col(f"is_{kind}_enabled"), F.col(f"{kind}_charged"),
        )

    full = lambda kind: division_fee_fraction(F.col(f"div_{kind}_pct"), F.col(f"is_{kind}_enabled"))
    return priced.withColumns(
        {
            "full_frf": full("frf"),
            "full_erf": full("erf"),
            "erf_rate": rate("erf"),
            "frf_rate": rate("frf"),
            "is_erf_on_frf": F.coalesce("is_erf_on_frf", F.lit(0)),
        }
    )


def hierarchy_distinct(hierarchy: DataFrame, dropped_area: str = "DIVESTED") -> DataFrame:
    """Current commercial and industrial hierarchy, one row per combination."""
    category = F.col("cur_lob_category")
    return (
        current_rows(hierarchy)
        .where((category.ilike("%commercial%") | category.ilike("%industrial%")) & ~F.col("cur_area_nm").ilike(dropped_area))
        .select(
            "cur_region_nm", "cur_area_nbr", "cur_area_nm", "cur_div_nbr", "cur_div_nm",
            F.concat("cur_bu_nbr", F.lit(" "), "cur_bu_desc").alias("bu_name"), "div_nbr", "div_nm",
        )
        .distinct()
    )


def final_container_table(
    inv_srvc: DataFrame,
    snapshot: DataFrame,
    account_fees: DataFrame,
    division_fees: DataFrame,
    hierarchy: DataFrame,
) -> DataFrame:
    """The refresh's result: revenue and rates with and without fees, flags and account status.

    Rows without a division fee or outside the reported hierarchy are left out (see ``dropped_rows``).
    """
    return final_of(with_rates(inv_srvc, snapshot), account_fees, division_fees, hierarchy)


def final_of(rows: DataFrame, account_fees: DataFrame, division_fees: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """``final_container_table`` from rows of the three facts, however they were brought together."""
    priced = fee_rates(rows, account_fees, division_fees)
    multiplier = fee_multiplier(F.col("is_erf_on_frf"), F.col("frf_rate"), F.col("erf_rate"))
    placed = priced.join(if_small(hierarchy_distinct(hierarchy)), ["cur_div_nbr", "div_nbr"]).withColumn("fee_factor", multiplier)
    factor = F.col("fee_factor")
    base = F.col("bcr_rev") + F.col("bsp_rev") + F.col("bce_rev") + F.col("bcs_rev")
    exists = F.col("bcr_exists") + F.col("bce_exists") + F.col("bcs_exists") + F.col("bsp_exists")
    extra = [c.lower() for c in EXTRA_CODES]
    count = F.col("container_cnt")
    # sums widen to 28 digits and more; back to money width the product with the factor stays exact
    amount = lambda value: value.cast(AMOUNT)
    computed = {
        "bcr_rev_inv_base": base,
        "bcr_rev_inv_fees": factor * amount(base),
        **{f"{c}_rate_inv_fees": factor * amount(F.col(f"{c}_rate")) for c in extra},
        **{f"{c}_rev_inv_fees": factor * amount(F.col(f"{c}_rev")) for c in extra},
        "bcr_rt_base": F.col("bcr_rt") * count,
        "bcs_rt_base": F.col("bcs_rt") * count,
        "bcr_rt_fees": factor * amount(F.col("bcr_rt") * count),
        "bcs_rt_fees": factor * amount(F.col("bcs_rt") * count),
        "bcr_exists": F.when(exists > 0, 1).otherwise(0),
        "fees_pct": factor - 1,
        "acct_status": account_status(
            F.col("new_acct"), F.col("lost_acct"), F.col("open_container"), F.col("closed_container")
        ),
    }
    kept = [
        "month_dt", "cur_region_nm", "cur_area_nbr", "cur_area_nm", "cur_div_nbr", "cur_div_nm", "bu_name", "div_nm",
        "div_nbr", "acct_nbr", "site_nbr", "container_grp_nbr", "is_franchise", "is_national_account",
        *[f"{c}_{m}" for m in ("rev", "rate", "qty_bill_inv", "cnt_srvc") for c in extra],
        "bcr_active_cont_bom", "bcr_active_cont_eom", "bcr_new_cnt", "bcr_lost_cnt",
        "new_acct", "lost_acct", "closed_container", "open_container",
    ]
    return placed.select(*kept, *[expr.alias(name) for name, expr in computed.items()])


def dropped_rows(rows: DataFrame, division_fees: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """How many rows the two inner joins of the final table leave out, per reason."""
    fee_keys = division_fees.select("month_dt", "div_nbr", F.lit(1).alias("__fee")).distinct()
    hier_keys = hierarchy_distinct(hierarchy).select("cur_div_nbr", "div_nbr", F.lit(1).alias("__hier")).distinct()
    probed = rows.join(if_small(fee_keys), ["month_dt", "div_nbr"], "left").join(if_small(hier_keys), ["cur_div_nbr", "div_nbr"], "left")
    reason = F.when(F.col("__fee").isNull(), "no division fee").when(F.col("__hier").isNull(), "outside hierarchy")
    return probed.groupBy(F.coalesce(reason, F.lit("kept")).alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))


SUMMARY_KEYS = [
    "month_dt", "cur_region_nm", "cur_area_nbr", "cur_area_nm", "cur_div_nbr", "cur_div_nm", "bu_name", "div_nm",
    "div_nbr", "is_franchise", "is_national_account", "acct_status", "bcr_exists",
]
SUMMARY_MEASURES = (
    ["bcr_rev_inv_base", "bcr_rev_inv_fees"]
    + [f"{c.lower()}_{m}" for m in ("rev", "rate", "rate_inv_fees", "rev_inv_fees", "qty_bill_inv", "cnt_srvc") for c in EXTRA_CODES]
    + ["bcr_rt_base", "bcs_rt_base", "bcr_rt_fees", "bcs_rt_fees"]
    + ["bcr_active_cont_bom", "bcr_active_cont_eom", "bcr_new_cnt", "bcr_lost_cnt"]
)


def final_summary(final: DataFrame) -> DataFrame:
    return final.groupBy(*SUMMARY_KEYS).agg(*[F.sum(m).alias(m) for m in SUMMARY_MEASURES])


def account_trace(rows: DataFrame, accounts: DataFrame, order: Sequence[str], on: Sequence[str] = ("div_nbr", "acct_nbr")) -> DataFrame:
    """Every row of the given accounts in date order."""
    return rows.join(accounts.select(*on), list(on), "left_semi").orderBy(*on, *order)
