"""Billing tables derived from a retail star schema (orders, line items, customers, parts, nations).

An account is a customer, a container group is an order, an invoice, service or charge line is a line
item, a division is a nation. Every table is a plain projection or grouping of the given ones, so the
jobs on top grow with them.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from binledger.functions.dates import OPEN_END, day_key, month_key
from binledger.functions.text import pad_key
from binledger.plans.container import INVOICE_CODES
from binledger.session import stage, stage_bucketed
from binledger.sources.tables import literal_table, read_table

FIRST_MONTH, LAST_MONTH = dt.date(1995, 1, 1), dt.date(2001, 12, 1)
AS_OF = dt.date(2001, 9, 1)

# Charge code per return flag and line number; two codes lie outside the refresh list.
LINE_CODES = {f"{flag}{n}": code for flag in "ANR" for n, code in enumerate(INVOICE_CODES, 1)}
LINE_CODES.update(R1="RCC", R2="FRE", N6="cex")


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def _rate(column: str) -> Column:
    return F.col(column).cast("decimal(4,2)")


class Retail:
    """Lazy billing views over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.folder}/{name}.parquet")

    @cached_property
    def placed_orders(self) -> DataFrame:
        """Orders with the customer's division."""
        customer = self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        return self.table("orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))

    @cached_property
    def placed_lines(self) -> DataFrame:
        order = self.placed_orders.select(
            "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "c_nationkey", "c_mktsegment"
        )
        return self.table("lineitem").join(order, F.col("l_orderkey") == F.col("o_orderkey"))

    def _line_flags(self) -> dict[str, Column]:
        return {
            "is_updated": _flag(_rate("l_discount") == F.lit(Decimal("0.10"))),
            "is_deleted": _flag(_rate("l_tax") == F.lit(Decimal("0.08"))),
            "is_merged": _flag(F.col("l_quantity") == 50),
            "is_split": _flag(F.col("l_quantity") == 1),
        }

    def _line_keys(self) -> list[Column]:
        return [
            F.col("o_custkey").alias("acct_sk"),
            F.col("l_orderkey").alias("container_grp_sk"),
            (F.col("c_nationkey").cast("long") * 10 + _flag(F.col("c_mktsegment") == "BUILDING")).alias("corp_hier_sk"),
        ]

    @cached_property
    def invoice_detail(self) -> DataFrame:
        code = F.concat("l_returnflag", F.col("l_linenumber").cast("string"))
        return self.placed_lines.select(
            month_key(F.col("l_shipdate")).alias("revenue_period"),
            *self._line_keys(),
            code.alias("charge_cd_sk"),
            F.col("l_partkey").alias("rate_sk"),
            _money("l_extendedprice").alias("revenue_amt"),
            _money("l_quantity").alias("qty_billed"),
            _flag(F.col("l_returnflag") == "R").alias("is_credit"),
            *[c.alias(n) for n, c in self._line_flags().items()],
        )

    @cached_property
    def service_detail(self) -> DataFrame:
        code = F.concat("l_returnflag", F.col("l_linenumber").cast("string"))
        flags = self._line_flags()
        return self.placed_lines.select(
            day_key(F.col("l_shipdate")).alias("service_day"),
            *self._line_keys(),
            code.alias("service_cd_sk"),
            F.col("l_quantity").cast("int").alias("container_cnt"),
            flags["is_deleted"].alias("is_deleted"),
            flags["is_updated"].alias("is_updated"),
        )

    @cached_property
    def dim_acct(self) -> DataFrame:
        span = self.table("orders").groupBy("o_custkey").agg(
            F.min("o_orderdate").cast("date").alias("acct_open_dt"),
            F.max("o_orderdate").cast("date").alias("acct_close_dt"),
        )
        return (
            self.table("customer")
            .join(span, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select(
                F.col("c_custkey").alias("acct_sk"),
                pad_key(F.col("c_nationkey"), 3).alias("div_nbr"),
                pad_key(F.col("c_custkey"), 7).alias("acct_nbr"),
                "acct_open_dt",
                "acct_close_dt",
                _flag(F.col("c_mktsegment") == "HOUSEHOLD").alias("is_national_account"),
                F.lit(1).alias("is_current"),
            )
        )

    @cached_property
    def dim_container_grp(self) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        status, price = F.col("o_orderstatus"), F.col("o_totalprice")
        hundreds = F.floor(price / 100000).cast("int")
        return self.placed_orders.select(
            F.col("o_orderkey").alias("container_grp_sk"),
            pad_key(F.col("c_nationkey"), 3).alias("div_nbr"),
            pad_key(F.col("o_custkey"), 7).alias("acct_nbr"),
            pad_key(F.substring("o_orderpriority", 1, 1), 5).alias("site_nbr"),
            F.col("o_orderkey").cast("string").alias("container_grp_nbr"),
            (hundreds + 1).alias("container_cnt"),
            F.floor(price / 40000).cast("int").alias("container_size"),
            F.when(status == "F", "FR").when(price < 100000, "YW").when(price < 400000, "FL").alias("container_cd"),
            _flag(F.col("o_orderpriority") == "5-LOW").alias("is_franchise"),
            day.alias("orig_start_dt"),
            F.when(status == "F", F.date_add(day, 90)).when(status == "P", F.date_add(day, 900)).otherwise(F.lit(OPEN_END)).alias("close_dt"),
            hundreds.cast("string").alias("contract_nbr"),
            F.lit("0").alias("contract_grp_nbr"),
            F.when(F.col("c_mktsegment") == "BUILDING", "31").otherwise("10").alias("rev_distrib_cd"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "X").otherwise("P").alias("acct_type"),
            F.when(price >= 450000, "91").otherwise("10").alias("district_cd"),
            F.when(status == "O", 12).otherwise(4).alias("recurring_charge_freq"),
            hundreds.alias("pickup_lifts"),
            F.when(status == "P", 2).otherwise(1).alias("pickup_length"),
            F.when((F.col("c_mktsegment") == "MACHINERY") & (price < 150000), "UNKNOWN").otherwise("WEEK").alias("pickup_unit"),
            F.lit(1).alias("is_current"),
        )

    @cached_property
    def dim_charge_cd(self) -> DataFrame:
        return literal_table(self.spark, {"charge_cd_sk": list(LINE_CODES), "charge_cd": list(LINE_CODES.values())})

    @cached_property
    def dim_service_cd(self) -> DataFrame:
        return self.dim_charge_cd.toDF("service_cd_sk", "service_cd")

    @cached_property
    def dim_rate_hist(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("rate_sk"), _money("p_retailprice").alias("rate_amt"))

    @cached_property
    def nations(self) -> DataFrame:
        return self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))

    @cached_property
    def dim_corp_hier(self) -> DataFrame:
        nation = self.nations.withColumn("rev_distrib_cd", F.explode(F.array(F.lit("10"), F.lit("31"))))
        industrial = F.col("rev_distrib_cd") == "31"
        region = F.col("r_name")
        lob = (
            F.when(industrial, "Small Industrial")
            .when(region == "AFRICA", "Commercial")
            .when(region == "AMERICA", "COMMERCIAL")
            .when(region == "ASIA", "Residential")
            .when(region == "EUROPE", "commercial hauling")
            .otherwise("Commercial")
        )
        return nation.select(
            (F.col("n_nationkey").cast("long") * 10 + _flag(industrial)).alias("corp_hier_sk"),
            region.alias("cur_region_nm"),
            F.concat(F.lit("A"), F.col("n_regionkey").cast("string")).alias("cur_area_nbr"),
            F.when(F.col("n_name") == "NATION_24", "Divested").otherwise(F.concat(region, F.lit(" AREA"))).alias("cur_area_nm"),
            F.concat(F.lit("4"), pad_key(F.col("n_nationkey"), 3)).alias("cur_div_nbr"),
            F.col("n_name").alias("cur_div_nm"),
            F.concat(F.lit("BU"), pad_key(F.col("n_nationkey"), 3)).alias("cur_bu_nbr"),
            F.when(F.col("n_name") != "NATION_7", F.lower("n_name")).alias("cur_bu_desc"),
            pad_key(F.col("n_nationkey"), 3).alias("div_nbr"),
            F.concat(F.lit("DIV "), F.col("n_name")).alias("div_nm"),
            "rev_distrib_cd",
            lob.alias("cur_lob_category"),
            _flag(~(industrial & (region == "MIDDLE EAST"))).alias("is_current"),
        )

    @cached_property
    def dim_contract_fee(self) -> DataFrame:
        balance = F.col("s_acctbal")
        level = (F.floor(balance / 1000) + 1).cast("decimal(3,0)")
        grouped = self.table("supplier").groupBy(
            pad_key(F.col("s_nationkey"), 3).alias("div_nbr"),
            F.floor(F.greatest(balance, F.lit(0.0)) / 2000).cast("string").alias("contract_nbr"),
        ).agg(
            F.max(level * F.lit(0.50).cast("decimal(3,2)")).cast("decimal(5,2)").alias("erf_rate_pct"),
            F.max(level * F.lit(0.75).cast("decimal(3,2)")).cast("decimal(5,2)").alias("frf_rate_pct"),
            F.max(_flag(balance > 3000)).alias("is_erf_locked"),
            F.max(_flag(balance > 6000)).alias("is_frf_locked"),
            F.max(_flag(balance > 5000)).alias("is_erf_on_frf"),
        )
        ends = F.when(F.col("contract_nbr") == "2", F.lit(dt.date(1998, 6, 30))).otherwise(F.lit(OPEN_END))
        return grouped.select(
            "div_nbr", "contract_nbr", F.lit("0").alias("contract_grp_nbr"), "erf_rate_pct", "frf_rate_pct",
            "is_erf_locked", "is_frf_locked", "is_erf_on_frf",
            F.lit(dt.date(1995, 1, 1)).alias("eff_dt"), ends.alias("disc_dt"),
            _flag(F.col("contract_nbr") != "2").alias("is_current"),
        )

    @cached_property
    def dim_acct_fee(self) -> DataFrame:
        balance, segment = F.col("c_acctbal"), F.col("c_mktsegment")

        def fee(kind: str, charged: Column, enabled: Column, current: Column) -> Column:
            return F.struct(
                F.lit(kind).alias("fee_type"), _flag(charged).alias("is_fee_charged"),
                _flag(enabled).alias("is_acct_fee_enabled"), F.lit(dt.date(1995, 1, 1)).alias("eff_dt"),
                F.when(current, F.lit(OPEN_END)).otherwise(F.lit(dt.date(1998, 12, 31))).alias("disc_dt"), _flag(current).alias("is_current"),
            )

        yes = F.lit(True)
        fees = F.array(
            fee("FRF", balance > 0, segment != "MACHINERY", segment != "FURNITURE"),
            fee("EVR", balance > 2000, yes, yes),
            fee("INV", segment.isin("BUILDING", "HOUSEHOLD"), yes, yes),
        )
        return self.table("customer").select(
            pad_key(F.col("c_nationkey"), 3).alias("div_nbr"), pad_key(F.col("c_custkey"), 7).alias("acct_nbr"), F.inline(fees)
        )

    @cached_property
    def dim_division_fee(self) -> DataFrame:
        first = F.when(F.col("r_name") == "AFRICA", F.lit(dt.date(1996, 1, 1))).otherwise(F.lit(FIRST_MONTH))
        months = F.explode(F.sequence(first, F.lit(LAST_MONTH), F.expr("interval 1 month"))).alias("m")
        level = F.col("n_regionkey").cast("decimal(2,0)")
        return self.nations.select("n_nationkey", "r_name", "n_regionkey", months).select(
            month_key(F.col("m")).alias("month_dt"),
            pad_key(F.col("n_nationkey"), 3).alias("div_nbr"),
            ((level + 1) * F.lit(1.25).cast("decimal(3,2)")).cast("decimal(5,2)").alias("erf_rate"),
            ((level + 2) * F.lit(1.10).cast("decimal(3,2)")).cast("decimal(5,2)").alias("frf_rate"),
            _flag(F.col("r_name") != "ASIA").alias("is_erf_enabled"),
            F.lit(1).alias("is_frf_enabled"),
        )

    @cached_property
    def division_fee_rate(self) -> DataFrame:
        level = F.col("n_regionkey").cast("decimal(2,0)")
        return self.nations.select(
            pad_key(F.col("n_nationkey"), 3).alias("div_nbr"),
            ((level + 2) * F.lit(1.10).cast("decimal(3,2)")).cast("decimal(5,2)").alias("frf_rate"),
            ((level + 1) * F.lit(1.25).cast("decimal(3,2)")).cast("decimal(5,2)").alias("erf_rate"),
            (level + F.lit(4.50).cast("decimal(3,2)")).cast("decimal(5,2)").alias("admin_fee"),
            _flag(F.col("r_name").isin("AFRICA", "EUROPE")).alias("erf_on_frf"),
        )

    @cached_property
    def charge_rates(self) -> DataFrame:
        """Charge lines valid from the earlier to the later of order and ship day; status O stays open."""
        begin, end = F.least("o_orderdate", "l_shipdate"), F.greatest("o_orderdate", "l_shipdate")
        codes = F.create_map(*[F.lit(x) for pair in LINE_CODES.items() for x in pair])
        return self.placed_lines.select(
            pad_key(F.col("c_nationkey"), 3).alias("div_nbr"),
            pad_key(F.col("o_custkey"), 7).alias("acct_nbr"),
            pad_key(F.substring("o_orderpriority", 1, 1), 5).alias("site_nbr"),
            F.col("o_orderkey").cast("string").alias("container_grp_nbr"),
            codes[F.concat("l_returnflag", F.col("l_linenumber").cast("string"))].alias("charge_code"),
            F.when(F.col("l_returnflag") == "N", "W").otherwise("R").alias("charge_type"),
            F.when(F.col("l_linestatus") == "F", "Q").otherwise("F").alias("charge_method"),
            F.concat(F.lit("T"), F.col("l_linenumber").cast("string")).alias("tax_app_code"),
            _money("l_extendedprice").alias("charge_rate"),
            day_key(begin).alias("effective_date"),
            F.when(F.col("l_linestatus") == "O", 0).otherwise(day_key(end)).alias("close_date"),
            F.when(_rate("l_tax") == F.lit(Decimal("0.08")), "1").otherwise("0").alias("adj_flag"),
            F.when(_rate("l_discount") == F.lit(Decimal("0.10")), "N").when(F.col("l_returnflag") == "N", "y").otherwise("Y").alias("current_ind"),
            F.col("l_shipdate").alias("stamped_at"),
        )


class LaidOutRetail(Retail):
    """The same tables, with those that several facts read written once, in buckets of the container.

    Orders, line items and what is derived from them line by line lie in as many buckets of the same key, so their
    joins and groupings by container need no exchange.
    """

    @cached_property
    def placed_orders(self) -> DataFrame:
        return stage_bucketed(super().placed_orders, "placed-orders", ["o_orderkey"])

    @cached_property
    def placed_lines(self) -> DataFrame:
        used = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                "l_returnflag", "l_linestatus", "l_shipdate"]
        order = self.placed_orders.select(
            "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "c_nationkey", "c_mktsegment"
        )
        lines = self.table("lineitem").select(*used).join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        return stage_bucketed(lines, "placed-lines", ["l_orderkey"], arranged=True)

    @cached_property
    def dim_acct(self) -> DataFrame:
        return stage(super().dim_acct, "accounts")
