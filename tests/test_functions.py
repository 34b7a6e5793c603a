import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from binledger.functions import dates, labels, money, text


def one(spark, **columns):
    return [r[0] if len(r) == 1 else tuple(r) for r in spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).collect()][0]


def values(spark, rows, ddl, expr):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(expr).collect()]


def test_day_keys(spark):
    got = values(spark, [(20160229,), (20160231,), (20161301,), (0,), (None,)], "k int", dates.date_of_day_key(F.col("k")))
    assert got == [dt.date(2016, 2, 29), None, None, None, None]
    assert one(spark, m=dates.month_of_day_key(F.lit(20160731)), z=dates.month_of_day_key(F.lit(0))) == (201607, 0)


def test_active_between_bounds(spark):
    rows = [(20160101, 0), (20160101, 20160301), (20160101, 20160302), (20160401, 0), (20160331, 0)]
    got = values(spark, rows, "e int, c int", dates.active_between(F.col("e"), F.col("c"), F.lit(20160301), F.lit(20160401)))
    assert got == [True, False, True, False, True]


def test_spreadsheet_dates(spark):
    got = values(spark, [("42736",), ("2017-01-01",), ("2017-01-01 00:00",), ("x",)], "t string", dates.serial_or_iso_date(F.col("t")))
    assert got == [dt.date(2017, 1, 1)] * 3 + [None]


def test_padding_keeps_long_values(spark):
    assert values(spark, [(7,), (123456,)], "n long", text.pad_key(F.col("n"), 4)) == ["0007", "123456"]
    assert one(spark, k=text.account_key(F.lit(28), F.lit(12345))) == "028-0012345"


def test_base36_edges(spark):
    got = values(spark, [(1,), (13,), (35,), (36,), (46656,), (1679616,)], "n long", text.base36(F.col("n")))
    assert got == ["0001", "000D", "000Z", "0010", "1000", "10000"]


def test_email_rules(spark):
    rows = [("a.b@c.com, old one",), ("none@x.com",), ("a@None.com",), ("NoEmail@x.com",), ("me@own.com",), ("not an address",), (None,), ("o'neil@x.org",)]
    df = spark.createDataFrame(rows, "raw string").select(text.clean_email(F.col("raw")).alias("e"))
    got = df.select("e", text.email_reject_reason(F.col("e"), "Own.com").alias("r")).collect()
    assert [r.r for r in got] == [None, "none_user", "none_domain", "no_email", "own_domain", "not_an_address", "not_an_address", None]
    assert got[0].e == "a.b@c.com" and got[7].e == "oneil@x.org"


def test_occurrences_do_not_overlap(spark):
    assert values(spark, [("aaaa",), ("",), (None,), ("Aa aa",)], "t string", text.occurrences(F.col("t"), "aa")) == [2, 0, None, 1]


def test_fee_rates_and_multiplier(spark):
    ddl = "locked int, pct decimal(5,2), div decimal(5,2), en int, ch int"
    rows = [(1, Decimal("5"), Decimal("9"), None, None), (1, None, Decimal("9"), 1, 1), (None, Decimal("5"), Decimal("9"), 1, None),
            (0, Decimal("5"), Decimal("9"), 0, 1), (0, Decimal("5"), Decimal("9"), 1, 0), (0, Decimal("5"), Decimal("9"), None, 1)]
    rate = money.effective_fee_rate(*[F.col(c) for c in ("locked", "pct", "div", "en", "ch")])
    got = values(spark, rows, ddl, rate)
    assert got == [Decimal("0.05"), None, Decimal("0.09"), Decimal(0), Decimal(0), None]
    d = lambda v: money.dec(v)
    both = one(spark, on=money.fee_multiplier(F.lit(1), d("0.1"), d("0.2")), off=money.fee_multiplier(F.lit(None).cast("int"), d("0.1"), d("0.2")))
    assert both == (Decimal("1.32"), Decimal("1.30"))


def test_fee_load_compounds_when_told(spark):
    load = money.fee_load(money.dec("100.00"), money.dec("5.00"), F.lit(1), money.dec("10.00"), F.lit(1), money.dec("20.00"), F.lit(1), F.lit(1))
    assert one(spark, **load) == (Decimal("105"), Decimal("10.5"), Decimal("23.1"), Decimal("138.6"))


def test_units_round_trip(spark):
    got = values(spark, [(Decimal("-12.34"),), (Decimal("0.00"),), (None,)], "v decimal(18,2)", money.from_units(money.as_units(F.col("v"), 2), 2))
    assert got == [Decimal("-12.34"), Decimal("0.00"), None]


def test_account_status_order(spark):
    rows = [(1, 0, 1, 0), (1, 1, 0, 0), (0, 0, 1, 0), (0, 0, 1, 1), (0, 0, 0, 0), (None, None, None, None)]
    got = values(spark, rows, "n int, l int, o int, c int", labels.account_status(*[F.col(x) for x in "nloc"]))
    assert got == ["NEW ACCOUNT", "LOST ACCOUNT", "EXISTING - NEW CONTAINER", "EXISTING - CLOSED CONTAINER", "EXISTING - NO CHANGE", None]


def test_tenure_bands(spark):
    rows = [(m,) for m in (18, 19, 36, 37, 60, 72, 73, 108, 109, 180, 181, None)]
    panel = values(spark, rows, "m int", labels.tenure_range(F.col("m")))
    assert panel[0] == "Less than 3 Years" and panel[2] == "Over 15 Years" and panel[3] == panel[5] == "Between 3 and 6 Years"
    assert panel[-1] == "Over 15 Years" and panel[9] == "Between 10 and 15 Years"
    summary = values(spark, rows, "m int", labels.tenure_group(F.col("m")))
    assert summary == ["18 mo or less"] + ["19 mo to 3 yrs"] * 2 + ["3 to 6 yrs"] * 2 + ["6 to 9 yrs"] * 3 + ["more than 9 yrs"] * 3 + ["err"]
    strata = values(spark, [(3.0,), (3.01,), (6.0,)], "y double", labels.tenure_stratum(F.col("y")))
    assert strata == ["less than 3 yrs", "3 to 6 years", "greater than 6 yrs"]


def test_treatment_thresholds(spark):
    rows = [(x,) for x in (0.0, 0.15, 0.3, 0.55, 0.8, 0.999)]
    assert values(spark, rows, "u double", labels.treatment_group(F.col("u"))) == ["A22", "A21", "A12", "A11", "HO", "HO"]


def test_ceil_to_step(spark):
    assert values(spark, [(1.01,), (1.25,), (-0.1,)], "v double", money.ceil_to(F.col("v"), F.lit(0.25))) == [1.25, 1.25, 0.0]
