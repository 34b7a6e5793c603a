"""Grouped results: conditional sums, first rows, wide tables, subtotals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sums_by_code(code: Column, codes: Sequence[str], value: Column, suffix: str) -> list[Column]:
    """One conditional sum per code, 0 where the code is absent; codes match in any case."""
    return [
        F.sum(F.when(F.upper(code) == c.upper(), value).otherwise(F.lit(0))).alias(f"{c.lower()}_{suffix}")
        for c in codes
    ]


def decimal_scale(df: DataFrame, column: str) -> int:
    """Digits after the point of a decimal column; whole numbers have none."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return kind.scale
    if isinstance(kind, T.IntegralType):
        return 0
    raise TypeError(f"{column} must be decimal or integral, not {kind.simpleString()}")


def any_flag(condition: Column) -> Column:
    return F.max(F.when(condition, 1).otherwise(0))


def every_flag(condition: Column) -> Column:
    return F.min(F.when(condition, 1).otherwise(0))


def strict_sum(value: Column) -> Column:
    """Sum that is NULL as soon as one input is."""
    return F.when(F.count(F.lit(1)) == F.count(value), F.sum(value))


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in a total order.

    ``row_number() = 1`` lets Spark cut each key to one row per task before the shuffle, so a hot key
    never travels whole.
    """
    ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("__rn") == 1).drop("__rn")


def latest_row(df: DataFrame, keys: Sequence[str], stamp: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Newest row per key by one or more stamps; ``tie`` columns make the choice total."""
    order = [F.col(c).desc_nulls_last() for c in stamp] + [F.col(c).asc_nulls_first() for c in tie]
    return dedup_first(df, keys, order)


def group_size(df: DataFrame, keys: Sequence[str], name: str, weight: Column | None = None) -> DataFrame:
    """Write the size (or summed weight) of each row's group back to the row.

    Counted map-side and joined back, so that no group has to sit in one task as a window would want.
    NULL keys form a group of their own.
    """
    measure = F.count(F.lit(1)) if weight is None else F.sum(weight)
    sizes = df.groupBy(*[F.col(k).alias(f"__g_{k}") for k in keys]).agg(measure.alias(name))
    match = [F.col(k).eqNullSafe(F.col(f"__g_{k}")) for k in keys]
    return df.join(sizes, match, "left").drop(*[f"__g_{k}" for k in keys])


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def arg_max(df: DataFrame, keys: Sequence[str], value: str, tie: Sequence[str]) -> DataFrame:
    """The whole row holding the largest ``value`` of its key."""
    return latest_row(df, keys, [value], tie)


def at_most_sites(df: DataFrame, account: Sequence[str], site: str, limit: int) -> DataFrame:
    """Rows of accounts with at most ``limit`` distinct sites; rows without a site make one more."""
    sites = df.groupBy(*account, site).agg(F.lit(1).alias("__one"))
    small = sites.groupBy(*account).agg(F.count(F.lit(1)).alias("__sites")).where(F.col("__sites") <= limit)
    return df.join(small.drop("__sites"), list(account), "left_semi")


def wide_flags(df: DataFrame, keys: Sequence[str], kind: str, kinds: Sequence[str], flag: str) -> DataFrame:
    """One column per kind with the largest flag seen; NULL where the kind never occurs."""
    return df.groupBy(*keys).pivot(kind, list(kinds)).agg(F.max(flag))


def month_columns(
    df: DataFrame, keys: Sequence[str], month: str, months: Sequence[int], values: Mapping[str, str]
) -> DataFrame:
    """One row per key, per month an ``active_<m>`` flag and each value (0 where there is no row).

    One pass instead of one self-join per month. (key, month) must be unique: a repeated one fails the job.
    """
    columns = []
    for m in months:
        here = F.col(month) == m
        repeated = F.count(F.when(here, 1)) > 1
        columns.append(F.when(repeated, F.raise_error(F.lit(f"a key has two rows in {m}")).cast("int")).otherwise(any_flag(here)).alias(f"active_{m}"))
        columns += [F.coalesce(F.max(F.when(here, F.col(v))), F.lit(0)).alias(f"{out}_{m}") for out, v in values.items()]
    return df.where(F.col(month).isin(list(months))).groupBy(*keys).agg(*columns)


def crosstab_totals(
    df: DataFrame, row: str, column: str, column_values: Sequence[str], blank: str = "(blank)", total: str = "Grand Total",
    other: str = "(other)",
) -> DataFrame:
    """Counts per row and column value with buckets for blanks and unlisted values, and totals on both sides.

    The cube runs over the counted cells, not over the input rows.
    """
    value = F.col(column).cast("string")
    cells = df.groupBy(
        F.coalesce(F.col(row).cast("string"), F.lit(blank)).alias(row),
        F.when(value.isNull(), blank).when(value.isin(list(column_values)), value).otherwise(other).alias(column),
    ).agg(F.count(F.lit(1)).alias("__n"))
    cubed = cells.cube(row, column).agg(F.sum("__n").alias("__n"))
    named = cubed.select(
        F.coalesce(row, F.lit(total)).alias(row), F.coalesce(column, F.lit(total)).alias(column), "__n"
    )
    heads = [*column_values, other, blank, total]
    wide = named.groupBy(row).pivot(column, heads).agg(F.sum("__n"))
    return wide.select(row, *[F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias(h) for h in heads])


def detail_with_subtotals(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Detail rows plus one subtotal row per key; columns a subtotal does not have are NULL."""
    subtotals = df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures]).withColumn("row_kind", F.lit("subtotal"))
    return df.withColumn("row_kind", F.lit("detail")).unionByName(subtotals, allowMissingColumns=True)
