"""Exact ranks over groups of any size.

An unpartitioned window, or one over a group holding a third of all rows, sorts in a single task.
Here rows are range-partitioned on (group, order), numbered inside their range, and shifted by the
number of rows before it; the only thing counted centrally is one number per range.
The order must be total, so that the positions are defined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from binledger.operators.joins import if_small
from binledger.session import stage

_ROW_BITS = (1 << 33) - 1  # low bits of monotonically_increasing_id: row number in its partition


def _ranges(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_position(
    df: DataFrame,
    order: Sequence[Column],
    groups: Sequence[str] = (),
    position: str = "position",
    size: str | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Add the 0-based position of each row inside its group, and the group's size when asked.

    With ``weight`` a row stands for that many equal rows; its position is that of the first of them.
    """
    keys = [F.col(g).asc_nulls_first() for g in groups] + list(order)
    ranged = (
        df.repartitionByRange(_ranges(df), *keys)
        .sortWithinPartitions(*keys)
        .withColumn("__range", F.spark_partition_id())
        .withColumn("__row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    )
    fixed = stage(ranged, "positions")
    if weight is None:
        counts = fixed.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
        inside = fixed
    else:
        counts = fixed.groupBy("__range").agg(F.sum(weight).alias("__n"))
        before = Window.partitionBy("__range").orderBy("__row").rowsBetween(Window.unboundedPreceding, -1)
        inside = fixed.withColumn("__row", F.coalesce(F.sum(weight).over(before), F.lit(0)))

    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("__range", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__shift"))
    # at most one row per range, so the broadcast is bounded by the shuffle partition count
    placed = inside.join(F.broadcast(shifts), "__range").withColumn("__pos", F.col("__shift") + F.col("__row"))

    if not groups:
        out = placed.withColumn(position, F.col("__pos"))
        if size:
            total = counts.agg(F.sum("__n"))
            out = out.withColumn(size, total.scalar())
        return out.drop("__range", "__row", "__shift", "__pos")

    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    starts = placed.groupBy(*[F.col(g).alias(f"__g_{g}") for g in groups]).agg(
        F.min("__pos").alias("__group_first"), rows.alias("__group_size")
    )
    # written, the table of groups has a known size: few groups are broadcast and a hot one is not shuffled
    starts = stage(starts, "groups")
    match = [F.col(g).eqNullSafe(F.col(f"__g_{g}")) for g in groups]
    out = placed.join(starts, match).withColumn(position, F.col("__pos") - F.col("__group_first"))
    if size:
        out = out.withColumn(size, F.col("__group_size"))
    return out.drop("__range", "__row", "__shift", "__pos", "__group_first", "__group_size", *[f"__g_{g}" for g in groups])


def row_ids(df: DataFrame, order: Sequence[Column], name: str = "row_id") -> DataFrame:
    """Gapless ids 1..n in the given order."""
    return with_position(df, order, position=name).withColumn(name, F.col(name) + 1)


def percentile_rank(df: DataFrame, order: Sequence[Column], groups: Sequence[str] = (), name: str = "pct_rank") -> DataFrame:
    """Position as a percent of the way from first to last row, two decimals; 0 for a lone row."""
    ranked = with_position(df, order, groups, "__p", "__m")
    # integer half-up rounding: the quotient is an exact count of hundredths
    hundredths = F.expr("(__p * 20000 + (__m - 1)) div (2 * (__m - 1))")
    return ranked.withColumn(name, F.when(F.col("__m") <= 1, F.lit(0.0)).otherwise(hundredths / F.lit(100.0))).drop(
        "__p", "__m"
    )


def ntile(df: DataFrame, tiles: int, order: Sequence[Column], groups: Sequence[str] = (), name: str = "tile") -> DataFrame:
    """Tiles 1..n per group; the first (size mod n) tiles hold one row more."""
    ranked = with_position(df, order, groups, "__p", "__m")
    small, extra = f"(__m div {tiles})", f"(__m % {tiles})"
    wide_rows = f"({extra} * ({small} + 1))"
    tile = F.expr(
        f"case when __p < {wide_rows} then __p div ({small} + 1) "
        f"else {extra} + (__p - {wide_rows}) div {small} end + 1"
    )
    return ranked.withColumn(name, tile.cast("int")).drop("__p", "__m")


def group_index(df: DataFrame, keys: Sequence[str], groups: Sequence[str] = (), name: str = "group_index") -> DataFrame:
    """Number 1..k of each distinct key in sort order, per outer group.

    Only the distinct keys are ranked; rows get the number by a join.
    """
    distinct = df.select(*groups, *keys).distinct()
    numbered = with_position(distinct, [F.col(k).asc_nulls_first() for k in keys], groups, name)
    numbered = numbered.withColumn(name, F.col(name) + 1).withColumnsRenamed({c: f"__k_{c}" for c in [*groups, *keys]})
    match = [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in [*groups, *keys]]
    return df.join(if_small(numbered), match).drop(*[f"__k_{c}" for c in [*groups, *keys]])
