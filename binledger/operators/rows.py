"""Row filters and splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION_FLAGS = ("is_updated", "is_deleted", "is_merged", "is_split")


def live_rows(df: DataFrame, flags: Sequence[str] = VERSION_FLAGS) -> DataFrame:
    """Rows no later version has replaced: every given flag is 0."""
    return df.where(reduce(lambda a, b: a & b, [F.col(f) == 0 for f in flags]))


def current_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_current") == 1)


def unless(condition: Column) -> Column:
    """Negated condition where an unknown one keeps the row."""
    return ~F.coalesce(condition, F.lit(False))


def first_reason(reasons: Mapping[str, Column]) -> Column:
    """Name of the first condition that holds, NULL when none does."""
    return F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in reasons.items()])


def accept_reject(df: DataFrame, reasons: Mapping[str, Column]) -> DataFrame:
    """Keep every row and say why it is rejected; ``reject_reason`` is NULL for accepted rows."""
    return df.withColumn("reject_reason", first_reason(reasons))


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col("reject_reason").isNotNull())


def funnel(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """Rows left after each keep-step, all counted in one pass over ``df``.

    Output: step_no, step, rows_left. Step 0 is the input.
    """
    counts, passed = [F.count(F.lit(1)).alias("s0")], F.lit(True)
    for i, keep in enumerate(steps.values(), 1):
        passed = passed & F.coalesce(keep, F.lit(False))
        counts.append(F.count(F.when(passed, 1)).alias(f"s{i}"))
    names = ["input", *steps]
    lines = F.array(
        *[
            F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"), F.col(f"s{i}").alias("rows_left"))
            for i, name in enumerate(names)
        ]
    )
    return df.agg(*counts).select(F.inline(lines))
