"""Column profiles: missing values, summary statistics, mean fill, word counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.functions.text import occurrences
from binledger.operators.selection import quantiles


def _long(df: DataFrame, per_column: dict[str, dict[str, str]]) -> DataFrame:
    """Unfold one wide row of aggregates into one row per column."""
    rows = [
        F.struct(F.lit(column).alias("column_name"), *[F.col(src).alias(out) for out, src in outs.items()])
        for column, outs in per_column.items()
    ]
    return df.select(F.inline(F.array(*rows)))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Length and missing values per column, in one pass."""
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.count(F.when(F.col(c).isNull(), 1)).alias(f"m{i}") for i, c in enumerate(columns)]
    wide = df.agg(*aggs)
    return _long(wide, {c: {"rows_total": "n", "rows_missing": f"m{i}"} for i, c in enumerate(columns)})


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    aggs, outs = [], {}
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"n{i}"),
            F.avg(x).alias(f"a{i}"),
            F.stddev_samp(x).alias(f"d{i}"),
            F.min(x).alias(f"lo{i}"),
            F.max(x).alias(f"hi{i}"),
        ]
        outs[c] = {"n": f"n{i}", "mean": f"a{i}", "std": f"d{i}", "min": f"lo{i}", "max": f"hi{i}"}
    moments = _long(df.agg(*aggs), outs)
    names = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    quartiles = (
        quantiles(df, columns, list(names))
        .groupBy("column_name")
        .agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name) for p, name in names.items()])
    )
    return moments.join(quartiles, "column_name", "left").select(
        "column_name", "n", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def mean_impute(df: DataFrame, column: str, digits: int = 4) -> DataFrame:
    """Fill missing values with the rounded mean of the others."""
    mean = df.agg(F.round(F.avg(F.col(column).cast("decimal(18,4)")), digits).cast("double"))
    return df.withColumn(column, F.coalesce(F.col(column), mean.scalar()))


def word_occurrences(df: DataFrame, text: str, words: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Occurrences of each given string per group, over the whole texts, in one pass."""
    wide = df.groupBy(*by).agg(*[F.sum(occurrences(F.col(text), w)).alias(f"w{i}") for i, w in enumerate(words)])
    rows = [F.struct(F.lit(w).alias("word"), F.coalesce(F.col(f"w{i}"), F.lit(0)).alias("hits")) for i, w in enumerate(words)]
    return wide.select(*by, F.inline(F.array(*rows)))
