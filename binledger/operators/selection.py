"""Exact order statistics without a sort.

A rank is bracketed by two values that a mergeable sketch puts safely below and above it, and a second pass counts the
rows below the bracket and inside it, so the bracket is proven, or given up, by counting. A bracket shrinks to about
4 / ``ACCURACY`` of its rows per round; when no more than ``SMALL`` rows lie in it, its values are counted and the rank is
read off. Every pass is one aggregation with partial results; only the rows of the last brackets are grouped, and nothing
is range-partitioned or written.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

#: Relative accuracy of the sketch (its rank error is one part in this many rows), and rows of a bracket to stop at.
ACCURACY, SMALL = 1_000, 50_000


@dataclass
class _Bracket:
    """Where the values of the ranks ``first`` to ``last`` lie: between two values (None: unbounded), ``below`` rows
    before, ``inside`` rows."""

    column: str
    first: int
    last: int
    below: int
    inside: int
    low: float | None = None
    high: float | None = None
    slack: float = 2.0

    def holds(self, x: Column) -> Column:
        out = x.isNotNull()
        if self.low is not None:
            out = out & (x >= F.lit(self.low))
        return out if self.high is None else out & (x <= F.lit(self.high))

    @property
    def settled(self) -> bool:
        return self.inside <= SMALL or (self.low is not None and self.low == self.high)

    def edges(self) -> list[float]:
        """Shares of the rows inside that lie safely before and behind the ranks."""
        most, spare = max(self.inside - 1, 1), self.slack / ACCURACY
        return [max((self.first - self.below) / most - spare, 0.0), min((self.last - self.below) / most + spare, 1.0)]


def _narrow(df: DataFrame, open_: list[_Bracket]) -> None:
    """One round: sketch inside every open bracket, then count below and inside the narrower ones."""
    # brackets with the same bounds share a sketch
    shared: dict[tuple, list[_Bracket]] = {}
    for b in open_:
        shared.setdefault((b.column, b.low, b.high), []).append(b)
    aims = []
    for i, some in enumerate(shared.values()):
        edges = [e for b in some for e in b.edges()]
        aims.append(_sketch(some[0], edges).alias(f"e{i}"))
    _take(df, list(shared.values()), df.agg(*aims).first())


def _sketch(bracket: _Bracket, edges: list[float]) -> Column:
    x = F.col(bracket.column)
    whole = bracket.low is None and bracket.high is None
    return F.percentile_approx(x if whole else F.when(bracket.holds(x), x), edges, ACCURACY)


def _take(df: DataFrame, shared: list[list[_Bracket]], found: Row | dict) -> None:
    """Narrow every bracket to its sketched edges ``found`` (e<i>: those of group i) where the counts agree."""
    tried: list[tuple[_Bracket, _Bracket]] = []
    for i, some in enumerate(shared):
        for k, b in enumerate(some):
            low, high = float(found[f"e{i}"][2 * k]), float(found[f"e{i}"][2 * k + 1])
            tried.append((b, _Bracket(b.column, b.first, b.last, 0, 0, low, high)))
    counts = []
    for i, (_, t) in enumerate(tried):
        x = F.col(t.column)
        counts += [F.count(F.when(x < F.lit(t.low), 1)).alias(f"b{i}"), F.count(F.when(t.holds(x), 1)).alias(f"i{i}")]
    got = df.agg(*counts).first()
    for i, (b, t) in enumerate(tried):
        below, inside = got[f"b{i}"], got[f"i{i}"]
        if below <= b.first and b.last < below + inside and inside < b.inside:
            b.low, b.high, b.below, b.inside, b.slack = t.low, t.high, below, inside, 2.0
        else:
            b.slack *= 8  # the sketch missed: a wider bracket next time


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact interpolated quantiles of several numeric columns: column_name, prob, value.

    NULL values do not count; a column without values gives no rows. NaN is the largest value.
    """
    probs = sorted(set(map(float, probs)))
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    # the numbers of values, and the sketch of the first round
    spare = 2.0 / ACCURACY
    edges = [e for p in probs for e in (max(p - spare, 0.0), min(p + spare, 1.0))]
    first = values.agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.percentile_approx(c, edges, ACCURACY).alias(f"e{i}") for i, c in enumerate(columns)],
    ).first()
    brackets, sketched, aims = [], {}, []
    for i, c in enumerate(columns):
        n = first[f"n{i}"]
        for k, p in enumerate(probs if n else []):
            target = p * (n - 1)
            low, high = math.floor(target), math.ceil(target)
            aims.append((c, p, low, high, target - low))
            b = _Bracket(c, low, high, 0, n)
            sketched.setdefault(i, []).append((b, first[f"e{i}"][2 * k : 2 * k + 2]))
            brackets.append(b)
    if not aims:
        return df.sparkSession.createDataFrame([], "column_name string, prob double, value double")
    groups = list(sketched.values())
    _take(values, [[b for b, _ in g] for g in groups], {f"e{i}": [e for _, pair in g for e in pair] for i, g in enumerate(groups)})
    found = _select(values, brackets)
    ends = F.array(*[
        F.struct(F.lit(c).alias("aimed"), F.lit(p).alias("prob"), F.lit(low).cast("long").alias("low"),
                 F.lit(high).cast("long").alias("high"), F.lit(part).alias("part"))
        for c, p, low, high, part in aims
    ])
    # one row per found rank, met by the aims that use it
    wanted = found.withColumn("aim", F.explode(F.filter(ends, lambda e: (e["aimed"] == F.col("column_name")) & (
        (e["low"] == F.col("rank")) | (e["high"] == F.col("rank"))))))
    both = wanted.groupBy("column_name", "aim").agg(
        F.max(F.when(F.col("rank") == F.col("aim.low"), F.col("value"))).alias("lo"),
        F.max(F.when(F.col("rank") == F.col("aim.high"), F.col("value"))).alias("hi"),
    )
    step = F.when(F.col("aim.part") == 0, F.lit(0.0)).otherwise((F.col("hi") - F.col("lo")) * F.col("aim.part"))
    return both.select("column_name", F.col("aim.prob").alias("prob"), (F.col("lo") + step).alias("value"))


def _select(df: DataFrame, brackets: list[_Bracket]) -> DataFrame:
    """(column_name, rank, value) of the brackets' ranks; a rank of two brackets comes twice."""
    while open_ := [b for b in brackets if not b.settled and b.slack < ACCURACY]:
        _narrow(df, open_)
    entries = [
        F.when(
            b.holds(F.col(b.column)),
            F.struct(F.lit(i).alias("bracket"), F.col(b.column).alias("value")),
        )
        for i, b in enumerate(brackets)
    ]
    # few rows lie in a bracket; only for these are the brackets unfolded
    near = df.where(reduce(lambda a, b: a | b, [b.holds(F.col(b.column)) for b in brackets]))
    hits = near.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")).select("e.*")
    counted = hits.groupBy("bracket", "value").agg(F.count(F.lit(1)).alias("copies"))
    upto = F.sum("copies").over(Window.partitionBy("bracket").orderBy("value"))
    known = F.array(*[
        F.struct(F.lit(b.column).alias("column_name"), F.lit(b.below).cast("long").alias("below"),
                 F.array(*[F.lit(r).cast("long") for r in range(b.first, b.last + 1)]).alias("ranks"))
        for b in brackets
    ])
    placed = counted.withColumn("upto", upto).withColumn("of", F.element_at(known, F.col("bracket") + 1))
    place = placed.withColumns({"begin": F.col("of.below") + F.col("upto") - F.col("copies"), "end": F.col("of.below") + F.col("upto")})
    reached = F.filter("of.ranks", lambda r: (r >= F.col("begin")) & (r < F.col("end")))
    return place.select(F.col("of.column_name").alias("column_name"), F.explode(reached).alias("rank"), "value")
