"""Counts at named stages of a job, gathered while the job runs.

``funnel`` counts the steps of one flat table. A job whose steps lie between joins and groupings would need a pass per
step; here each stage is observed where it is computed (``DataFrame.observe``), so the counts cost no scan and no
shuffle of their own and are there once the job has written its results.

The counts are those of the tasks that ran: a stage that Spark runs again because an executor was lost with its shuffle
files may be counted twice, as may a frame that several jobs compute. Observe frames that are written right after.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from binledger.sources.tables import literal_table


def left_after(steps: Mapping[str, Column], rows: Column | None = None) -> dict[str, Column]:
    """Rows left after each keep-step (those before it included), as aggregates; ``rows`` is how many a row stands for."""
    out, passed = {}, F.lit(True)
    for name, keep in steps.items():
        passed = passed & F.coalesce(keep, F.lit(False))
        out[name] = F.count(F.when(passed, 1)) if rows is None else F.coalesce(F.sum(F.when(passed, rows)), F.lit(0))
    return out


class StageAudit:
    """Named stages of one run, in the order they are watched."""

    def __init__(self) -> None:
        self._watched: list[tuple[Observation, list[str]]] = []

    def watch(self, df: DataFrame, counts: Mapping[str, Column]) -> DataFrame:
        """``df`` with one or more named counts (aggregates over its columns) taken as it is computed."""
        known = {name for _, names in self._watched for name in names}
        if known & set(counts):
            raise ValueError(f"stages are watched already: {sorted(known & set(counts))}")
        observation = Observation()
        self._watched.append((observation, list(counts)))
        return df.observe(observation, *[c.cast("long").alias(f"s{i}") for i, c in enumerate(counts.values())])

    def counts(self) -> dict[str, int]:
        """Stage to rows left. Waits for jobs that still run, so every watched frame must have been computed."""
        out: dict[str, int] = {}
        for observation, names in self._watched:
            found = observation.get
            out |= {name: found[f"s{i}"] for i, name in enumerate(names)}
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        """step_no, step, rows_left."""
        counts = self.counts()
        return literal_table(
            spark, {"step_no": list(range(len(counts))), "step": list(counts), "rows_left": list(counts.values())}
        )


def watched(audit: StageAudit | None, df: DataFrame, counts: Mapping[str, Column]) -> DataFrame:
    """``audit.watch`` where there is an audit."""
    return df if audit is None else audit.watch(df, counts)
