"""Monthly roll-ups kept as partial sums: late lines are merged into their months, the other months stay as they are."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.operators.joins import if_small
from binledger.session import stage
from binledger.sources.published import publish_months, read_note, read_published


def merge_late(
    lines: DataFrame, path: str, keys: Sequence[str], sums: Sequence[str], month: str = "month_dt", batch: int | None = None
) -> bool:
    """Add the sums of ``lines`` to the published roll-up at ``path``; False where this batch was merged before.

    Lines are summed per grain (``keys`` and the month) first; only the months they touch are read, merged and replaced,
    in one step. The number of the batch is published in the same step, so a batch that a restarted stream delivers again
    changes nothing. Batches must come in rising order and from one writer.
    """
    spark = lines.sparkSession
    seen = read_note(spark, path, "batch")
    if batch is not None and seen is not None and batch <= int(seen):
        return False
    grain = [*keys, month]
    total = [F.sum(c).alias(c) for c in sums]
    late = stage(lines.groupBy(*grain).agg(*total), "late")
    if late.isEmpty():
        return True
    try:
        stored = read_published(spark, path)
    except FileNotFoundError:
        merged = late
    else:
        touched = if_small(late.select(month).distinct())
        kept = stored.join(touched, month, "left_semi").select(*late.columns)
        # sums of sums may have more digits: back to the stored types
        merged = kept.unionByName(late).groupBy(*grain).agg(*total)
        merged = merged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stored.schema.fields])
    publish_months(merged, path, month, None if batch is None else ("batch", str(batch)))
    return True


def late_merger(path: str, keys: Sequence[str], sums: Sequence[str], month: str = "month_dt") -> Callable[[DataFrame, int], None]:
    """``merge_late`` for ``foreachBatch`` of a stream of late lines."""

    def merge(lines: DataFrame, batch: int) -> None:
        merge_late(lines, path, keys, sums, month, batch)

    return merge
