"""Order statistics by brackets and counts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from binledger.operators import profile, selection

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def columns(kind, n, seed=1):
    draw = random.Random(seed)
    if kind == "skewed":
        return [draw.choice([7.0, 7.0, draw.gauss(0, 1e6), draw.random() * 1e-9, None]) for _ in range(n)]
    if kind == "equal":
        return [3.5] * n
    if kind == "few":
        return [float(draw.randint(0, 3)) for _ in range(n)]
    if kind == "signed":
        return [draw.choice([-1, 1]) * 10.0 ** draw.randint(-300, 300) for _ in range(n)]
    return [draw.random() for _ in range(n)]


@pytest.mark.parametrize("accuracy,small", [(selection.ACCURACY, selection.SMALL), (20, 10), (3, 1)])
def test_quantiles_of_many_shapes(spark, monkeypatch, accuracy, small):
    monkeypatch.setattr(selection, "ACCURACY", accuracy)
    monkeypatch.setattr(selection, "SMALL", small)
    kinds = ["skewed", "equal", "few", "signed", "plain"]
    data = {k: columns(k, 2000) for k in kinds}
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{k} double" for k in kinds)).repartition(6)
    got = {(r.column_name, r.prob): r.value for r in selection.quantiles(df, kinds, PROBS).collect()}
    assert len(got) == len(kinds) * len(PROBS)
    for k in kinds:
        known = np.array([v for v in data[k] if v is not None])
        for p in PROBS:
            assert got[k, p] == pytest.approx(np.quantile(known, p), rel=1e-12, abs=1e-300), (k, p)


def test_no_values_nan_and_integers(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (3, None, 1.0), (None, None, 2.0)], "a int, b double, c double")
    got = {(r.column_name, r.prob): r.value for r in selection.quantiles(df, ["a", "b", "c"], [0.5, 1.0]).collect()}
    assert got["a", 0.5] == 2.0 and got["a", 1.0] == 3.0 and got["c", 0.5] == 2.0 and np.isnan(got["c", 1.0])
    assert ("b", 0.5) not in got
    assert selection.quantiles(df.limit(0), ["a"], [0.5]).collect() == []


def test_nothing_is_sorted_or_shuffled_by_range(spark):
    df = spark.range(300_000).select(F.xxhash64("id").cast("double").alias("x"))
    out = profile.describe_numeric(df, ["x"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    row = out.first()
    known = np.array([r.x for r in df.collect()])
    assert [row.q25, row.q50, row.q75] == pytest.approx(np.quantile(known, [0.25, 0.5, 0.75]).tolist(), rel=1e-12)
