"""Forest search against brute force: recall, exact scores, defined results."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from binledger.llm import forest

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, every, k=20):
    """Per asking (id, vector): the k best others as (id, score)."""
    fine = {(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for i, v in fine:
        if i % every == 0:
            some = {}
            for j, w in fine:
                if j != i:
                    score = sum(a * b for a, b in zip(v, w))
                    some[j, score] = None
            out.setdefault(i, []).append(sorted(some, key=lambda s: (-round(s[1], 12), s[0]))[:k])
    return out


def search(spark, rows, every=20, schema=SCHEMA, **options):
    df = spark.createDataFrame(rows, schema).repartition(3)
    for name in ("id", "v", "asks", "class", "ref", "leaf", "floor", "best", "asked", "rank", "score"):
        df = df.withColumn(name, F.lit("x"))
    return forest.nearest(df, F.col("vec_id") % every == 0, **options).collect()


def recall(rows, got, every=20):
    wanted = brute(rows, every)
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    vectors = {i: np.array(v, float) for i, v in rows}
    hits = total = 0
    assert set(found) == {i for i, (best,) in wanted.items() if best}
    for i, (best,) in wanted.items():
        some = sorted(found.get(i, []))
        assert [s[0] for s in some] == list(range(1, len(best) + 1))
        assert [s[2] for s in some] == sorted((s[2] for s in some), reverse=True)
        for _, j, score in some:
            assert j != i and score == pytest.approx(vectors[i] @ vectors[j], abs=1e-9)
        hits += len({j for j, _ in best} & {s[1] for s in some})
        total += len(best)
    return hits / total


def clusters(count, size, width, seed, spread=0.15, norms=False):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(count, width))
    x = np.repeat(centres, size, axis=0) + spread * draw.normal(size=(count * size, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if norms:
        x *= np.exp(draw.normal(size=(len(x), 1)))
    order = draw.permutation(len(x))
    return [(int(i), x[j].tolist()) for i, j in enumerate(order)]


@pytest.mark.parametrize("norms", [False, True])
def test_recall_on_clusters(spark, norms, monkeypatch):
    used = []
    fitted = forest.setting
    monkeypatch.setattr(forest, "setting", lambda *a: used.append(fitted(*a)) or used[-1])
    monkeypatch.setattr(forest, "LEAF", 32)
    monkeypatch.setattr(forest, "KNOWN_LEAST", 50)
    monkeypatch.setattr(forest, "KNOWN", 100)
    monkeypatch.setattr(forest, "PRICE", 5)
    rows = clusters(80, 40, 16, 1, norms=norms)
    got = search(spark, rows)
    assert recall(rows, got) >= 0.9
    trees, depth, leaves = used[0]
    assert leaves < trees << depth  # a part of the leaves, not all


def test_every_leaf_is_exact_and_groups_are_cut(spark, monkeypatch):
    monkeypatch.setattr(forest, "MEMBERS", 37)
    monkeypatch.setattr(forest, "ASKING", 5)
    monkeypatch.setattr(forest, "KNOWN_LEAST", 3)
    monkeypatch.setattr(forest, "KNOWN", 200)
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(size=8).tolist()) for i in range(600)]
    assert recall(rows, search(spark, rows, recall=1.0)) >= 0.99


def test_queue_order_is_that_of_the_leaves(monkeypatch):
    draw = np.random.default_rng(7)
    x = draw.normal(size=(500, 6))
    f = forest.Forest(x, float(np.linalg.norm(x, axis=1).max()), 3, 4)
    for row in range(20):
        far = f.priorities(x[row], 3, 4)
        probed = f.probed(x[row : row + 1], 3, 4, 48)[0]
        assert len(set(probed)) == 48
        assert np.all(np.diff([far[t, n] for t, n in probed]) >= -1e-12)
    at = f.leaves(x, 3, 4)
    assert np.bincount(at[:, 0], minlength=16).max() < 60  # medians: the leaves are of a size


def test_hot_copies_ties_nulls_and_lengths(spark):
    draw = np.random.default_rng(5)
    rows = [(i, draw.normal(size=4).tolist()) for i in range(100)]
    rows += [(i, [3.0, 0.0, -0.0, 4.0]) for i in range(100, 400)]  # one vector of most rows
    rows += [(400, None), (420, []), (440, [0.0, 0.0]), (460, [1.0, None]), (480, [float("nan"), 1.0]), (None, [1.0, 2.0]),
             (500, [1.0, 2.0]), (520, [0.5, 0.5, 0.5, 0.5, 2.0]), (500, [1.0, 2.0])]
    got = search(spark, rows, recall=1.0)
    wanted = brute(rows, 20)
    for i, (best,) in wanted.items():
        mine = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == i)
        assert [m[1] for m in mine] == [j for j, _ in best], i
        assert [m[2] for m in mine] == pytest.approx([s for _, s in best])
    assert {r.query_id for r in got} == set(wanted)


def test_few_rows(spark):
    assert search(spark, []) == []
    assert search(spark, [(20, [1.0, 2.0])]) == []
    assert search(spark, [(1, [1.0, 2.0]), (2, [1.0, 1.0])]) == []
    got = search(spark, [(20, [1.0, 2.0]), (3, [1.0, 1.0]), (40, [0.0, -1.0])])
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [
        (20, 1, 3, 3.0), (20, 2, 40, -2.0), (40, 1, 3, -1.0), (40, 2, 20, -2.0),
    ]


def test_op13(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert recall(rows, forest.op13_forest_neighbours(spark, data).collect()) >= 0.9
