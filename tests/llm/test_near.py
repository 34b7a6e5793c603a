"""Components, vector near-dedup and the Jaccard join against brute force."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from binledger.llm import jaccard, pivots
from binledger.llm.components import components


def roots(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {x: find(x) for x in parent}


def test_components(frame):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 40)]
    links += [(r.randint(200, 400), r.randint(200, 400)) for _ in range(120)]
    rows = [*links, links[0], (7, 7), (None, 3), (3, None)]
    got = {x.node: x.root for x in components(frame(rows, "a long, b long")).collect()}
    assert got == roots([x for x in links if x[0] != x[1]])
    assert components(frame([], "a long, b long")).count() == 0


def cosines(vectors, least=0.95):
    good = {k: np.array(v, float) for k, v in vectors if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = [(a, b) for a, b in itertools.combinations(sorted(good), 2)
             if len(good[a]) == len(good[b]) and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= least]
    root, count = roots(links), {k: 0 for k, _ in vectors}
    for pair in links:
        for k in pair:
            count[k] += 1
    return {k: (count[k], root.get(k, k), root.get(k, k) == k) for k, _ in vectors}


@pytest.mark.parametrize("block", [1024, 16])
def test_vectors(frame, monkeypatch, block):
    monkeypatch.setattr(pivots, "BLOCK", block)
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=32).astype(np.float32).tolist()) for i in range(400)]
    base = np.array(rows[7][1])
    rows += [(1000 + i, (base + r.normal(size=32) * 0.08).astype(np.float32).tolist()) for i in range(60)]
    rows += [(2000 + i, rows[9][1]) for i in range(40)] + [(3000, (np.array(rows[9][1]) * 2).tolist())]
    rows += [(5001, None), (5002, []), (5003, [0.0] * 32), (5004, [float("nan")] * 32), (5005, [None] * 32),
             (5006, [1.0, 2.0]), (5007, [2.0, 4.0]), (5008, [1e30] * 32), (5009, [float("inf")] + [1.0] * 31)]
    got = {x.vec_id: (x.n_links, x.component_id, x.kept)
           for x in pivots.near_duplicates(frame(rows, "vec_id long, embedding array<float>")).collect()}
    want = cosines(rows)
    found = sum(v[0] for v in got.values()) / sum(v[0] for v in want.values())
    assert set(got) == set(want) and found >= 0.99
    assert all(got[k][0] <= want[k][0] for k in want)  # none below the threshold


@pytest.mark.parametrize("block", [1, 2])
def test_vectors_with_empty_blocks(frame, monkeypatch, block):
    monkeypatch.setattr(pivots, "BLOCK", block)
    r = np.random.default_rng(6)
    rows = [(i, [1.0, *(r.normal(size=3) * 0.01).tolist()]) for i in range(6)]
    got = {x.vec_id: (x.n_links, x.component_id, x.kept)
           for x in pivots.near_duplicates(frame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == cosines(rows)


def test_few_or_no_vectors(frame):
    few = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0]), (None, [1.0, 0.0])]
    got = {x.vec_id: (x.n_links, x.component_id, x.kept)
           for x in pivots.near_duplicates(frame(few, "vec_id long, embedding array<float>")).collect()}
    assert got == {1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True), None: (0, None, True)}
    assert pivots.near_duplicates(frame([], "vec_id long, embedding array<float>")).count() == 0


def test_recall_at_the_threshold():
    """Share of pairs at cosine 0.95 to 0.99 that share enough pivots, of vectors like those of the tables."""
    r = np.random.default_rng(1)
    data = r.normal(size=(4000, 64))
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    p = data[:256]
    other = r.normal(size=data.shape)
    other -= (other * data).sum(axis=1, keepdims=True) * data
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    for cosine, least in ((0.99, 0.99), (0.98, 0.97)):
        near = cosine * data + np.sqrt(1 - cosine**2) * other
        a, b = (np.argsort(-(x @ p.T), axis=1)[:, : pivots.NEAREST] for x in (data[256:], near[256:]))
        shared = np.array([len(set(x) & set(y)) for x, y in zip(a, b, strict=True)])
        assert (shared >= pivots.SHARED).mean() >= least


@pytest.mark.parametrize("count", [256, 1024, 2048, 8192])
def test_recall_at_0_95_with_many_pivots(count):
    """Share of other pairs at 0.95 that meet under the setting chosen for so many pivots."""
    r = np.random.default_rng(count)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    given = unit(r.normal(size=(4 * count, 64)))
    p = given[:count]
    nearest, shared = pivots.setting(p, given, 0.95)
    data, other = unit(r.normal(size=(1500, 64))), r.normal(size=(1500, 64))
    other = unit(other - (other * data).sum(axis=1, keepdims=True) * data)
    a, b = (np.argsort(-(x @ p.T), axis=1)[:, :nearest] for x in (data, 0.95 * data + np.sqrt(1 - 0.95**2) * other))
    met = np.array([len(set(x) & set(y)) >= shared for x, y in zip(a, b, strict=True)])
    print(count, nearest, shared, met.mean())
    assert shared and met.mean() >= 0.94


def test_no_setting_with_few_or_useless_pivots():
    r = np.random.default_rng(0)
    cone = r.normal(size=(4000, 64)) + 40 * np.eye(64)[0]  # all cosines above 0.95: near pivots tell nothing
    cone /= np.linalg.norm(cone, axis=1, keepdims=True)
    assert pivots.setting(cone[:256], cone, 0.95) == (0, 0)
    assert pivots.setting(cone[:3], cone, 0.95) == (0, 0)


def sets_of(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def brute(rows):
    sets = [(k, sets_of(t)) for k, t in rows]
    links = [(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2) if x and y and len(x & y) / len(x | y) >= 0.8]
    root, count = roots(links), {k: 0 for k, _ in rows}
    for pair in links:
        for k in pair:
            count[k] += 1
    return {k: (root.get(k, k), count[k], root.get(k, k) == k) for k, _ in rows}


@pytest.mark.parametrize("block", [1_000_000, 2_000])
def test_jaccard(frame, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_GRAMS", block)
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [r.choice(vocabulary) for _ in range(150)]
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 80)))) for i in range(120)]
    for k in range(60):
        words = list(base)
        for _ in range(r.randint(0, 4)):
            words[r.randrange(len(words))] = "changed"
        rows.append((1000 + k, " ".join(words)))
    rows += [(2000 + k, "Exact copy, of one text!") for k in range(30)] + [(2100, "exact copy of one TEXT")]
    rows += [(3000, ""), (3001, ""), (3002, None), (3003, "?!"), (3004, "one"), (3005, "One."), (3006, "a b c d")]
    got = {x.doc_id: (x.class_id, x.n_links, x.kept) for x in jaccard.jaccard_links(frame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_jaccard_with_fewer_classes_than_blocks(frame, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_GRAMS", 20)
    rows = []
    for k in range(8):  # groups of two and three near copies over some twenty blocks each
        words = [f"g{k}w{i}" for i in range(150)]
        rows += [(10 * k + j, " ".join(words[: 150 - j])) for j in range(2 + k % 2)]
    got = {x.doc_id: (x.class_id, x.n_links, x.kept) for x in jaccard.jaccard_links(frame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_jaccard_edges(frame):
    rows = [(4, "same text here now yes", "x"), (4, "same text here now yes", "x"), (None, "same text here now yes", "x"), (9, None, "x")]
    got = sorted(jaccard.jaccard_links(frame(rows, "doc_id long, text string, class_id string")).collect(), key=str)
    assert {(x.doc_id, x.class_id, x.n_links, x.kept) for x in got} == {(4, 4, 1, True), (None, None, 0, True), (9, 9, 0, True)}
    assert len(got) == 4
    assert jaccard.jaccard_links(frame([], "doc_id long, text string")).count() == 0


def test_bands_reach_the_recall():
    bands = jaccard.bands_for(0.8, 0.999, 4)
    assert 1 - (1 - 0.8**4) ** bands >= 0.999 > 1 - (1 - 0.8**4) ** (bands - 1)


def test_one_vector_of_another_length_leaves_the_index_on(spark, frame):
    draw = np.random.default_rng(11)
    x = draw.normal(size=(1200, 32))
    x[1000:] = x[:200] + 0.02 * draw.normal(size=(200, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, draw.normal(size=90).tolist())]
    df = frame(rows, "vec_id long, embedding array<double>")
    found, given = pivots._pivots(df.select(F.col("embedding").alias("v")), len(rows), pivots.SAMPLE)
    assert found.shape[1] == 32 and pivots.setting(found, given, 0.95) != (0, 0)
    got = {r.vec_id: r for r in pivots.near_duplicates(df).collect()}
    assert len(got) == 1201 and got[5000].n_links == 0 and got[5000].kept
    linked = sum(got[1000 + i].component_id == i and got[i].n_links >= 1 for i in range(200))
    assert linked >= 190 and all(got[i].kept for i in range(1000))
