"""Nearest neighbours by largest inner product, from a forest of random-projection trees.

**Trees.** A tree has one random direction per level, orthogonal to those of its other levels. A node is split at the
median of its sample vectors along the direction of its level, so a leaf is a cell between parallel planes and trees
follow the density: a large group of near copies is split like anything else. The largest inner product is turned into
the smallest distance by one more component, ``sqrt(M^2 - |x|^2)`` with ``M`` the largest norm, which is 0 for queries.

**Search.** A query's leaves come from one priority queue over all trees. A node's priority is the sum of the squared
distances from the query to the planes that were crossed on the way, a lower bound of its squared distance to the cell.
The best node goes on to its nearer child at the same priority and puts the farther one back; a leaf that comes out of
the queue is probed, until the query has as many leaves as it is given.

**How many.** Trees, depth and leaves per query are fitted: the exact answers of at most ``TRIED`` queries are computed in
one pass over all vectors, and of the settings under which a share of ``RECALL`` of these answers lies in probed leaves the
cheapest is taken (vectors to score, and a fixed price per leaf). Where the data have no structure, as for random
vectors, that can be most leaves of a shallow forest; the last setting, all leaves, is exact.

**Reranking.** Queries and the members of a leaf meet in groups of at most ``MEMBERS`` by ``ASKING`` vectors; a longer leaf is
cut into as many groups as it needs. A group scores its pairs in double precision and returns the best of each query.
The best of a bounded sample are known to every query from the start: what scores below the last of them is not returned.

Bounds: the forest is fitted on at most ``PER_LEAF`` * 2^``DEEPEST`` vectors. Every vector is indexed, no leaf or list is
capped. From ``LEAF`` * 2^``DEEPEST`` vectors on (4 million) leaves grow with the table.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite components, and rows without an id, take no
part. Of vectors of different lengths the shorter one counts as filled up with zeros. Equal vectors are searched once and
all found; ties go to the smaller id. Rows that repeat an id and its vector are one row. Where an id has several vectors,
each one asks, and none of the id's own is an answer. A lone vector has no answer.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from binledger.llm.registry import query, table
from binledger.session import stage

#: Answers per query.
NEAREST = 20
#: Trees that are tried; depth at most; vectors of a leaf that the depth aims at; sample vectors per leaf.
TREES, DEEPEST, LEAF, PER_LEAF = (4, 8), 14, 256, 8
#: Queries the search is fitted with, the share of their answers it must find, and a leaf's price in scored vectors.
TRIED, RECALL, PRICE = 256, 0.95, 300
#: Sample vectors whose best answers every query starts from: one in so many of all, within these bounds.
KNOWN, KNOWN_LEAST, KNOWN_MOST = 8, 512, 32_768
#: Vectors and queries of a group.
MEMBERS, ASKING = 4096, 1024
#: Keys with more than this share of all queries are joined by broadcast; there are no more of them than 1 / share.
HOT = 1e-4


class Forest:
    """Directions (trees, width + 1, depth), thresholds (trees, 2^depth - 1) in heap order, and the largest norm."""

    def __init__(self, sample: np.ndarray, norm: float, trees: int, depth: int, seed: int = 0) -> None:
        draw = np.random.default_rng(seed)
        self.norm, self.width, self.depth = norm, sample.shape[1], depth
        self.directions = np.stack([self._directions(draw) for _ in range(trees)])
        self.thresholds = np.zeros((trees, (1 << depth) - 1))
        for tree, along in enumerate(self.project(self.lifted(sample))):
            node = np.zeros(len(sample), np.int64)
            for level in range(depth):
                order = np.lexsort((along[:, level], node))
                names, first, size = np.unique(node[order], return_index=True, return_counts=True)
                low, high = (along[order[first + at], level] for at in ((size - 1) // 2, size // 2))
                self.thresholds[tree, (1 << level) - 1 + names] = (low + high) / 2
                node = 2 * node + (along[:, level] > self.thresholds[tree, (1 << level) - 1 + node])

    def _directions(self, draw: np.random.Generator) -> np.ndarray:
        blocks = []
        while sum(b.shape[1] for b in blocks) < self.depth:
            blocks.append(np.linalg.qr(draw.normal(size=(self.width + 1, self.width + 1)))[0])
        return np.concatenate(blocks, axis=1)[:, : self.depth]

    def _fitted(self, x: np.ndarray) -> np.ndarray:
        """Cut or filled up to the width of the forest; only the choice of leaves depends on it."""
        x = x[:, : self.width]
        return np.pad(x, ((0, 0), (0, self.width - x.shape[1])))

    def lifted(self, x: np.ndarray) -> np.ndarray:
        x = self._fitted(x)
        rest = np.maximum(self.norm**2 - (x * x).sum(axis=1), 0)
        return np.concatenate([x, np.sqrt(rest)[:, None]], axis=1)

    def asked(self, q: np.ndarray) -> np.ndarray:
        q = self._fitted(q)
        length = np.sqrt((q * q).sum(axis=1, keepdims=True))
        return np.pad(q * (self.norm / np.where(length > 0, length, 1)), ((0, 0), (0, 1)))

    def project(self, x: np.ndarray) -> np.ndarray:
        """(trees, rows, depth)"""
        return np.round(x @ self.directions, 12)

    def leaves(self, x: np.ndarray, trees: int, depth: int) -> np.ndarray:
        """(rows, trees): the leaf of each vector at ``depth``."""
        along = self.project(self.lifted(x))
        out = np.zeros((len(x), trees), np.int64)
        for tree in range(trees):
            for level in range(depth):
                node = out[:, tree]
                out[:, tree] = 2 * node + (along[tree, :, level] > self.thresholds[tree, (1 << level) - 1 + node])
        return out

    def probed(self, q: np.ndarray, trees: int, depth: int, count: int) -> list[list[tuple[int, int]]]:
        """The first ``count`` (tree, leaf) of each query in the order of the shared queue."""
        along = self.project(self.asked(q))
        out = []
        for row in range(len(q)):
            planes = along[:, row, :].tolist()
            queue = [(0.0, tree, 0, 0) for tree in range(trees)]  # priority, tree, level, node: a heap as it stands
            found: list[tuple[int, int]] = []
            while queue and len(found) < count:
                far, tree, level, node = heapq.heappop(queue)
                place, cuts = planes[tree], self.thresholds[tree]
                while level < depth:
                    gap = place[level] - cuts[(1 << level) - 1 + node]
                    side = int(gap > 0)
                    heapq.heappush(queue, (far + gap * gap, tree, level + 1, 2 * node + 1 - side))
                    node, level = 2 * node + side, level + 1
                found.append((tree, node))
            out.append(found)
        return out

    def priorities(self, q: np.ndarray, trees: int, depth: int) -> np.ndarray:
        """(trees, 2^depth): the priority of every leaf for one query, to fit the search with."""
        along = self.project(self.asked(q[None]))[:, 0, :]
        far = np.zeros((trees, 1))
        for level in range(depth):
            gap = along[:trees, level, None] - self.thresholds[:trees, (1 << level) - 1 : (1 << level + 1) - 1]
            low, high = far + np.where(gap > 0, gap**2, 0), far + np.where(gap > 0, 0, gap**2)
            far = np.stack([low, high], axis=2).reshape(trees, -1)
        return far


def setting(forest: Forest, tried: list[tuple[np.ndarray, np.ndarray]], rows: int, recall: float,
            sizes: tuple[int, ...] = TREES) -> tuple[int, int, int]:
    """(trees, depth, leaves per query) of the least cost under which ``recall`` of the answers are found.

    ``tried`` are queries with the vectors of their exact answers.
    """
    best = (float("inf"), min(sizes), 1, 2 * min(sizes))
    for depth in range(1, forest.depth + 1):
        for trees in sizes:
            needed = []
            for q, answers in tried:
                far = forest.priorities(q, trees, depth)
                at = forest.leaves(answers, trees, depth)
                nearest = far[np.arange(trees)[None, :], at].min(axis=1)
                needed.append(np.searchsorted(np.sort(far, axis=None), nearest, side="right"))
            needed = np.sort(np.concatenate(needed)) if needed else np.array([2 * trees])
            leaves = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))])
            cost = leaves * (rows / (1 << depth) + PRICE)
            if cost < best[0]:
                best = (cost, trees, depth, leaves)
    return best[1:]


def _matrix(packed: list[bytes], dtype: str) -> np.ndarray:
    width = max(map(len, packed))
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in packed), dtype).reshape(len(packed), -1).astype(np.float64)


def _like(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, width - x.shape[1])))


def _best(q: np.ndarray, x: np.ndarray, ids: list[list[int]], floor: np.ndarray, keep: int):
    """Per query (scores, ids) of the ``keep`` best that reach its floor, best first.

    A product of matrices only chooses; the scores that count are summed row by row, the same in every group.
    """
    width = max(q.shape[1], x.shape[1])
    q, x = _like(q, width), _like(x, width)
    rough = q @ x.T
    slack = 1e-9 * (1 + np.abs(rough).max(initial=0))
    many = [len(i) > 1 for i in ids]
    first = np.array([i[0] for i in ids])
    for row in range(len(q)):
        bar = floor[row] - slack
        if rough.shape[1] > keep:
            bar = max(bar, np.partition(rough[row], -keep)[-keep] - slack)
        at = np.flatnonzero(rough[row] >= bar)
        scores = (q[row] * x[at]).sum(axis=1)
        names = first[at]
        if any(many[i] for i in at):
            scores = np.repeat(scores, [len(ids[i]) for i in at])
            names = np.array([n for i in at for n in ids[i]])
        order = np.lexsort((names, -scores))[:keep]
        order = order[scores[order] >= floor[row]]
        yield scores[order], names[order]


def nearest(
    df: DataFrame, asks: Column, key: str = "vec_id", vector: str = "embedding", k: int = NEAREST, recall: float = RECALL,
    trees: tuple[int, ...] = TREES,
) -> DataFrame:
    """(query_id, rank, <key>, score): the ``k`` best other rows for each row where ``asks`` holds."""
    exact = isinstance(df.schema[vector].dataType.elementType, FloatType)  # components fit four bytes
    kind, dtype = ("float", "<f4") if exact else ("double", "<f8")
    x = F.col(vector).cast(f"array<{kind}>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    fine = F.coalesce(finite & F.exists(x, lambda e: e != 0), F.lit(False)) & F.col(key).isNotNull()
    # adding 0 makes one zero of the two
    rows = df.where(fine).select(
        F.col(key).alias("id"), F.transform(x, lambda e: (e + F.lit(0).cast(kind))).alias("v"),
        F.coalesce(asks, F.lit(False)).alias("asks"),
    )
    keep = k + 1  # one may be the query itself
    ranked = rows.select("id", "v").distinct().withColumn("place", F.expr("row_number() over (partition by v order by id)"))
    classes = ranked.where(F.col("place") <= keep).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = stage(classes.withColumn("class", F.monotonically_increasing_id()), "vectors")
    asking = rows.where("asks").groupBy("v").agg(F.count("*").alias("n"), F.min("id").alias("id"))
    asking = stage(asking.withColumn("asked", F.monotonically_increasing_id()), "queries")

    forest, known = _fit(classes, max(trees), dtype)
    if forest is None:
        return _answers(rows, asking, None, key, k)
    total = classes.count()
    context = df.sparkSession.sparkContext
    use = setting(forest, _tried(classes, asking, keep, dtype), total, recall, trees)
    shared = context.broadcast((forest, known, use))  # bounded: see the sample and the depth

    starts = stage(asking.select("asked", "v").mapInArrow(_starting(shared, keep, dtype), (
        "asked long, packed binary, floor double, best array<struct<score:double,id:long>>"
    )), "starts")
    probes = starts.select("asked", "packed", "floor").mapInArrow(
        _probing(shared, dtype), "leaf long, ref long, packed binary, floor double"
    )
    members = classes.mapInArrow(_placing(shared, dtype), "leaf long, ref long, packed binary, ids array<long>")
    # a row per leaf, of which the forest has trees * 2^depth at most
    sizes = stage(
        members.groupBy("leaf").agg(F.count("*").alias("n")).join(probes.groupBy("leaf").agg(F.count("*").alias("q")), "leaf")
        .select("leaf", F.ceil(F.col("n") / MEMBERS).cast("int").alias("parts"),
                F.ceil(F.col("q") / ASKING).cast("int").alias("rounds")), "leaves"
    )
    sizes = F.broadcast(sizes)
    own = lambda of: F.pmod(F.xxhash64("ref"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    there = members.join(sizes, "leaf").withColumn("part", own("parts")).withColumn("round", every("rounds"))
    here = probes.join(sizes, "leaf").withColumn("round", own("rounds")).withColumn("part", every("parts"))
    both = there.select("leaf", "part", "round", "ref", "packed", "ids", F.lit(None).cast("double").alias("floor")).unionByName(
        here.select("leaf", "part", "round", "ref", "packed", F.lit(None).cast("array<long>").alias("ids"), "floor")
    )
    found = both.groupBy("leaf", "part", "round").applyInArrow(_reranking(keep, dtype), "asked long, score double, id long")
    found = found.unionByName(starts.select("asked", F.inline("best")))
    best = F.struct((-F.col("score")).alias("score"), "id")
    # at most ``keep`` answers from each group a query visits
    answers = found.groupBy("asked").agg(F.slice(F.sort_array(F.collect_set(best)), 1, keep).alias("best"))
    return _answers(rows, asking, stage(answers, "answers"), key, k)


def _answers(rows: DataFrame, asking: DataFrame, answers: DataFrame | None, key: str, k: int) -> DataFrame:
    if answers is None:
        return rows.limit(0).select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias(key),
                                    F.lit(0.0).alias("score"))
    asked = rows.where("asks").select("id", "v").distinct()
    total = asking.agg(F.sum("n")).first()[0] or 0
    given = asking.select("asked", "v", "n").join(answers, "asked")
    hot = F.col("n") > HOT * total
    # the queries with one vector that many rows have stay where they are
    often = F.broadcast(given.where(hot).select("v", "best"))
    seldom = asked.join(F.broadcast(asking.where(hot).select("v")), "v", "left_anti")
    met = asked.join(often, "v").unionByName(seldom.join(given.where(~hot).select("v", "best"), "v"))
    others = F.slice(F.filter("best", lambda b: b["id"] != F.col("id")), 1, k)
    return met.select(F.col("id").alias("query_id"), F.posexplode(others).alias("rank", "b")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("b.id").alias(key), (-F.col("b.score")).alias("score")
    )


def _packed(column: pa.Array, dtype: str) -> list[bytes]:
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False).astype(dtype)
    return [values[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _fit(classes: DataFrame, trees: int, dtype: str) -> tuple[Forest | None, tuple | None]:
    """The forest, and the known sample: (vectors, ids)."""
    measure = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double")))
    rows, norm = classes.agg(F.count("*"), F.max(measure)).first()
    if not rows:
        return None, None
    depth = int(np.clip(np.ceil(np.log2(rows / LEAF)), 1, DEEPEST))
    known = int(np.clip(rows // KNOWN, KNOWN_LEAST, KNOWN_MOST))
    wanted = max(known, PER_LEAF << depth)
    share = F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < int(min(1.0, wanted / rows) * (1 << 30))
    # the same rows in every run: about ``wanted``, twice as many at most
    picked = classes.where(share).select("v", "ids").limit(2 * wanted).toArrow()
    if not picked.num_rows:
        picked = classes.limit(wanted).select("v", "ids").toArrow()
    packed = _packed(picked.column("v").combine_chunks(), dtype)
    ids = picked.column("ids").to_pylist()
    order = sorted(range(len(packed)), key=lambda i: packed[i])
    sizes, counts = np.unique([len(p) for p in packed], return_counts=True)
    common = int(sizes[counts.argmax()])
    sample = _matrix([packed[i] for i in order if len(packed[i]) == common], dtype)
    np.random.default_rng(1).shuffle(order)
    chosen = order[:known]
    return Forest(sample, norm, trees, depth), ([packed[i] for i in chosen], [ids[i] for i in chosen])


def _tried(classes: DataFrame, asking: DataFrame, keep: int, dtype: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """At most ``TRIED`` queries and the vectors of their exact answers."""
    picked = asking.orderBy(F.xxhash64("v")).limit(TRIED).select("id", "v").toArrow()
    if not picked.num_rows:
        return []
    packed = _packed(picked.column("v").combine_chunks(), dtype)
    names = picked.column("id").to_pylist()
    tried = classes.sparkSession.sparkContext.broadcast(packed)
    schema = pa.schema([("q", pa.int32()), ("score", pa.float64()), ("id", pa.int64()), ("packed", pa.binary())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = _matrix(tried.value, dtype)
        floor = np.full(len(q), -np.inf)
        best: list[list[tuple]] = [[] for _ in q]
        for batch in batches:
            vectors, ids = _packed(_column(batch, "v"), dtype), _column(batch, "ids").to_pylist()
            of = {n: i for i, some in enumerate(ids) for n in some}
            for row, (scores, found) in enumerate(_best(q, _matrix(vectors, dtype), ids, floor, keep)):
                if len(found):
                    some = [(-s, n, vectors[of[n]]) for s, n in zip(scores.tolist(), found.tolist())]
                    best[row] = sorted(best[row] + some)[:keep]
                    if len(best[row]) == keep:
                        floor[row] = -best[row][-1][0]
        flat = [(row, -s, n, v) for row, some in enumerate(best) for s, n, v in some]
        if flat:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*flat), schema.types)], schema=schema)

    top = classes.select("v", "ids").mapInArrow(scan, "q int, score double, id long, packed binary")
    top = top.withColumn("place", F.expr("row_number() over (partition by q order by score desc, id)"))
    found: dict[int, list[bytes]] = {}
    for r in top.where(F.col("place") <= keep).collect():  # TRIED * keep rows
        if r.id != names[r.q] and len(found.setdefault(r.q, [])) < keep - 1:
            found[r.q].append(bytes(r.packed))
    q = _matrix(packed, dtype)
    return [(q[i], _matrix(some, dtype)) for i, some in sorted(found.items()) if some]


def _starting(shared, keep: int, dtype: str):
    schema = pa.schema([("asked", pa.int64()), ("packed", pa.binary()), ("floor", pa.float64()),
                        ("best", pa.list_(pa.struct([("score", pa.float64()), ("id", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, (vectors, ids), _ = shared.value
        known = _matrix(vectors, dtype)
        for batch in batches:
            for part in (batch.slice(i, ASKING) for i in range(0, batch.num_rows, ASKING)):
                packed = _packed(_column(part, "v"), dtype)
                best = [
                    [{"score": s, "id": n} for s, n in zip(scores.tolist(), names.tolist())]
                    for scores, names in _best(_matrix(packed, dtype), known, ids, np.full(len(packed), -np.inf), keep)
                ]
                floor = [b[-1]["score"] if len(b) == keep else -np.inf for b in best]
                yield pa.RecordBatch.from_pydict(
                    {"asked": _column(part, "asked"), "packed": packed, "floor": floor, "best": best}, schema=schema
                )

    return run


def _probing(shared, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, _, use = shared.value
        trees, depth, count = use
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                packed = _column(part, "packed").to_pylist()
                found = forest.probed(_matrix(packed, dtype), trees, depth, count)
                row = np.repeat(np.arange(len(packed)), list(map(len, found)))
                leaf = [tree << 32 | node for some in found for tree, node in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf, pa.int64()), *(_column(part, c).take(pa.array(row)) for c in ("asked", "packed", "floor"))],
                    ["leaf", "ref", "packed", "floor"],
                )

    return run


def _placing(shared, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, _, (trees, depth, _) = shared.value
        for batch in batches:
            for part in (batch.slice(i, 2048) for i in range(0, batch.num_rows, 2048)):
                packed = _packed(_column(part, "v"), dtype)
                leaf = forest.leaves(_matrix(packed, dtype), trees, depth) + (np.arange(trees) << 32)
                row = pa.array(np.repeat(np.arange(len(packed)), trees))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf.ravel(), pa.int64()), _column(part, "class").take(row),
                     pa.array(packed, pa.binary()).take(row), _column(part, "ids").take(row)],
                    ["leaf", "ref", "packed", "ids"],
                )

    return run


def _reranking(keep: int, dtype: str):
    schema = pa.schema([("asked", pa.int64()), ("score", pa.float64()), ("id", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        floor = group.column("floor").to_numpy()
        asks = np.flatnonzero(~np.isnan(floor))
        holds = np.flatnonzero(np.isnan(floor))
        if not len(asks) or not len(holds):
            return schema.empty_table()
        packed, ref = group.column("packed").to_pylist(), group.column("ref").to_numpy()
        ids = group.column("ids").take(pa.array(holds)).to_pylist()
        q, x = _matrix([packed[i] for i in asks], dtype), _matrix([packed[i] for i in holds], dtype)
        out = list(_best(q, x, ids, floor[asks], keep))
        return pa.table(
            [pa.array(np.repeat(ref[asks], [len(s) for s, _ in out]), pa.int64()),
             pa.array(np.concatenate([s for s, _ in out])), pa.array(np.concatenate([n for _, n in out]), pa.int64())],
            schema=schema,
        )

    return run


@query("op13_forest_neighbours")
def op13_forest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 20 == 0)
