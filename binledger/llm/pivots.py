"""Near-duplicate vectors by a pivot-permutation index.

**Description.** Reference points (pivots) are taken from a bounded sample of the vectors, none close to another, so
that a large group of copies gives one pivot at most. A vector is described by its ``nearest`` nearest pivots in order.
Vectors at a small angle order the pivots nearly alike and share most of these.

**Retrieval.** The inverted lists are kept on sets of ``shared`` pivots: a vector stands in the list of every
``shared``-subset of its nearest pivots, so two vectors meet in a list exactly if their shared-pivot count reaches
``shared``. A pair is taken up in one list only, that of its smallest shared pivots.

**Recall.** The more pivots there are, the fewer of its nearest a pair at the threshold shares. Both numbers are therefore
chosen for the pivots at hand: the first of ``SETTINGS`` under which a share of ``RECALL`` of pairs exactly at the
threshold, made from the sample, meets in a list. Where none does, all vectors are one list.

**Verification.** Within a list the cosines are computed in double precision, in blocks of at most ``BLOCK`` vectors
against another block; a long list is cut into as many blocks as it needs and every pair of blocks is a group of its
own, so one list of a third of all vectors is spread over many tasks. A block returns one row per vector (how many
vectors it links to, and the root of its links inside the block), never a row per pair.

The number of pivots grows with the root of the number of vectors, so that the lists stay short. Equal vectors are
collapsed to one with a weight before anything else.

Bounds: ``SAMPLE`` vectors at most are looked at for pivots. Every vector is indexed; there is no cap on lists or links.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite components have no links. Vectors of
different lengths are compared within their length only. Repeated ids: each row counts as a vector, the id's row is
given once per row. NULL ids keep their row, with a NULL component and ``kept`` true.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.llm.components import components
from binledger.llm.registry import query, table
from binledger.session import stage

#: Vectors that are looked at for pivots; a pivot's cosine to all earlier ones is below ``APART``.
SAMPLE, APART = 4096, 0.7
#: Pivots for up to ``BASE_ROWS`` vectors; beyond, their number grows with the root of the number of vectors up to
#: ``MOST_PIVOTS`` (which bounds the driver's work, not what is found).
BASE_PIVOTS, BASE_ROWS, MOST_PIVOTS = 256, 65_536, 8192
#: Nearest pivots that describe a vector, and pivots that two vectors must share, with few pivots.
NEAREST, SHARED = 8, 4
#: The same in the order they are tried, and the share of ``TRIED`` pairs at the threshold that must meet in a list.
SETTINGS = [(NEAREST, SHARED), (9, 4), (8, 3), (9, 3), (10, 3), (8, 2), (10, 2)]
RECALL, TRIED = 0.95, 2000
#: Vectors of a block.
BLOCK = 1024


def _pivots(vectors: DataFrame, rows: int, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Pivots, and the sample they are from, the same in every run: rows whose hash falls into its share of all hashes."""
    wanted = min(MOST_PIVOTS, BASE_PIVOTS * max(1, int(np.sqrt(rows / BASE_ROWS))))
    sample = max(sample, 4 * wanted)
    share = min(1.0, sample / max(rows, 1))
    picked = vectors.where(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < int(share * (1 << 30)))
    found = sorted(r.v for r in picked.select("v").limit(2 * sample).collect())
    if not found:
        return np.zeros((0, 0)), np.zeros((0, 0))
    # the commonest length, the larger one of two; vectors of other lengths are listed by their length
    sizes, counts = np.unique([len(x) for x in found], return_counts=True)
    width = int(sizes[counts == counts.max()].max())
    given = np.array([x for x in found if len(x) == width], np.float64)
    given /= np.linalg.norm(given, axis=1, keepdims=True)
    np.random.default_rng(0).shuffle(given)
    out = given[:1]
    for x in given[1:]:
        if len(out) == wanted:
            break
        if (out @ x).max() < APART:
            out = np.vstack([out, x])
    return out, given


def setting(pivots: np.ndarray, given: np.ndarray, threshold: float) -> tuple[int, int]:
    """(nearest, shared) by ``SETTINGS`` and ``RECALL``; (0, 0) for one list of all.

    A pair is a vector of the sample and the same turned to the threshold, in the direction from one vector of the
    sample to another, so that the pairs differ as the vectors themselves do.
    """
    if len(pivots) < NEAREST:
        return 0, 0
    one, a, b = np.random.default_rng(1).integers(0, len(given), (3, TRIED))
    x, turn = given[one], given[a] - given[b]
    turn -= (turn * x).sum(axis=1, keepdims=True) * x
    length = np.linalg.norm(turn, axis=1)
    on = length > 1e-6
    x, turn = x[on], turn[on] / length[on, None]
    cosine = min(max(threshold, -1.0), 1.0)
    most = max(n for n, _ in SETTINGS)
    near = [np.argsort(-(v @ pivots.T), axis=1, kind="stable")[:, :most].copy()
            for v in (x, cosine * x + np.sqrt(1 - cosine**2) * turn)]
    for nearest, shared in SETTINGS:
        if nearest <= len(pivots) and len(x):
            p, q = (order[:, :nearest] for order in near)
            if ((p[:, :, None] == q[:, None, :]).sum(axis=(1, 2)) >= shared).mean() >= RECALL:
                return nearest, shared
    return 0, 0


def _describe(pivots: np.ndarray, nearest: int, shared: int):
    """Rows (key, vector) of the inverted lists: one per subset of the nearest pivots."""
    width = pivots.shape[1] if nearest else -1
    k = nearest
    subsets = np.array(list(combinations(range(k), shared)), np.int64)
    schema = pa.schema([("node", pa.int64()), ("weight", pa.int64()), ("v", pa.binary()), ("near", pa.list_(pa.int32())),
                        ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 2048) for i in range(0, batch.num_rows, 2048)):
                lists = part.column(part.schema.get_field_index("v")).to_pylist()
                near = np.zeros((len(lists), k), np.int64)
                for n in {len(x) for x in lists}:
                    rows = [i for i, x in enumerate(lists) if len(x) == n]
                    if n == width:
                        given = np.array([lists[i] for i in rows], np.float64)
                        # the order does not depend on the block: ties go to the lower pivot
                        near[rows] = np.argsort(-np.round(_unit(given) @ pivots.T, 12), axis=1, kind="stable")[:, :k]
                ordered = np.sort(near, axis=1)
                keys = np.zeros((len(lists), len(subsets) if shared else 0), np.uint64)
                for column in range(shared):
                    keys = (keys ^ (ordered[:, subsets[:, column]] + 1).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                    keys ^= keys >> np.uint64(29)
                keys = [[len(x)] if len(x) != width else row for x, row in zip(lists, keys.view(np.int64).tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "node": part.column(part.schema.get_field_index("node")),
                        "weight": part.column(part.schema.get_field_index("weight")),
                        "v": [np.array(x, np.float64).tobytes() for x in lists],
                        "near": ordered.astype(np.int32).tolist(), "keys": keys,
                    }, schema=schema)

    return run


def _unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top  # components may be so large or small that their squares leave the range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest row reachable over a symmetric boolean matrix."""
    root = np.arange(len(linked))
    rows, columns = np.nonzero(linked)
    while True:
        new = root.copy()
        np.minimum.at(new, rows, root[columns])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _verify(threshold: float, shared: int):
    """Links inside a block or between two blocks of one list."""
    schema = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])

    def block(rows: list[tuple]) -> dict | None:
        if len(rows) < 2:
            return None
        node = np.array([r[1] for r in rows])
        side = np.array([r[2] for r in rows])
        weight = np.array([r[3] for r in rows], np.int64)
        v = _unit(np.array([np.frombuffer(r[4], np.float64) for r in rows]))
        near = np.array([r[5] for r in rows])
        linked = v @ v.T >= threshold
        np.fill_diagonal(linked, False)
        if rows[0][6] != rows[0][7]:  # two blocks: the pairs inside each are compared elsewhere
            linked &= side[:, None] != side[None, :]
        if not linked.any():
            return None
        # the list's own pivots are those that all its vectors share; a pair belongs here if it shares none but these
        # among the pivots up to the largest of them, so that no smaller subset has it too
        if near.shape[1] and shared:
            names, codes = np.unique(near, return_inverse=True)
            has = np.zeros((len(rows), len(names)), np.float32)
            has[np.arange(len(rows))[:, None], codes.reshape(near.shape)] = 1
            linked &= _owned(has, [r[0] for r in rows][0], names, shared)
            if not linked.any():
                return None
        root = _roots(linked)
        on = linked.any(axis=1)
        return {"node": node[on], "root": node[root[on]], "links": (linked @ weight)[on]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True)

        for _, group in groupby(rows(), lambda r: (r[0], r[6], r[7])):
            found = block(list(group))
            if found:
                yield pa.RecordBatch.from_pydict(found, schema=schema)

    return run


def _hash(names: np.ndarray) -> np.uint64:
    key = np.uint64(0)
    with np.errstate(over="ignore"):
        for p in names:
            key = (key ^ np.uint64(p + 1)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
    return key


def _owned(has: np.ndarray, key: int, names: np.ndarray, shared: int) -> np.ndarray:
    """Pairs whose ``shared`` smallest common pivots are the subset behind ``key``."""
    common = np.flatnonzero(has.all(axis=0))
    wanted = np.int64(key).view(np.uint64)
    for subset in combinations(common, min(shared, len(common))):
        if _hash(names[list(subset)]) == wanted:
            upto = has[:, : subset[-1] + 1]
            return (upto @ upto.T) == shared
    return np.ones((len(has), len(has)), bool)  # one list for all: vectors of another length, or fewer pivots than needed


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95,
                    sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``df``: its id, number of linked rows, component (smallest id) and whether it is kept."""
    spark = df.sparkSession
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    fine = F.coalesce(finite & F.exists(x, lambda e: e != 0), F.lit(False)) & F.col(key).isNotNull()
    # adding 0.0 makes one zero of the two
    rows = df.select(F.col(key).alias("id"), F.when(fine, F.transform(x, lambda e: e + 0.0)).alias("v"))
    classes = stage(
        rows.where("v is not null").groupBy("v").agg(F.min("id").alias("first"), F.count("*").alias("weight"))
        .withColumn("node", F.monotonically_increasing_id()), "vectors"
    )
    count = classes.count()
    pivots, given = _pivots(classes, count, sample)
    nearest, shared = setting(pivots, given, threshold)
    described = classes.select("node", "weight", "v").mapInArrow(
        _describe(pivots, nearest, shared),
        "node long, weight long, v binary, near array<int>, keys array<long>",
    )
    described = stage(described, "described")
    listed = described.select("node", F.explode("keys").alias("list"))
    long = listed.groupBy("list").agg(F.count("*").alias("size")).where("size > 1")
    # only lists of two or more go on; the vectors themselves are added afterwards, once per list
    listed = described.select("*", F.explode("keys").alias("list")).drop("keys").join(long, "list", "left_semi")
    sized = listed.join(long, "list").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    side = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    sized = sized.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sized = sized.select(
        "list", "node", "side", "weight", "v", "near", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j")
    )
    found = (
        sized.repartition("list", "i", "j").sortWithinPartitions("list", "i", "j")
        .mapInArrow(_verify(threshold, shared), "node long, root long, links long")
    )
    found = stage(found, "found")
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = parts.join(classes.select("node", "first"), "node")
    names = named.groupBy("root").agg(F.min("first").alias("component"))
    # only linked vectors have a root: it is looked up among them, so that no join meets the NULL roots of the others
    placed = parts.join(names, "root").select("node", "component")
    whole = (
        classes.join(linked, "node", "left").join(placed, "node", "left")
        .select("v", F.coalesce("component", "first").alias("component"),
                (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"))
    )
    out = rows.join(whole, "v", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


_ORACLE = """
with recursive v as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from v a, v b
  where a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.95
), reach(a, b) as (
  select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a
)
select e.vec_id, coalesce(n.n, 0)::bigint as n_links, least(e.vec_id, coalesce(c.b, e.vec_id)) as component_id,
       e.vec_id <= coalesce(c.b, e.vec_id) as kept
from embeddings e left join (select a, count(*) n from links group by a) n on n.a = e.vec_id
left join (select a, min(b) b from reach group by a) c on c.a = e.vec_id
"""


@query("op2_pivot_near_dedup", _ORACLE)
def op2(spark, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings").select("vec_id", "embedding"))
