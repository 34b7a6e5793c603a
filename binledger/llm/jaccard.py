"""N-gram Jaccard join by MinHash banding.

**Sets.** A text is lower-cased and cut into words (letters and digits); its set holds the hashes of all runs of
``N_GRAM`` words, or of the whole text where it has fewer. Texts with equal sets are one class with a weight, so exact
copies cost nothing further.

**Candidates.** Rows per band are fixed, and bands are as many as the target recall asks for: a pair at the threshold
shares one of b bands of r rows with probability 1 - (1 - t^r)^b. Band hashes are shuffled; classes that share one are
tied to the smallest of the band (a row per class and band, not a pair), and the connected groups of these ties are the
units of verification.

**Verification.** Every class travels to its group once, with its whole set; a group of more than ``BLOCK_GRAMS``
n-grams is cut into blocks, and each pair of blocks is a group of its own, so a group of a third of all texts is spread
over many tasks. Inside, every pair that shares a band is compared on the whole sets. A block returns one row per class
(number of linked documents and the root of its links inside the block), never a row per pair.

The result has one row per document: its class (smallest document id that links lead to), the number of documents it is
linked to directly (Jaccard similarity of the sets at least the threshold, equal sets included), and whether it stays.

Defined results: NULL texts and texts without words have no links. NULL ids: the row is kept, without links. A repeated
id counts once per row. Ties cannot occur, as the smallest id stays.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.llm.automaton import _slices, let_go
from binledger.llm.components import components
from binledger.llm.registry import query, table
from binledger.session import stage

#: Words of an n-gram, least similarity, and the share of pairs at that similarity that must be found.
N_GRAM, THRESHOLD, RECALL = 5, 0.8, 0.999
#: Rows of a band.
ROWS = 4
#: N-grams of a block.
BLOCK_GRAMS = 1_000_000
#: Distinct words whose hash a Python worker remembers at most.
WORD_CACHE = 200_000

_WORD = re.compile(r"[^\W_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def bands_for(threshold: float, recall: float, rows: int) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))


_SEEN: dict[str, int] = {}


def grams(text: str | None, n: int = N_GRAM) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of ``text``."""
    words = _WORD.findall((text or "").lower())
    if not words:
        return np.zeros(0, np.uint64)
    try:
        hashed = [_SEEN[w] for w in words]
    except KeyError:
        if len(_SEEN) > WORD_CACHE:
            _SEEN.clear()
        for w in words:
            if w not in _SEEN:
                _SEEN[w] = xxhash.xxh3_64_intdigest(w)
        hashed = [_SEEN[w] for w in words]
    x = np.array(hashed, np.uint64)
    n = min(n, len(x))
    out = np.zeros(len(x) - n + 1, np.uint64)
    for k in range(n):
        out = (out ^ x[k : len(x) - n + 1 + k]) * _MIX
        out ^= out >> np.uint64(32)
    return np.unique(out)


def signature(x: np.ndarray, bands: int, rows: int) -> list[int]:
    """One hash per band, of the least values of ``rows`` random orders of the set."""
    draw = np.random.default_rng(20).integers(1, 1 << 63, (2, bands * rows), dtype=np.uint64)
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    factor = (draw[0] | np.uint64(1))[:, None]
    for k in range(0, len(x), 1024):
        np.minimum(least, ((x[k : k + 1024] ^ draw[1][:, None]) * factor).min(axis=1), out=least)
    least ^= least >> np.uint64(29)
    out = np.zeros(bands, np.uint64)
    for k in range(rows):
        out = (out ^ least.reshape(bands, rows)[:, k]) * _MIX
        out ^= out >> np.uint64(32)
    return out.view(np.int64).tolist()


def _describe(n: int, bands: int, rows: int):
    schema = pa.schema([("id", pa.int64()), ("class", pa.binary()), ("size", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in _slices(batches):
            out = []
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x = grams(text, n)
                if key is None or not len(x):
                    continue
                digest = xxhash.xxh3_128_digest(x.tobytes())
                out.append({"id": key, "class": digest, "size": len(x), "bands": signature(x, bands, rows)})
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        _SEEN.clear()  # the worker lives on, with other work

    return run


def _sets(n: int):
    """The whole set of each class, from one of its texts."""
    names = ["class", "group", "weight", "bands", "side", "blocks"]
    schema = pa.schema([("class", pa.binary()), ("group", pa.binary()), ("weight", pa.int64()),
                        ("bands", pa.list_(pa.int64())), ("side", pa.int32()), ("blocks", pa.int32()),
                        ("grams", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in _slices(batches):
            out = []
            for row in batch.to_pylist():
                data = grams(row["text"], n).tobytes()
                if xxhash.xxh3_128_digest(data) == row["class"]:  # an id may be repeated with another text
                    out.append({**{k: row[k] for k in names}, "grams": data})
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        _SEEN.clear()

    return run


def _verify(threshold: float):
    schema = pa.schema([("class", pa.binary()), ("root", pa.binary()), ("links", pa.int64())])

    def block(rows: list[tuple]) -> dict | None:
        unique = {r[1]: r for r in rows}  # a repeated row arrives more than once
        rows = [unique[k] for k in sorted(unique)]
        if len(rows) < 2:
            return None
        two = rows[0][6] != rows[0][7]  # two blocks: the pairs inside each are compared elsewhere
        sets = [np.frombuffer(r[5], np.uint64) for r in rows]
        size = np.array([len(x) for x in sets])
        names, flat = np.unique(np.concatenate(sets), return_inverse=True)
        start = np.concatenate([[0], np.cumsum(size)])
        inside = np.zeros(len(names), bool)
        places: dict[tuple[int, int], list[int]] = defaultdict(list)
        root = list(range(len(rows)))
        links = [0] * len(rows)

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i, row in enumerate(rows):
            earlier: set[int] = set()
            for place in enumerate(row[4]):
                earlier.update(places[place])
                places[place].append(i)
            j = np.fromiter(earlier, np.int64, len(earlier))
            # a pair whose sizes alone keep it under the threshold need not be compared
            j = j[(np.minimum(size[j], size[i]) >= threshold * np.maximum(size[j], size[i]) - 1e-9)]
            if two:
                j = j[[rows[k][2] != row[2] for k in j]] if len(j) else j
            if not len(j):
                continue
            inside[flat[start[i] : start[i + 1]]] = True
            for part in (j[k : k + 512] for k in range(0, len(j), 512)):
                at = np.concatenate([flat[start[k] : start[k + 1]] for k in part])
                both = np.add.reduceat(inside[at].astype(np.int64), np.concatenate([[0], np.cumsum(size[part])[:-1]]))
                # whole numbers: |A and B| >= t |A or B|
                near = part[both * (1 + threshold) >= threshold * (size[part] + size[i]) - 1e-9]
                for k in near.tolist():
                    links[i] += rows[k][3]
                    links[k] += row[3]
                    a, b = find(i), find(k)
                    root[max(a, b)] = min(a, b)
            inside[flat[start[i] : start[i + 1]]] = False
        on = [i for i in range(len(rows)) if links[i]]
        if not on:
            return None
        return {"class": [rows[i][1] for i in on], "root": [rows[find(i)][1] for i in on], "links": [links[i] for i in on]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        def rows():
            for batch in batches:
                for k in range(0, batch.num_rows, 64):
                    part = batch.slice(k, 64)
                    yield from zip(*(c.to_pylist() for c in part.columns), strict=True)

        for _, group in groupby(rows(), lambda r: (r[0], r[6], r[7])):
            found = block(list(group))
            if found:
                yield pa.RecordBatch.from_pydict(found, schema=schema)

    return run


def jaccard_links(df: DataFrame, key: str = "doc_id", text: str = "text", n: int = N_GRAM,
                  threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """(key, class_id, n_links, kept) for every row of ``df``."""
    bands = bands_for(threshold, recall, rows)
    texts = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    described = stage(
        texts.mapInArrow(_describe(n, bands, rows), "id long, class binary, size long, bands array<long>"), "described"
    )
    classes = described.groupBy("class").agg(
        F.min("id").alias("first"), F.count("*").alias("weight"), F.min("size").alias("size"), F.first("bands").alias("bands")
    )  # equal sets have equal bands
    classes = stage(classes, "classes")
    banded = classes.select("class", F.posexplode("bands").alias("band", "hash"))
    least = banded.groupBy("band", "hash").agg(F.min("class").alias("least"), F.count("*").alias("n")).where("n > 1")
    ties = banded.join(least.drop("n"), ["band", "hash"]).where("class > least").select("class", "least")
    groups = components(ties, "class", "least")
    member = classes.join(groups.withColumnRenamed("node", "class").withColumnRenamed("root", "group"), "class")
    total = member.groupBy("group").agg(F.sum("size").alias("total"))
    member = member.join(total, "group").withColumn("blocks", F.ceil(F.col("total") / BLOCK_GRAMS).cast("int"))
    member = member.withColumn("side", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")).drop("total", "size")
    placed = (
        texts.join(member.withColumnRenamed("first", "id").hint("shuffle_hash"), "id")
        .select("text", "class", "group", "weight", "bands", "side", "blocks")
        .mapInArrow(_sets(n), "class binary, group binary, weight long, bands array<long>, side int, blocks int, grams binary")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("group", "class", "side", "weight", "bands", "grams",
                F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    )
    found = stage(
        placed.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j")
        .mapInArrow(_verify(threshold), "class binary, root binary, links long"), "found"
    )
    linked = found.groupBy("class").agg(F.sum("links").alias("links"))
    parts = components(found, "class", "root").withColumnRenamed("node", "class")
    names = parts.join(classes.select("class", "first"), "class").groupBy("root").agg(F.min("first").alias("least"))
    whole = (
        classes.select("class", "first", "weight").join(linked, "class", "left").join(parts, "class", "left")
        .join(names, "root", "left")
        .select("class", F.least("first", "least").alias("class_id"),
                (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    )
    of_id = described.select("id", "class").join(whole, "class").select("id", "class_id", "n_links")
    # a repeated id has one result: the class of its smallest, the most links of its rows
    of_id = of_id.groupBy("id").agg(F.min("class_id").alias("class_id"), F.max("n_links").alias("n_links"))
    out = texts.select("id").join(of_id, "id", "left")
    class_id = F.coalesce("class_id", "id")
    return out.select(
        F.col("id").alias(key), class_id.alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(class_id == F.col("id"), F.lit(True)).alias("kept"),
    )


@query("op8_jaccard_join")
def op8(spark, folder: str) -> DataFrame:
    return jaccard_links(table(spark, folder, "documents").select("doc_id", "text"))
