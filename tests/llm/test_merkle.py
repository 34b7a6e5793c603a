"""The Merkle manifest against a plain rebuild of both trees."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from binledger.llm import merkle

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(leaves, arity):
    """Root of the leaves and per leaf the steps (before, after) up to it."""
    paths, at = [[] for _ in leaves], list(range(len(leaves)))
    while len(leaves) > 1:
        runs = [leaves[i:i + arity] for i in range(0, len(leaves), arity)]
        for p, i in zip(paths, at):
            run, slot = runs[i // arity], i % arity
            p.append(("".join(run[:slot]), "".join(run[slot + 1:])))
        leaves, at = [sha(*r) for r in runs], [i // arity for i in at]
    return leaves[0], paths


def expected(rows, arity=16):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for g in order:
        members = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subs[g] = (members, *tree([leaf(r) for r in members], arity))
    root, tops = tree([subs[g][1] for g in order], arity)
    out = []
    for g, top in zip(order, tops):
        for r, path in zip(subs[g][0], subs[g][2]):
            path = path + top
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            x = leaf((*r[:4], "".join(c.lower() if c.isascii() else c for c in r[4]))) if changed else leaf(r)
            for before, after in path:
                x = sha(before, x, after)
            out.append((r[0], leaf(r), subs[g][1], root, sha(*[b + a for b, a in path]), x, x == root))
    return sorted(out, key=str)


def result(df, **options):
    got = merkle.manifest(df, tampered=merkle.tampered_leaf(), **options).drop("siblings")
    return sorted([tuple(r) for r in got.collect()], key=str)


def rows_for(sizes):
    rows, n = [], 0
    for g, size in sizes:
        for _ in range(size):
            rows.append((n, g, ["en", None][n % 2], n * 7, f"Text Ä {n}" if n % 3 else "plain"))
            n += 1
    return rows


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_trees_of_many_shapes(spark, arity):
    rows = rows_for([("a", 1), ("b", 2), (None, 16), ("ä", 17), ("Z", 37), ("", 3)])
    df = spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)
    assert result(df, arity=arity) == expected(rows, arity)


def test_many_groups_and_one_with_most_rows(spark):
    rows = rows_for([(f"s{i}", 1) for i in range(40)] + [("hot", 300)])
    assert result(spark.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (1, "a", "en", 1, ""), (1, "a", "en", 1, "B"),
        (1, "a", "en", 1, "B"), (5, "a", None, None, "Y" * 50_000), (1, "b", "de", 2, "B"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("g", "h", "pos", "n", "id", "path", "root", "leaf", "run", "shown", "digests"):
        df = df.withColumn(name, F.lit("x"))
    assert result(df) == expected(rows)


def test_lone_row_and_empty_table(spark):
    one = [(7, "a", "en", 3, "Abc")]
    assert result(spark.createDataFrame(one, SCHEMA)) == expected(one)
    assert result(spark.createDataFrame([], SCHEMA)) == []


def test_a_changed_row_changes_the_root_and_is_found(spark):
    rows = rows_for([("a", 40), ("b", 5)])
    roots = {r[3] for r in result(spark.createDataFrame(rows, SCHEMA))}
    other = [(*r[:4], r[4] + "!") if r[0] == 33 else r for r in rows]
    changed = spark.createDataFrame(other, SCHEMA)
    assert roots.isdisjoint({r[3] for r in result(changed)})
    kept = merkle.manifest(spark.createDataFrame(rows, SCHEMA), tampered=F.when(F.col("doc_id") == 33, F.sha2("text", 256)))
    assert [r.doc_id for r in kept.where("not verified").collect()] == [33]
