"""Merkle manifest of a dataset: one root for all rows, a proof per row, verified by folding.

**Leaves.** A row's leaf is the hash of its fields, each written as ``-`` where NULL and otherwise as its length in bytes,
``:`` and its value, so that no two different rows write alike.

**Levels.** The nodes of a group stand at positions 0..n-1. While a group has several nodes, the slot-zero row of every run
of ``arity`` consecutive ones computes the indices of its run (its own plus the slot offsets), an equijoin of the level
with itself finds the nodes there, and the slot-zero row emits the parent. A level is written before the next one reads
it. A level has one ``arity``-th of the rows of the one below, so the sum of all levels is bounded by the first; the
number of levels grows with the logarithm of the largest group. The join key is (group, position), so a group that holds
a third of all rows is dealt out like any other.

**Groups.** What remains of a group is its subroot; the subroots in the order of the groups are the leaves of one more
tree, whose last node is the root.

**Proofs.** The siblings above a run are common to its members. They are worked out from the root downwards, once per
run, as text before and after the own place at each level; a row adds its own siblings to those of its run.

Defined results: NULL groups are a group of their own, the first one. Rows of a group stand in the order of their key,
NULL first, then of their leaf, so repeated keys are ordered and repeated rows are leaves side by side with proofs of
their own. The only row of a group is its subroot, and a lone subroot is the root; such proofs are the hash of nothing.
An empty table gives an empty result. Other columns of the table do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from binledger.llm.registry import query, table
from binledger.operators.ranking import with_position
from binledger.session import stage

#: Nodes that share a parent.
ARITY = 16


def field(value: Column) -> Column:
    """``-`` for NULL, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*fields: Column) -> Column:
    """Lower-case hex SHA-256 of the texts one after another."""
    return F.sha2(F.concat(*fields), 256)


def leaf(columns: Sequence[Column | str]) -> Column:
    return digest(*[field(F.col(c) if isinstance(c, str) else c) for c in columns])


def group_key(value: Column) -> Column:
    """A text that is never NULL, in the order NULL, then values by their bytes."""
    return F.coalesce(F.concat(F.lit(":"), value.cast("string")), F.lit("-"))


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "source",
    key: str = "doc_id",
    tampered: Column | None = None,
    arity: int = ARITY,
) -> DataFrame:
    """(key, leaf, subroot, root, siblings, proof_sha256, folded_root, verified), one row per row of ``docs``.

    ``siblings`` is the proof: per level the digests before and after the own place. ``tampered`` is a leaf to fold in
    place of the own one; where it is NULL the own one is folded.
    """
    if arity < 2:
        raise ValueError("a run needs two nodes at least")
    other = F.lit(None).cast("string") if tampered is None else tampered
    base = docs.select(
        F.col(key).alias("id"), group_key(F.col(group)).alias("g"), leaf(columns).alias("h"), other.alias("shown")
    )
    order = [F.col("id").asc_nulls_first(), F.col("h"), F.col("shown")]
    rows = stage(with_position(base, order, ["g"], "pos", "n"), "merkle-rows")

    runs = _levels(rows.select("g", "pos", "n", "h"), arity)
    ends = [rows.where("n = 1").select("g", "h")] + [r.where("n = 1").select("g", "h") for r in runs]
    subroots = _union(ends)
    ranked = with_position(subroots, [F.col("g")], [], "pos", "n")
    ranked = stage(ranked.select(F.lit("").alias("g"), "pos", "n", "h", F.col("g").alias("part")), "merkle-subroots")
    top_runs = _levels(ranked.select("g", "pos", "n", "h"), arity)
    roots = _union([ranked.where("n = 1").select("h")] + [r.where("n = 1").select("h") for r in top_runs])

    # one row: the root
    nothing = F.broadcast(roots.select(F.lit("").alias("g"), F.col("h").alias("root"), _no_steps().alias("path")))
    upper = _paths(top_runs, nothing, ["root"], arity)
    heads = _climb(ranked.withColumnRenamed("h", "subroot"), upper, nothing, ["root"], arity)
    heads = stage(heads.select(F.col("part").alias("g"), "subroot", "root", "path"), "merkle-heads")

    lower = _paths(runs, heads, ["subroot", "root"], arity)
    out = _climb(rows, lower, heads, ["subroot", "root"], arity)
    folded = F.aggregate("path", F.coalesce("shown", "h"), lambda x, p: digest(p["before"], x, p["after"]))
    proof = F.array_join(F.transform("path", lambda p: F.concat(p["before"], p["after"])), "")
    return out.select(
        F.col("id").alias(key), F.col("h").alias("leaf"), "subroot", "root", F.col("path").alias("siblings"),
        F.sha2(proof, 256).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _no_steps() -> Column:
    return F.array().cast("array<struct<before:string,after:string>>")


def _levels(nodes: DataFrame, arity: int) -> list[DataFrame]:
    """Per level the runs (g, pos, n, h, digests): a run is the node at ``pos`` of the level above, of ``n`` there."""
    out = []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        several = nodes.where("n > 1")
        slot_zero = several.where(F.col("pos") % arity == 0).select(
            "g", F.expr(f"pos div {arity}").alias("run"), F.expr(f"(n + {arity - 1}) div {arity}").alias("above"),
            F.explode(F.expr(f"sequence(pos, least(pos + {arity - 1}, n - 1))")).alias("pos"),
        )
        found = slot_zero.join(several.select("g", "pos", "h"), ["g", "pos"])
        # a run has ``arity`` members at most
        run = found.groupBy("g", F.col("run").alias("pos"), F.col("above").alias("n")).agg(
            F.transform(F.sort_array(F.collect_list(F.struct("pos", "h"))), lambda s: s["h"]).alias("digests")
        )
        run = run.withColumn("h", F.sha2(F.array_join("digests", ""), 256))
        out.append(stage(run, "merkle-level"))
        nodes = out[-1].select("g", "pos", "n", "h")
        most = -(-most // arity)
    return out


def _paths(runs: list[DataFrame], heads: DataFrame, carry: list[str], arity: int) -> DataFrame | None:
    """(g, run, run_digests, run_path, carried columns) of the lowest level: the members' digests, the steps above."""
    upper = None
    for level in reversed(runs):
        upper = _climb(level.drop("h"), upper, heads, carry, arity)
        upper = upper.select(
            "g", F.col("pos").alias("run"), F.col("digests").alias("run_digests"), F.col("path").alias("run_path"), *carry
        )
        upper = stage(upper, "merkle-paths")
    return upper


def _climb(nodes: DataFrame, upper: DataFrame | None, heads: DataFrame, carry: list[str], arity: int) -> DataFrame:
    """Add ``path``, the steps from a node to the root. A group's last node (``n`` = 1) goes on at the group's head."""
    last = nodes.where("n = 1").join(heads, "g")
    if upper is None:
        return last
    inner = nodes.where("n > 1").withColumn("run", F.expr(f"pos div {arity}")).join(upper, ["g", "run"])
    slot = F.expr(f"cast(pos % {arity} as int)")
    step = F.struct(
        F.array_join(F.slice("run_digests", F.lit(1), slot), "").alias("before"),
        F.array_join(F.slice("run_digests", slot + 2, F.size("run_digests")), "").alias("after"),
    )
    return last.unionByName(inner.withColumn("path", F.concat(F.array(step), "run_path")).select(*last.columns))


ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def tampered_leaf() -> Column:
    """The leaf with the text's A-Z in lower case, for rows whose id's checksum 5 divides; else NULL."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.translate("text", ALPHABET, ALPHABET.lower())
    return F.when(hit, leaf(["doc_id", "source", "lang", "n_chars", text]))


def _sql(levels: int = 6) -> str:
    """Both trees level by level, written out for at most 16 to the power of ``levels`` rows a group."""
    parts = [
        """crc as (select list(v order by i) t from (
             select i, list_reduce(list_prepend(i, range(8)), lambda c, k:
               case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) v from range(256) r(i)))""",
        """docs as (select doc_id, g, h, shown, row_number() over (partition by g order by doc_id nulls first, h, shown) - 1 pos,
             count(*) over (partition by g) n from (
           select doc_id, coalesce(':' || source, '-') g, sha256({front} || {text}) h,
             case when xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''),
               lambda d: ord(d)::bigint)), lambda c, d: xor(c // 256, t[xor(c % 256, d) + 1])), 4294967295) % 5 = 0
             then sha256({front} || {lower}) end shown from documents, crc))""".format(
            front=" || ".join(_sql_field(c) for c in ("doc_id", "source", "lang", "n_chars")), text=_sql_field("text"),
            lower=_sql_field(f"translate(text, '{ALPHABET}', '{ALPHABET.lower()}')"),
        ),
        "a0 as (select g, pos, n, h from docs)",
        *_sql_levels("a", levels),
        f"""b0 as (select '' g, row_number() over (order by g) - 1 pos, count(*) over () n, h, g part from (
              {' union all '.join(f'select g, h from a{k} where n = 1' for k in range(levels + 1))}))""",
        *_sql_levels("b", levels),
        f"root as ({' union all '.join(f'select h root from b{k} where n = 1' for k in range(levels + 1))})",
        "start as (select doc_id, docs.h leaf, b0.h subroot, root, docs.g, docs.pos, b0.pos bpos, coalesce(shown, docs.h) x, "
        "'' proof from docs join b0 on part = docs.g, root)",
    ]
    last = "start"
    for tree, at, group in (("a", "pos", "last.g"), ("b", "bpos", "''")):
        for k in range(levels):
            before = f"array_to_string(r.hs[:last.{at} // {ARITY ** k} % {ARITY}], '')"
            after = f"array_to_string(r.hs[last.{at} // {ARITY ** k} % {ARITY} + 2:], '')"
            parts.append(
                f"{tree}s{k} as (select last.* exclude (x, proof), case when r.h is null then x else sha256({before} || x || "
                f"{after}) end x, case when r.h is null then proof else proof || {before} || {after} end proof from {last} last "
                f"left join {tree}r{k} r on r.g = {group} and r.run = last.{at} // {ARITY ** (k + 1)})"
            )
            last = f"{tree}s{k}"
    return (
        f"with {', '.join(parts)} select doc_id, leaf, subroot, root, sha256(proof) proof_sha256, x folded_root, "
        f"x = root verified from {last}"
    )


def _sql_field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::varchar)) || ':' || {value}::varchar, '-')"


def _sql_levels(tree: str, levels: int) -> list[str]:
    out = []
    for k in range(levels):
        out.append(
            f"{tree}r{k} as (select g, pos // {ARITY} run, (n + {ARITY - 1}) // {ARITY} n, list(h order by pos) hs, "
            f"sha256(string_agg(h, '' order by pos)) h from {tree}{k} where n > 1 group by 1, 2, 3)"
        )
        out.append(f"{tree}{k + 1} as (select g, run pos, n, h from {tree}r{k})")
    return out


@query("op11_merkle_manifest", _sql())
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest(table(spark, folder, "documents"), tampered=tampered_leaf()).drop("siblings")
