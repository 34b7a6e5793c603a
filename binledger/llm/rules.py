"""Quality by a sparse rule ensemble.

**Statistics** of a text are column expressions: lengths, shares of kinds of characters, repeats. **Rules** are the
paths of the trees of a random forest fitted on a bounded labelled sample: every path from the root to a node is a
conjunction of comparisons. A **lasso-logistic** fit on the rules' truth values keeps a few of them with weights, and
these are **compiled** into one column expression, so that scoring is a projection without any Python.

Defined results: NULL and empty texts have zero statistics and are scored like any other. Without usable labels, or
with labels of one class, every text has the smoothed share of the label. NULL ids are scored and not held out.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binledger.llm.automaton import _free
from binledger.llm.labelled import SAMPLE, Rows, held_out, lasso_logistic, sample_of
from binledger.llm.registry import query, table
from binledger.session import stage

#: Trees and their depth; weight of the lasso.
TREES, DEPTH, PENALTY = 12, 3, 3e-4
#: Bounds that a tree may choose from for each statistic.
BOUNDS = 512

Condition = tuple[str, str, float]  # statistic, "<=" or ">", bound
Rule = tuple[Condition, ...]


def statistics(text: str = "text") -> dict[str, Column]:
    """Statistics by name; every one is a finite double, 0 for an empty text."""
    t = F.coalesce(F.col(text), F.lit(""))
    chars = F.length(t).cast("double")

    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace(t, pattern, "")).cast("double")

    def share(count: Column, of: Column) -> Column:
        return F.when(of > 0, count / of).otherwise(F.lit(0.0))

    letters = left(r"[^\p{L}]+")
    words = F.length(F.regexp_replace(F.regexp_replace(t, r"\S+", "x"), r"\s+", "")).cast("double")
    solid = left(r"\s+")
    lines = F.split(t, "\n")
    repeats = F.length(F.regexp_replace(t, r"(?<!\S)(\S++)\s+(?=\1(?!\S))", "")).cast("double")
    return {
        "log_chars": F.log1p(chars),
        "word_length": share(solid, words),
        "letter_share": share(letters, chars),
        "upper_share": share(left(r"[^\p{Lu}]+"), chars),
        "digit_share": share(left(r"[^\p{N}]+"), chars),
        "sign_share": share(solid - letters, chars),
        "double_sign_share": share(chars - left(r"[^\p{L}\p{N}\s]{2,}"), chars),
        "lone_sign_share": share(chars - left(r"(?<!\S)[^\p{L}\p{N}\s]+(?!\S)"), chars),
        "repeat_share": share(chars - repeats, chars),
        "line_share": share(F.size(F.array_distinct(lines)).cast("double"), F.size(lines).cast("double")),
    }


def tree_rules(model, names: list[str]) -> list[Rule]:
    """Every path from a root to another node, as a simplified conjunction; equal rules once."""
    found: set[Rule] = set()

    def walk(node, path: tuple[Condition, ...]) -> None:
        if path:
            found.add(_simplify(path))
        if node.getClass().getSimpleName() != "InternalNode":
            return
        split = node.split()
        name, bound = names[split.featureIndex()], float(split.threshold())
        walk(node.leftChild(), (*path, (name, "<=", bound)))
        walk(node.rightChild(), (*path, (name, ">", bound)))

    for tree in model.trees:
        walk(tree._call_java("rootNode"), ())
    return sorted(found)


def _simplify(path: tuple[Condition, ...]) -> Rule:
    tight: dict[tuple[str, str], float] = {}
    for name, sign, bound in path:
        old = tight.get((name, sign))
        tight[name, sign] = bound if old is None else (min if sign == "<=" else max)(old, bound)
    return tuple(sorted((n, s, b) for (n, s), b in tight.items()))


def holds(rule: Rule) -> Column:
    return reduce(
        lambda a, b: a & b, [(F.col(n) <= F.lit(b)) if s == "<=" else (F.col(n) > F.lit(b)) for n, s, b in rule]
    )


def fit(documents: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
        most: int = SAMPLE) -> tuple[list[tuple[Rule, float]], float]:
    """Rules with weights, and the intercept."""
    names = list(statistics(text))
    chosen = sample_of(labels, label, key, most)  # at most about ``most`` short rows, so they may be broadcast
    given = documents.select(key, text).join(F.broadcast(chosen), key)
    given = stage(given.select("label", *[c.alias(n) for n, c in statistics(text).items()]), "statistics")
    total = {r["label"]: r["count"] for r in given.groupBy("label").count().collect()}
    n1, n0 = total.get(1, 0), total.get(0, 0)
    if not n1 or not n0:
        return [], math.log((n1 + 0.5) / (n0 + 0.5))
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=5, seed=1,
        maxBins=BOUNDS, weightCol="weight",
        featureSubsetStrategy="onethird",
    )
    # one partition of a bounded sample: the forest draws its bootstrap rows by partition
    ordered = given.repartition(1).sortWithinPartitions(*names, "label")
    # both classes weigh the same in the trees, so that bounds are looked for where the rarer one is
    ordered = ordered.withColumn("weight", F.when(F.col("label") == 1, 0.5 / n1).otherwise(0.5 / n0) * (n1 + n0))
    model = forest.fit(VectorAssembler(inputCols=names, outputCol="features").transform(ordered))
    rules = tree_rules(model, names)
    if not rules:
        return [], math.log((n1 + 0.5) / (n0 + 0.5))
    rows = np.array([[r["label"], *(r[n] for n in names)] for r in given.collect()], np.float64)
    rows = rows[np.lexsort(rows.T)]
    at = {n: i + 1 for i, n in enumerate(names)}
    truth = np.ones((len(rows), len(rules)), bool)
    for j, rule in enumerate(rules):
        for n, s, b in rule:
            truth[:, j] &= rows[:, at[n]] <= b if s == "<=" else rows[:, at[n]] > b
    x = Rows([[(int(j), 1.0) for j in np.flatnonzero(t)] for t in truth], len(rules))
    w, b0 = lasso_logistic(x, rows[:, 0], PENALTY)
    return [(r, float(v)) for r, v in zip(rules, w, strict=True) if v], float(b0)


def score(df: DataFrame, rules: list[tuple[Rule, float]], intercept: float, text: str = "text",
          out: str = "score") -> DataFrame:
    """Add the quality of ``text`` (0 to 1); a column that is already called ``out`` is replaced."""
    df = _free(df, out)
    kept = [F.col(f"`{c}`") for c in df.columns]
    if not rules:
        return df.select(*kept, F.lit(1 / (1 + math.exp(-intercept))).alias(out))
    # only statistics that a rule asks for are computed, under names that no column of the input has
    used = sorted({n for rule, _ in rules for n, _, _ in rule})
    taken = {c.lower() for c in df.columns}
    prefix = next(p for p in ("_stat_" + "_" * k for k in range(99)) if not any(c.startswith(p) for c in taken))
    all_of = statistics(text)
    # generated, not projected: a later filter on the score is then not pushed below, where every rule that it is made
    # of would compute its statistics again
    known = df.select(*kept, F.inline(F.array(F.struct(*[all_of[n].alias(prefix + n) for n in used]))))
    z = reduce(
        lambda a, b: a + b,
        [F.when(holds(tuple((prefix + n, s, b) for n, s, b in rule)), w).otherwise(0.0) for rule, w in rules],
        F.lit(intercept),
    )
    return known.select(*kept, (1 / (1 + F.exp(-z))).alias(out))


@query("op3_quality_rules")
def op3(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rules, intercept = fit(docs, table(spark, folder, "labels"))
    return score(docs, rules, intercept).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
