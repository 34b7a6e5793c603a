"""Toxicity by a counterfactual-regularised classifier.

**Features** of a text are which words and which word beginnings (``PREFIXES`` characters) it has, lower-cased; how
often does not count, so a long text is not toxic for its length. Of the labelled sample's features the ``FEATURES``
that tell the classes apart best (by the chi-squared statistic, in at least ``LEAST_DOCS`` texts) are kept.

**Counterfactuals.** In every labelled sentence that names a group of people, each such term is exchanged for the next
ones of its list. The fit minimises mean log loss plus the lasso penalty plus ``SWAP_PENALTY`` times the mean squared
change of the score by these swaps: what a group is called must not move a score, so a neutral mention of a group that
toxic texts often name does not become a false positive.

The labelled rows are a bounded sample (``labelled.SAMPLE``); every text is scored whole.

Defined results: NULL and empty texts have the intercept's score. Without usable labels, or with labels of one class,
every text has the smoothed share of the label. NULL ids are scored like any other and are not held out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.llm.automaton import _free, _slices, _with, let_go
from binledger.llm.labelled import SAMPLE, Rows, held_out, lasso_logistic, sample_of
from binledger.llm.registry import query, table
from binledger.session import stage

#: Groups of people, by the axis along which their names may be exchanged.
IDENTITY = {
    "gender": ["women", "men", "girls", "boys"],
    "person": ["woman", "man", "girl", "boy"],
    "faith": ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist"],
    "faiths": ["christians", "muslims", "jews", "hindus", "buddhists", "atheists"],
    "origin": ["african", "american", "arab", "asian", "european", "latino", "mexican"],
    "origins": ["africans", "americans", "arabs", "asians", "europeans", "latinos", "mexicans"],
    "colour": ["black", "white", "brown"],
    "love": ["gay", "lesbian", "bisexual", "straight", "transgender"],
    "ability": ["blind", "deaf", "disabled", "autistic"],
    "age": ["young", "old", "elderly", "teenage"],
    "status": ["immigrants", "refugees", "natives", "citizens"],
}
#: Other terms that a term is exchanged for.
SWAPS = 2
#: Lengths of the word beginnings, features that are kept, and texts that a feature must be in.
PREFIXES, FEATURES, LEAST_DOCS = (4, 5, 6, 7, 8), 3000, 3
#: Weight of the lasso and of the change by swaps.
PENALTY, SWAP_PENALTY = 1e-4, 5.0
#: How far the rarer class is weighed up (see ``labelled.lasso_logistic``).
BALANCE = 0.5

_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")
_NEXT = {
    term: [terms[(i + k) % len(terms)] for k in range(1, min(SWAPS, len(terms) - 1) + 1)]
    for terms in IDENTITY.values()
    for i, term in enumerate(terms)
}


def features(words: set[str]) -> set[str]:
    out = {f"={w}" for w in words}
    for n in PREFIXES:
        out.update(f"{w[:n]}*" for w in words if len(w) >= n)
    return out


def swapped(text: str) -> Iterator[tuple[set[str], set[str]]]:
    """Features that are lost and gained by each exchange of a term in a sentence."""
    for sentence in _SENTENCE.findall(text.lower()):
        words = _WORD.findall(sentence)
        before = None
        for term in sorted(set(words) & _NEXT.keys()):
            before = before or features(set(words))
            for other in _NEXT[term]:
                after = features({other if w == term else w for w in words})
                yield before - after, after - before


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each label that have a feature; the labelled sample is bounded, and so is what a task holds."""
    let_go()
    toxic, clean = Counter(), Counter()
    for batch in _slices(batches):
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            (toxic if label else clean).update(features(set(_WORD.findall((text or "").lower()))))
    names = list(toxic.keys() | clean.keys())
    yield pa.RecordBatch.from_pydict(
        {"feature": names, "toxic": [toxic[f] for f in names], "clean": [clean[f] for f in names]},
        schema=pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())]),
    )


def _describe(place: dict[str, int]):
    schema = pa.schema([("label", pa.int32()), ("has", pa.list_(pa.int32())), ("swaps", pa.list_(pa.list_(pa.int32())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in _slices(batches):
            rows = []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                has = [place[f] for f in features(set(_WORD.findall((text or "").lower()))) if f in place]
                pairs = set()
                for lost, gained in swapped(text or ""):
                    # a lost feature is given as -1 - its place
                    change = [*(-1 - place[f] for f in lost if f in place), *(place[f] for f in gained if f in place)]
                    if change:
                        pairs.add(tuple(sorted(change)))
                rows.append({"label": label, "has": sorted(has), "swaps": sorted(pairs)})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def fit(documents: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic",
        swap_penalty: float = SWAP_PENALTY, most: int = SAMPLE) -> tuple[dict[str, float], float]:
    """Feature weights and intercept."""
    chosen = sample_of(labels, label, key, most)  # at most about ``most`` short rows, so they may be broadcast
    given = stage(documents.select(key, text).join(F.broadcast(chosen), key).select(text, "label"), "labelled")
    both = given.groupBy("label").count().collect()
    total = {r["label"]: r["count"] for r in both}
    n1, n0 = total.get(1, 0), total.get(0, 0)
    if not n1 or not n0:
        return {}, math.log((n1 + 0.5) / (n0 + 0.5))
    counted = given.mapInArrow(_count_features, "feature string, toxic long, clean long")
    counted = counted.groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    apart = a * (n0 - b) - b * (n1 - a)
    chi = apart * apart / ((a + b) * (n1 + n0 - a - b) + 1.0)
    best = counted.where(a + b >= LEAST_DOCS).orderBy(chi.desc(), "feature").limit(FEATURES).select("feature").collect()
    names = [r.feature for r in best]
    place = {f: i for i, f in enumerate(names)}
    rows = given.mapInArrow(_describe(place), "label int, has array<int>, swaps array<array<int>>").collect()
    rows.sort(key=lambda r: (r.label, r.has))
    x = Rows([[(i, 1.0) for i in r.has] for r in rows], len(names))
    pairs = Rows([[(i, 1.0) if i >= 0 else (-1 - i, -1.0) for i in p] for r in rows for p in r.swaps], len(names))
    w, b0 = lasso_logistic(x, np.array([r.label for r in rows], np.float64), PENALTY, pairs, swap_penalty, balance=BALANCE)
    return {f: float(v) for f, v in zip(names, w, strict=True) if v}, float(b0)


def score(df: DataFrame, weights: dict[str, float], intercept: float, text: str = "text", out: str = "score") -> DataFrame:
    """Add the toxicity of ``text`` (0 to 1); a column that is already called ``out`` is replaced."""
    df = _free(df, out)
    schema = df.select("*", F.lit(0.0).alias(out)).schema
    whole = {f[1:]: v for f, v in weights.items() if f[0] == "="}
    begin = {n: {f[:-1]: v for f, v in weights.items() if f[0] != "=" and len(f) == n + 1} for n in PREFIXES}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in _slices(batches):
            scores = []
            for t in batch.column(batch.schema.get_field_index(text)).to_pylist():
                words = set(_WORD.findall((t or "").lower()))
                z = intercept + math.fsum(whole[w] for w in whole.keys() & words)
                for n, known in begin.items():
                    z += math.fsum(known[p] for p in known.keys() & {w[:n] for w in words if len(w) >= n})
                scores.append(1 / (1 + math.exp(-z)) if z > -700 else 0.0)
            yield _with(batch, **{out: pa.array(scores, pa.float64())})

    return df.mapInArrow(run, schema)


@query("op9_toxicity")
def op9(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    weights, intercept = fit(docs, table(spark, folder, "labels"))
    scored = score(docs, weights, intercept)
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
