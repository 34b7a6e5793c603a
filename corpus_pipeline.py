"""Corpus pipeline: toxic and poor documents go, near copies and benchmark leaks go, the rest is encoded.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's documents. All but the last return the columns of ``documents``; the last adds the token ids and the decoded
text. Defined results: rows with a NULL id stay through the stages that compare documents; empty texts are scored like
any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from binledger.llm import automaton, decontaminate, jaccard, rules, toxicity
from binledger.llm.registry import ship, table
from binledger.session import stage

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: A document goes at this toxicity, or below this quality.
TOXIC, POOR = 0.5, 0.3


def ready(spark: SparkSession) -> None:
    """Ship the package, and send the Python workers batches of no more rows than the steps work on at a time.

    An executor and a worker hold whole batches beside all else: at Spark's default, 10,000 texts each. ``run`` puts the
    session's setting back; a step alone cannot, as its result is computed later.
    """
    ship(spark)
    if not 0 < int(spark.conf.get(_BATCH)) <= automaton.BATCH_ROWS:
        spark.conf.set(_BATCH, str(automaton.BATCH_ROWS))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    weights, intercept = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, weights, intercept, out="_toxicity").where(F.col("_toxicity") < TOXIC).drop("_toxicity")


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    found, intercept = rules.fit(docs, table(spark, sf_dir, "labels"))
    return rules.score(docs, found, intercept, out="_quality").where(F.col("_quality") >= POOR).drop("_quality")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the smallest id stays; rows that repeat an id and its text are one document."""
    ready(spark)
    gone = jaccard.jaccard_links(docs).where("not kept").select("doc_id").distinct()
    return docs.join(stage(gone, "copies"), "doc_id", "left_anti").select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    leaks = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(stage(leaks, "leaks"), "doc_id", "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    coded = automaton.encode(docs, automaton.word_vocabulary(), decoded="decoded")
    return coded.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("encoding", encode),
]

#: Two stages are learned classifiers, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = spark.conf.get(_BATCH)
    try:
        for name, step in STAGES:
            docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    finally:
        spark.conf.set(_BATCH, before)
    return docs
