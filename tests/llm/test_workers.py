"""What Python workers hold: batches of few rows, and one operator's tables at a time."""

import corpus_pipeline
import pyarrow as pa
import pytest

from binledger.llm import automaton, jaccard, toxicity

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.fixture
def setting(spark):
    before = spark.conf.get(BATCH)
    yield
    spark.conf.set(BATCH, before)


def largest_batch(spark):
    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    return spark.range(0, 3000, 1, 1).mapInArrow(rows, "n long").agg({"n": "max"}).first()[0]


def test_steps_send_small_batches_to_the_workers(spark, setting, frame):
    docs = frame([(1, "some words")], "doc_id long, text string")
    for asked, most in (("10000", automaton.BATCH_ROWS), ("0", automaton.BATCH_ROWS), ("100", 100)):
        spark.conf.set(BATCH, asked)
        corpus_pipeline.encode(spark, docs, "")
        assert largest_batch(spark) == most


def test_run_puts_the_setting_back(spark, setting, monkeypatch, tmp_path, frame):
    docs = frame([(1, "some words")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.conf.set(BATCH, "5000")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("encoding", corpus_pipeline.encode)])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 1 and spark.conf.get(BATCH) == "5000"
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("encoding", corpus_pipeline.encode), ("none", lambda *_: 1 / 0)])
    with pytest.raises(ZeroDivisionError):
        corpus_pipeline.run(spark, str(tmp_path))
    assert spark.conf.get(BATCH) == "5000"


@pytest.mark.parametrize("work", [
    jaccard._describe(5, 14, 4), jaccard._sets(5), jaccard._verify(0.8), toxicity._count_features, toxicity._describe({}),
])
def test_other_operators_let_the_automaton_go(work, monkeypatch):
    monkeypatch.setattr(automaton, "_BUILT", {"vocabulary": object()})
    list(work(iter([])))
    assert not automaton._BUILT


def test_score_lets_the_automaton_go(frame, monkeypatch):
    docs, given = frame([(1, "some words")], "doc_id long, text string"), []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda _, work, schema: given.append(work))
    toxicity.score(docs, {}, 0.0)
    monkeypatch.setattr(automaton, "_BUILT", {"vocabulary": object()})
    list(given[0](iter([])))
    assert not automaton._BUILT
