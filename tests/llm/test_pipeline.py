"""The pipeline as a whole, and the library without the subpackage."""

import importlib
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scoutlens.llm import common, queries, simhash


@pytest.fixture(scope="module")
def stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = common.materialize(stage(spark, docs, sf_small), "stage")
        out.append(docs)
    return out


def test_stages_are_the_operators_in_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "simhash_near_dedup", "mixing", "sentencepiece"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_decisions_take_effect(spark, sf_small, stages):
    ids = [{r["doc_id"] for r in s.select("doc_id").collect()} for s in stages]
    assert ids[0] >= ids[1] >= ids[2] > ids[3] >= ids[4] and ids[4] == ids[5]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect()}
    clean = [i for i in ids[0] if labels.get(i) == 0]
    assert sum(i in ids[2] for i in clean) >= 0.97 * len(clean)
    groups = simhash.near_duplicates(stages[2]).select("doc_id", "component_id").collect()
    assert ids[3] == {r["component_id"] for r in groups}
    last = stages[5]
    assert last.select("doc_id", "sample").groupBy("doc_id").agg(F.max("sample").alias("m")).where("m > 1").count() == 0


def test_run_gives_the_last_stage(spark, sf_small, stages):
    got = corpus_pipeline.run(spark, sf_small)
    assert "pipeline" not in queries.QUERIES and corpus_pipeline.ORACLE_SQL is None
    plain = lambda df: sorted((r["doc_id"], r["sample"], r["ids"]) for r in df.select("doc_id", "sample", "ids").collect())
    assert plain(got) == plain(stages[-1])


def test_odd_documents_pass_all_stages(spark, sf_small):
    docs = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "x " * 30000, "en", "s", 1), (2, "x " * 30000, "en", "s", 1),
         (3, "the house of the water", None, None, 1)], "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            table = common.materialize(stage(spark, table, sf_small), "odd")
            table.count()


def test_the_rest_works_without_the_subpackage(monkeypatch):
    import __spark_entry__ as entry

    assert "pipeline" in entry.queries() and "op5_simhash" in entry.queries()
    for name in [m for m in sys.modules if m.startswith("scoutlens.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "scoutlens.llm", None)
    again = importlib.reload(entry)
    try:
        assert "pipeline" not in again.queries() and not any(k.startswith("op") and k[2].isdigit() for k in again.queries())
        assert "top_players" in again.queries()
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
