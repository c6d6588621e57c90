"""The pipeline stage by stage, on a small folder of tables."""

import pytest

import __spark_entry__
import corpus_pipeline

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, found = spark.read.parquet(f"{TABLES}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.store(stage(spark, docs, TABLES), f"test-{name}")
        found.append((name, docs, after))
        docs = after
    return found


def test_stages_keep_the_columns_and_only_filter(stages):
    for name, before, after in stages[:-1]:
        assert after.columns == before.columns, name
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()} and ids


def test_the_result_packs_all_that_was_kept(stages):
    _, before, after = stages[-1]
    assert {r.doc_id for r in after.select("doc_id").distinct().collect()} == {
        r.doc_id for r in before.collect()}


def test_rows_that_repeat_an_id_and_a_text_stay_once(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, "b"), (1, text, "a"), (1, text, "a"), (2, text, "a"), (3, "other words", "a"),
            (None, text, "a"), (None, text, "a"), (4, None, "a"), (4, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = corpus_pipeline.near_duplicates(spark, docs, TABLES)
    assert kept.columns == docs.columns
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, [
        (1, text, "a"), (3, "other words", "a"), (None, text, "a"), (None, text, "a"),
        (4, None, "a")]))


def test_all_queries_are_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n[:2] == "op" and n[2].isdigit()} == {
        f"op{i}" for i in range(1, 14)}
