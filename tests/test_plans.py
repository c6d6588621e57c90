"""The physical plans have the shape the operators promise."""

import re

import pytest

from conftest import SMALL
from passages.plans.catalog import QUERIES


def plan(spark, name):
    df = QUERIES[name](spark, SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return [e for e in re.findall(r"Exchange (\w+)", text) if e != "HashedRelationBroadcastMode"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["word_chunks", "char_window_chunks", "embed_chunks"])
def test_narrow_operators_only_spread_the_scan(spark, name):
    text = plan(spark, name)
    assert len(re.findall(r"Exchange ", text)) == 1 and "REPARTITION_BY_NUM" in text


def test_search_ships_k_rows_per_query_and_prunes_columns(spark):
    text = plan(spark, "topk_cosine")
    assert "WindowGroupLimit" in text and "SinglePartition" not in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_filter_reaches_the_scan(spark):
    assert "EqualTo(lang,en)" in plan(spark, "search_where")


def test_words_are_split_once_per_document(spark):
    text = plan(spark, "word_chunks")
    generate = next(line for line in text.splitlines() if "Generate" in line)
    assert "split(" not in generate
