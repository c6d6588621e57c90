"""The filter audit against plain counting, over every order of the filters."""

import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from passages.llm.filters import audit, audit_filters, failures, order_steps, pieces

SCHEMA = "doc_id bigint, text string, lang string, part string, failed string, n string"
PLAIN = " ".join(f"word{i}" for i in range(120))
ROWS = [
    (1, PLAIN, "en"), (2, PLAIN, "de"), (3, PLAIN, "en"), (3, PLAIN, "en"), (4, None, "en"),
    (5, "", None), (6, "SHOUT " * 150, "en"), (7, PLAIN + " # |", "en"), (8, PLAIN + " $", ""),
    (9, " \n\t\x0b\x0c\r ", "de"), (None, PLAIN, "en"), (None, PLAIN, "en"), (None, "a", None),
    (10, "É ñ  x " + PLAIN, "fr"), (10, "another text of the same id", "fr"),
    (11, " ".join(f"w{i}" for i in range(20_000)), "en"), (12, "spam " * 200, "en"),
    (-5, PLAIN, "es"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (3, 0, 0), (6, 1, 0), (7, None, None), (8, 1, 1),
          (None, 1, 1), (12, 0, 1), (4, 1, 0)]


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(*r, "p", "f", "n") for r in ROWS]
    labels = [(*r, "p") for r in LABELS]
    return (spark.createDataFrame(rows, SCHEMA).repartition(3, "text"),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, part string"))


def failing(row):
    doc_id, text, _ = row
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    same = [r[0] for r in ROWS if (r[1] or "") == text and r[0] is not None]
    return {name for name, bad in {
        "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": re.search(r"[#$%&*|]", text), "E": doc_id is not None and doc_id > min(same),
    }.items() if bad}


def expected():
    good = {r[0] for r in LABELS if r[0] is not None and r[1] == 1}
    toxic = {r[0] for r in LABELS if r[0] is not None and r[2] == 1}
    out, removed_by = {}, Counter()
    for part in {r[2] or "" for r in ROWS}:
        rows = [(r[0], failing(r)) for r in ROWS if (r[2] or "") == part]
        for order in permutations("ABCDE"):
            left = rows
            for step, name in enumerate(order, 1):
                removed = [r for r in left if name in r[1]]
                left = [r for r in left if name not in r[1]]
                removed_by[part, name] += len(removed)
                out[part, "".join(order), step] = [
                    len(left), len(removed), sum(name in r[1] for r in rows) - len(removed),
                    sum(r[1] == {name} for r in rows), sum(r[0] in good for r in removed),
                    sum(r[0] in toxic for r in removed)]
    return {k: (*v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_plain_counting(tables):
    found = {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails,
                                           r.good_lost, r.toxic_lost, r.shapley)
        for r in audit_filters(*tables).collect()
    }
    assert found == expected()


def test_empty_tables(tables):
    documents, labels = tables
    assert audit_filters(documents.limit(0), labels).count() == 0
    without = audit_filters(documents, labels.limit(0)).agg(
        F.sum("good_lost"), F.sum("toxic_lost"), F.count("*")).first()
    assert tuple(without) == (0, 0, 600 * 5)


def test_other_filters_over_a_hot_id(spark):
    """Any number of id tables; a third of the rows is one id."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
        F.lit(b"t").alias("digest"), F.lit("p").alias("part"), F.lit(1).cast("long").alias("n"),
        F.lit(True).alias("good"), F.lit(False).alias("toxic"))
    ids = {"X": rows.where("doc_id = 7"), "Y": rows.where("doc_id < 100")}
    found = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley)
             for r in audit(rows, {k: v.select("doc_id", "digest") for k, v in ids.items()}).collect()}
    hot = sum(1 for i in range(3000) if i % 3 == 0 or i == 7)
    low = sum(1 for i in range(100) if i % 3 and i != 7)
    assert found[("XY", 1)] == (3000 - hot, hot, 0, 0, hot)
    assert found[("XY", 2)] == (3000 - hot - low, low, hot, low, hot + low + low)
    assert found[("YX", 2)] == (3000 - hot - low, 0, hot, 0, hot)


def test_pieces_are_cut_at_white_space():
    data = b"ab  cd\nefg " * 50 + b"x" * 100
    for limit in (1, 7, 64, 10_000):
        found = list(pieces(data, limit))
        assert b"".join(found) == data and [w for p in found for w in p.split()] == data.split()
    assert failures(b"", 0) == (True, False, False, False)
    assert len(order_steps("ABCDE")) == 600
