"""Filter interaction audit: what each filter of a chain removes, hides and costs, in any order.

Every filter leaves one stored table of the ids that fail it. Which ids a prefix of a chain
leaves does not depend on the order inside the prefix, so ids are split filter by filter:
a left-semi join with a filter's table keeps those that fail it, a left-anti join those that
pass. The last level holds one disjoint set of ids for each combination of failures; the
survivors, removals, redundancies and losses of every prefix of every order are unions of
such sets, so no order is joined twice. Each level goes on from files.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passages.llm.common import map_texts, small, store

FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_UPPER_PERCENT = 10
UPPER, SYMBOLS = bytes(range(65, 91)), b"#$%&*|"
PIECE_BYTES = 1 << 20
SHIPPED_ROWS = 250_000
KEY = ("doc_id", "digest")

_space = re.compile(rb"[\x20\x09-\x0d]")


def pieces(data: bytes, limit: int = PIECE_BYTES) -> Iterator[bytes]:
    """``data`` in pieces of about ``limit`` bytes, cut where white space stands."""
    begin = 0
    while begin < len(data):
        end = min(begin + limit, len(data))
        if end < len(data):
            found = _space.search(data, end)
            end = found.start() if found else len(data)
        yield data[begin:end]
        begin = end


def failures(data: bytes, points: int) -> tuple[bool, bool, bool, bool]:
    """Whether a text of ``points`` code points fails A, B, C and D."""
    count, distinct = 0, set()
    for piece in pieces(data):
        words = piece.split()
        count += len(words)
        distinct.update(words)
    upper = len(data) - len(data.translate(None, UPPER))
    return (
        count < LEAST_WORDS,
        100 * len(distinct) < LEAST_DISTINCT_PERCENT * count,
        100 * upper > MOST_UPPER_PERCENT * points,
        len(data.translate(None, SYMBOLS)) < len(data),
    )


def failure_marks(documents: DataFrame) -> DataFrame:
    """``(doc_id, part, digest, A, B, C, D)`` of every row, in one narrow pass over the texts."""

    def work():
        def step(block: pa.RecordBatch) -> dict:
            texts = block.column(2)
            raw = texts.cast(pa.binary()).to_pylist()
            found = [failures(t, n) for t, n in zip(raw, pc.utf8_length(texts).to_pylist())]
            return {
                "doc_id": block.column(0),
                "part": block.column(1).fill_null(""),
                "digest": [hashlib.blake2b(t, digest_size=16).digest() for t in raw],
            } | {name: [row[i] for row in found] for i, name in enumerate("ABCD")}

        return step

    schema = "doc_id bigint, part string, digest binary, A boolean, B boolean, C boolean, D boolean"
    return map_texts(documents, schema, work, keys=("doc_id", "lang"))


def repeated_texts(marks: DataFrame) -> DataFrame:
    """Ids whose text a smaller doc_id has too. Minima combine before the shuffle."""
    known = marks.where("doc_id IS NOT NULL").select(*KEY)
    firsts = known.groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
    )
    firsts = store(firsts.where("first < last").select("digest", "first"), "firsts")
    return known.join(small(firsts, SHIPPED_ROWS), "digest").where("doc_id > first").select(*KEY)


def failing_tables(marks: DataFrame) -> dict[str, DataFrame]:
    """One stored table of failing ids ``(doc_id, digest)`` for each filter, A to E."""
    found = {name: marks.where(name).select(*KEY) for name in "ABCD"}
    found["E"] = repeated_texts(marks)
    return {name: store(ids, f"failing-{name}") for name, ids in found.items()}


def with_labels(marks: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, digest, part, n, good, toxic)``: equal rows counted, with their labels.

    Of several labels of an id the largest count; ids without a label have neither.
    """
    rows = store(marks.groupBy(*KEY, "part").agg(F.count("*").alias("n")), "rows")
    of_id = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    known = rows.where("doc_id IS NOT NULL").join(of_id, "doc_id", "left")
    unknown = rows.where("doc_id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    return known.select(*rows.columns, *flags).unionByName(unknown)


def split_by(rows: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """``rows`` with ``failed``: a bit for each table of ``failing`` that holds the row's id."""
    rows = rows.withColumn("failed", F.lit(0))
    for place, (name, ids) in enumerate(failing.items()):
        same = rows["doc_id"].eqNullSafe(ids["doc_id"]) & (rows["digest"] == ids["digest"])
        removed = rows.join(ids, same, "left_semi").withColumn("failed", F.col("failed") + (1 << place))
        survivors = rows.join(ids, same, "left_anti")
        rows = store(removed.unionByName(survivors), f"split-{name}")
    return rows


def order_steps(names: str) -> list[tuple[str, int, int, int]]:
    """``(order, step, before, own)`` of all orders; ``before`` and ``own`` are bits."""
    bit = {name: 1 << place for place, name in enumerate(names)}
    return [
        ("".join(order), step + 1, sum(bit[x] for x in order[:step]), bit[name])
        for order in permutations(names) for step, name in enumerate(order)
    ]


def audit(rows: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    ``rows`` is ``(doc_id, digest, part, n, good, toxic)``; an empty table gives no row.
    ``shapley`` sums what a filter removes over all orders: of ``k`` filters that an id
    fails, each stands first in a ``k``-th of them.
    """
    sums = split_by(rows, failing).groupBy("part", "failed").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    # At most two to the number of filters for each part.
    parts = sums.groupBy("part").agg(
        F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("sets")
    )
    names = "".join(failing)
    steps = ",".join(":".join(map(str, step)) for step in order_steps(names))
    step = F.split("step", ":")
    table = parts.select("part", "sets", F.explode(F.split(F.lit(steps), ",")).alias("step")).select(
        "part", "sets", step[0].alias("filter_order"), step[1].cast("int").alias("step"),
        step[2].cast("int").alias("before"), step[3].cast("int").alias("own"),
    )
    before, own = F.col("before"), F.col("own")

    def total(wanted, value="n") -> Column:
        found = F.filter("sets", lambda s: wanted(s["failed"]))
        return F.aggregate(found, F.lit(0).cast("bigint"), lambda sum_, s: sum_ + s[value])

    def hits(failed: Column, bits: Column) -> Column:
        return failed.bitwiseAND(bits) > 0

    def removed(failed: Column) -> Column:
        return hits(failed, own) & ~hits(failed, before)

    # Orders in which one of k filters stands first.
    shares = F.array(*[F.lit(factorial(len(names)) // k).cast("bigint")
                       for k in range(1, len(names) + 1)])
    first_in = F.aggregate(
        F.filter("sets", lambda s: hits(s["failed"], own)), F.lit(0).cast("bigint"),
        lambda sum_, s: sum_ + s["n"] * F.element_at(shares, F.bit_count(s["failed"])),
    )
    return table.select(
        "part", "filter_order", "step",
        total(lambda f: ~hits(f, before.bitwiseOR(own))).alias("kept"),
        total(removed).alias("removed"),
        total(lambda f: hits(f, own) & hits(f, before)).alias("redundant"),
        total(lambda f: f == own).alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
        first_in.alias("shapley"),
    )


def audit_filters(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of five filters over ``documents`` ``(doc_id, text, lang)``.

    They fail texts with under 100 words (A), few distinct words (B), many of the letters
    A-Z (C), a symbol of ``#$%&*|`` (D), and texts that a smaller doc_id has too (E). NULL
    texts are empty; the part is ``lang``, empty where NULL. Every row counts, also one that
    repeats another; an id with several texts is several ids. A row without doc_id is judged
    by A to D, has no labels and repeats no one. Other columns are ignored; an empty table
    gives no row.
    """
    marks = store(failure_marks(documents), "marks")
    return audit(with_labels(marks, labels), failing_tables(marks))
