"""Mixing: targets against a plain loop, outcomes against what rounding must keep."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from passages.llm import mixing
from passages.llm.mixing import each_row, mix_sources, round_items, settle, source_targets

SCHEMA = "doc_id bigint, text string, source string, size string, target string, bin string"


def plain_targets(sizes, weights=(5, 2, 1)):
    """Reshare what is above three times a source's size, until none is."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        rest = sum(w for s, w in weight.items() if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else weight[s] * left / rest for s in names}
        above = {s for s in names if s not in full and target[s] > 3 * sizes[s]}
        if not above:
            return target
        full |= above


def make_rows():
    rng = np.random.default_rng(5)
    rows = []
    for source, count in {"b": 700, "a": 40, "": 9, "\U0001F600": 60, "�": 3, None: 200}.items():
        rows += [(len(rows) + i, " ".join(["w"] * int(n)), source)
                 for i, n in enumerate(rng.integers(0, 60, count))]
    rows += [(-1, None, "a"), (-2, " \n", "empty"), (-3, "x " * 5000, "b"), (-4, "", "b")]
    rows += [(None, "n n", "b")] * 7 + [(-5, "same id and text", "b")] * 900
    rows += [(-6, "one", "b"), (-6, "one two three", "b")]
    return rows


ROWS = make_rows()


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in ROWS], SCHEMA).repartition(5, "text")


@pytest.fixture(scope="module")
def mixed(documents):
    return mix_sources(documents, group=8).collect()


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_every_row_once_with_its_source(mixed):
    size = Counter()
    for _, text, source in ROWS:
        size[source] += words(text)
    target = plain_targets(size)
    assert Counter((r.doc_id, r.source, r.size) for r in mixed) == Counter(
        (d, s, words(t)) for d, t, s in ROWS)
    for r in mixed:
        assert r.source_size == size[r.source] and math.isclose(r.target, target[r.source])


def test_copies_are_the_share_rounded_and_words_stay(mixed):
    taken, longest = Counter(), Counter()
    for r in mixed:
        share = r.target / r.source_size if r.source_size else 0
        assert r.taken == r.size * r.copies and r.copies <= 3
        assert r.copies in (math.floor(share), math.ceil(share)) or r.size == 0
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    for r in mixed:
        assert abs(taken[r.source] - r.target) <= max(longest[r.source], 1e-6)


def test_reruns_agree_however_rows_are_dealt(documents, mixed):
    def answer(rows):
        return sorted(str((r.doc_id, r.size, r.source, r.copies)) for r in rows)

    again = mix_sources(documents.repartition(2), group=8).collect()
    other = mix_sources(documents, group=8, seed=2).collect()
    assert answer(mixed) == answer(again) != answer(other)


def test_empty_table(documents):
    assert mix_sources(documents.limit(0)).count() == 0
    assert mix_sources(documents.where("source = 'empty'")).select("target", "taken").collect() == [
        (0.0, 0)]


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 1000, "c": 5}, {"a": 0, "b": 7},
    {f"s{i:02d}": 3**i for i in range(12)}, {None: 4, "z": 100, "": 2}, {"only": 9},
])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size bigint")
    found = {r.source: r.target for r in source_targets(df).collect()}
    expected = plain_targets(sizes)
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[s], expected[s], abs_tol=1e-9) for s in found)


def test_targets_of_more_words_than_32_bits_hold(spark):
    """A weight times all words is beyond 2^31 from 430 million words on."""
    sizes = {"a": 1_200_000_000, "b": 800_000_000, "c": 100_000_000, "d": 3_000_000}
    df = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    found = {r.source: r.target for r in source_targets(df).collect()}
    expected = plain_targets(sizes)
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[s], expected[s], rel_tol=1e-12) for s in found)


def test_averages_are_kept(spark):
    """Over many draws each item goes up as often as its fraction says."""
    items = [("0", 5.0, 0.3), ("1", 1.0, 0.9), ("2", 2.0, 0.5), ("3", 8.0, 0.05), ("4", 1.0, 0.0),
             ("5", 3.0, 1.0)]
    draws = 20_000
    array = F.array(*[
        F.struct(F.lit(int(k)).cast("bigint").alias("o"), F.struct(F.lit(k).alias("k")).alias("key"),
                 F.lit(s).alias("s"), F.lit(p).alias("p"), mixing.chance(F.lit(k), "id").alias("u"))
        for k, s, p in items])
    settled = spark.range(draws).select("id", settle(array, "struct<k:string>").alias("r")).select(
        "id", F.explode(F.concat("r.done", F.array(F.struct(
            F.col("r.held.key").alias("key"),
            (mixing.chance(F.lit("last"), "id") < F.col("r.held.p")).alias("up"))))).alias("x"))
    ups = {r.k: r.n for r in settled.groupBy("x.key.k").agg(
        F.sum(F.col("x.up").cast("int")).alias("n")).collect()}
    for k, _, p in items:
        assert abs(ups[k] / draws - p) < 0.015, k


def test_settled_words_equal_a_plain_loop(spark):
    rng = np.random.default_rng(1)
    rows = [(0, i % 5, i, (str(i),), float(rng.integers(1, 50)), float(rng.random()), float(rng.random()))
            for i in range(200)]
    kind = "struct<k:string>"
    df = spark.createDataFrame(
        rows, f"place bigint, bin bigint, o bigint, key {kind}, s double, p double, u double")
    found = {r.bin: r for r in mixing.in_groups(df, kind, "test").collect()}
    for number in range(5):
        held, done = None, {}
        for _, _, o, (k,), s, p, u in sorted(r for r in rows if r[1] == number):
            if held is None:
                held = [k, s, p]
                continue
            gain, loss = min((1 - held[2]) * held[1], p * s), min(held[2] * held[1], (1 - p) * s)
            to_held = u * (gain + loss) < loss
            moved = gain if to_held else -loss
            a, b = held[2] + moved / held[1], p - moved / s
            if abs(a - round(a)) < 1e-9:
                done[held[0]], held = round(a) == 1, [k, s, b]
            else:
                done[k], held = round(b) == 1, [held[0], held[1], a]
        row = found[number]
        assert {x.key.k: x.up for x in row.done} == done and row.held.key.k == held[0]
        assert math.isclose(row.held.p, held[2], abs_tol=1e-9)
    up = {r.key.k: r.up for r in round_items(df, kind, 5, 1, group=2).collect()}
    assert len(up) == 200
    words_before, words_after = sum(r[4] * r[5] for r in rows), sum(r[4] for r in rows if up[r[3][0]])
    assert abs(words_before - words_after) <= max(r[4] for r in rows)


def test_many_equal_rows_are_dealt_out(spark):
    df = spark.createDataFrame([(1, 3, 25), (2, 3, 4), (None, 2, 11)], "doc_id bigint, size bigint, c bigint")
    found = defaultdict(list)
    for r in each_row(df, chunk=10).collect():
        found[r.doc_id].append(r.i)
    assert {k: sorted(v) for k, v in found.items()} == {
        1: list(range(1, 26)), 2: [1, 2, 3, 4], None: list(range(1, 12))}
