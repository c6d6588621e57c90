"""Lexical search: the treap against its cells, the search against scoring every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from passages.llm.lexical import Best, Grid, ranked_search

WORDS = [f"t{i}" for i in range(400)]


def grid_of(seed, rows, columns, cells, most=1000):
    rng = np.random.default_rng(seed)
    places = rng.choice(rows * columns, cells, replace=False)
    values = rng.integers(1, most, cells)
    return places // columns, places % columns, values, np.arange(columns) * 3 + 1


@pytest.mark.parametrize("rows, columns, cells", [(1, 1, 1), (7, 5, 20), (300, 40, 900), (9, 700, 2000)])
def test_packed_squares_hold_their_maxima(rows, columns, cells):
    row, column, value, docs = grid_of(1, rows, columns, cells)
    built = Grid.build(row, column, value, docs)
    grid = Grid.unpacked(built.packed())
    assert np.array_equal(grid.masks, built.masks) and np.array_equal(grid.maxima, built.maxima)
    for i in range(len(row)):
        at, path = 0, []
        for level in range(grid.height):
            bit = grid.height - 1 - level
            quarter = (row[i] >> bit & 1) * 2 + (column[i] >> bit & 1)
            assert grid.masks[at] >> quarter & 1
            path.append((level, at))
            at = grid.first[at] + bin(grid.masks[at] & ((1 << quarter) - 1)).count("1")
        assert grid.maxima[at] == value[i]
        for level, square in path:
            bit = grid.height - level
            inside = (row >> bit == row[i] >> bit) & (column >> bit == column[i] >> bit)
            assert grid.maxima[square] == value[inside].max()


@pytest.mark.parametrize("seed", range(6))
def test_search_equals_all_sums(seed):
    # Few values: many equal scores.
    row, column, value, docs = grid_of(seed, 60, 500, 6000, most=3 if seed % 2 else 5000)
    grid, rng = Grid.build(row, column, value, docs), np.random.default_rng(seed)
    for size in (1, 3, 30):
        own = rng.choice(60, size, replace=False)
        score = Counter()
        for r, c, v in zip(row, column, value):
            if r in own:
                score[int(docs[c])] += int(v)
        expected = sorted(score.items(), key=lambda x: (-x[1], x[0]))[:10]
        best = Best(10)
        grid.search(own, best)
        assert list(zip(best.ids, best.scores)) == expected


def test_bounds_leave_most_squares_alone():
    rng = np.random.default_rng(2)
    row, column = np.divmod(rng.choice(256 * 4096, 60_000, replace=False), 4096)
    value = np.where((column < 64) & (row < 32), 10_000, rng.integers(1, 20, len(row)))
    grid, best = Grid.build(row, column, value, np.arange(4096)), Best(10)
    looked = grid.search(np.arange(8), best)
    # The ranges of all levels are twice the documents, each looked at for eight rows.
    assert looked < 8 * 2 * 4096 / 4 and (best.ids < 64).all()


def sentence(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[min(int(x), 399)] for x in rng.geometric(0.02, n))


DOCS = [(i, sentence(i, 5 + i % 90)) for i in range(300)]
DOCS += [(1000 + i, DOCS[0][1]) for i in range(60)]
DOCS += [(-4, None), (-3, ""), (-2, " .,;"), (None, sentence(1, 40)), (5, "t1 t2"), (5, "t1 t2"),
         (-1, "Über T3-T3 t3 naïve 日本 x" + "y" * 3000), (-9, sentence(77, 30_000))]
ITEMS = [(i, sentence(1000 + i, 12)) for i in range(15)] + [
    (20, DOCS[0][1]), (21, None), (22, "..."), (23, "nowhere at all"), (24, "t1 T1 t1"),
    (25, "über NAÏVE 日本"), (None, "t1"), (26, "t1"), (26, "t2")]


def terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def expected(docs, items, k):
    docs = [(d, Counter(terms(t))) for d, t in docs if d is not None]
    count, total = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    wanted = {}
    for item, text in items:
        if item is not None:
            wanted.setdefault(item, set()).update(terms(text))
    out = set()
    for item, own in wanted.items():
        scored = []
        for d, c in docs:
            m = 100 - 90 + 90 * sum(c.values()) * count // total
            scored.append((-sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in own if t in c), d))
        for rank, (s, d) in enumerate(sorted(x for x in scored if x[0] < 0)[:k], 1):
            out.add((item, rank, d, -s))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    docs = [(d, t, "rank", "score") for d, t in DOCS]
    return (spark.createDataFrame(docs, "doc_id bigint, text string, rank string, score string").repartition(4),
            spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id bigint, text string, doc_id string"))


@pytest.mark.parametrize("options", [
    {}, {"block_docs": 7}, {"block_cells": 100, "k": 3}, {"slice_bytes": 900, "block_docs": 50}])
def test_ranks_equal_brute_force(tables, options):
    found = {tuple(r) for r in ranked_search(*tables, **options).collect()}
    assert found == expected(DOCS, ITEMS, options.get("k", 10))


def test_empty_tables(tables):
    documents, items = tables
    assert ranked_search(documents.limit(0), items).count() == 0
    assert ranked_search(documents, items.limit(0)).count() == 0
    assert ranked_search(documents.where("text IS NULL"), items).count() == 0
