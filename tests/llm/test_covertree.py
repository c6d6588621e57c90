"""Cover trees: their invariants, what they prune, and exact answers on awkward vectors."""

import math
from collections import defaultdict

import numpy as np
import pytest

from passages.llm.covertree import CoverTree, DualSearch, top_scores


def clusters(count, rows, width, spread, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(count, width)) * 256
    noise = rng.normal(size=(count * rows, width)) * spread
    return np.floor(np.repeat(centres, rows, axis=0) + noise)


@pytest.mark.parametrize("points", [
    clusters(20, 50, 8, 4), clusters(1, 700, 3, 256), np.ones((300, 4)), np.ones((1, 2)),
    np.arange(500.0)[:, None] ** 2,
])
def test_levels_separate_cover_and_nest(points):
    tree = CoverTree(points, leaf_rows=4)
    assert sorted(tree.order) == list(range(len(points)))
    by_level = defaultdict(set)
    for node, level in enumerate(tree.level):
        children = tree.children[node]
        if children:
            assert tree.centre[node] in {tree.centre[c] for c in children}
            assert sorted(x for c in children for x in range(tree.begin[c], tree.end[c])) == list(
                range(tree.begin[node], tree.end[node]))
        for child in children:
            assert tree.level[child] < level
            gap = np.linalg.norm(points[tree.centre[child]] - points[tree.centre[node]])
            assert gap <= 2.0 ** (tree.level[child] + 1)
        rows = points[tree.order[tree.begin[node]:tree.end[node]]]
        away = np.linalg.norm(rows - points[tree.centre[node]], axis=1)
        assert math.isclose(away.max(initial=0), tree.radius[node], abs_tol=1e-9)
        by_level[level].add(tree.centre[node])
    for level, centres in by_level.items():
        own = points[sorted(centres)]
        gaps = np.linalg.norm(own[:, None] - own, axis=2)[np.triu_indices(len(own), 1)]
        assert (gaps > 2.0**level).all()


def brute(query_ids, queries, ids, points, k):
    whole = [[int(x) for x in row] for row in points]
    found = {}
    for q, row in zip(query_ids, queries):
        scores = [
            (-min(max(sum(int(a) * b for a, b in zip(row, p)), -(2**63)), 2**63 - 1), i)
            for p, i in zip(whole, ids) if i != q
        ]
        found[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return found


@pytest.mark.parametrize("spread, most", [(2, 0.2), (400, 1.0)])
def test_tight_clusters_are_pruned(spread, most):
    points = clusters(40, 100, 16, spread)
    ids = np.random.default_rng(2).permutation(len(points))
    rows = np.flatnonzero(ids % 50 == 0)
    search = DualSearch(ids[rows], points[rows], np.full(len(rows), -np.inf), ids, points, 5, 32, 4, 64)
    best = search.run()
    assert search.scored <= most * len(rows) * len(points)
    found = {
        q: list(zip(best.ids[n].tolist(), best.scores[n].tolist()))
        for n, q in enumerate(search.query_ids)
    }
    exact = points[rows] @ points.T
    for q, n in zip(ids[rows], range(len(rows))):
        order = sorted((-int(s), int(i)) for s, i in zip(exact[n], ids) if i != q)[:5]
        assert found[q] == [(i, -s) for s, i in order]


def test_long_and_unequal_vectors(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, rng.normal(size=5).astype(np.float32).tolist()) for i in range(60)]
    vectors += [(100 + i, (rng.normal(size=5) * 4e5).astype(np.float32).tolist()) for i in range(30)]
    vectors += [(200 + i, (rng.normal(size=5) * 1e20).astype(np.float32).tolist()) for i in range(20)]
    vectors += [(300 + i, rng.normal(size=n).astype(np.float32).tolist())
                for i, n in enumerate([1, 2, 3, 9, 9, 1] * 4)]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>")
    width = 9
    whole = [
        [math.floor(256 * x) if abs(x) < 1e15 else int(256 * x) for x in v] + [0] * (width - len(v))
        for _, v in vectors
    ]
    ids = [i for i, _ in vectors]
    asked = [n for n, i in enumerate(ids) if i % 10 == 0]
    expected = brute([ids[n] for n in asked], [whole[n] for n in asked], ids, whole, 4)
    found = defaultdict(list)
    for r in top_scores(df, every=10, k=4, sample_rows=20, top_nodes=3, block_rows=16,
                        slice_rows=7).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    assert found == expected


def test_components_that_leave_doubles_take_no_part(spark):
    rows = [(0, [1.0, 1.0]), (1, [1e307, 1.0]), (2, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert [tuple(r) for r in top_scores(df).collect()] == [(0, 1, 2, 512 * 256 + 256 * 256)]
    assert top_scores(df.where("vec_id > 0")).count() == 0
