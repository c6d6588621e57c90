"""Search over codes: bounds hold, answers are exact, vectors of few points are read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from passages.operators import coded
from passages.operators.search import topk_cosine
from passages.session import scratch_path
from test_search import _copies, _expected_topk, _table


def test_codes_are_within_their_error():
    rng = np.random.default_rng(0)
    vectors = np.concatenate([rng.normal(size=(500, 16)), np.eye(16), np.zeros((1, 16))])
    codes, error = coded.code_vectors(vectors)
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = vectors / np.where(length > 0, length, 1)
    assert (np.linalg.norm(unit - codes / 127, axis=1) <= error).all()
    asked = rng.normal(size=(50, 16))
    asked /= np.linalg.norm(asked, axis=1, keepdims=True)
    assert (np.abs(asked @ unit.T - asked @ codes.T / 127) <= error + 1e-6).all()


def _stored(spark, points):
    path = scratch_path(spark, "coded")
    coded.code_points(points, dim=8).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("kind", ["copies", "random", "clusters"])
@pytest.mark.parametrize("k, sample", [(1, 4096), (3, 2), (500, 10)])
def test_search_is_exact(spark, kind, k, sample):
    rng = np.random.default_rng(1)
    if kind == "copies":
        q, p = _copies(rng, 45, 8), _copies(rng, 300, 8)
    elif kind == "random":
        q, p = rng.normal(size=(45, 8)), rng.normal(size=(300, 8))
    else:
        centers = rng.normal(size=(4, 8))
        q = centers[rng.integers(0, 4, 45)] + 1e-4 * rng.normal(size=(45, 8))
        p = centers[rng.integers(0, 4, 300)] + 1e-4 * rng.normal(size=(300, 8))
    q, p = q.astype(np.float32).astype(float), p.astype(np.float32).astype(float)
    qids, pids = rng.permutation(45), rng.permutation(300) * 10_000_000_000
    points = _stored(spark, _table(spark, pids, p, "id").repartition(4))
    found = coded.topk_coded(
        _table(spark, qids, q, "query_id"), points, k, dim=8, sample_points=sample)
    assert sorted(map(tuple, found.collect())) == _expected_topk(qids, q, pids, p, k)


def test_null_and_many_queries(spark):
    points = spark.createDataFrame(
        [(1, [1.0] * 8), (2, None), (3, []), (4, [0.0] * 8), (5, [1.0, 2.0] * 4)],
        "id bigint, embedding array<float>")
    stored = _stored(spark, points)
    queries = spark.createDataFrame([(7, [1.0] * 8), (8, None)], "query_id bigint, embedding array<float>")
    for limit in (1 << 20, 0):
        hits = coded.topk_coded(queries, stored, 2, dim=8, broadcast_bytes=limit).collect()
        assert sorted((h.query_id, h.id, h["rank"]) for h in hits) == [(7, 1, 1), (7, 5, 2)]
    assert coded.topk_coded(queries, stored.limit(0), 2, dim=8).count() == 0
    assert coded.topk_coded(queries.limit(0), stored, 2, dim=8).count() == 0


def test_few_pairs_are_scored_and_codes_are_all_the_first_pass_reads(spark):
    rng = np.random.default_rng(3)
    q, p = rng.normal(size=(40, 8)), rng.normal(size=(4000, 8))
    points = _stored(spark, _table(spark, range(4000), p, "id").repartition(4))
    queries = _table(spark, range(40), q, "query_id")
    table = queries.toArrow()
    floors = coded._sample_floors(table, points, 3, "id", "embedding", 8, 500)
    pairs = coded.open_pairs(table, floors, points, 3, 8, "id")
    # Of 160,000 pairs less than one in fifty is scored exactly.
    assert 120 <= pairs.count() < 40 * 4000 / 50
    first = points.where("error < 1").select(F.col("id"), "code", "error")
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "embedding" not in plan.split("ReadSchema")[1]
    found = coded.topk_coded(queries, points, 3, dim=8)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(map(tuple, found.collect())) == sorted(
        map(tuple, topk_cosine(queries, points, 3, dim=8).collect()))
