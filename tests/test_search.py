import numpy as np
import pytest
from pyspark.sql import functions as F

from passages.functions.vectors import cosine_similarity, mean_of_vectors
from passages.operators import embedding, scoring
from passages.operators.pairs import pairwise_similarity
from passages.operators.search import topk_cosine, topk_cosine_sparse


def _table(spark, ids, vectors, name):
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, f"{name} long, embedding array<float>")


def _units(a, b):
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.rint(a @ b.T / np.sqrt(np.outer((a * a).sum(1), (b * b).sum(1))) * 1e6)


def _expected_topk(qids, q, pids, p, k):
    units, rows = _units(q, p), []
    for i, qid in enumerate(qids):
        ranked = sorted((-u, pid) for u, pid in zip(units[i], pids) if not np.isnan(u))[:k]
        rows += [(int(qid), int(pid), -u / 1e6, r + 1) for r, (u, pid) in enumerate(ranked)]
    return sorted(rows)


def _copies(rng, n, dim, share=0.4):
    """Small whole vectors; a large share of them is the same, one is zero."""
    vectors = rng.integers(-3, 4, (n, dim)).astype(float)
    vectors[rng.random(n) < share] = vectors[0]
    vectors[n // 2] = 0
    return vectors


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "block_bytes": 8 * 8 * 20}])
@pytest.mark.parametrize("k", [1, 3, 500])
def test_topk_is_exact(spark, options, k):
    rng = np.random.default_rng(1)
    q, p = _copies(rng, 45, 8), _copies(rng, 200, 8)
    qids, pids = rng.permutation(45), rng.permutation(200) * 10_000_000_000
    found = topk_cosine(
        _table(spark, qids, q, "query_id"), _table(spark, pids, p, "id").repartition(5), k,
        dim=8, **options,
    )
    assert sorted(map(tuple, found.collect())) == _expected_topk(qids, q, pids, p, k)


def test_topk_blocks_inside_a_task(monkeypatch):
    monkeypatch.setattr(scoring, "MATRIX_CELLS", 500)
    monkeypatch.setattr(scoring, "FIRST_POINTS", 5)
    monkeypatch.setattr(scoring, "EXACT_PAIRS", 16)
    rng = np.random.default_rng(5)
    for kind in (_copies, lambda r, n, d: r.normal(size=(n, d))):
        q, p = kind(rng, 37, 4), kind(rng, 150, 4)
        best = scoring.Best(q, 3)
        for part in np.array_split(rng.permutation(150), 4):
            best.add(part, p[part])
        rows = [(int(i), int(d), u / 1e6) for i, d, u in zip(*best.found())]
        assert sorted(rows) == sorted(r[:3] for r in _expected_topk(range(37), q, range(150), p, 3))


def test_pairs_blocks_inside_a_task(monkeypatch):
    monkeypatch.setattr(scoring, "MATRIX_CELLS", 500)
    monkeypatch.setattr(scoring, "FIRST_POINTS", 5)
    monkeypatch.setattr(scoring, "MOST_POINTS", 23)
    monkeypatch.setattr(scoring, "EXACT_PAIRS", 16)
    rng = np.random.default_rng(6)
    for vectors in (_copies(rng, 120, 4), rng.normal(size=(120, 4))):
        ids = rng.permutation(120)
        for limit in (1, 6, 200):
            found = [(i, j, u / 1e6) for i, j, u in scoring.best_pairs(ids, vectors, limit)]
            assert found == _expected_pairs(ids, vectors, limit)


def test_topk_filter_and_wrong_dimension(spark):
    points = _table(spark, range(6), np.eye(6), "id")
    queries = _table(spark, [1], [[0, 0, 1, 1, 0, 0]], "query_id")
    found = topk_cosine(queries, points, 1, where=F.col("id") > 2, dim=6).collect()
    assert [(r.id, r.rank) for r in found] == [(3, 1)]
    with pytest.raises(Exception, match="every vector must have"):
        topk_cosine(queries, points, dim=5).collect()


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "query_rows": 16}])
def test_topk_sparse_is_exact(spark, options):
    rng = np.random.default_rng(2)
    dim = 5000

    def make(n):
        dense = np.zeros((n, dim))
        for row in dense:
            at = np.unique(np.concatenate([[7], rng.integers(0, dim, 40)]))
            row[at] = rng.integers(1, 5, len(at))
        dense[: n // 3] = dense[0]
        dense[n // 2] = 0
        return dense

    def table(ids, dense, name):
        rows = [(int(i), ([int(b) for b in np.flatnonzero(v)], [float(x) for x in v[v != 0]]))
                for i, v in zip(ids, dense)]
        return spark.createDataFrame(
            rows, f"{name} long, vector struct<buckets array<int>, weights array<double>>")

    q, p = make(30), make(120)
    found = topk_cosine_sparse(
        table(range(30), q, "query_id"), table(range(120), p, "id").repartition(4), 4, **options)
    assert sorted(map(tuple, found.collect())) == _expected_topk(range(30), q, range(120), p, 4)


def _expected_pairs(ids, vectors, limit):
    units = _units(vectors, vectors)
    rows = [(-units[a, b], *sorted((int(ids[a]), int(ids[b]))))
            for a in range(len(ids)) for b in range(a) if not np.isnan(units[a, b])]
    return [(i, j, -u / 1e6) for u, i, j in sorted(rows)[:limit]]


@pytest.mark.parametrize("block_rows", [16_384, 40, 9])
@pytest.mark.parametrize("kind", ["random", "copies", "clusters"])
def test_pairs_are_exact(spark, block_rows, kind):
    rng = np.random.default_rng(3)
    if kind == "random":
        vectors = rng.normal(size=(180, 6))
    elif kind == "copies":
        vectors = _copies(rng, 180, 6, share=0.34)
    else:
        centers = rng.normal(size=(5, 6))
        vectors = centers[rng.integers(0, 5, 180)] + rng.normal(size=(180, 6)) * 0.02
    vectors = vectors.astype(np.float32).astype(float)
    ids = rng.permutation(180)
    found = pairwise_similarity(
        _table(spark, ids, vectors, "id"), 7, dim=6, block_rows=block_rows)
    assert [tuple(r) for r in found.collect()] == _expected_pairs(ids, vectors, 7)


def test_pairs_of_few_points(spark):
    assert pairwise_similarity(_table(spark, [1], [[1, 2]], "id"), dim=2).collect() == []
    two = _table(spark, [9, 4], [[1, 0], [1, 1]], "id")
    assert [tuple(r) for r in pairwise_similarity(two, dim=2).collect()] == [(4, 9, 0.707107)]


def test_normalized_vectors_keep_the_order(spark):
    rng = np.random.default_rng(4)
    points = _table(spark, range(80), rng.normal(size=(80, 5)), "id")
    queries = _table(spark, range(9), rng.normal(size=(9, 5)), "query_id")
    plain = topk_cosine(queries, points, dim=5).select("query_id", "id", "rank").collect()
    unit = embedding.l2_normalize(points)
    scaled = topk_cosine(queries, unit, dim=5).select("query_id", "id", "rank").collect()
    assert sorted(plain) == sorted(scaled)


def test_zero_vectors(spark):
    df = _table(spark, [1, 2], [[0, 0], [3, 4]], "id")
    rows = {r.id: r.embedding for r in embedding.l2_normalize(df).collect()}
    assert rows[1] == [None, None] and rows[2] == [0.6, 0.8]
    same = df.select("id", cosine_similarity("embedding", "embedding").alias("c")).collect()
    assert {r.id: r.c for r in same} == {1: None, 2: 1.0}
    coded = {r.id: r for r in embedding.quantize_vectors(df).collect()}
    assert coded[1].codes == [0, 0] and coded[2].codes == [95, 127]


def test_mean_pool_counts_padding_unless_masked(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 2.0], 1), (1, [3.0, 4.0], 1), (1, [0.0, 0.0], 0), (1, [0.0, 0.0], 0)],
        "chunk long, embedding array<float>, real int")
    assert embedding.mean_pool(df, "chunk").first().embedding == [1.0, 1.5]
    assert embedding.mean_pool(df, "chunk", mask="real").first().embedding == [2.0, 3.0]
    row = spark.createDataFrame(
        [([[1.0, 2.0], [3.0, 4.0], [0.0, 0.0], [0.0, 0.0]], [1, 1, 0, 0])],
        "v array<array<float>>, m array<int>")
    assert row.select(mean_of_vectors("v")).first()[0] == [1.0, 1.5]
    assert row.select(mean_of_vectors("v", "m")).first()[0] == [2.0, 3.0]


def test_embedder_hook(spark):
    def lengths(frames):
        for frame in frames:
            frame["embedding"] = [[float(len(t)), 1.0] for t in frame["text"]]
            yield frame

    df = spark.createDataFrame([(1, "abc"), (2, "")], "query_id long, text string")
    rows = embedding.embed_queries(df, embedder=lengths).collect()
    assert {r.query_id: r.embedding for r in rows} == {1: [3.0, 1.0], 2: [0.0, 1.0]}
    unit = embedding.embed_queries(df, embedder=lengths, normalize=True).collect()
    assert all(abs(sum(x * x for x in r.embedding) - 1) < 1e-9 for r in unit)


def test_default_embedder(spark):
    df = spark.createDataFrame(
        [(1, "b a a"), (2, "a  b\na"), (3, " "), (4, None)], "query_id long, text string")
    rows = {r.query_id: r.embedding for r in embedding.embed_queries(df, dim=16).collect()}
    assert rows[1] == rows[2] and len(rows[1]) == 16 and any(rows[1])
    assert rows[3] == rows[4] == [0.0] * 16


def test_null_vectors_take_no_part_on_either_route(spark):
    from passages.operators.search import topk_cosine

    vector = "array<float>"
    points = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0])],
                                   f"id bigint, embedding {vector}")
    queries = spark.createDataFrame([(7, [1.0, 1.0]), (8, None)],
                                    f"query_id bigint, embedding {vector}")
    for limit in (1 << 20, 0):
        hits = topk_cosine(queries, points, 2, dim=2, broadcast_bytes=limit).collect()
        assert [(h.query_id, h.id, h.rank) for h in hits] == [(7, 1, 1)]


def test_upsert_keeps_one_row_of_a_repeated_id(spark):
    from pyspark.sql import functions as F

    from passages.operators.points import upsert_points

    kind = "id bigint, v int"
    old = spark.createDataFrame([(1, 1), (2, 2)], kind)
    new = spark.createDataFrame([(2, 5), (2, 10), (3, 3)], kind)
    stored = {(r.id, r.v) for r in upsert_points(old, new, F.col("v")).collect()}
    assert stored == {(1, 1), (2, 10), (3, 3)}
    assert upsert_points(old, new).count() == 3


def _watch_products(monkeypatch, module):
    """Sizes of the matrices that are compared with the floors."""
    sizes, found = [], module.cells_where
    monkeypatch.setattr(module, "cells_where", lambda m: sizes.append(m.size) or found(m))
    return sizes


def test_products_of_a_search_stay_in_the_cache(monkeypatch):
    sizes = _watch_products(monkeypatch, scoring)
    rng = np.random.default_rng(8)
    q, p = rng.normal(size=(3001, 8)), rng.normal(size=(3003, 8))
    best = scoring.Best(q, 2)
    for part in np.array_split(np.arange(3003), 2):
        best.add(part, p[part])
    assert sizes and max(sizes) <= 1 << 20
    rows = [(int(i), int(d), u / 1e6) for i, d, u in zip(*best.found())]
    assert sorted(rows) == sorted(r[:3] for r in _expected_topk(range(3001), q, range(3003), p, 2))


def test_only_what_reaches_a_known_score_is_found():
    rng = np.random.default_rng(9)
    q, p = rng.normal(size=(20, 6)), rng.normal(size=(900, 6))
    units = np.sort(_units(q, p), axis=1).astype(np.int64)
    least = units[:, -2].copy()
    least[3] = scoring.NO_SCORE
    best = scoring.Best(q, 5, least=least)
    best.add(np.arange(900), p)
    row, _, found = best.found()
    for i in range(20):
        assert sorted(found[row == i]) [-2:] == units[i, -2:].tolist()
    best = scoring.Best(q, 5, least=units[:, -2])
    best.add(np.arange(900), p)
    assert len(best.found()[0]) == 40


def _sparse(rng, n, whole, dim=400):
    import pyarrow as pa

    buckets = [np.sort(rng.choice(dim, rng.integers(1, 30), replace=False)) for _ in range(n)]
    buckets = [np.union1d(b, [7]) for b in buckets]
    weights = [rng.integers(1, 5, len(b)) * (1.0 if whole else 0.37) for b in buckets]
    dense = np.zeros((n, dim))
    for row, b, w in zip(dense, buckets, weights):
        row[b] = w
    table = pa.table([pa.array(np.arange(n)), pa.array([b.astype(np.int32) for b in buckets]),
                      pa.array(weights)], names=["id", "buckets", "weights"])
    return table, dense


@pytest.mark.parametrize("whole", [True, False])
def test_sparse_products_are_tiles_and_exact(monkeypatch, whole):
    from passages.operators import search

    sizes = _watch_products(monkeypatch, search)
    rng = np.random.default_rng(10)
    monkeypatch.setattr(search, "DENSE_SHARE", 20)
    (left, q), (right, p) = _sparse(rng, 2100, whole), _sparse(rng, 2300, whole)
    best = search.SparseBest(left, 3)
    for start in (0, 1000):
        best.add_sparse(right.slice(start, 1000 if not start else 1300))
    assert sizes and max(sizes) <= 1 << 20
    rows = [(int(i), int(d), u / 1e6) for i, d, u in zip(*best.found())]
    assert sorted(rows) == sorted(r[:3] for r in _expected_topk(range(2100), q, range(2300), p, 3))


SPARSE = "vector struct<buckets array<int>, weights array<double>>"


def _sparse_rows(spark, ids, table, name):
    rows = [(i, (b, w)) for i, b, w in zip(ids, *(table.column(c).to_pylist() for c in (1, 2)))]
    return spark.createDataFrame(rows, f"{name} long, {SPARSE}")


def test_sparse_turns_store_points_once_and_shuffle_none(spark):
    """Each block of queries used to take a copy of all points through a shuffle, and vice versa."""
    from pathlib import Path

    from passages.operators import search
    from passages.session import shared_dir

    rng = np.random.default_rng(11)
    # Ids that repeat, and NULL ids, in several turns; the points repeat some vectors.
    (left, q), (right, _) = _sparse(rng, 90, True), _sparse(rng, 700, True)
    ids = [None if i % 9 == 0 else i // 2 for i in range(90)]
    queries = _sparse_rows(spark, ids, left, "query_id")
    points = _sparse_rows(spark, [*range(700), *range(1000, 1200)],
                          right.take(list(range(700)) + [3] * 200), "id").repartition(6)
    wanted = topk_cosine_sparse(queries, points, 4).collect()
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    found = topk_cosine_sparse(queries, points, 4, broadcast_bytes=0, query_rows=9)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" not in plan and "Generate" not in plan
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted))
    rows = {}
    for made in set(folder.iterdir()) - before:
        rows.setdefault(made.name.split("-")[0], []).append(spark.read.parquet(str(made)).count())
    assert rows["searched"] == [900] and rows["asked"] == [90] and len(rows["best"]) > 5
    assert sum(rows["near"]) <= 4 * 90 and sum(rows["best"]) <= 4 * 90
    # No task returns what the sample rules out.
    last = search.SparseBest(left, 4, np.full(90, 900_000))
    last.add_sparse(right)
    assert (last.found()[2] >= 900_000).all()


@pytest.mark.parametrize("cells", [1, 90 * 3, 1 << 26])
def test_sparse_matrix_is_bounded(monkeypatch, cells):
    from passages.operators import search

    rng = np.random.default_rng(12)
    (left, q), (right, p) = _sparse(rng, 90, True, dim=60), _sparse(rng, 300, True, dim=60)
    monkeypatch.setattr(search, "DENSE_CELLS", cells)
    best = search.SparseBest(left, 3)
    assert best.dense.size <= max(cells, 90) and best.dense.dtype == np.float32
    best.add_sparse(right)
    rows = [(int(i), int(d), u / 1e6) for i, d, u in zip(*best.found())]
    assert sorted(rows) == sorted(r[:3] for r in _expected_topk(range(90), q, range(300), p, 3))


def test_sparse_vectors_of_nothing_take_no_part(spark):
    kind = "vector struct<buckets array<int>, weights array<double>>"
    points = spark.createDataFrame([(1, ([1, 2], [1.0, 1.0])), (2, ([], [])), (3, None), (4, ([5], [1.0]))],
                                   f"id long, {kind}")
    queries = spark.createDataFrame([(7, ([1], [2.0])), (8, ([], [])), (9, None)], f"query_id long, {kind}")
    for limit in (1 << 20, 0):
        hits = topk_cosine_sparse(queries, points, 3, broadcast_bytes=limit).collect()
        assert sorted((h.query_id, h.id, h.score) for h in hits) == [(7, 1, 0.707107), (7, 4, 0.0)]


def test_texts_and_payloads_are_joined_to_stored_hits(spark):
    """The join counts its rows; the search must not run again for each count."""
    from passages.operators import coded
    from passages.plans import rag

    docs = spark.createDataFrame([(i, f"w{i} w{i % 3} a b") for i in range(9)], "doc_id long, text string")
    asked = embedding.embed_queries(docs.withColumnRenamed("doc_id", "query_id"))
    points = coded.code_points(rag.document_vectors(docs)).withColumn("payload", F.lit("p"))
    hits = topk_cosine(asked, points, 2)
    wanted = sorted(map(tuple, hits.collect()))
    for joined in (rag.hit_texts(hits, docs, 18, broadcast_bytes=0),
                   coded.topk_coded(asked, points, 2, broadcast_bytes=0, keep=("payload",))):
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        searched = [line for line in plan.splitlines() if "FlatMapCoGroupsInArrow" in line]
        assert not searched and "MapInArrow run" not in plan
        assert sorted(map(tuple, joined.select(*hits.columns).collect())) == wanted
