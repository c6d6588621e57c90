"""Links between similar vectors against brute force, with hot buckets and hot vectors."""

import numpy as np
import pytest

from passages.operators.neighbours import meeting_chance, similar_pairs_approx, table_count

DIM = 12


def brute(vectors, threshold):
    classes = {}
    for i, v in vectors:
        classes[tuple(v)] = min(i, classes.get(tuple(v), i))
    distinct = list(classes)
    m = np.array(distinct)
    norms = np.sqrt((m**2).sum(1))
    norms[norms == 0] = np.inf
    links = (np.round(m @ m.T / np.outer(norms, norms), 6) >= threshold).sum(1)
    links = dict(zip(distinct, links - (norms < np.inf)))
    return sorted((i, classes[tuple(v)], int(links[tuple(v)])) for i, v in vectors)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    near = rng.normal(size=DIM) + 0.05 * rng.normal(size=(120, DIM))  # one hot bucket
    far = rng.normal(size=(300, DIM))
    pairs = far[:80] + 0.2 * rng.normal(size=(80, DIM))
    rows = np.concatenate([near, far, pairs]).astype(np.float32).tolist()
    rows += [rows[150]] * 200 + [[0.0] * DIM] * 3  # a third of all rows: one vector
    order = rng.permutation(len(rows))
    return [(int(i), rows[n]) for i, n in enumerate(order)]


def answer(spark, vectors, *args, **settings):
    df = spark.createDataFrame(vectors, "id bigint, embedding array<float>")
    return sorted(map(tuple, similar_pairs_approx(df, *args, dim=DIM, **settings).collect()))


def test_one_bucket_is_exact_in_any_blocks(spark, vectors):
    expected = brute(vectors, 0.9)
    assert max(links for _, _, links in expected) > 100
    assert answer(spark, vectors, 0.9) == expected
    assert answer(spark, vectors, 0.9, block_rows=37) == expected


def test_buckets_find_the_stated_share_and_nothing_false(spark, vectors):
    found = answer(spark, vectors, 0.9, bucket_rows=16, block_rows=50)
    expected = brute(vectors, 0.9)
    assert [r[:2] for r in found] == [r[:2] for r in expected]
    assert all(a[2] <= b[2] for a, b in zip(found, expected))
    classes = {b[1]: (a[2], b[2]) for a, b in zip(found, expected)}
    recall = sum(a for a, _ in classes.values()) / sum(b for _, b in classes.values())
    assert 0.95 <= recall <= 1


def test_tables_reach_the_recall():
    for bits in (0, 1, 6, 18):
        chance = meeting_chance(0.8, bits)
        tables = table_count(0.8, bits, 0.95)
        assert 1 - (1 - chance) ** tables >= 0.95 - 1e-12
        assert tables == 1 or 1 - (1 - chance) ** (tables - 1) < 0.95


def test_no_rows_nulls_and_settings(spark):
    rows = [(None, [1.0] * DIM), (1, None), (2, [1.0] * DIM), (2, [1.0] * DIM)]
    assert answer(spark, rows) == [(2, 2, 0), (2, 2, 0)]
    assert answer(spark, rows[:2]) == []
    with pytest.raises(ValueError):
        answer(spark, rows, 0.0)
