from collections import Counter

import pytest
from pyspark.sql import functions as F

from passages.functions.text import cut_at_eos, fit_context, strip_prompt
from passages.operators import tokens
from passages.operators.joins import hot_keys, join_lookup

TEXTS = ["b a a　c", "", None, "a d e a", "zz a"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


@pytest.fixture(scope="module")
def vocab(docs):
    return tokens.build_vocab(docs, size=4).cache()


def test_vocab(vocab):
    assert sorted(map(tuple, vocab.collect())) == sorted(
        [("[PAD]", 0), ("[UNK]", 100), ("[CLS]", 101), ("[SEP]", 102),
         ("a", 1000), ("b", 1001), ("c", 1002), ("d", 1003)])


def test_whole_vocabulary_loses_no_word(spark):
    # More words than 30,000, most of equal count, and one that is a reserved token.
    texts = [" ".join(f"w{i}" for i in range(d * 7000, d * 7000 + 8000)) for d in range(5)]
    df = spark.createDataFrame(list(enumerate([*texts, "[PAD] x x"])), "doc_id long, text string")
    counts = Counter(w for t in [*texts, "[PAD] x x"] for w in t.split())
    ranks = sorted(counts, key=lambda w: (-counts[w], w))
    vocab = tokens.build_vocab(df)
    assert {r.token: r.id for r in vocab.collect()} == {
        **{w: 1000 + i for i, w in enumerate(ranks)}, **tokens.SPECIAL_TOKENS}
    back = tokens.decode_corpus(tokens.encode_corpus(df, vocab), vocab)
    assert {r.doc_id: r.text for r in back.collect()} == dict(enumerate([*texts, "x x"]))


@pytest.mark.parametrize("rows", [tokens.BROADCAST_ROWS, 2])
def test_encode_and_decode(docs, vocab, rows):
    coded = tokens.encode_corpus(docs, vocab, broadcast_rows=rows)
    ids = {r.doc_id: r.ids for r in coded.collect()}
    assert ids == {
        0: [101, 1001, 1000, 1000, 1002, 102], 1: [101, 102], 2: None,
        3: [101, 1000, 1003, 100, 1000, 102], 4: [101, 100, 1000, 102]}
    back = tokens.decode_corpus(coded, vocab, broadcast_rows=rows)
    assert {r.doc_id: r.text for r in back.collect()} == {
        0: "b a a c", 1: "", 2: None, 3: "a d a", 4: "a"}
    listed = tokens.token_listing(coded, vocab, broadcast_rows=rows).where("doc_id = 4")
    assert sorted(map(tuple, listed.collect())) == [
        (4, 0, 101, "[CLS]"), (4, 1, 100, "[UNK]"), (4, 2, 1000, "a"), (4, 3, 102, "[SEP]")]


def test_shuffled_lookup_equals_shipped_lookup_with_a_hot_word(spark):
    # "the" is a third of all words, and one document holds a third of the rows.
    texts = ["the " * 3000 + "x y"] + [f"the w{i} v{i % 50}" for i in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    vocab = tokens.build_vocab(df).cache()
    shipped = tokens.encode_corpus(df, vocab)
    joined = tokens.encode_corpus(df, vocab, broadcast_rows=1)
    assert sorted(map(tuple, shipped.collect())) == sorted(map(tuple, joined.collect()))


def test_join_lookup_spreads_hot_keys(spark):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") < 1000, 7).when(F.col("id") < 1100, None)
        .otherwise(F.col("id")).cast("long").alias("k"))
    assert hot_keys(df, "k") == [7]
    lookup = spark.range(0, 2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner"):
        ours = join_lookup(df, lookup, "k", ["id"], how).select("id", "k", "v")
        plain = df.join(lookup, "k", how).select("id", "k", "v")
        assert Counter(map(tuple, ours.collect())) == Counter(map(tuple, plain.collect()))


def test_pad_batch(spark):
    df = spark.createDataFrame(
        [(1, 1, [5]), (1, 2, [5, 6, 7]), (2, 3, []), (2, 4, [])],
        "batch long, id long, ids array<int>")
    rows = {r.id: r.ids for r in tokens.pad_batch(df, "batch", "id").collect()}
    assert rows == {1: [5, 0, 0], 2: [5, 6, 7], 3: [], 4: []}


def _one(spark, values, column):
    df = spark.createDataFrame([(values,)], "t array<int>")
    return df.select(column).first()[0]


def test_cuts(spark):
    ids = list(range(1, 31))
    # 40 - 10 - (6 - 1) = 25 tokens fit; 5 are too many.
    assert _one(spark, ids, fit_context("t", 40, 6)) == ids[5:]
    assert _one(spark, ids, fit_context("t", 40, 6, as_written=True)) == ids[25:]
    assert _one(spark, ids[:25], fit_context("t", 40, 6)) == ids[:25]
    assert _one(spark, ids[:25], fit_context("t", 40, 6, as_written=True)) == ids[:25]
    assert _one(spark, ids, fit_context("t", 5, 6)) == []
    assert _one(spark, ids, fit_context("t", 5, 6, as_written=True)) == ids
    assert _one(spark, ids, strip_prompt("t", F.array(*map(F.lit, [1, 2])))) == ids[2:]
    assert _one(spark, [1], strip_prompt("t", F.array(*map(F.lit, [1, 2])))) == []

    def cut(values, **options):
        return _one(spark, values, cut_at_eos("t", F.lit(9), 4, **options))

    assert cut([1, 9, 2, 9]) == [1, 9]
    assert cut([1, 2, 3, 4, 9]) == [1, 2, 3, 4]
    assert cut([1]) == [1] and cut([]) == []
    assert cut([9, 1, 9, 2]) == [9]
    assert cut([9, 1, 9, 2], skip_first=True) == [9, 1, 9]
    assert cut([9, 1], skip_first=True) == [9, 1]


def test_dictionaries_keep_nulls_columns_and_groups(spark):
    rows = [(i, f"n{i}", [f"w{j % 7}" if j % 5 else None for j in range(i % 9)] if i % 4 else None)
            for i in range(60)]
    df = spark.createDataFrame(rows, "id long, name string, t array<string>").repartition(3)
    lookup = spark.createDataFrame([(f"w{j}", j) for j in range(5)], "token string, id int")
    expected = {i: (n, None if t is None else [
        int(w[1]) if w and w != "w5" and w != "w6" else None for w in t]) for i, n, t in rows}
    for values in (1, 10, 1000):
        found = tokens.translate(df, "t", lookup, "token", "id", broadcast_rows=1, group_values=values)
        assert found.columns == df.columns
        assert {r.id: (r.name, r.t) for r in found.collect()} == expected
    nothing = tokens.translate(df.limit(0), "t", lookup, "token", "id", broadcast_rows=1)
    assert nothing.count() == 0


def test_long_words_are_not_shipped(spark, monkeypatch):
    monkeypatch.setattr(tokens, "BROADCAST_BYTES", 1000)
    df = spark.createDataFrame([(1, "a " + "x" * 5000 + " a")], "doc_id long, text string")
    vocab = tokens.build_vocab(df)
    coded = tokens.encode_corpus(df, vocab)
    assert "Cogroup" in coded._jdf.queryExecution().toString() or "CoGroup" in (
        coded._jdf.queryExecution().toString())
    assert coded.first().ids == [101, 1000, 1001, 1000, 102]


def test_rows_in_buckets_are_not_shuffled_to_their_dictionaries(spark):
    df = spark.createDataFrame([(i, f"a b{i}") for i in range(50)], "doc_id long, text string")
    coded = tokens.encode_corpus(df, tokens.build_vocab(df), broadcast_rows=1)
    plan = coded._jdf.queryExecution().executedPlan().toString()
    bucketed = [line for line in plan.splitlines() if "_codes" in line and "Exchange" in line]
    assert "Bucketed: true" in plan and not bucketed


def test_a_worker_holds_a_group_of_bounded_size():
    import pyarrow as pa

    batch = pa.record_batch([pa.array([list(range(1000))] * 500)], names=["t"])
    sizes = [g.column(0).combine_chunks().flatten() for g in tokens._groups([batch] * 4, 0, tokens.GROUP_VALUES)]
    assert sum(map(len, sizes)) == 2_000_000 and max(map(len, sizes)) <= 600_000
