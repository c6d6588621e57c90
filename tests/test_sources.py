import pytest
from pyspark.sql import functions as F

from passages.plans import rag
from passages.session import scratch_path, shared_dir, spread
from passages.sources import collections, documents, exchange
from passages.operators import prompts
from passages.operators.chunking import word_chunks
from passages.operators.embedding import embed_chunks
from passages.operators.points import make_points


def _points(spark, *rows):
    return spark.createDataFrame(
        rows, "id long, embedding array<float>, payload map<string,string>")


def test_text_files(spark, tmp_path):
    (tmp_path / "a.b.txt").write_bytes("x\r\n\r\n \né".encode())
    (tmp_path / "plain").write_bytes(b"\n")
    rows = documents.read_text_files(spark, str(tmp_path)).collect()
    assert {(r.source, r.text) for r in rows} == {("a.b", "x\n \né"), ("plain", "")}
    assert len({r.doc_id for r in rows}) == 2 and all(0 <= r.doc_id < 1 << 43 for r in rows)
    hits = rag.document_vectors(documents.read_text_files(spark, str(tmp_path)))
    assert hits.count() == 1


def test_collection_life(spark):
    root = scratch_path(spark, "collections")
    assert collections.list_collections(spark, root).collect() == []
    with pytest.raises(ValueError):
        collections.read_collection(spark, root, "demo")
    first = _points(spark, (1, [1.0, 0.0], {"txt_chunk": "a"}), (2, [0.0, 1.0], None))
    old = collections.recreate_collection(spark, root, "demo", first, 2)
    new = _points(spark, (2, [1.0, 1.0], {"txt_chunk": "b"}), (3, [2.0, 1.0], {}))
    for _ in range(2):
        stored = collections.upsert_collection(spark, root, "demo", new, 2)
        assert sorted((r.id, r.embedding) for r in stored.collect()) == [
            (1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [2.0, 1.0])]
    # The version read before is still whole.
    assert sorted(r.id for r in old.collect()) == [1, 2]
    fresh = collections.recreate_collection(spark, root, "demo", new, 2)
    assert sorted(r.id for r in fresh.collect()) == [2, 3]
    collections.recreate_collection(spark, root, "other", new, 2)
    names = [r.name for r in collections.list_collections(spark, root).collect()]
    assert names == ["demo", "other"]


@pytest.mark.parametrize("row", [(1, [1.0], {}), (1, None, {}), (None, [1.0, 2.0], {})])
def test_collection_rejects_bad_points(spark, row):
    root = scratch_path(spark, "collections")
    with pytest.raises(Exception, match="a point needs"):
        collections.recreate_collection(spark, root, "demo", _points(spark, row), 2)
    assert collections.list_collections(spark, root).collect() == []


def test_requests_responses_and_history(spark):
    path = scratch_path(spark, "exchange")
    asked = spark.createDataFrame([("q\n1",), ("q2",)], "text string")
    bodies = asked.select(
        prompts.chat_request(F.array(prompts.message("user", "text"))).alias("body"))
    exchange.write_requests(bodies, f"{path}/requests")
    assert spark.read.text(f"{path}/requests").count() == 2
    answers = spark.createDataFrame(
        [('{"choices":[{"message":{"content":"a\\nb"}}]}',), ("oops",)], "body string")
    exchange.write_requests(answers, f"{path}/responses")
    found = prompts.chat_response(exchange.read_responses(spark, f"{path}/responses")).collect()
    assert {(r.content, r.bad_json) for r in found} == {("a\nb", None), (None, "oops")}
    for _ in range(2):
        exchange.append_history(bodies.withColumn("response", F.lit("r")), f"{path}/history")
    history = exchange.read_history(spark, f"{path}/history", "body string, response string")
    assert history.count() == 4


def test_shared_dir_follows_the_session(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_spread_leaves_many_files_alone(spark):
    path = scratch_path(spark, "many")
    spark.range(100).repartition(9).write.parquet(path)
    df = spark.read.parquet(path)
    assert spread(df, "id") is df
    one = spark.range(100).coalesce(1)
    one.write.parquet(path + "-one")
    single = spread(spark.read.parquet(path + "-one"), "id")
    assert single.rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism


def test_hit_texts_both_ways(spark):
    text = " ".join(f"w{i}" for i in range(700))
    docs = spark.createDataFrame([(d, f"d{d} {text}") for d in range(4)], "doc_id long, text string")
    asked = spark.createDataFrame(
        [(q, f"d{q % 2} w5 w6 w{q}") for q in range(40)] + [(99, " ")],
        "query_id long, text string")
    few = rag.rag_prompts(docs, asked)
    many = rag.rag_prompts(docs, asked, broadcast_bytes=0)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    rows = {r.query_id: r.context for r in few.collect()}
    assert len(rows) == 41 and rows[99] == "" and rows[0].count("\n") == 2
    stored = rag.document_vectors(docs)
    again = rag.rag_prompts(docs, asked, points=stored)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, again.collect()))


def test_stored_points_of_another_cut_give_their_own_texts(spark):
    docs = spark.createDataFrame(
        [(d, " ".join(f"d{d}w{i}" for i in range(700)), "s") for d in range(3)],
        "doc_id long, text string, source string")
    cut = word_chunks(docs, chunk_size=100, overlap=10, keep=("source",))
    stored = make_points(embed_chunks(cut))
    chunks = cut.collect()
    asked = spark.createDataFrame([(i, r.text) for i, r in enumerate(chunks)],
                                  "query_id long, text string")
    for limit in (rag.BROADCAST_BYTES, 0):
        found = rag.rag_prompts(docs, asked, k=1, points=stored, broadcast_bytes=limit)
        assert {r.query_id: r.context for r in found.collect()} == {
            i: r.text for i, r in enumerate(chunks)}
        bare = rag.rag_prompts(docs, asked, k=1, points=stored.drop("payload"),
                               broadcast_bytes=limit, chunk_size=100, overlap=10)
        assert sorted(map(tuple, bare.collect())) == sorted(map(tuple, found.collect()))


def _files(path):
    import os

    return {os.path.join(folder, f) for folder, _, names in os.walk(path.removeprefix("file:"))
            for f in names if f.endswith(".parquet")}


def test_upsert_of_one_point_writes_one_bucket(spark):
    root = scratch_path(spark, "collections")
    points = _points(spark, *[(i, [float(i), 1.0], {"txt_chunk": str(i)}) for i in range(300)])
    collections.recreate_collection(spark, root, "demo", points, 2, buckets=8)
    before = _files(root)
    assert len(before) == 8
    stored = collections.upsert_collection(
        spark, root, "demo", _points(spark, (5, [0.0, 9.0], None)))
    assert len(_files(root) - before) == 1
    rows = {r.id: r.embedding for r in stored.collect()}
    assert len(rows) == 300 and rows[5] == [0.0, 9.0] and rows[6] == [6.0, 1.0]
    assert collections.upsert_collection(spark, root, "demo", points.limit(0)).count() == 300
    again = collections.compact_collection(spark, root, "demo")
    assert {r.id: r.embedding for r in again.collect()} == rows
    folders = {r[0].rsplit("/", 2)[0] for r in again.select(F.input_file_name()).distinct().collect()}
    assert len(folders) == 1


def test_settings_belong_to_the_collection(spark):
    root = scratch_path(spark, "collections")
    points = _points(spark, (1, [1.0, 0.0], {}))
    with pytest.raises(ValueError, match="distance"):
        collections.recreate_collection(spark, root, "demo", points, 2, distance="dot")
    collections.recreate_collection(spark, root, "demo", points, 2, buckets=4)
    assert collections.collection_settings(spark, root, "demo") == {
        "dim": 2, "distance": "cosine", "buckets": 4, "partition_by": [], "coded": False}
    with pytest.raises(ValueError, match="2 entries"):
        collections.upsert_collection(spark, root, "demo", points, 3)
    with pytest.raises(Exception, match="a point needs"):
        collections.upsert_collection(spark, root, "demo", _points(spark, (2, [1.0], {})))
    assert [r.id for r in collections.read_collection(spark, root, "demo").collect()] == [1]
    empty = collections.recreate_collection(spark, root, "demo", points.limit(0), 2)
    assert empty.columns == points.columns and empty.count() == 0


def test_points_move_between_payload_folders(spark):
    root = scratch_path(spark, "collections")
    kind = "id long, embedding array<float>, payload map<string,string>, lang string"
    points = spark.createDataFrame(
        [(i, [1.0, float(i)], {"txt_chunk": f"t{i}"}, "en" if i % 3 else None) for i in range(60)], kind)
    collections.recreate_collection(
        spark, root, "demo", points, 2, buckets=4, partition_by=("lang",), coded=True)
    moved = spark.createDataFrame([(i, [2.0, float(i)], {}, "de/x") for i in range(60)], kind)
    stored = collections.upsert_collection(spark, root, "demo", moved)
    assert {(r.id, r.lang, tuple(r.embedding)) for r in stored.collect()} == {
        (i, "de/x", (2.0, float(i))) for i in range(60)}


def test_search_reads_only_the_folders_of_its_filter(spark):
    root = scratch_path(spark, "collections")
    texts = [(i, "en" if i % 2 else "de", f"w{i} w{i % 7} common") for i in range(80)]
    chunks = spark.createDataFrame(texts, "id long, lang string, text string")
    points = embed_chunks(chunks).select("id", "embedding", "lang", F.create_map(
        F.lit("txt_chunk"), F.col("text"), F.lit("source"), F.col("lang")).alias("payload"))
    asked = chunks.where("id < 20").select(F.col("id").alias("query_id"), "text")
    answers = []
    for coded in (True, False):
        stored = collections.recreate_collection(
            spark, root, "demo", points, 64, buckets=4, partition_by=("lang",), coded=coded)
        plan = stored.where("lang = 'en'").select("id")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(lang" in plan
        read = stored.where("lang = 'en'").select(F.input_file_name()).distinct().collect()
        assert read and all("/lang=en/" in r[0] for r in read)
        hits = rag.search_collection(
            spark, root, "demo", asked, k=2, where=F.col("lang") == "en").collect()
        assert all(r.payload["source"] == "en" for r in hits)
        answers.append(sorted((r.query_id, r.id, r.score, r["rank"], r.payload["txt_chunk"]) for r in hits))
    far = rag.search_collection(spark, root, "demo", asked, k=2, where=F.col("lang") == "en",
                                broadcast_bytes=0).collect()
    answers.append(sorted((r.query_id, r.id, r.score, r["rank"], r.payload["txt_chunk"]) for r in far))
    assert answers[0] == answers[1] == answers[2] and len(answers[0]) == 40
