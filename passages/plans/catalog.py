"""Queries over the given tables, one per operator; ``oracles.py`` holds their SQL."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passages.functions import text as tx
from passages.functions import vectors as vec
from passages.operators import (
    assembly, chat, chunking, coded, embedding, metrics, neighbours, pairs, points, prompts, search,
    tokens,
)
from passages.operators.joins import join_lookup
from passages.plans import chats, rag, ranking, windows
from passages.session import ROW_GROUP_BYTES, scratch_path, spread
from passages.sources import collections, documents, exchange
from passages.streaming import assemble, ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# ---- inputs -------------------------------------------------------------------


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return documents.read_documents(spark, f"{sf}/documents.parquet")


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.word_chunks(_documents(spark, sf))


def _turns(spark: SparkSession, sf: str, *roles: str) -> DataFrame:
    turns = spread(_table(spark, sf, "conversations"), "conv_id", "turn")
    return turns.where(F.col("role").isin(*roles)) if roles else turns


def _questions(spark: SparkSession, sf: str) -> DataFrame:
    turns = _turns(spark, sf, "user")
    return turns.select(points.point_id("conv_id", "turn").alias("query_id"), "text")


def _keyed_turns(spark: SparkSession, sf: str, *roles: str) -> DataFrame:
    turns = _turns(spark, sf, *roles)
    return turns.withColumn("seq_id", points.point_id("conv_id", "turn"))


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return spread(_table(spark, sf, "embeddings"), "vec_id")


MODELS = ("7b-open-chat-3.5", "7b-zephyr-b", "mixtral", "7b-chat")


def _with_model(df: DataFrame, names: tuple[str, ...] = MODELS) -> DataFrame:
    """Give each conversation a model, one of every prompt family."""
    models = F.array(*map(F.lit, names))
    return df.withColumn("model", F.element_at(models, (F.col("conv_id") % len(names) + 1).cast("int")))


def _joined(array: Column | str) -> Column:
    """Numbers of an array as text, so that results compare by value."""
    array = F.col(array) if isinstance(array, str) else array
    return F.array_join(array.cast("array<string>"), " ")


def _whole(vector: Column | str) -> Column:
    return _joined(F.transform(vector, lambda x: x.cast("int")))


def _long(name: str) -> Column:
    return F.col(name).cast("long").alias(name)


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a table that a query reads more than once."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


# ---- sources and sinks --------------------------------------------------------


@query
def read_documents(spark, sf):
    return _documents(spark, sf).select("doc_id", "text", "source")


@query
def source_name(spark, sf):
    path = F.regexp_replace("url", r"\?.*", "")
    return _table(spark, sf, "pages").select("page_id", tx.source_name(path).alias("source"))


@query
def recreate_collection(spark, sf):
    root = scratch_path(spark, "collections")
    stored = _vectors(spark, sf).select(
        F.col("vec_id").alias("id"), "embedding",
        points.wrap_payload(F.col("label").cast("string"), F.lit("embeddings")).alias("payload"),
    )
    collections.recreate_collection(spark, root, "demo", stored, 64)
    again = collections.recreate_collection(spark, root, "demo", stored, 64)
    return again.select("id", points.payload_text("payload").alias("txt_chunk"))


@query
def list_collections(spark, sf):
    root = scratch_path(spark, "collections")
    turns = _keyed_turns(spark, sf).select(F.col("seq_id").alias("id"), "role", "text")
    for role in ("assistant", "system", "user"):
        stored = embedding.embed(turns.where(F.col("role") == role)).select(
            "id", "embedding", points.wrap_payload("text", "role").alias("payload")
        )
        collections.recreate_collection(spark, root, role, stored, 64)
    return collections.list_collections(spark, root)


@query
def upsert_points(spark, sf):
    vectors = _vectors(spark, sf)
    old = vectors.select(
        F.col("vec_id").alias("id"), "embedding", F.lit("old").alias("state")
    )
    # Every other vector comes again under its id, and once more under a new id.
    again = vectors.where(F.col("label") > 4).select(
        F.explode(F.array(F.col("vec_id"), F.col("vec_id") + 1_000_000_000)).alias("id"),
        "embedding", F.lit("new").alias("state"),
    )
    return points.upsert_points(old, again).select("id", "state")


@query
def make_points(spark, sf):
    docs = _documents(spark, sf)
    chunks = chunking.word_chunks(docs, keep=("source",))
    made = points.make_points(embedding.embed_chunks(chunks))
    return made.select(
        "id", _whole("embedding").alias("embedding"),
        points.payload_text("payload").alias("txt_chunk"),
        F.try_element_at("payload", F.lit("source")).alias("source"),
    )


@query
def append_history(spark, sf):
    path = scratch_path(spark, "history")
    turns = _turns(spark, sf)
    for role in ("system", "user", "assistant"):
        exchange.append_history(turns.where(F.col("role") == role), path)
    schema = "conv_id bigint, turn bigint, role string, text string"
    return exchange.read_history(spark, path, schema)


def _response(text: Column) -> Column:
    choice = F.struct(F.struct(F.lit("assistant").alias("role"), text.alias("content")).alias("message"))
    return F.to_json(F.struct(F.array(choice).alias("choices")))


@query
def write_requests(spark, sf):
    path = scratch_path(spark, "requests")
    questions = _questions(spark, sf).select(
        prompts.chat_request(F.array(prompts.message("user", "text"))).alias("body")
    )
    exchange.write_requests(questions, path)
    return spark.read.text(path).select(F.col("value").alias("body"))


@query
def read_responses(spark, sf):
    path = scratch_path(spark, "responses")
    answers = _turns(spark, sf, "assistant").select(_response(F.col("text")).alias("body"))
    exchange.write_requests(answers, path)
    return prompts.chat_response(exchange.read_responses(spark, path)).select("content")


# ---- filters and projections --------------------------------------------------


@query
def drop_empty_lines(spark, sf):
    # A blank line after each sentence, half of them with a carriage return.
    spaced = F.regexp_replace(F.regexp_replace("text", r"\. ", ".\r\n\r\n"), r"\? ", "?\n\n")
    return _documents(spark, sf).select("doc_id", tx.drop_empty_lines(spaced).alias("text"))


@query
def project_hits(spark, sf):
    events = _table(spark, sf, "events")
    number = F.col("event_id").cast("string")
    hits = events.select(
        F.when(F.col("event_type") == "error", F.concat(F.lit("uuid-"), number))
        .when(F.col("event_type") != "view", number)
        .alias("raw_id"),
        F.col("value").alias("score"),
        F.col("props").alias("payload"),
    )
    return points.project_hits(hits)


@query
def wrap_payload(spark, sf):
    texts = _table(spark, sf, "benchmark").select(
        F.lit("benchmark").alias("source"), F.col("item_id").alias("id"), F.col("text").alias("raw")
    )
    objects = _table(spark, sf, "events").select(
        F.lit("events").alias("source"), F.col("event_id").alias("id"), F.col("props").alias("raw")
    )
    wrapped = texts.unionByName(objects).select(
        F.col("source").alias("origin"), "id",
        points.wrap_payload("raw", "source", parse_json=True).alias("p"),
    )
    return wrapped.select(
        "origin", "id", points.payload_text("p").alias("txt_chunk"),
        F.try_element_at("p", F.lit("source")).alias("source"),
        F.try_element_at("p", F.lit("k")).alias("k"),
    )


@query
def payload_text(spark, sf):
    payload = F.when(F.col("role") == "system", F.create_map(F.lit("note"), F.col("text"))).otherwise(
        points.wrap_payload("text", "role")
    )
    hits = _turns(spark, sf).select("conv_id", "turn", points.payload_text(payload).alias("text"))
    return hits.where(F.col("text").isNotNull())


@query
def search_where(spark, sf):
    asked = embedding.embed_queries(_questions(spark, sf))
    chunks = chunking.word_chunks(_documents(spark, sf), keep=("lang",))
    stored = embedding.embed_chunks(chunks).select(points.point_id().alias("id"), "embedding", "lang")
    return _hits(search.topk_cosine(asked, stored, where=F.col("lang") == "en"))


# ---- chunking -----------------------------------------------------------------


@query
def word_chunks(spark, sf):
    return _chunks(spark, sf).select("doc_id", _long("chunk_no"), "text")


@query
def char_window_chunks(spark, sf):
    lines = _documents(spark, sf).select("doc_id", tx.drop_empty_lines("text").alias("text"))
    return chunking.char_window_chunks(lines).select(
        "doc_id", _long("chunk_no"), "text"
    )


@query
def token_window_chunks(spark, sf):
    docs = _documents(spark, sf)
    ids = tokens.encode_corpus(docs, tokens.build_vocab(docs), special=False)
    return chunking.token_window_chunks(ids).select(
        "doc_id", _long("chunk_no"), _joined("ids").alias("ids"), _joined("mask").alias("mask")
    )


@query
def pad_batch(spark, sf):
    turns = _keyed_turns(spark, sf)
    ids = tokens.encode_corpus(turns, tokens.build_vocab(turns), key="seq_id")
    batch = ids.withColumn("conv_id", points.point_doc("seq_id"))
    return tokens.pad_batch(batch, "conv_id", "seq_id").select(
        "conv_id", "seq_id", _joined("ids").alias("ids")
    )


# ---- tokens -------------------------------------------------------------------


@query
def build_vocab(spark, sf):
    return tokens.build_vocab(_documents(spark, sf)).select("token", _long("id"))


@query
def encode_corpus(spark, sf):
    docs = _documents(spark, sf)
    ids = tokens.encode_corpus(docs, tokens.build_vocab(docs))
    return ids.select("doc_id", _joined("ids").alias("ids"))


@query
def decode_corpus(spark, sf):
    docs = _documents(spark, sf)
    vocab = _stored(spark, tokens.build_vocab(docs), "vocab")
    return tokens.decode_corpus(tokens.encode_corpus(docs, vocab), vocab)


@query
def whole_vocab(spark, sf):
    # All words of the documents: no id is [UNK] and every word comes back.
    docs = _documents(spark, sf)
    vocab = tokens.build_vocab(docs)
    back = tokens.decode_corpus(tokens.encode_corpus(docs, vocab), vocab, keep=("ids",))
    return back.select("doc_id", _joined("ids").alias("ids"), "text")


@query
def token_listing(spark, sf):
    turns = _keyed_turns(spark, sf).withColumn("text", F.replace("text", F.lit("\n"), F.lit(" <0x0A> ▁")))
    vocab = _stored(spark, tokens.build_vocab(turns), "vocab")
    ids = tokens.encode_corpus(turns, vocab, key="seq_id")
    return tokens.token_listing(ids, vocab, key="seq_id").select(
        "seq_id", _long("pos"), _long("id"), "token"
    )


def _answered(spark, sf) -> DataFrame:
    """User turns with the words of the prompt and of prompt plus answer."""
    asked = _turns(spark, sf, "user").select("conv_id", "turn", tx.words("text").alias("prompt"))
    answers = _turns(spark, sf, "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), tx.words("text").alias("answer")
    )
    pairs_ = asked.join(answers, ["conv_id", "turn"])
    return pairs_.select("conv_id", "turn", "prompt", F.concat("prompt", "answer").alias("output"))


@query
def strip_prompt(spark, sf):
    cut = tx.strip_prompt("output", "prompt")
    return _answered(spark, sf).select("conv_id", "turn", F.array_join(cut, " ").alias("answer"))


@query
def fit_context(spark, sf):
    split = _documents(spark, sf).select("doc_id", tx.words("text").alias("words"))
    budget = tx.fit_context("words", 512, 101)
    written = tx.fit_context("words", 512, 101, as_written=True)
    return split.select(
        "doc_id", F.array_join(budget, " ").alias("budget"),
        F.array_join(written, " ").alias("as_written"),
    )


@query
def cut_at_eos(spark, sf):
    turns = _with_model(_turns(spark, sf, "assistant"), (*MODELS, "2b-it"))
    family = chat.prompt_family("model")
    ended = F.replace("text", F.lit("."), F.concat(F.lit(" "), chat.eos_token(family)))
    split = turns.select(
        "conv_id", "turn", chat.eos_token(family).alias("eos"), tx.words(ended).alias("tokens")
    )
    return split.select(
        "conv_id", "turn",
        F.array_join(tx.cut_at_eos("tokens", F.col("eos"), 12), " ").alias("text"),
    )


# ---- vectors and search -------------------------------------------------------


@query
def embed_chunks(spark, sf):
    vectors = embedding.embed_chunks(_chunks(spark, sf))
    return vectors.select("doc_id", _long("chunk_no"), _whole("embedding").alias("embedding"))


@query
def embed_with_model(spark, sf):
    """Vectors of a plugged-in model: counts of the letters a to z by a fixed matrix."""
    matrix = np.zeros((256, 16))
    letters = np.arange(26)[:, None]
    matrix[97:123] = (letters * 7 + np.arange(16) * 13) % 11 - 5
    model = embedding.projection_embedder(matrix, spark)
    vectors = embedding.embed_chunks(_chunks(spark, sf), 16, embedder=model)
    return vectors.select("doc_id", _long("chunk_no"), _whole("embedding").alias("embedding"))


@query
def window_vectors(spark, sf):
    docs = _documents(spark, sf)
    vocab = _stored(spark, tokens.build_vocab(docs), "vocab")
    vectors = windows.window_vectors(docs, vocab)
    return vectors.select("doc_id", _long("chunk_no"), _whole("embedding").alias("embedding"))


@query
def embed_queries(spark, sf):
    vectors = embedding.embed_queries(_questions(spark, sf))
    return vectors.select("query_id", _whole("embedding").alias("embedding"))


@query
def mean_pool(spark, sf):
    pooled = embedding.mean_pool(_vectors(spark, sf), "label")
    rows = pooled.select(_long("label"), F.posexplode("embedding").alias("dim", "value"))
    return rows.select("label", _long("dim"), F.round("value", 6).alias("value"))


@query
def l2_normalize(spark, sf):
    vectors = embedding.embed_chunks(_chunks(spark, sf))
    unit = embedding.l2_normalize(vectors)
    rows = unit.select("doc_id", _long("chunk_no"), F.posexplode("embedding").alias("dim", "value"))
    return rows.select("doc_id", "chunk_no", _long("dim"), F.round("value", 6).alias("value"))


@query
def cosine_similarity(spark, sf):
    """Similarity of each vector to the mean of its label."""
    vectors = _vectors(spark, sf)
    means = embedding.mean_pool(vectors, "label").withColumnRenamed("embedding", "mean")
    both = join_lookup(vectors, means, "label", ["vec_id"], how="inner")
    score = vec.cosine_similarity("embedding", "mean")
    return both.select("vec_id", F.round(score, 6).alias("score"))


def _hits(hits: DataFrame) -> DataFrame:
    return hits.select("query_id", "id", "score", _long("rank"))


@query
def topk_cosine(spark, sf):
    asked = embedding.embed_queries(_questions(spark, sf))
    return _hits(search.topk_cosine(asked, rag.document_vectors(_documents(spark, sf))))


@query
def topk_coded(spark, sf):
    # The stored vectors with their codes: the first pass reads codes only.
    stored = _stored(spark, coded.code_points(rag.document_vectors(_documents(spark, sf))), "coded")
    return _hits(coded.topk_coded(embedding.embed_queries(_questions(spark, sf)), stored))


@query
def search_collection(spark, sf):
    root = scratch_path(spark, "collections")
    chunks = chunking.word_chunks(_documents(spark, sf), keep=("lang", "source"))
    stored = embedding.embed_chunks(chunks).select(
        points.point_id().alias("id"), "embedding", "lang",
        points.wrap_payload("text", "source").alias("payload"),
    )
    collections.recreate_collection(
        spark, root, "chunks", stored, 64, partition_by=("lang",), coded=True)
    hits = rag.search_collection(
        spark, root, "chunks", _questions(spark, sf), where=F.col("lang") == "en")
    return hits.select(
        "query_id", "id", "score", _long("rank"), points.payload_text("payload").alias("txt_chunk"),
        F.try_element_at("payload", F.lit("source")).alias("source"),
    )


@query
def topk_cosine_sparse(spark, sf):
    words = embedding.spaced_words("text")
    asked = _questions(spark, sf).select(
        "query_id", embedding.hashed_sparse_vector(words).alias("vector")
    )
    stored = _chunks(spark, sf).select(
        points.point_id().alias("id"), embedding.hashed_sparse_vector("text").alias("vector")
    )
    return _hits(search.topk_cosine_sparse(asked, stored))


@query
def pairwise_similarity(spark, sf):
    return pairs.pairwise_similarity(_vectors(spark, sf), id="vec_id")


@query
def similar_pairs_approx(spark, sf):
    return neighbours.similar_pairs_approx(_table(spark, sf, "embeddings"), 0.4, id="vec_id")


@query
def similar_texts(spark, sf):
    return ranking.similar_texts(_table(spark, sf, "benchmark"))


@query
def quantize_vectors(spark, sf):
    coded = embedding.quantize_vectors(_vectors(spark, sf))
    rebuilt = embedding.dequantize_vectors(coded.withColumn("original", F.col("embedding")))
    return rebuilt.select(
        "vec_id", _joined("codes").alias("codes"), F.round("scale", 9).alias("scale"),
        F.round(vec.cosine_similarity("original", "embedding"), 6).alias("kept"),
    )


# ---- prompts, chat and JSON ---------------------------------------------------


@query
def context_text(spark, sf):
    # Hits: the answers of a conversation, ranked by turn; some have none.
    asked = _table(spark, sf, "conversations").select(F.col("conv_id").alias("query_id")).distinct()
    hits = _turns(spark, sf, "assistant").select(
        F.col("conv_id").alias("query_id"), F.col("turn").alias("rank"), "text"
    )
    return prompts.context_text(asked, hits)


@query
def fill_template(spark, sf):
    template = F.lit(prompts.CONTEXT_TEXT)
    return _table(spark, sf, "benchmark").select(
        "item_id",
        prompts.fill_template(template, "text").alias("filled"),
        prompts.fill_template(template, "text", legacy=True).alias("legacy"),
        prompts.fill_template(F.lit("no placeholder"), "text").alias("missing"),
    )


@query
def set_user_message(spark, sf):
    messages = prompts.rag_messages(F.lit("your_user_prompt"), F.lit(""))
    updated = _questions(spark, sf).select(
        "query_id", prompts.set_user_message(messages, "text").alias("m")
    )
    return updated.select(
        "query_id", F.col("m")[0]["role"].alias("first_role"), F.col("m")[1]["role"].alias("role"),
        F.col("m")[1]["content"].alias("content"),
    )


@query
def chat_request(spark, sf):
    body = prompts.chat_request(prompts.rag_messages("text", F.lit("excerpt")))
    return _questions(spark, sf).select("query_id", body.alias("body"))


@query
def minimal_request(spark, sf):
    """Messages and model only, with the texts of a benchmark item as payloads."""
    placeholder = "{{payloads}}"
    system = prompts.fill_template(
        F.lit(f"Excerpts: {placeholder} Answer from them."), "text", placeholder=placeholder)
    messages = F.array(
        prompts.message("system", F.lit("Answer truthfully.")), prompts.message("user", "text"),
        prompts.message("system", system))
    return _table(spark, sf, "benchmark").select(
        "item_id", prompts.chat_request(messages, minimal=True).alias("body"))


@query
def chat_response(spark, sf):
    """Responses of several choices: every turn of a role, one without content."""
    turns = _turns(spark, sf)
    body = F.when(
        F.col("role") == "system", F.lit('{"choices":[{"message":{"content":7}},{"message":{}}]}')
    ).otherwise(
        F.concat(
            F.substring(_response(F.col("text")), F.lit(1), F.char_length(_response(F.col("text"))) - 2),
            F.lit(',{"message":{"content":"second"}},{"other":1}]}'),
        )
    )
    rows = prompts.chat_response(turns.select("conv_id", "turn", body.alias("body")), keep=("conv_id", "turn"))
    return rows.select("conv_id", "turn", _long("choice"), "content")


def _deltas(spark, sf) -> DataFrame:
    """Streamed answers: a role chunk first, then one chunk per piece of text."""
    pieces = _pieces(spark, sf)
    text = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("piece").alias("content")).alias("delta"))).alias("choices")))
    role = F.lit('{"choices":[{"delta":{"role":"assistant"}}]}')
    return pieces.select("seq_id", "pos", text.alias("body")).unionByName(
        pieces.where(F.col("pos") == 0).select("seq_id", F.lit(-1).alias("pos"), role.alias("body"))
    )


def _pieces(spark, sf) -> DataFrame:
    """Token pieces of the answers: up to four characters and the space before them."""
    found = F.regexp_extract_all("text", F.lit(r"\s*\S{1,4}"), F.lit(0))
    return _keyed_turns(spark, sf, "assistant").select("seq_id", F.posexplode(found).alias("pos", "piece"))


@query
def stream_deltas(spark, sf):
    return prompts.stream_deltas(_deltas(spark, sf), "seq_id", "pos")


@query
def validate_structured(spark, sf):
    turns = _turns(spark, sf)
    answer = (
        F.when(F.col("role") == "user", F.to_json(F.struct(F.col("text").alias("content"))))
        .when(F.col("role") == "system", F.to_json(F.struct(F.col("turn").alias("content"))))
        .otherwise(F.col("text"))
    )
    return turns.select("conv_id", "turn", prompts.is_valid_answer(answer).alias("is_valid"))


@query
def format_chat_turn(spark, sf):
    turns = _with_model(_turns(spark, sf, "user")).withColumn("text", F.concat("text", F.lit("\r\n")))
    return chat.format_chat_turn(turns).select("conv_id", "turn", "model", "prompt")


@query
def chat_messages(spark, sf):
    pattern = "<|im_start|>{role}\n{content}<|im_end|>\n"
    return chat.chat_messages(_turns(spark, sf), pattern, "<|im_start|>assistant\n")


@query
def chat_history(spark, sf):
    turns = _turns(spark, sf, "user", "assistant")
    keyed = turns.select("conv_id", "turn", "role", points.point_id("conv_id", "turn").alias("seq_id"), "text")
    ids = tokens.encode_corpus(keyed, tokens.build_vocab(keyed), key="seq_id")
    coded = ids.select(
        points.point_doc("seq_id").alias("conv_id"), points.point_chunk("seq_id").alias("turn"), "ids"
    )
    history = chat.chat_history(coded, budget=256)
    return history.select("conv_id", _long("turn"), _joined("history").alias("history"))


@query
def chat_context(spark, sf):
    turns = _with_model(_turns(spark, sf))
    vocab = _stored(spark, tokens.build_vocab(turns), "vocab")
    context = chats.chat_context(turns, vocab, max_length=512, sample_length=101)
    return context.select("conv_id", _long("turn"), _joined("ids").alias("ids"))


@query
def json_map_values(spark, sf):
    host = F.regexp_extract("url", r"^https?://([^/]+)/", 1)
    body = F.to_json(
        F.struct(F.struct(host.alias("host"), F.col("page_id").alias("id")).alias("weight_map"))
    )
    return prompts.json_map_values(_table(spark, sf, "pages").select(body.alias("body")))


# ---- streaming ----------------------------------------------------------------


@query
def assemble_text(spark, sf):
    return assembly.assemble_text(_pieces(spark, sf))


def _arrive(spark, sf, df: DataFrame, path: str) -> None:
    """Write the files of a stream, as many as cores where the turns are few: a batch of three
    opens the state of every key group, however little the files hold."""
    size = int(_table(spark, sf, "conversations")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    df.coalesce(max(spark.sparkContext.defaultParallelism, size // ROW_GROUP_BYTES)).write.parquet(path)


@query
def assemble_text_stream(spark, sf):
    source, target = scratch_path(spark, "pieces"), scratch_path(spark, "assembled")
    pieces = _pieces(spark, sf)
    last = pieces.groupBy("seq_id").agg(F.max("pos").alias("pos")).withColumn("is_last", F.lit(True))
    marked = pieces.join(last, ["seq_id", "pos"], "left").withColumn(
        "is_last", F.coalesce("is_last", F.lit(False))
    )
    _arrive(spark, sf, marked, source)
    stream = spark.readStream.schema(marked.schema).option("maxFilesPerTrigger", 3).parquet(source)
    assemble.assemble_text_stream(stream).writeStream.format("parquet").option(
        "checkpointLocation", scratch_path(spark, "progress")
    ).trigger(availableNow=True).start(target).awaitTermination()
    return spark.read.parquet(target)


@query
def stream_deltas_stream(spark, sf):
    """The chunks of the answers as they come, in batches that cut through answers."""
    source, target = scratch_path(spark, "deltas"), scratch_path(spark, "answers")
    chunks = _deltas(spark, sf).withColumn("pos", F.col("pos") + 1)
    last = chunks.groupBy("seq_id").agg((F.max("pos") + 1).alias("pos"))
    end = F.lit('{"choices":[{"delta":{},"finish_reason":"stop"}]}')
    _arrive(spark, sf, chunks.unionByName(last.withColumn("body", end)), source)
    stream = spark.readStream.schema(chunks.schema).option("maxFilesPerTrigger", 3).parquet(source)
    assemble.stream_deltas_stream(stream).writeStream.format("parquet").option(
        "checkpointLocation", scratch_path(spark, "progress")
    ).trigger(availableNow=True).start(target).awaitTermination()
    return spark.read.parquet(target)


@query
def ingest_stream(spark, sf):
    schema = _table(spark, sf, "documents").schema
    # A pattern, so that a table of one file and a folder of files are both found.
    stream = spark.readStream.schema(schema).parquet(f"{sf}/documents.parque[t]")
    target = scratch_path(spark, "points")
    ingest.ingest_stream(stream, target, scratch_path(spark, "progress")).awaitTermination()
    stored = ingest.latest_points(spark, target)
    return stored.select(
        "id", _whole("embedding").alias("embedding"),
        points.payload_text("payload").alias("txt_chunk"),
        F.try_element_at("payload", F.lit("source")).alias("source"),
    )


# ---- scalars, aggregates and metrics ------------------------------------------


@query
def format_size(spark, sf):
    size = F.col("n_chars") * F.col("n_chars") * (F.col("doc_id") + 1)
    return _table(spark, sf, "documents").select(
        "doc_id", tx.format_size("n_chars").alias("chars"), tx.format_size(size).alias("scaled")
    )


@query
def total_size(spark, sf):
    sizes = metrics.total_size(_table(spark, sf, "documents"), "source", "n_chars", 18, 32)
    return sizes.select("source", "items", "bytes", "size")


@query
def throughput(spark, sf):
    rates = metrics.throughput(_table(spark, sf, "events"), "event_type")
    return rates.select(
        "event_type", "items", F.round("seconds", 3).alias("seconds"),
        F.round("per_second", 6).alias("per_second"),
    )


@query
def job_counters(spark, sf):
    """What one job saw at two places on its way, counted while it wrote the chunks."""
    docs, seen = metrics.counted(_documents(spark, sf), letters=F.sum(F.char_length("text")))
    chunks = chunking.word_chunks(docs)
    written = metrics.write_counted(
        chunks, scratch_path(spark, "chunks"), letters=F.sum(F.char_length("text")))
    found = [("documents", seen.get["items"], seen.get["letters"]),
             ("chunks", written["items"], written["letters"])]
    return spark.createDataFrame(found, "place string, items bigint, letters bigint")


@query
def rag_prompts(spark, sf):
    return rag.rag_prompts(_documents(spark, sf), _questions(spark, sf))
