"""Documents and questions to ready chat requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passages.functions.text import words
from passages.functions.vectors import with_value
from passages.operators.chunking import word_chunks
from passages.operators.coded import topk_coded
from passages.operators.embedding import EMBEDDING_DIM, Embedder, embed_chunks, embed_queries
from passages.operators.joins import join_lookup
from passages.operators.points import payload_text, point_chunk, point_doc, point_id
from passages.operators.prompts import chat_request, context_text, rag_messages
from passages.operators.search import BROADCAST_BYTES, topk_cosine
from passages.session import stored
from passages.sources.collections import collection_settings, read_collection

CHUNK_SIZE, OVERLAP = 300, 80
# A hit is an id, a query id, a score and a rank; counted with room for overhead.
HIT_BYTES = 64


def document_vectors(
    documents: DataFrame,
    dim: int = EMBEDDING_DIM,
    embedder: Embedder | None = None,
    chunk_size: int = CHUNK_SIZE,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``(id, embedding)`` of the word chunks of all documents.

    Empty lines need no removal first: words are split at any white space.
    """
    vectors = embed_chunks(
        word_chunks(documents, chunk_size=chunk_size, overlap=overlap), dim, embedder
    )
    return vectors.select(point_id().alias("id"), "embedding")


def hit_texts(
    hits: DataFrame,
    documents: DataFrame,
    most_hits: int,
    broadcast_bytes: int = BROADCAST_BYTES,
    chunk_size: int = CHUNK_SIZE,
    overlap: int = OVERLAP,
) -> DataFrame:
    """Add ``text`` to hits, cutting only the chunks that were hit.

    Texts are fetched after the search and never travel with the vectors. Hits that
    are known to be few go to the documents, grouped so that a document is split into
    words once; more of them meet the documents in a shuffle that spreads a document
    many queries found.
    """
    keyed = hits.withColumn("doc_id", point_doc("id"))
    texts = documents.select("doc_id", F.col("text").alias("_text"))

    def chunk(words: Column, id: Column) -> Column:
        first = point_chunk(id) * (chunk_size - overlap) + 1
        return F.array_join(F.slice(words, first, F.lit(chunk_size)), " ")

    if most_hits * HIT_BYTES > broadcast_bytes:
        # The join counts its rows first: they come from storage, not from another search.
        joined = join_lookup(
            stored(keyed, "hits"), texts, "doc_id", ["query_id", "rank"], how="inner")
        text = chunk(words("_text"), F.col("id"))
        return joined.select("query_id", "id", "score", "rank", text.alias("text"))
    hit = F.struct("query_id", "id", "score", "rank")
    by_document = keyed.groupBy("doc_id").agg(F.collect_list(hit).alias("_hits"))
    with_text = with_value(
        words("_text"),
        lambda w: F.transform(
            "_hits", lambda h: F.struct(h.alias("hit"), chunk(w, h["id"]).alias("text"))
        ),
    )
    return (
        texts.join(F.broadcast(by_document), "doc_id")
        .select(F.explode(with_text).alias("_h"))
        .select("_h.hit.*", "_h.text")
    )


def stored_texts(
    hits: DataFrame, points: DataFrame, most_hits: int, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``text`` to hits from the payloads of the points that were hit."""
    texts = points.select("id", payload_text("payload").alias("text"))
    if most_hits * HIT_BYTES > broadcast_bytes:
        return join_lookup(stored(hits, "hits"), texts, "id", ["query_id", "rank"], how="inner")
    return texts.join(F.broadcast(hits), "id")


def search_collection(
    spark: SparkSession,
    root: str,
    name: str,
    questions: DataFrame,
    k: int = 3,
    where: Column | None = None,
    embedder: Embedder | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(query_id, id, score, rank, payload)``: the best points of a collection.

    ``where`` may name any column of the points; on those that the collection is
    partitioned by, other folders are not read. The collection's own settings say how long
    its vectors are and whether codes go before them.
    """
    settings = collection_settings(spark, root, name)
    points = read_collection(spark, root, name)
    if where is not None:
        points = points.where(where)
    asked = embed_queries(questions, settings["dim"], embedder=embedder)
    if settings["coded"]:
        return topk_coded(asked, points, k, dim=settings["dim"], broadcast_bytes=broadcast_bytes,
                          keep=("payload",))
    hits = topk_cosine(asked, points, k, dim=settings["dim"], broadcast_bytes=broadcast_bytes)
    payloads = points.select("id", "payload")
    if questions.count() * k * HIT_BYTES > broadcast_bytes:
        return join_lookup(
            stored(hits, "hits"), payloads, "id", ["query_id", "rank"], how="inner"
        ).select(*hits.columns, "payload")
    return payloads.join(F.broadcast(hits), "id").select(*hits.columns, "payload")


def rag_prompts(
    documents: DataFrame,
    questions: DataFrame,
    k: int = 3,
    points: DataFrame | None = None,
    dim: int = EMBEDDING_DIM,
    embedder: Embedder | None = None,
    legacy: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    chunk_size: int = CHUNK_SIZE,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``(query_id, context, body)``: a chat request for each question ``(query_id, text)``.

    ``points`` ``(id, embedding, payload)`` is a stored collection, and the text of a hit
    is the one in its payload, however the documents were cut; a hit without it has no
    text. Points without a payload must come from ``document_vectors`` of ``documents``
    with this ``chunk_size`` and ``overlap``. Without ``points`` the documents are cut
    and embedded here.
    """
    stored = points is not None and "payload" in points.columns
    if points is None:
        points = document_vectors(documents, dim, embedder, chunk_size, overlap)
    asked = embed_queries(questions, dim, embedder=embedder)
    hits = topk_cosine(asked, points, k, dim=dim, broadcast_bytes=broadcast_bytes)
    if stored:
        texts = stored_texts(hits, points, questions.count() * k, broadcast_bytes)
    else:
        texts = hit_texts(
            hits, documents, questions.count() * k, broadcast_bytes, chunk_size, overlap
        )
    found = context_text(questions, texts)
    return found.select(
        "query_id", "context",
        chat_request(rag_messages("text", "context", legacy=legacy)).alias("body"),
    )
