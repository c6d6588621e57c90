"""Documents arriving in a folder become points as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from passages.operators.chunking import word_chunks
from passages.operators.embedding import EMBEDDING_DIM, Embedder, embed_chunks
from passages.operators.joins import join_lookup
from passages.operators.points import make_points, point_doc
from passages.session import folder_names, spread

# Bytes of document ids and batch numbers that are shipped to the points.
BROADCAST_BYTES, VERSION_BYTES = 32 << 20, 24


def document_points(
    documents: DataFrame, dim: int = EMBEDDING_DIM, embedder: Embedder | None = None
) -> DataFrame:
    """``(id, embedding, payload)`` of documents; stateless, so batch and stream agree."""
    return make_points(embed_chunks(word_chunks(documents, keep=("source",)), dim, embedder))


def ingest_stream(
    documents: DataFrame, path: str, checkpoint: str, embedder: Embedder | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write the points of each micro-batch, and which documents it brought, under ``path``.

    A document that comes again replaces all its points, also those of chunks that it no
    longer has; one without text leaves none. Of rows of one document in a batch the one
    with the largest text counts. A replayed batch overwrites its folders and point ids
    derive from ``(doc_id, chunk_no)``, so a restart repeats nothing. A batch counts once
    its documents are written; it costs what it brings, however large the collection is.
    """

    def store(batch: DataFrame, number: int) -> None:
        rows = batch.where("doc_id IS NOT NULL")
        documents = spread(rows, "doc_id").groupBy("doc_id").agg(
            F.max(F.struct("text", "source")).alias("_row")
        ).select("doc_id", "_row.*")
        points = document_points(documents, embedder=embedder)
        points.write.mode("overwrite").parquet(f"{path}/points/batch={number}")
        rows.select("doc_id").distinct().write.mode("overwrite").parquet(f"{path}/documents/batch={number}")

    return (
        documents.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _numbers(spark: SparkSession, path: str, key: str) -> list[int]:
    """Numbers of the folders ``key=number`` that were written to their end."""
    found = [n.partition("=")[2] for n in folder_names(spark, path, done=True) if n.startswith(f"{key}=")]
    return sorted(int(n) for n in found if n.isdigit())


def _open(spark: SparkSession, path: str) -> tuple[int, list[int]]:
    """The last batch that was compacted, -1 for none, and the batches after it."""
    base = max(_numbers(spark, f"{path}/compacted", "upto"), default=-1)
    return base, [n for n in _numbers(spark, f"{path}/documents", "batch") if n > base]


def latest_points(spark: SparkSession, path: str) -> DataFrame:
    """The points of each document as the last batch that brought it left them.

    Only batches since the last compaction are compared, by document; vectors are shuffled
    only where the documents of those batches are too many to be shipped.
    """
    base, batches = _open(spark, path)
    empty = spark.createDataFrame([], "id bigint, embedding array<float>, payload map<string,string>")
    kept = spark.read.parquet(f"{path}/compacted/upto={base}") if base >= 0 else empty
    kept = kept.select(empty.columns)
    if not batches:
        return kept

    def read(kind: str) -> DataFrame:
        folders = [f"{path}/{kind}/batch={n}" for n in batches]
        return spark.read.option("basePath", f"{path}/{kind}").parquet(*folders)

    latest = read("documents").groupBy("doc_id").agg(F.max("batch").alias("_latest"))
    few = read("documents").count() * VERSION_BYTES <= BROADCAST_BYTES
    arrived = read("points").withColumn("doc_id", point_doc("id"))
    if few:
        arrived = arrived.join(F.broadcast(latest), "doc_id")
        kept = kept.join(F.broadcast(latest), point_doc("id") == F.col("doc_id"), "left_anti")
    else:
        arrived = join_lookup(arrived, latest, "doc_id", ["id"], how="inner")
        kept = kept.join(latest, point_doc("id") == F.col("doc_id"), "left_anti")
    return kept.unionByName(arrived.where("batch = _latest").select(empty.columns))


def compact_points(spark: SparkSession, path: str) -> DataFrame:
    """Write the latest points of all batches so far as one table, read from then on.

    Batches that arrive meanwhile are not in it and stay to be read. Older folders are left
    for readers that have them open.
    """
    _, batches = _open(spark, path)
    if batches:
        latest_points(spark, path).write.mode("errorifexists").parquet(f"{path}/compacted/upto={batches[-1]}")
    return latest_points(spark, path)
