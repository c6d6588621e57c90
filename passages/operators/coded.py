"""Exact k-nearest search over coded points: one byte an entry first, vectors only for the rest.

A point carries a code of its unit vector, one signed byte for each entry, and how far the
code is from it. The cosine of a query and a point lies within that error of the query's
product with the code. The first pass reads ids, codes and errors, no vectors: a task
raises each query's floor (the k-th largest lower bound so far, at first the k-th score
among a sample) and keeps the points whose upper bound reaches it. Only those pairs are
scored exactly, by a second scan that skips all other points. Points never move.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passages.functions.vectors import cosine_similarity
from passages.operators.cells import SCORE_UNIT, nonzero, vector_matrix
from passages.operators.embedding import EMBEDDING_DIM
from passages.operators.joins import join_lookup
from passages.operators.search import BROADCAST_BYTES, topk_cosine
from passages.session import stored

SAMPLE_POINTS = 4096
# Points of one block of products, and products held at once.
BLOCK_POINTS, BLOCK_CELLS = 1 << 13, 1 << 22
# Scores are whole millionths; a product in single precision adds less than the rest.
SLACK = 1.5 / SCORE_UNIT + 1e-5
PAIR_BYTES = 32
CODES = "code binary, error float"


def code_vectors(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the unit vectors and the distances to them, infinite for zero vectors."""
    length = np.sqrt(np.square(vectors).sum(1, keepdims=True))
    unit = np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)
    codes = np.rint(unit * 127)
    error = np.where(length[:, 0] > 0, np.sqrt(np.square(unit - codes / 127).sum(1)), np.inf)
    # Rounded up, as the bound must hold in single precision.
    return codes.astype(np.int8), np.nextafter(error.astype(np.float32), np.float32(np.inf))


def code_points(points: DataFrame, vector: str = "embedding", dim: int = EMBEDDING_DIM) -> DataFrame:
    """Add ``code`` (``dim`` signed bytes) and ``error``; NULL and empty vectors have neither."""

    @F.arrow_udf(CODES)
    def coded(column: pa.Array) -> pa.Array:
        known = column.is_valid().to_numpy(zero_copy_only=False) & (
            column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) > 0)
        codes, error = code_vectors(vector_matrix(column.filter(pa.array(known)), dim))
        place = pa.array(np.cumsum(known) - 1, mask=~known)
        data = pa.FixedSizeBinaryArray.from_buffers(
            pa.binary(dim), len(codes), [None, pa.py_buffer(np.ascontiguousarray(codes).tobytes())])
        return pa.StructArray.from_arrays(
            [data.cast(pa.binary()).take(place), pa.array(error).take(place)], names=["code", "error"])

    return points.withColumn("_coded", coded(vector)).select(*points.columns, "_coded.*")


class Bounds:
    """Floors of the queries of a task, and the pairs that may reach them."""

    def __init__(self, units: np.ndarray, floors: np.ndarray, k: int):
        self.units, self.floors, self.k = units.astype(np.float32), floors.copy(), k
        self.lower = np.full((len(units), k), -np.inf, np.float32)
        self.found: list[tuple[np.ndarray, ...]] = []

    def add(self, ids: np.ndarray, codes: np.ndarray, error: np.ndarray) -> None:
        points = codes.astype(np.float32).T / np.float32(127)
        step = max(BLOCK_CELLS // max(len(ids), 1), 1)
        for start in range(0, len(self.units), step):
            rows = slice(start, start + step)
            near = self.units[rows] @ points
            low = near - error
            kept = np.concatenate([self.lower[rows], low], axis=1)
            self.lower[rows] = np.partition(kept, kept.shape[1] - self.k, axis=1)[:, -self.k:]
            self.floors[rows] = np.maximum(self.floors[rows], self.lower[rows].min(1) - SLACK)
            row, column = np.nonzero(near + error >= self.floors[rows][:, None])
            self.found.append((row + start, ids[column], low[row, column], (near + error)[row, column]))

    def left(self) -> tuple[np.ndarray, ...]:
        """Query row, id, lower and upper bound of the pairs that the last floors leave."""
        if not self.found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        row, ids, low, high = (np.concatenate(parts) for parts in zip(*self.found))
        open_ = high >= self.floors[row]
        self.found = [(row[open_], ids[open_], low[open_], high[open_])]
        return self.found[0]


def open_pairs(
    queries: pa.Table, floors: np.ndarray, points: DataFrame, k: int, dim: int, point_id: str,
) -> DataFrame:
    """``(query, id, low, high)``: pairs whose bounds reach the floors, by one scan of codes.

    ``query`` is the row of ``queries`` ``(query_id, vector)``. Every task keeps what it
    cannot rule out; pairs below the k-th largest lower bound of all tasks go then.
    """
    shared = points.sparkSession.sparkContext.broadcast((queries, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, floors = shared.value
        vectors = vector_matrix(table.column(1).combine_chunks(), dim)
        bounds = Bounds(vectors / np.sqrt(np.square(vectors).sum(1, keepdims=True)), floors, k)
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_POINTS):
                part = batch.slice(begin, BLOCK_POINTS)
                codes = np.frombuffer(b"".join(part.column(1).to_pylist()), np.int8).reshape(-1, dim)
                bounds.add(part.column(0).to_numpy(), codes, part.column(2).to_numpy())
            bounds.left()
        row, ids, low, high = bounds.left()
        yield pa.RecordBatch.from_arrays(
            [pa.array(row.astype(np.int64)), pa.array(ids.astype(np.int64)),
             pa.array(low.astype(np.float64)), pa.array(high.astype(np.float64))],
            ["query", "id", "low", "high"])

    coded = points.where(F.col("error") < float("inf")).select(F.col(point_id).cast("long").alias("id"), "code", "error")
    kept = stored(
        coded.mapInArrow(run, "query bigint, id bigint, low double, high double"), "open-pairs")
    order = Window.partitionBy("query").orderBy(F.desc("low"), "id")
    kth = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k)
    least = kth.select("query", (F.col("low") - SLACK).alias("_least"))
    return kept.join(least, "query", "left").where("_least IS NULL OR high >= _least").drop("_least")


def topk_coded(
    queries: DataFrame,
    points: DataFrame,
    k: int = 3,
    query_id: str = "query_id",
    point_id: str = "id",
    vector: str = "embedding",
    dim: int = EMBEDDING_DIM,
    sample_points: int = SAMPLE_POINTS,
    broadcast_bytes: int = BROADCAST_BYTES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(query_id, id, score, rank, *keep)`` as ``topk_cosine``, over points from ``code_points``.

    ``points`` should be a stored table: it is scanned for a sample, for codes, and for the
    vectors, and the columns to ``keep``, of the pairs left. Queries beyond ``broadcast_bytes``
    go by ``topk_cosine``; so do all where the pairs left are more than that, as codes then
    rule out too little. An id that repeats should have one vector.
    """
    asked = queries.select(query_id, vector).where(nonzero(vector))
    most = broadcast_bytes // (8 * dim)
    table = asked.limit(most + 1).toArrow()

    def plain() -> DataFrame:
        hits = topk_cosine(queries, points, k, query_id=query_id, point_id=point_id, vector=vector, dim=dim,
                           broadcast_bytes=broadcast_bytes)
        return join_lookup(stored(hits, "hits"), points.select(point_id, *keep), point_id, [query_id, "rank"],
                           how="inner").select(*hits.columns, *keep) if keep else hits

    if table.num_rows > most:
        return plain()
    pairs = open_pairs(
        table, _sample_floors(table, points, k, point_id, vector, dim, sample_points), points, k, dim,
        point_id,
    )
    if pairs.count() * PAIR_BYTES > broadcast_bytes:
        return plain()
    # The row of each query, from the same table that numbered them.
    spark = points.sparkSession
    rows = pa.table([pa.array(np.arange(table.num_rows)), table.column(0), table.column(1)],
                    names=["query", "_query_id", "_asked"])
    schema = T.StructType([
        T.StructField("query", T.LongType()),
        T.StructField("_query_id", queries.schema[query_id].dataType),
        T.StructField("_asked", queries.schema[vector].dataType)])
    numbered = F.broadcast(spark.createDataFrame(rows, schema))
    exact = (
        points.select(F.col(point_id).cast("long").alias("_id"), F.col(vector).alias("_vector"), *keep)
        .join(F.broadcast(pairs.select("query", F.col("id").alias("_id"))), "_id")
        .join(numbered, "query")
        .withColumn("_units", F.rint(cosine_similarity("_asked", "_vector") * SCORE_UNIT).cast("long"))
        .where("_units IS NOT NULL")
    )
    order = Window.partitionBy("_query_id").orderBy(F.desc("_units"), "_id")
    return (
        exact.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select(F.col("_query_id").alias(query_id), F.col("_id").alias(point_id),
                (F.col("_units") / SCORE_UNIT).alias("score"), "rank", *keep)
    )


def _sample_floors(
    table: pa.Table, points: DataFrame, k: int, point_id: str, vector: str, dim: int, most: int
) -> np.ndarray:
    """The k-th best score of each query among ``most`` points; none if they are too few."""
    sample = points.where(nonzero(vector)).orderBy(F.xxhash64(point_id), point_id)
    drawn = sample.select(vector).limit(most).toArrow()
    floors = np.full(table.num_rows, -np.inf, np.float32)
    if drawn.num_rows < k or not table.num_rows:
        return floors
    left, right = (vector_matrix(c.combine_chunks(), dim) for c in (table.column(1), drawn.column(0)))
    left, right = (v / np.sqrt(np.square(v).sum(1, keepdims=True)) for v in (left, right))
    step = max(BLOCK_CELLS // drawn.num_rows, 1)
    for start in range(0, len(left), step):
        scores = left[start:start + step] @ right.T
        floors[start:start + step] = np.partition(scores, -k, axis=1)[:, -k] - SLACK
    return floors
