"""Text to vector: a deterministic default embedder, and a hook for a real model."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passages.functions.text import words as split_words
from passages.functions.vectors import largest_entry, unit_vector, with_value

EMBEDDING_DIM = 64

Embedder = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def spaced_words(text: Column | str) -> Column:
    """The words of a text with one space between them, as chunks have them already."""
    return F.array_join(split_words(text), " ")


def hashed_vector(text: Column | str, dim: int = EMBEDDING_DIM) -> Column:
    """Signed feature hashing of space-separated words to ``ARRAY<FLOAT>``.

    The first eight hex digits of a word's md5 choose one of ``dim`` buckets, the ninth
    its sign, and a bucket holds the sum of its signs. All words of a chunk are in its
    row, so the sum needs no shuffle; a batch hashes each distinct word once.
    """

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def embed(column: pa.Array) -> pa.Array:
        rows, buckets, signs = _hash_words(column, dim)
        sums = np.bincount(rows * dim + buckets, weights=signs, minlength=len(column) * dim)
        offsets = pa.array(np.arange(len(column) + 1, dtype=np.int32) * dim)
        return pa.ListArray.from_arrays(offsets, pa.array(sums.astype(np.float32)))

    return embed(text)


def hashed_sparse_vector(text: Column | str, dim: int = 1 << 18) -> Column:
    """The same hashing for a wide space: ``(buckets, weights)`` without the zeros."""

    @F.arrow_udf("buckets array<int>, weights array<double>")
    def embed(column: pa.Array) -> pa.Array:
        rows, buckets, signs = _hash_words(column, dim)
        cells, where = np.unique(rows * dim + buckets, return_inverse=True)
        sums = np.bincount(where, weights=signs, minlength=len(cells))
        cells, sums = cells[sums != 0], sums[sums != 0]
        offsets = pa.array(
            np.searchsorted(cells, np.arange(len(column) + 1) * dim).astype(np.int32)
        )
        return pa.StructArray.from_arrays(
            [
                pa.ListArray.from_arrays(offsets, pa.array((cells % dim).astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array(sums)),
            ],
            names=["buckets", "weights"],
        )

    return embed(text)


def _hash_words(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and sign of every word of a text column."""
    split = pc.split_pattern(pc.fill_null(column, ""), " ")
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    coded = split.flatten().dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    hashes = np.array(
        [int(hashlib.md5(w.encode()).hexdigest()[:9], 16) for w in distinct], dtype=np.int64
    )
    index = coded.indices.to_numpy(zero_copy_only=False)
    buckets = (hashes >> 4) % dim
    signs = np.where(hashes % 16 < 8, 1.0, -1.0)
    # A text without words splits into one empty string.
    signs[[n for n, w in enumerate(distinct) if not w]] = 0
    rows = np.repeat(np.arange(len(column), dtype=np.int64), lengths)
    return rows, buckets[index], signs[index]


def projection_embedder(matrix: np.ndarray, spark: SparkSession, text: str = "text") -> Embedder:
    """A model to plug in: byte counts of a text times a ``(256, dim)`` matrix.

    The matrix is shipped once to each executor and read once by each worker task.
    """
    shared = spark.sparkContext.broadcast(np.asarray(matrix, np.float64))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for frame in frames:
            counts = np.stack([
                np.bincount(np.frombuffer((t or "").encode(), np.uint8), minlength=256)
                for t in frame[text]
            ]) if len(frame) else np.zeros((0, 256))
            yield frame.assign(embedding=list((counts @ model).astype(np.float32)))

    return run


def embed(
    df: DataFrame,
    text: str = "text",
    dim: int = EMBEDDING_DIM,
    embedder: Embedder | None = None,
    spaced: bool = False,
) -> DataFrame:
    """Add ``embedding`` to every row; rows are independent and never move.

    ``spaced`` tells that one space already separates the words. ``embedder`` receives the rows as pandas batches through ``mapInPandas`` and
    returns them with ``embedding`` added; load its model once, before the loop.
    """
    if embedder is not None:
        schema = T.StructType(df.schema.fields + [
            T.StructField("embedding", T.ArrayType(T.FloatType()))
        ])
        return df.mapInPandas(embedder, schema)
    words = F.col(text) if spaced else spaced_words(text)
    return df.withColumn("embedding", hashed_vector(words, dim))


def embed_chunks(
    chunks: DataFrame, dim: int = EMBEDDING_DIM, embedder: Embedder | None = None
) -> DataFrame:
    """Vectors of word-chunk rows ``(doc_id, chunk_no, text, ...)``."""
    return embed(chunks, "text", dim, embedder, spaced=True)


def embed_queries(
    questions: DataFrame,
    dim: int = EMBEDDING_DIM,
    normalize: bool = False,
    embedder: Embedder | None = None,
) -> DataFrame:
    """Vectors of question rows ``(query_id, text, ...)``, optionally of unit length."""
    vectors = embed(questions, "text", dim, embedder)
    return l2_normalize(vectors) if normalize else vectors


def mean_pool(
    df: DataFrame,
    key: str | list[str],
    vector: str = "embedding",
    mask: str | None = None,
) -> DataFrame:
    """Mean vector per key over rows of token vectors.

    Padding rows count unless ``mask`` (1 = real token) is named. The sum of each key
    is one fixed-size buffer combined before the shuffle, so a hot key ships one
    buffer per task.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    keys = [key] if isinstance(key, str) else list(key)
    if mask is not None:
        df = df.where(F.col(mask) == 1)
    pooled = df.groupBy(*keys).agg(
        Summarizer.mean(array_to_vector(F.col(vector))).alias("_mean")
    )
    return pooled.select(*keys, vector_to_array("_mean").alias(vector))


def l2_normalize(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Divide each vector by its length; entries of a zero vector become NULL."""
    return df.withColumn(vector, unit_vector(vector))


def quantize_vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Add ``scale`` and ``codes``: entries scaled, rounded and clipped to one byte."""
    scale = largest_entry(vector) / 127

    def code(x: Column, scale: Column) -> Column:
        steps = F.rint(F.coalesce(x.cast("double") / F.nullif(scale, F.lit(0.0)), F.lit(0.0)))
        return F.greatest(F.lit(-127.0), F.least(F.lit(127.0), steps)).cast("tinyint")

    codes = with_value(scale, lambda s: F.transform(vector, lambda x: code(x, s)))
    return df.withColumn("scale", scale).withColumn("codes", codes)


def dequantize_vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rebuild approximate vectors from ``scale`` and ``codes``."""
    rebuilt = with_value(F.col("scale"), lambda s: F.transform("codes", lambda c: c * s))
    return df.withColumn(vector, rebuilt)
