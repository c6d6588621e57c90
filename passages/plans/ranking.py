"""Texts to the most similar pairs of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passages.operators.embedding import EMBEDDING_DIM, Embedder, embed
from passages.operators.pairs import pairwise_similarity


def similar_texts(
    df: DataFrame,
    limit: int = 5,
    key: str = "item_id",
    text: str = "text",
    dim: int = EMBEDDING_DIM,
    embedder: Embedder | None = None,
) -> DataFrame:
    """``(i, j, score, text_i, text_j)``: the ``limit`` most similar pairs of texts.

    Texts are looked up for the ``limit`` pairs only, which is what is broadcast.
    """
    vectors = embed(df.select(F.col(key).alias("id"), F.col(text).alias("text")), "text", dim, embedder)
    best = pairwise_similarity(vectors, limit, dim=dim)
    sides = best.select("i", "j", "score", F.explode(F.array("i", "j")).alias(key))
    found = df.select(key, text).join(F.broadcast(sides), key)
    return found.groupBy("i", "j", "score").agg(
        F.max(F.when(F.col(key) == F.col("i"), F.col(text))).alias("text_i"),
        F.max(F.when(F.col(key) == F.col("j"), F.col(text))).alias("text_j"),
    )
