"""Vectors of token windows, the other way to cut a document for a model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passages.operators.chunking import token_window_chunks
from passages.operators.embedding import EMBEDDING_DIM, Embedder, embed, l2_normalize
from passages.operators.tokens import decode_corpus, encode_corpus


def window_vectors(
    documents: DataFrame,
    vocab: DataFrame,
    dim: int = EMBEDDING_DIM,
    normalize: bool = False,
    embedder: Embedder | None = None,
) -> DataFrame:
    """``(doc_id, chunk_no, embedding)`` of the token windows of each document.

    The embedder sees the tokens of a window as text, without special tokens.
    """
    windows = token_window_chunks(encode_corpus(documents, vocab, special=False))
    keyed = windows.select(F.struct("doc_id", "chunk_no").alias("key"), "ids")
    texts = decode_corpus(keyed, vocab, key="key")
    vectors = embed(texts, "text", dim, embedder, spaced=True)
    if normalize:
        vectors = l2_normalize(vectors)
    return vectors.select("key.doc_id", "key.chunk_no", "embedding")
