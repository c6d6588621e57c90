"""Chunking: one document row to many overlapping chunk rows.

All three cuts are closed forms of the window position, so they run inside the scan
stage: no shuffle, and the word array ends at the generator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passages.functions.text import words

# Fixed values of the token windows.
PAD_ID, UNK_ID, CLS_ID, SEP_ID = 0, 100, 101, 102


def _stride(size: int, overlap: int) -> int:
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than the chunk size")
    return size - overlap


def word_chunks(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    chunk_size: int = 300,
    overlap: int = 80,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(key, chunk_no, text)``: windows of words joined by one space.

    The last window is the first that reaches the last word; a text without words
    has no chunk.
    """
    stride = _stride(chunk_size, overlap)
    cut = df.select(key, *keep, words(text).alias("_words"))
    count = F.size("_words")
    last = F.greatest(count - chunk_size, F.lit(0)) + (stride - 1)
    starts = F.when(count > 0, F.sequence(F.lit(0), last, F.lit(stride)))
    chunks = F.transform(
        starts, lambda s: F.array_join(F.slice(F.col("_words"), s + 1, chunk_size), " ")
    )
    return cut.select(key, *keep, F.posexplode(chunks).alias("chunk_no", "text"))


def char_window_chunks(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = 400,
    overlap: int = 80,
    keep_tail: bool = False,
) -> DataFrame:
    """``(key, chunk_no, text)``: sliding windows of ``size`` code points.

    The text is taken as it is; ``drop_empty_lines`` comes before, where it is wanted.
    Only full windows are kept, as a shorter tail holds less than a window; with
    ``keep_tail`` it follows as a last, short chunk. One regular-expression pass
    reads each text once: every match consumes a stride and looks ahead a window.
    """
    stride = _stride(size, overlap)
    least, consumed = ("1,", "1,") if keep_tail else ("", "")
    pattern = f"(?s)(?=(.{{{least}{size}}})).{{{consumed}{stride}}}"
    windows = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    if keep_tail:
        length = F.char_length(text)
        count = F.greatest(F.ceil((length - size) / stride), F.lit(0)) + 1
        windows = F.when(length > 0, F.slice(windows, F.lit(1), count.cast("int")))
    return df.select(key, F.posexplode(windows).alias("chunk_no", "text"))


def token_window_chunks(
    df: DataFrame,
    key: str = "doc_id",
    ids: str = "ids",
    chunk_size: int = 510,
    overlap: int = 100,
    pad_to: int = 512,
) -> DataFrame:
    """``(key, chunk_no, ids, mask)``: windows over token ids, wrapped and padded.

    ``ids`` holds the plain ids without special tokens. Windows start at every
    multiple of the stride below the length, so the last may lie inside the one
    before. The mask is 1 for a real token.
    """
    stride = _stride(chunk_size, overlap)
    if chunk_size + 2 > pad_to:
        raise ValueError("a wrapped window must fit into pad_to tokens")
    count = F.size(ids)
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1, F.lit(stride)))
    windows = F.transform(starts, lambda s: F.slice(F.col(ids), s + 1, chunk_size))
    cut = df.select(key, F.posexplode(windows).alias("chunk_no", "_window"))
    real = F.size("_window") + 2
    return cut.select(
        key,
        "chunk_no",
        F.concat(
            F.array(F.lit(CLS_ID)),
            F.col("_window"),
            F.array(F.lit(SEP_ID)),
            F.array_repeat(F.lit(PAD_ID), pad_to - real),
        ).alias("ids"),
        F.concat(
            F.array_repeat(F.lit(1), real), F.array_repeat(F.lit(0), pad_to - real)
        ).alias("mask"),
    )
