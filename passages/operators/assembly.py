"""Text from a sequence of token pieces, released at word borders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passages.functions.text import ALPHANUMERIC_END
from passages.operators.ordered import concat_ordered, running_total


def assemble_text(
    df: DataFrame,
    key: str = "seq_id",
    position: str = "pos",
    piece: str = "piece",
    segment: int = 16_384,
) -> DataFrame:
    """``(key, emit_no, text)``: the texts a reader of the sequence would see.

    Text is held until a piece ends in a letter or number, then released as a whole;
    what is left at the end is released last. The number of earlier releases names
    the group of a piece.
    """
    pieces = df.where(F.col(piece).isNotNull() & (F.col(piece) != ""))
    ends = F.col(piece).rlike(ALPHANUMERIC_END).cast("long")
    grouped = running_total(
        pieces, key, position, ends, "emit_no", inclusive=False, segment=segment,
        keep_segment=True,
    )
    return concat_ordered(grouped, [key, "emit_no"], position, piece, "text")
