"""Helpers shared by the operators: texts in blocks, and tables stored between jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passages.llm.hashing import BLOCK_BYTES, blocks
from passages.session import scratch_path


def map_texts(
    df: DataFrame,
    schema: str,
    work: Callable[[], Callable[[pa.RecordBatch], dict[str, list]]],
    keys: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Run ``work()`` once per task and its result on each block of ``(*keys, text)``.

    A block holds at most ``block_bytes`` of text, or one text. NULL texts are empty. The
    result is a dict of columns in the order of ``schema``. Nothing is shuffled.
    """
    target = df.sparkSession.createDataFrame([], schema).schema
    names = target.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = work()
        types = None
        for batch in batches:
            if types is None:
                from pyspark.sql.pandas.types import to_arrow_schema

                types = to_arrow_schema(target)
            column = batch.column(len(keys)).fill_null("")
            batch = pa.RecordBatch.from_arrays([*batch.columns[:-1], column], [*keys, "text"])
            for begin, end in blocks(column, block_bytes):
                out = step(batch.slice(begin, end - begin))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[n], types.field(n).type) for n in names], names
                )

    return df.select(*keys, F.col(text).alias("text")).mapInArrow(run, target)


def map_rows(
    df: DataFrame,
    work: Callable[[], Callable[[pa.RecordBatch, pa.Array], pa.RecordBatch]],
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Run ``work()`` once per task and its result on each block of whole rows and its texts.

    As ``map_texts``, but all columns go through and the result has the same ones: rows may
    be left out or their values replaced. NULL texts are empty in the texts given.
    """
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = work()
        for batch in batches:
            texts = batch.column(at).fill_null("")
            for begin, end in blocks(texts, block_bytes):
                out = step(batch.slice(begin, end - begin), texts.slice(begin, end - begin))
                if out.num_rows:
                    yield out

    return df.mapInArrow(run, df.schema)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and go on from its files: lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``place``, from 0 in that order, which must tell all rows apart.

    Rows are sorted by ranges and stored; only the lengths of the ranges are summed, so no
    task sees all rows.
    """
    number = F.monotonically_increasing_id()
    # The high bits of the number are the task, the low 33 the row in it.
    ranges = store(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_number", number),
        "ranges",
    ).withColumn("_range", F.shiftright("_number", 33))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("_range").count().select(
        "_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")
    )
    place = F.col("_start") + F.col("_number").bitwiseAND((1 << 33) - 1)
    return ranges.join(F.broadcast(starts), "_range").select(*df.columns, place.alias("place"))


# A table of more bytes than this is never shipped, however few its rows.
SHIPPED_BYTES = 64 << 20


def width(value: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes; what holds texts or lists is measured."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value)
    elif isinstance(kind, T.StructType):
        size = sum((width(value[f.name], f.dataType) for f in kind.fields), F.lit(0))
    elif isinstance(kind, T.ArrayType):
        size = F.aggregate(
            value, F.lit(0).cast("bigint"),
            lambda total, x: total + width(x, kind.elementType).cast("bigint"),
        ) if not isinstance(kind.elementType, T.NumericType) else F.size(value) * 8
    else:
        size = F.lit(0)
    return F.coalesce(size, F.lit(0)) + 8


def small(df: DataFrame, rows: int, most_bytes: int = SHIPPED_BYTES) -> DataFrame:
    """Mark a stored table for broadcast if it has few rows and few bytes, else leave it."""
    size = width(F.struct(*[F.col(f"`{c}`") for c in df.columns]), df.schema)
    measured = df.select(size.alias("size")).limit(rows + 1).agg(
        F.count("*").alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
    ).first()
    return F.broadcast(df) if measured.rows <= rows and measured.bytes <= most_bytes else df
