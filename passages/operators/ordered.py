"""Order-dependent work within a key, split so that no key needs one task.

A position column cuts every key into segments of a fixed length. A window or an
ordered collect runs inside a segment, whose size is bounded because positions are
unique per key; only one row per segment is combined per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passages.functions.text import whole_div

SEGMENT = 16_384


def with_segment(df: DataFrame, position: str, length: int = SEGMENT) -> DataFrame:
    """Add ``_seg``, the number of the segment that ``position`` lies in."""
    return df.withColumn("_seg", whole_div(F.col(position).cast("long"), length))


def running_total(
    df: DataFrame,
    key: str,
    position: str,
    value: Column,
    name: str,
    inclusive: bool = True,
    segment: int = SEGMENT,
    keep_segment: bool = False,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of ``key`` up to ``position``.

    ``keep_segment`` leaves the column ``_seg``; the rows are then already distributed
    for an aggregation per key and segment.
    """
    df = with_segment(df, position, segment).withColumn("_val", value)
    inside = Window.partitionBy(key, "_seg").orderBy(position)
    upto = Window.currentRow if inclusive else -1
    local = df.withColumn(
        "_local",
        F.coalesce(
            F.sum("_val").over(inside.rowsBetween(Window.unboundedPreceding, upto)), F.lit(0)
        ),
    )
    totals = df.groupBy(key, "_seg").agg(F.sum("_val").alias("_total"))
    before = Window.partitionBy(key).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        key, "_seg", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset")
    )
    return (
        local.join(offsets, [key, "_seg"])
        .withColumn(name, F.col("_local") + F.col("_offset"))
        .drop("_val", "_local", "_offset", *([] if keep_segment else ["_seg"]))
    )


def concat_ordered(
    df: DataFrame,
    key: str | list[str],
    position: str,
    text: str,
    name: str,
    separator: str = "",
    segment: int = SEGMENT,
) -> DataFrame:
    """One row per key: its texts joined in the order of ``position``, NULLs left out.

    Rows that already carry ``_seg`` keep it.
    """
    keys = [key] if isinstance(key, str) else list(key)

    def joined(order: str, value: str) -> Column:
        rows = F.sort_array(F.collect_list(F.struct(order, value)))
        return F.array_join(F.transform(rows, lambda r: r[value]), separator)

    if "_seg" not in df.columns:
        df = with_segment(df, position, segment)
    parts = df.groupBy(*keys, "_seg").agg(joined(position, text).alias("_part"))
    return parts.groupBy(*keys).agg(joined("_seg", "_part").alias(name))
