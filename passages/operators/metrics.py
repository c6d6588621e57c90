"""Sizes and rates."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from passages.functions.text import format_size, whole_div


def total_size(
    df: DataFrame,
    by: str,
    count: Column | str,
    type_size: int | Column = 1,
    block_size: int | Column = 1,
) -> DataFrame:
    """``(by, items, bytes, size)``: sum of ``count * type_size div block_size``."""
    count = F.col(count) if isinstance(count, str) else count
    type_size = type_size if isinstance(type_size, Column) else F.lit(type_size)
    block_size = block_size if isinstance(block_size, Column) else F.lit(block_size)
    item = whole_div((count * type_size).cast("long"), block_size)
    return (
        df.groupBy(by)
        .agg(F.count("*").alias("items"), F.sum(item).alias("bytes"))
        .withColumn("size", format_size("bytes"))
    )


def throughput(df: DataFrame, by: str, time: str = "ts") -> DataFrame:
    """``(by, items, seconds, per_second)``; the rate over no time is NULL."""
    seconds = F.timestamp_diff("MICROSECOND", F.min(time), F.max(time)) / F.lit(1e6)
    return (
        df.groupBy(by)
        .agg(F.count("*").alias("items"), seconds.alias("seconds"))
        .withColumn("per_second", F.col("items") / F.nullif("seconds", F.lit(0.0)))
    )


def counted(df: DataFrame, **counters: Column) -> tuple[DataFrame, Observation]:
    """``df`` and what a job over it will have seen: ``items``, and an aggregate per name.

    The counters ride along with the job that the rows are for, so nothing is scanned
    again; ``Observation.get`` waits for the first job over the returned table.
    """
    observation = Observation()
    columns = [c.alias(name) for name, c in counters.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("items"), *columns), observation


def write_counted(df: DataFrame, path: str, **counters: Column) -> dict:
    """Write ``df`` as Parquet; ``items``, the counters, ``seconds`` and items ``per_second``."""
    watched, observation = counted(df, **counters)
    start = time.perf_counter()
    watched.write.parquet(path)
    seconds = time.perf_counter() - start
    seen = observation.get
    return seen | {"seconds": seconds, "per_second": seen["items"] / seconds}
