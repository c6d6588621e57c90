"""Joins of a large, possibly skewed side with a lookup that is unique per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys above 1/HOT_SHARE of all rows are hot; there can be at most HOT_SHARE of them.
HOT_SHARE = 64
SALTS = 64


def hot_keys(df: DataFrame, key: str) -> list:
    """Keys that hold more than 1/HOT_SHARE of the rows: HOT_SHARE values at most."""
    counts = df.groupBy(key).count()
    total = df.count()
    rows = counts.where(F.col("count") * HOT_SHARE > total).select(key).collect()
    return [row[0] for row in rows if row[0] is not None]


def join_lookup(
    df: DataFrame, lookup: DataFrame, key: str, spread_by: list[str], how: str = "left"
) -> DataFrame:
    """Shuffle join on ``key`` in which rows of hot keys are spread over salts.

    ``spread_by`` names columns that tell rows of one key apart. The lookup rows of
    hot keys are repeated per salt, all others appear once.
    """
    hot = hot_keys(df, key)
    if not hot:
        return df.join(lookup, key, how)
    is_hot = F.col(key).isin(hot)
    salted = df.withColumn(
        "salt",
        F.when(is_hot, F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int")).otherwise(0),
    )
    all_salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    repeated = lookup.withColumn(
        "salt", F.explode(F.when(is_hot, all_salts).otherwise(F.array(F.lit(0))))
    )
    return salted.join(repeated, [key, "salt"], how).drop("salt")
