"""Sharding: constant-time placement through a table that shards fill by preference.

Every shard walks the slots of a prime-sized table in its own order (an offset and a step,
both from its name). Shards take turns; at its turn a shard claims the next slot of its
order that is free. Slots are shared out almost evenly, and when a shard goes or comes most
slots keep their owner. A row's key names a slot, and the slot's owner is looked up in the
table, whose size is fixed, so it is shipped to every task.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A prime of at least a hundred slots a shard keeps shares within one per cent.
TABLE_SLOTS = 65_537


def preference(shard: str, slots: int) -> tuple[int, int]:
    """Where a shard's walk begins, and its step; ``slots`` is prime, so it visits all."""
    digest = hashlib.md5(shard.encode()).hexdigest()
    return int(digest[:15], 16) % slots, int(digest[15:30], 16) % (slots - 1) + 1


def fill_table(shards: list[str], slots: int = TABLE_SLOTS) -> list[int]:
    """Index of the owner of each slot."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards need distinct names, one at least and no more than slots")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    walks = [preference(s, slots) for s in shards]
    places = [offset for offset, _ in walks]
    owner = [-1] * slots
    claimed = 0
    while True:
        for shard, (_, step) in enumerate(walks):
            while owner[places[shard]] >= 0:
                places[shard] = (places[shard] + step) % slots
            owner[places[shard]] = shard
            claimed += 1
            if claimed == slots:
                return owner


def slot_table(spark: SparkSession, shards: list[str], slots: int = TABLE_SLOTS) -> DataFrame:
    """``(slot, shard)``: the filled table, one row per slot."""
    owners = ",".join(map(str, fill_table(shards, slots)))
    names = F.array(*[F.lit(s) for s in shards])
    return spark.range(1).select(
        F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "owner")
    ).select(
        F.col("slot").cast("bigint").alias("slot"),
        F.element_at(names, F.col("owner").cast("int") + 1).alias("shard"),
    )


def slot_of(key: Column, slots: int = TABLE_SLOTS) -> Column:
    """The slot of a key, from 60 bits of its MD5; a NULL key counts as an empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % slots


def place(
    df: DataFrame, key: str, shards: list[str], slots: int = TABLE_SLOTS
) -> DataFrame:
    """``df`` with ``slot`` and ``shard``; columns of these names are replaced.

    Rows of equal keys, NULL keys among them, go to the same shard, whatever the other
    rows are; repeated rows are all placed; an empty table stays empty. The table of slots
    is shipped (its size does not depend on the data), so no row is shuffled.
    """
    table = slot_table(df.sparkSession, shards, slots)
    placed = df.drop("shard").withColumn("slot", slot_of(df[key], slots))
    return placed.join(F.broadcast(table), "slot", "left").select(
        *[c for c in df.columns if c not in ("slot", "shard")], "slot", "shard"
    )
