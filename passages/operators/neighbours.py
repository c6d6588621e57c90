"""Links between similar vectors of a table, found in buckets of random projections.

1. Identical vectors are one class, named by its smallest id; only classes are compared.
2. The signs of ``bits`` random projections are a class's bucket in one of several tables.
   It also visits each bucket one sign away, from the larger code to the smaller, so two
   classes at most one sign apart meet in exactly one bucket of the table.
3. A bucket is cut into blocks; a task compares two blocks exactly and returns counts.
4. Two classes that meet in several tables count in the first: a class carries its codes.

``bits`` grows with the classes, so a bucket has about ``bucket_rows`` of them, and tables
are added until a pair at the threshold meets with probability ``recall``. Of classes
that fit one bucket all are compared, and the answer is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passages.operators.cells import SCORE_UNIT, nonzero, upto, vector_matrix
from passages.operators.embedding import EMBEDDING_DIM
from passages.operators.joins import join_lookup
from passages.operators.scoring import to_units
from passages.session import scratch_path

BUCKET_ROWS = 4096
MAX_BITS = 24
SEED = 20_240_229
COUNTS = "key string, links bigint"


def meeting_chance(threshold: float, bits: int) -> float:
    """Chance that two vectors at cosine ``threshold`` differ in at most one of ``bits`` signs."""
    same = 1 - math.acos(threshold) / math.pi
    return same**bits + bits * (1 - same) * same ** max(bits - 1, 0)


def table_count(threshold: float, bits: int, recall: float) -> int:
    """Tables after which a pair at the threshold has met with probability ``recall``."""
    chance = meeting_chance(threshold, bits)
    return 1 if chance >= recall else math.ceil(math.log(1 - recall) / math.log(1 - chance))


def similar_pairs_approx(
    points: DataFrame,
    threshold: float = 0.8,
    id: str = "id",
    vector: str = "embedding",
    dim: int = EMBEDDING_DIM,
    recall: float = 0.95,
    bucket_rows: int = BUCKET_ROWS,
    block_rows: int = 2048,
) -> DataFrame:
    """``(id, class_id, links)`` of every point with an id and a vector.

    ``class_id`` is the smallest id of the same vector, ``links`` the number of other classes
    whose cosine, to six decimals, is at least ``threshold``. No link is false; one at the
    threshold is found with probability ``recall``, more similar ones more often. A zero
    vector links with nothing. Every row of a repeated id is answered. A group of ``m``
    classes that all link is compared in ``m^2 / block_rows^2`` units, and never returned as
    pairs.
    """
    if not 0 < threshold <= 1 or not 0 < recall < 1:
        raise ValueError("threshold must be in (0, 1] and recall in (0, 1)")
    points = points.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v"))
    points = points.where("id IS NOT NULL AND v IS NOT NULL")
    # Values of equal text are equal; 128 bits and more tell the others apart.
    points = points.withColumn("key", F.sha2(F.concat_ws(",", F.col("v").cast("array<string>")), 256))
    classes = _stored(
        points.groupBy("key").agg(F.min("id").alias("id"), F.first("v").alias("v")), "classes"
    )
    members = join_lookup(
        points.select("id", "key"), classes.select("key", F.col("id").alias("class_id")), "key", ["id"]
    )
    counts = _links(classes.where(nonzero("v")), threshold, dim, recall, bucket_rows, block_rows)
    counts = _stored(counts.groupBy("key").agg(F.sum("links").alias("links")), "links")
    return join_lookup(members, counts, "key", ["id"]).select(
        "id", "class_id", F.coalesce("links", F.lit(0)).alias("links")
    )


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _links(
    classes: DataFrame, threshold: float, dim: int, recall: float, bucket_rows: int, block_rows: int
) -> DataFrame:
    """Counts ``(key, links)``, one or more rows for each class that links."""
    bits = min(max(math.ceil(math.log2(max(classes.count(), 1) / bucket_rows)), 0), MAX_BITS)
    tables = table_count(threshold, bits, recall)
    directions = np.random.default_rng(SEED).standard_normal((dim, tables * bits))
    powers = 1 << np.arange(bits)

    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = vector_matrix(batch.column(1), dim) @ directions > 0
            codes = (above.reshape(len(batch), tables, bits) @ powers).astype(np.int32)
            codes = pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), tables)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), codes.cast(pa.list_(pa.int32()))],
                ["key", "v", "codes"],
            )

    kind = classes.schema["v"].dataType.simpleString()
    coded = classes.select("key", "v").mapInArrow(signs, f"key string, v {kind}, codes array<int>")
    coded = _stored(coded, "codes")
    one_away = F.filter(
        F.array(F.lit(0), *[F.lit(1 << b) for b in range(bits)]),
        lambda bit: (bit == 0) | (F.col("code").bitwiseAND(bit) != 0),
    )
    entries = (
        coded.select("key", "v", "codes", F.posexplode("codes").alias("t", "code"))
        .withColumn("bit", F.explode(one_away))
        .select("key", "v", "codes", "t", F.col("code").bitwiseXOR(F.col("bit")).alias("code"),
                (F.col("bit") != 0).alias("guest"))
    )
    at_home = F.count_if(~F.col("guest"))
    blocks = (
        entries.groupBy("t", "code")
        .agg(at_home.alias("home"), (F.count("*") - at_home).alias("guests"))
        .where("home > 0")
        .select("t", "code", *[F.ceil(F.col(c) / block_rows).cast("int").alias(c)
                               for c in ("home", "guests")])
    )
    placed = entries.join(blocks, ["t", "code"]).withColumn(
        "block",
        F.pmod(F.xxhash64("key"), F.when(F.col("guest"), F.col("guests")).otherwise(F.col("home")))
        .cast("int"),
    )
    # A unit is a block at home with itself, a later one, or a block of guests.
    common = ["key", "v", "codes", "t", "code"]
    own = placed.where("NOT guest")
    left = own.select(
        *common, F.lit(0).alias("side"), F.col("block").alias("a"),
        F.explode(upto(F.col("block"), F.col("home") + F.col("guests") - 1)).alias("b"),
    )
    right = own.select(
        *common, F.lit(1).alias("side"),
        F.explode(upto(F.lit(0), F.col("block") - 1)).alias("a"), F.col("block").alias("b"),
    )
    visiting = placed.where("guest").select(
        *common, F.lit(1).alias("side"),
        F.explode(upto(F.lit(0), F.col("home") - 1)).alias("a"),
        (F.col("home") + F.col("block")).alias("b"),
    )
    units = left.unionByName(right).unionByName(visiting).groupBy("t", "code", "a", "b")
    return units.applyInArrow(_count_links(threshold, dim), COUNTS)


def _count_links(threshold: float, dim: int):
    """Function from one unit to the links that each of its classes has there."""
    least = math.ceil(round(threshold * SCORE_UNIT, 3))

    def run(unit: pa.Table) -> pa.Table:
        side, keys = unit["side"].to_numpy(), unit["key"].combine_chunks()
        table = unit["t"][0].as_py()
        same = unit["a"][0].as_py() == unit["b"][0].as_py()
        vectors = vector_matrix(unit["v"].combine_chunks(), dim)
        codes = unit["codes"].combine_chunks().flatten().to_numpy().reshape(len(keys), -1)
        squares = (vectors**2).sum(1)
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        scores = to_units(
            vectors[left] @ vectors[right].T, np.sqrt(np.outer(squares[left], squares[right]))
        )
        row, column = np.nonzero(np.triu(scores >= least, 1) if same else scores >= least)
        row, column = left[row], right[column]
        for earlier in range(table):  # met there already: at most one sign apart
            differ = codes[row, earlier] ^ codes[column, earlier]
            new = (differ & (differ - 1)) != 0
            row, column = row[new], column[new]
        counts = np.bincount(np.concatenate([row, column]), minlength=len(keys))
        some = np.flatnonzero(counts)
        return pa.table([keys.take(pa.array(some)), counts[some]], names=["key", "links"])

    return run
