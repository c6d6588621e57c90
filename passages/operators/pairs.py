"""The most similar pairs of a table of vectors, exactly and without a cross join.

1. Of identical vectors only the ``limit + 1`` smallest ids stay. A pair with any other
   copy is preceded by ``limit`` pairs of the same score and smaller ids, so no answer
   is lost, and a vector that a third of the table shares costs a handful of rows.
2. Points go to cells (see ``cells``). The best pairs inside blocks of cells give a
   floor under the answer's last score.
3. A point visits another cell only if a pair above that floor is possible there.
4. Cells are cut into blocks of ``block_rows``; a task multiplies two blocks and
   returns ``limit`` pairs.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passages.operators.cells import (
    MAX_PIVOTS, SCORE_UNIT, Cells, array_of, few_copies, in_blocks, nonzero, upto, vector_matrix,
)
from passages.operators.embedding import EMBEDDING_DIM
from passages.operators.scoring import best_pairs

PAIRS = "i bigint, j bigint, score_units bigint"


def pairwise_similarity(
    points: DataFrame,
    limit: int = 5,
    id: str = "id",
    vector: str = "embedding",
    dim: int = EMBEDDING_DIM,
    block_rows: int = 16_384,
) -> DataFrame:
    """``(i, j, score)``: the ``limit`` pairs ``i < j`` of highest cosine.

    Equal scores (to six decimals) rank by ``i``, then ``j``; zero vectors have no score.
    """
    points = points.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v"))
    points = points.where(nonzero("v"))
    if points.count() > block_rows:
        points = few_copies(points, limit + 1)
    pivots = min(-(-points.count() // block_rows), MAX_PIVOTS)
    if pivots <= 1:
        units = points.withColumn("side", F.lit(0)).groupBy(F.lit(0).alias("cell"))
        return _ranked(units.applyInArrow(_best_pairs(dim, limit, same_block=True), PAIRS), limit)
    return _ranked(_pairs_by_cell(points, limit, dim, block_rows, pivots), limit)


def _ranked(pairs: DataFrame, limit: int) -> DataFrame:
    return (
        pairs.orderBy(F.desc("score_units"), "i", "j")
        .limit(limit)
        .select("i", "j", (F.col("score_units") / SCORE_UNIT).alias("score"))
    )


def _pairs_by_cell(
    points: DataFrame, limit: int, dim: int, block_rows: int, pivots: int
) -> DataFrame:
    cells = Cells(points, dim, pivots, block_rows)
    inside = cells.located.withColumn("side", F.lit(0))
    near = inside.groupBy("cell", "block").applyInArrow(
        _best_pairs(dim, limit, same_block=True), PAIRS
    )
    best = near.orderBy(F.desc("score_units"), "i", "j").limit(limit).collect()
    floor = best[-1]["score_units"] if len(best) == limit else None
    visitors = cells.visits(
        points.withColumn("floor", F.lit(floor).cast("bigint")), "bigint", "later"
    )
    guests = cells.guest_blocks(visitors)
    home_count = array_of(cells.blocks, F.col("cell"))
    guest_count = array_of(guests, F.col("cell"))

    # A unit is a pair of blocks of a cell: home with a later home block, or home with
    # a visiting block. Pairs within one home block are already in ``near``.
    left = cells.located.select(
        "id", "v", F.lit(0).alias("side"), "cell", F.col("block").alias("a"),
        F.explode(upto(F.col("block") + 1, home_count + guest_count - 1)).alias("b"),
    )
    right = cells.located.select(
        "id", "v", F.lit(1).alias("side"), "cell",
        F.explode(upto(F.lit(0), F.col("block") - 1)).alias("a"), F.col("block").alias("b"),
    )
    visiting = in_blocks(visitors, guests).select(
        "id", "v", F.lit(1).alias("side"), "cell",
        F.explode(upto(F.lit(0), home_count - 1)).alias("a"),
        (home_count + F.col("block")).alias("b"),
    )
    units = left.unionByName(right).unionByName(visiting).groupBy("cell", "a", "b")
    return near.unionByName(
        units.applyInArrow(_best_pairs(dim, limit, same_block=False), PAIRS)
    )


def _best_pairs(dim: int, limit: int, same_block: bool):
    """Function from one block pair to its ``limit`` best pairs."""

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        ids = table.column("id").to_numpy()
        vectors = vector_matrix(table.column("v").combine_chunks(), dim)
        if same_block:
            found = best_pairs(ids, vectors, limit)
        else:
            left, right = side == 0, side == 1
            found = best_pairs(ids[left], vectors[left], limit, ids[right], vectors[right])
        return pa.table(
            [pa.array([p[n] for p in found], pa.int64()) for n in range(3)],
            names=["i", "j", "score_units"],
        )

    return run
