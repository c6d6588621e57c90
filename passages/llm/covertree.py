"""Exact top-k search by inner product: dual traversal of cover trees.

Both sides go to the nodes of a shared top level, fitted on a bounded sample; every row is
indexed. For a query node and a data node with centres ``c``, ``d`` and covering radii
``r``, ``s`` no score exceeds ``c.d + r|d| + s|c| + rs``. A pair whose bound does not reach
the worst k-th score of the query group is pruned: first between the top nodes, with
scores against the sample as floors, then inside each task between the cover trees of its
queries and its points.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from passages.llm.common import store

SAMPLE_ROWS = 1024
TOP_NODES = 32
# Rows of one data block and of one slice of queries, and their bytes: what a task holds.
BLOCK_ROWS = 8192
SLICE_ROWS = 16_384
BLOCK_BYTES = 16 << 20
LEAF_ROWS = 64
# Queries of one group: few, as the worst of their floors counts for all.
GROUP_ROWS = 16
# Points scored between two looks at the floor of a query group.
STEP_ROWS = 512
# Integers below this are exact in double precision, sums of products included.
EXACT = float(1 << 53)
LEAST, MOST = -(1 << 63), (1 << 63) - 1
# An answer that is still missing: no row has its place in the order.
NO_ID = np.iinfo(np.int64).max
SLACK = 1e-9


def spread_centres(points: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows chosen one after the other, each the farthest from those before, and how far.

    Those chosen from farther than ``t`` are more than ``t`` apart, and every row is within
    ``t`` of one of them: the separation and the covering of a cover tree's level.
    """
    chosen, reach = [0], [math.inf]
    away = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < min(most, len(points)):
        far = int(away.argmax())
        if not away[far] > 0:
            break
        chosen.append(far)
        reach.append(float(away[far]))
        away = np.minimum(away, np.linalg.norm(points - points[far], axis=1))
    return np.array(chosen), np.array(reach)


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (points**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * points @ centres.T
    return np.sqrt(np.maximum(square, 0))


class CoverTree:
    """Nodes by number: ``centre`` (a row), ``level``, ``radius``, ``children``, rows.

    The centres of level ``l`` are more than ``2^l`` apart; a child of level ``l`` is within
    ``2^(l+1)`` of its parent; a node that has children is, one level lower, its own child.
    Levels at which a node has no other child are not kept. Centres end at one for each
    ``leaf_rows`` rows: what is below a leaf is a list of rows. The rows of node ``n`` are
    ``order[begin[n]:end[n]]`` and its radius is the largest distance to one of them.
    """

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        chosen, reach = spread_centres(points, max(len(points) // leaf_rows, 1))
        levels = [math.ceil(math.log2(r)) - 1 if 0 < r < math.inf else None for r in reach]
        top = levels[1] + 1 if len(chosen) > 1 and levels[1] is not None else 0
        nearest = np.zeros(len(points), np.int64)
        away = np.linalg.norm(points - points[0], axis=1)
        above = nearest
        self.centre, self.level, self.children, self.parent = [0], [top], [[]], [-1]
        current, begun = [0], None
        for place, row in enumerate(chosen[1:], 1):
            level = levels[place]
            if level != begun:  # the parents are those of the level above, as it is whole
                begun, above, split = level, nearest.copy(), {}
            over = int(above[row])
            if over not in split:
                split[over] = current[over]
                current[over] = self._add(int(chosen[over]), level, split[over])
            current.append(self._add(int(row), level, split[over]))
            new = np.linalg.norm(points - points[row], axis=1)
            closer = new < away
            nearest[closer], away = place, np.minimum(away, new)
        owners = np.argsort(nearest, kind="stable")
        bounds = np.searchsorted(nearest[owners], np.arange(len(chosen) + 1))
        own = {current[i]: owners[bounds[i]:bounds[i + 1]] for i in range(len(chosen))}
        self.begin, self.end = [0] * len(self.centre), [0] * len(self.centre)
        order, size, stack = [], 0, [(0, False)]
        while stack:
            node, done = stack.pop()
            if done:
                self.end[node] = size
                continue
            self.begin[node] = size
            if node in own:
                order.append(own[node])
                size += len(own[node])
            stack.append((node, True))
            stack += [(child, False) for child in self.children[node]]
        self.order = np.concatenate(order)
        self.points = points[self.order]
        self.centres = points[self.centre]
        self.radius = np.array([
            np.linalg.norm(self.points[b:e] - c, axis=1).max(initial=0.0)
            for b, e, c in zip(self.begin, self.end, self.centres)
        ])
        self.length = np.linalg.norm(self.centres, axis=1)
        self.leaf = np.array([not c for c in self.children])

    def _add(self, row: int, level: int, parent: int) -> int:
        self.centre.append(row)
        self.level.append(level)
        self.children.append([])
        self.parent.append(parent)
        self.children[parent].append(len(self.centre) - 1)
        return len(self.centre) - 1


class Best:
    """The ``k`` best points of each query: larger scores first, then smaller ids."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = np.full((queries, k), LEAST, np.int64)
        self.ids = np.full((queries, k), NO_ID)

    def worst(self, rows: np.ndarray | slice) -> np.ndarray:
        missing = self.ids[rows, -1] == NO_ID
        return np.where(missing, -np.inf, self.scores[rows, -1].astype(float))

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores[rows], scores], axis=1)
        ids = np.concatenate([self.ids[rows], ids], axis=1)
        # ~score falls as the score rises, and has no overflow at either end.
        order = np.lexsort((ids, ~scores), axis=1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(scores, order, 1)
        self.ids[rows] = np.take_along_axis(ids, order, 1)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; beyond 64 bits the nearest end of the range."""
    long = np.linalg.norm(left, axis=1) * np.linalg.norm(right, axis=1).max(initial=0.0) >= EXACT
    out = np.empty((len(left), len(right)), np.int64)
    out[~long] = (left[~long] @ right.T).astype(np.int64)
    if long.any():
        whole = [[int(x) for x in row] for row in right]
        for at in np.flatnonzero(long):
            own = [int(x) for x in left[at]]
            out[at] = [
                min(max(sum(a * b for a, b in zip(own, row)), LEAST), MOST) for row in whole
            ]
    return out


class DualSearch:
    """Descends the query tree, each node with the data nodes that may still answer it."""

    def __init__(
        self, query_ids, queries, floors, ids, points, k, leaf_rows=LEAF_ROWS,
        group_rows=GROUP_ROWS, step_rows=STEP_ROWS,
    ):
        self.q, self.p = CoverTree(queries, group_rows), CoverTree(points, leaf_rows)
        self.step_rows = step_rows
        self.query_ids, self.ids = query_ids[self.q.order], ids[self.p.order]
        self.floors = np.clip(floors[self.q.order], float(LEAST), float(MOST))
        self.best = Best(len(queries), k)
        self.scored = 0
        # Rounding of the bound; scores themselves are exact.
        self.slack = SLACK * max(
            1.0, float(np.linalg.norm(queries, axis=1).max() * np.linalg.norm(points, axis=1).max())
        )

    def run(self) -> Best:
        stack = [(0, np.zeros(1, np.int64))]
        while stack:
            node, left = stack.pop()
            left = self.narrow(node, left)
            if not len(left):
                continue
            if self.q.leaf[node]:
                self.score(node, left)
            else:
                stack += [(child, left) for child in self.q.children[node]]
        return self.best

    def bounds(self, node: int, left: np.ndarray) -> np.ndarray:
        """What no score between the rows of ``node`` and those of each data node exceeds."""
        q, p = self.q, self.p
        return (
            p.centres[left] @ q.centres[node] + q.radius[node] * p.length[left]
            + p.radius[left] * q.length[node] + q.radius[node] * p.radius[left] + self.slack
        )

    def worst(self, node: int) -> float:
        rows = slice(self.q.begin[node], self.q.end[node])
        return float(np.maximum(self.best.worst(rows), self.floors[rows]).min())

    def narrow(self, node: int, left: np.ndarray) -> np.ndarray:
        """Data nodes within reach, opened where they are wider than ``node``."""
        while True:
            # A score equal to the floor may still win by its smaller id; NaN rules nothing out.
            left = left[~(self.bounds(node, left) < self.worst(node))]
            wide = ~self.p.leaf[left]
            if not self.q.leaf[node]:
                wide &= self.p.radius[left] >= self.q.radius[node]
            if not wide.any():
                return left
            opened = [c for n in left[wide] for c in self.p.children[n]]
            left = np.concatenate([left[~wide], np.array(opened, np.int64)])

    def score(self, node: int, left: np.ndarray) -> None:
        """Score data leaves from the best bound down; here each query has its own bound.

        A query is a ball without radius, so its bounds and its floor are tighter than those of
        its group. Of each step only the queries are scored that one of its leaves may answer.
        """
        rows = np.arange(self.q.begin[node], self.q.end[node])
        own = self.q.points[rows]
        bounds = (
            own @ self.p.centres[left].T
            + np.linalg.norm(own, axis=1)[:, None] * self.p.radius[left] + self.slack
        )
        order = np.argsort(-bounds.max(0), kind="stable")
        left, bounds = left[order], bounds[:, order]
        step = np.array([self.p.end[n] - self.p.begin[n] for n in left]).cumsum() // self.step_rows
        for at in np.unique(step):
            floor = np.maximum(self.best.worst(rows), self.floors[rows])[:, None]
            open_ = ~(bounds < floor) & (step == at)
            asked, taken = open_.any(1), left[open_.any(0)]
            if not len(taken):
                continue
            found = np.concatenate([np.arange(self.p.begin[n], self.p.end[n]) for n in taken])
            scores = products(own[asked], self.p.points[found])
            self.scored += scores.size
            wins = (scores + self.slack >= floor[asked]).any(0)
            scores = scores[:, wins]
            ids = np.broadcast_to(self.ids[found[wins]], scores.shape)
            itself = self.query_ids[rows[asked]][:, None] == ids
            self.best.add(
                rows[asked], np.where(itself, LEAST, scores), np.where(itself, NO_ID, ids)
            )


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, v)``: each component ``x`` as ``floor(256 * x)``, a whole number.

    Rows without id, vectors that are NULL or empty, and those with a component that is NULL
    or not finite, also once it is multiplied, are left out.
    """
    times = F.transform("embedding", lambda x: x.cast("double") * 256)
    finite = F.forall("t", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    # Beyond 2^52 every double is a whole number, and floor() would end at 64 bits.
    whole = F.transform(
        "t", lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)
    )
    return (
        embeddings.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0))
        .select("vec_id", times.alias("t")).where(finite).select("vec_id", whole.alias("v"))
    )


def _matrix(column, width: int) -> np.ndarray:
    """Rows of a list column; a shorter one ends in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def top_scores(
    embeddings: DataFrame, every: int = 50, k: int = 5, sample_rows: int = SAMPLE_ROWS,
    top_nodes: int = TOP_NODES, block_rows: int = BLOCK_ROWS, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best rows of each query, but itself.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; all rows are searched.
    Ties go to the smaller id. Of vectors of unequal length the shorter one counts as ended
    by zeros. Scores are exact; one beyond 64 bits counts as the nearest end of that range.
    Rows that repeat an id are each searched, the repeated query id is asked once (one of
    its rows, by smallest vector); a row never answers a query of its own id. An empty table
    gives no row; other columns are ignored.

    A data node larger than ``block_rows`` is split by a hash of the row, so copies of one
    vector spread over blocks; queries are ordered in slices. A block meets the queries
    of a slice that the bounds leave to its node.
    """
    spark = embeddings.sparkSession
    result = "query_id bigint, rank int, vec_id bigint, score bigint"
    vectors = store(integer_vectors(embeddings), "vectors")
    width = vectors.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return spark.createDataFrame([], result)
    fitting = max(BLOCK_BYTES // (8 * width), 1)
    block_rows, slice_rows = min(block_rows, fitting), min(slice_rows, fitting)
    sample = (
        vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(min(sample_rows, fitting)).toArrow()
    )
    sample_ids, drawn = sample["vec_id"].to_numpy(), _matrix(sample["v"], width)
    centres = drawn[spread_centres(drawn, top_nodes)[0]]
    longest = float(np.linalg.norm(drawn, axis=1).max())

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        for batch in batches:
            for begin in range(0, batch.num_rows, fitting):
                part = batch.slice(begin, fitting)
                yield part, _matrix(part.column(1), width)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in parts(batches):
            node = distances(own, centres).argmin(1)
            away = np.linalg.norm(own - centres[node], axis=1)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(node.astype(np.int32)), pa.array(away)],
                ["vec_id", "v", "node", "away"],
            )

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in parts(batches):
            scores = own @ drawn.T
            scores[part.column(0).to_numpy()[:, None] == sample_ids] = -np.inf
            kth = np.full(len(own), -np.inf)
            if scores.shape[1] >= k:
                kth = np.partition(scores, -k, axis=1)[:, -k]
            rounding = np.linalg.norm(own, axis=1) * longest
            kth = kth - np.where(rounding < EXACT, 0.0, SLACK * rounding)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(kth)], [*part.schema.names, "floor"]
            )

    located = vectors.mapInArrow(locate, "vec_id bigint, v array<double>, node int, away double")
    located = store(located, "located")
    queries = (
        located.where(F.col("vec_id") % every == 0)
        .groupBy("vec_id").agg(F.min(F.struct("v", "node", "away")).alias("r"))
        .select("vec_id", "r.*")
        .mapInArrow(floors, "vec_id bigint, v array<double>, node int, away double, floor double")
    )
    queries = store(queries, "queries")
    balls = {r.node: r for r in located.groupBy("node").agg(
        F.max("away").alias("radius"), F.count("*").alias("rows")).collect()}
    groups = {r.node: r for r in queries.groupBy("node").agg(
        F.max("away").alias("radius"), F.min("floor").alias("floor"),
        F.count("*").alias("rows")).collect()}
    if not groups:
        return spark.createDataFrame([], result)
    slices = max(-(-sum(g.rows for g in groups.values()) // slice_rows), 1)
    length = np.linalg.norm(centres, axis=1)
    reach: dict[int, list[int]] = {}
    for a, group in groups.items():
        floor = min(max(group.floor, float(LEAST)), float(MOST))
        reach[a] = []
        for b, ball in balls.items():
            bound = (
                centres[a] @ centres[b] + group.radius * length[b] + ball.radius * length[a]
                + group.radius * ball.radius
            )
            slack = SLACK * max(1.0, (group.radius + length[a]) * (ball.radius + length[b]))
            if not bound + slack < floor:
                reach[a].append(b)
    blocks = {b: -(-ball.rows // block_rows) for b, ball in balls.items()}
    units = F.create_map(*[
        x for a, found in reach.items() for x in (
            F.lit(a),
            F.array(*[F.struct(F.lit(b).alias("node"), F.lit(blocks[b]).alias("blocks"))
                      for b in sorted(found)]),
        )
    ])
    slice_of = F.pmod(F.xxhash64("vec_id"), F.lit(slices)).cast("int")
    asked = (
        queries.withColumn("slice", slice_of)
        .select("vec_id", "v", "floor", "slice", F.explode(units[F.col("node")]).alias("u"))
        .select("vec_id", "v", "floor", "slice", F.col("u.node").alias("node"),
                F.explode(F.sequence(F.lit(0), F.col("u.blocks") - 1)).alias("block"))
        .select("node", "block", "slice", "vec_id", "v", "floor")
    )
    block_count = F.create_map(*[x for b, n in blocks.items() for x in (F.lit(b), F.lit(n))])
    held = (
        located.withColumn(
            "block", F.pmod(F.xxhash64("vec_id", "v"), block_count[F.col("node")]).cast("int"))
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        .select("node", "block", "slice", "vec_id", "v")
    )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names=names)
        search = DualSearch(
            left["vec_id"].to_numpy(), _matrix(left["v"], width), left["floor"].to_numpy(),
            right["vec_id"].to_numpy(), _matrix(right["v"], width), k,
        )
        best = search.run()
        row, column = np.nonzero(best.ids != NO_ID)
        return pa.table(
            [search.query_ids[row], best.ids[row, column], best.scores[row, column]], names=names,
        )

    unit = ("node", "block", "slice")
    met = asked.groupBy(*unit).cogroup(held.groupBy(*unit)).applyInArrow(
        meet, "query_id bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
