"""Ranked lexical search over K2-treaps of the term-document grid.

A grid has a row for each term and a column for each document of a block; a cell holds what
the term adds to the document's score, its impact. The treap halves rows and columns level
by level; of each square it keeps which quarters hold cells, four bits, and the largest
impact in it, as the difference to the square around. Blocks are rows of a stored index.

A query's terms are rows. It descends all their paths at once over ranges of documents: a
range is bounded by the sum of its rows' maxima, the range with the largest bound is halved
next, and ranges whose bound is below the k-th best score so far go. At a single document the
maxima are the impacts, so the sum is the score. A task keeps its best across its blocks.

Terms are ordered by weight and documents of a block by length, which keeps impacts of
neighbours alike and bounds tight.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from passages.llm.common import map_texts, store
from passages.llm.filters import pieces
from passages.llm.hashing import lists_of, pack_ints, unpack_ints

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Each byte of a term as it counts, and white space for all others.
TERM_BYTES = bytes(
    ord(chr(c).lower()) if c < 128 and chr(c).isalnum() else c if c > 127 else 32 for c in range(256)
)
# Terms and items that are searched at once: what is shipped to every task.
SLICE_BYTES = 8 << 20
# A block ends at so many documents or cells.
BLOCK_DOCS, BLOCK_CELLS = 1 << 13, 1 << 20
# Ranges that are halved at once.
BATCH = 128
FIRST_ROUND = 256
BITS_BELOW = np.array([[bin(m & ((1 << q) - 1)).count("1") for q in range(4)] for m in range(16)], np.int64)


def item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, term)``: the distinct terms of each item; those without id are left out."""
    lowered = F.translate("text", UPPER, LOWER)
    return items.where("item_id IS NOT NULL").select(
        "item_id", F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term")
    ).distinct()


def in_slices(terms: DataFrame, most_bytes: int) -> Iterator[pa.Table]:
    """The stored ``(item_id, term)`` in slices of whole items, each small enough to ship."""
    size = terms.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    slices = -(-size // most_bytes)
    number = F.pmod(F.xxhash64("item_id"), F.lit(max(slices, 1)))
    for i in range(slices):
        yield terms.where(number == i).toArrow().sort_by([("item_id", "ascending"), ("term", "ascending")])


def term_counts(documents: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``(doc_id, n, terms, counts)``: terms of each text, and how often each asked one is in it."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def work():
        place = {term.encode(): i for i, term in enumerate(shared.value)}

        def step(block: pa.RecordBatch) -> dict:
            lengths, terms, counts = [], [], []
            for raw in block.column(1).cast(pa.binary()).to_pylist():
                n, times = 0, Counter()
                for piece in pieces(raw.translate(TERM_BYTES)):
                    words = piece.split()
                    n += len(words)
                    times.update(words)
                own = sorted((place[w], times[w]) for w in times.keys() & place.keys())
                lengths.append(n)
                terms.append([t for t, _ in own])
                counts.append([c for _, c in own])
            return {"doc_id": block.column(0), "n": lengths, "terms": terms, "counts": counts}

        return step

    schema = "doc_id bigint, n bigint, terms array<int>, counts array<bigint>"
    return map_texts(documents, schema, work)


class Grid:
    """A K2-treap: ``masks`` of all squares that are split and ``maxima`` of all squares,
    both level by level; ``docs`` are the ids of its columns."""

    def __init__(self, height: int, docs: np.ndarray, masks: np.ndarray, maxima: np.ndarray):
        self.height, self.docs, self.masks, self.maxima = height, docs, masks, maxima
        children = BITS_BELOW[masks, 3] + (masks >> 3 & 1)
        # Squares are numbered level by level, so the first child follows all earlier ones.
        self.first = 1 + np.cumsum(children) - children

    @classmethod
    def build(cls, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, docs: np.ndarray):
        """From cells with values above 0, no two at one place, one cell at least."""
        side = max(int(rows.max()), int(columns.max()))
        height = max(side.bit_length(), 1)
        code = np.zeros(len(rows), np.int64)
        for bit in range(height):
            code |= ((rows >> bit & 1) * 2 + (columns >> bit & 1)).astype(np.int64) << (2 * bit)
        order = np.argsort(code)
        code, values = code[order], values[order]
        masks, maxima = [], []
        for level in range(height, -1, -1):
            new = np.ones(len(code), bool)
            new[1:] = code[1:] != code[:-1]
            begins = np.flatnonzero(new)
            code, values = code[begins], np.maximum.reduceat(values, begins)
            maxima.append(values)
            if level:
                parent = code >> 2
                first = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
                masks.append(np.bitwise_or.reduceat(1 << (code & 3), first).astype(np.uint8))
                code = parent
        return cls(height, docs, np.concatenate(masks[::-1]), np.concatenate(maxima[::-1]))

    def parents(self) -> np.ndarray:
        """The square around each one but the first."""
        children = BITS_BELOW[self.masks, 3] + (self.masks >> 3 & 1)
        return np.repeat(np.arange(len(self.masks)), children)

    def packed(self) -> dict:
        """Masks two to a byte, and maxima as differences to the square around."""
        even = np.append(self.masks, np.zeros(len(self.masks) % 2, np.uint8))
        below = self.maxima[self.parents()] - self.maxima[1:]
        return {
            "height": self.height, "docs": self.docs.astype("<i8").tobytes(),
            "squares": len(self.masks), "masks": (even[::2] | even[1::2] << 4).tobytes(),
            "largest": int(self.maxima[0]), "below": pack_ints(below.astype(np.uint64)),
        }

    @classmethod
    def unpacked(cls, row: dict) -> Grid:
        two = np.frombuffer(row["masks"], np.uint8)
        masks = np.stack([two & 15, two >> 4], axis=1).reshape(-1)[:row["squares"]]
        below = unpack_ints(row["below"]).astype(np.int64)
        grid = cls(row["height"], np.frombuffer(row["docs"], "<i8"), masks, np.zeros(0, np.int64))
        parents, around = grid.parents(), np.full(len(below) + 1, row["largest"], np.int64)
        # A level's squares need those of the level above, which are a prefix of all.
        done = 1
        while done <= len(below):
            end = int(np.searchsorted(parents, done)) + 1
            around[done:end] = around[parents[done - 1:end - 1]] - below[done - 1:end - 1]
            done = end
        grid.maxima = around
        return grid

    def search(self, rows: np.ndarray, best: Best) -> int:
        """Offer the best documents for the sum over ``rows``; gives the squares looked at."""
        bits = (rows[None, :] >> np.arange(self.height - 1, -1, -1)[:, None]) & 1
        level, column = np.zeros(1, np.int64), np.zeros(1, np.int64)
        square = np.zeros((1, len(rows)), np.int64)
        bound, looked = np.full(1, int(self.maxima[0]) * len(rows), np.int64), 0
        while True:
            keep = bound >= best.least
            if not keep.all():
                level, column, square, bound = level[keep], column[keep], square[keep], bound[keep]
            if not len(bound):
                return looked
            if len(bound) > BATCH:
                order = np.argpartition(-bound, BATCH)
                now, later = order[:BATCH], order[BATCH:]
            else:
                now, later = np.arange(len(bound)), np.zeros(0, np.int64)
            found = [self.halved(level[now], column[now], square[now], bits, half) for half in (0, 1)]
            looked += 2 * len(now) * len(rows)
            halves = [np.concatenate(parts) for parts in zip(*found)]
            at_end = (halves[0] == self.height) & (halves[3] > 0)
            if at_end.any():
                best.offer(halves[3][at_end], self.docs[halves[1][at_end]])
            open_ = (halves[0] < self.height) & (halves[3] >= best.least)
            level, column, square, bound = (
                np.concatenate([old[later], new[open_]])
                for old, new in zip((level, column, square, bound), halves)
            )

    def halved(
        self, level: np.ndarray, column: np.ndarray, square: np.ndarray, bits: np.ndarray, half: int
    ) -> tuple[np.ndarray, ...]:
        """One half of the ranges: level, column, the rows' squares (-1: empty) and bounds."""
        inside = np.maximum(square, 0)
        quarter = bits[level] * 2 + half
        mask = self.masks[inside]
        held = (square >= 0) & ((mask >> quarter.astype(np.uint8)) & 1 > 0)
        child = np.where(held, self.first[inside] + BITS_BELOW[mask, quarter], 0)
        bound = np.where(held, self.maxima[child], 0).sum(axis=1)
        return level + 1, column * 2 + half, np.where(held, child, -1), bound


class Best:
    """The ``k`` highest scores above 0, equal ones by the smaller id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """The lowest score that may still come in."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]


def term_weights(documents: int, frequency: np.ndarray) -> np.ndarray:
    return np.array([
        math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in frequency
    ], np.int64)


def impacts(
    lengths: np.ndarray, documents: int, terms: int, counts: np.ndarray, weights: np.ndarray,
    of: np.ndarray,
) -> np.ndarray:
    """Impact of each cell; ``of`` is its document's place in ``lengths``."""
    measure = np.array([100 - 90 + 90 * int(n) * documents // terms for n in lengths], np.int64)
    return weights * (1_000_000_000 * counts // (1000 * counts + 8 * measure[of]))


INDEX = "height int, docs binary, squares bigint, masks binary, largest bigint, below binary"


def index_documents(
    postings: DataFrame, weights: np.ndarray, documents: int, terms: int,
    block_docs: int = BLOCK_DOCS, block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """The rows of ``postings`` in blocks, a treap each. Weights are by place of a term.

    A term's row is its place in the order of weights. Documents without any impact have no
    column, as no query finds them.
    """
    shared = postings.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        row_of = np.argsort(np.argsort(-weight, kind="stable"))
        waiting: list[tuple[np.ndarray, ...]] = []
        docs = cells = 0

        def block() -> Iterator[pa.RecordBatch]:
            ids, lengths, sizes, term, count = (np.concatenate(parts) for parts in zip(*waiting))
            doc = np.repeat(np.arange(len(ids)), sizes)
            value = impacts(lengths, documents, terms, count, weight[term], doc)
            term, doc, value = term[value > 0], doc[value > 0], value[value > 0]
            if not len(value):
                return
            order = np.lexsort((ids, lengths))
            place = np.argsort(order)
            row = Grid.build(row_of[term], place[doc], value, ids[order]).packed()
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("height", pa.int32()), ("docs", pa.binary()), ("squares", pa.int64()),
                ("masks", pa.binary()), ("largest", pa.int64()), ("below", pa.binary())]))

        for batch in batches:
            sizes = batch.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            begin = 0
            while begin < batch.num_rows:
                room = max(block_cells - cells, 1) + (int(ends[begin - 1]) if begin else 0)
                end = int(np.searchsorted(ends, room, side="right"))
                end = min(max(end, begin + 1), begin + block_docs - docs, batch.num_rows)
                part = batch.slice(begin, end - begin)
                waiting.append((
                    part.column(0).to_numpy(), part.column(1).to_numpy(), sizes[begin:end],
                    part.column(2).flatten().to_numpy().astype(np.int64),
                    part.column(3).flatten().to_numpy(),
                ))
                docs, cells = docs + end - begin, cells + int(sizes[begin:end].sum())
                begin = end
                if docs >= block_docs or cells >= block_cells:
                    yield from block()
                    waiting, docs, cells = [], 0, 0
        if waiting:
            yield from block()

    return postings.where("size(terms) > 0").mapInArrow(run, INDEX)


def search_index(
    index: DataFrame, items: list[int], rows: list[np.ndarray], weights: np.ndarray, k: int
) -> DataFrame:
    """``(item_id, doc_id, score)``: the ``k`` best documents that each task has for an item.

    ``rows`` holds the places of each item's terms in ``weights``.
    """
    shared = index.sparkSession.sparkContext.broadcast((items, rows, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, rows, weights = shared.value
        row_of = np.argsort(np.argsort(-weights, kind="stable"))
        best = [Best(k) for _ in items]
        for batch in batches:
            for i in range(batch.num_rows):
                grid = Grid.unpacked(batch.slice(i, 1).to_pylist()[0])
                for own, found in zip(rows, best):
                    known = row_of[own]
                    grid.search(known[known < 1 << grid.height], found)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.array(items, np.int64), [len(b.ids) for b in best])),
            pa.array(np.concatenate([np.zeros(0, np.int64), *[b.ids for b in best]])),
            pa.array(np.concatenate([np.zeros(0, np.int64), *[b.scores for b in best]])),
        ], ["item_id", "doc_id", "score"])

    return index.mapInArrow(run, "item_id bigint, doc_id bigint, score bigint")


def _cut(found: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked_search(
    documents: DataFrame, items: DataFrame, k: int = 10, slice_bytes: int = SLICE_BYTES,
    block_docs: int = BLOCK_DOCS, block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best of ``documents`` for each item.

    ``documents`` is ``(doc_id, text)`` and ``items`` ``(item_id, text)``; other columns are
    ignored. NULL texts have no terms; rows without id are left out, of the counts too; rows
    that repeat a doc_id are documents of their own, rows that repeat an item_id are one
    item. Equal scores rank by doc_id. Items without terms, and empty tables, give no row.
    Items are searched in slices of ``slice_bytes``, each against all documents.
    """
    texts = documents.select("doc_id", "text").where("doc_id IS NOT NULL")
    found = documents.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for terms in in_slices(store(item_terms(items), "terms"), slice_bytes):
        vocabulary = sorted(set(terms["term"].to_pylist()))
        place = {term: i for i, term in enumerate(vocabulary)}
        postings = store(term_counts(texts, vocabulary), "postings")
        total = postings.agg(
            F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("terms")
        ).first()
        if not total.documents:
            continue
        frequency = np.zeros(len(vocabulary), np.int64)
        counted = postings.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()
        frequency[counted["t"].to_numpy()] = counted["count"].to_numpy()
        weights = term_weights(total.documents, frequency)
        index = store(
            index_documents(postings, weights, total.documents, total.terms, block_docs, block_cells),
            "index",
        )
        own: dict[int, list[int]] = {}
        for item, term in zip(terms["item_id"].to_pylist(), terms["term"].to_pylist()):
            own.setdefault(item, []).append(place[term])
        hits = search_index(index, list(own), [np.array(t) for t in own.values()], weights, k)
        # Each of a bounded number of tasks first cuts what many tasks have found.
        hits = hits.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(FIRST_ROUND)))
        best = _cut(_cut(hits, k, "item_id", "part").drop("rank"), k, "item_id")
        found = found.unionByName(store(best.select("item_id", "rank", "doc_id", "score"), "hits"))
    return found
