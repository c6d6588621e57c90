"""N-gram Jaccard join by prefixes of token combinations.

Documents are sets of five-word shingles; two link at a similarity of 0.75. Sets that are
equal are one class from the start. Then:

1. A set can only link if three quarters of its shingles also occur in another set. Every
   task sends its shingles' fingerprints by ranges, in byte planes; a range answers with
   counts of shared shingles per document. Only documents above that bound go on.
2. Their shingles are ordered from rare to frequent. A set's prefix is so long that the
   prefixes of two linked sets share ``m + 1`` shingles. Rare shingles are indexed one by
   one; frequent ones are dealt into ``m`` classes and indexed as combinations of two of
   one class: among ``m + 1`` shared shingles there is a rare one or two of one class.
   ``m`` follows the set's size, so combinations stay in proportion to it.
3. In each index entry the first sets are pivots: they meet the entry's other sets, pairs
   are verified exactly and linked sets merged into components. More pivots follow, but
   only where an entry still holds several components: sets already connected are never
   compared, so a group of near copies of any size costs a few comparisons for each set.
   Sizes, rooms and parities (bounds that lose no link) keep most pairs from being made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passages.llm.common import small, store
from passages.llm.components import components, follow
from passages.llm.hashing import (
    Words, WordHasher, among, binary_rows, by_ranges, mix, pack_ints, run_starts, runs,
    shared_values, unpack_ints, word_groups,
)
from passages.llm.repeats import numbered, ranges_for

SHINGLE_WORDS = 5
PERCENT = 75
GROUP_WORDS = 250_000
# A shingle in more sets than this is frequent.
RARE = 16
# Sets below this size index frequent shingles one by one too.
SMALL_SET = 64
SHIPPED_ROWS = 250_000
PIVOT_GROWTH = 64
MOST_PAIRS_PER_ENTRY = 256
# A set's parities: which of 256 classes of shingles it has an odd number of.
PARITIES = ("b0", "b1", "b2", "b3")
PARITY_BITS = 64 * len(PARITIES)
# What an index entry tells of its set, for the bounds on a pair.
TRAITS = ("n", "room", "alone", *PARITIES)


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all documents of a group: document indexes and hashes, sorted.

    A document with fewer than five words has its whole sequence as one shingle.
    """
    at, counts = run_starts(words.first, SHINGLE_WORDS)
    doc = np.repeat(np.arange(len(counts)), counts)
    hashes = runs(words.hashes, SHINGLE_WORDS)[at] if len(at) else np.zeros(0, np.uint64)
    for length in range(1, SHINGLE_WORDS):
        short = np.flatnonzero(words.counts == length)
        if len(short):
            whole = runs(words.hashes, length, seed=100 + length)[words.first[short]]
            doc, hashes = np.concatenate([doc, short]), np.concatenate([hashes, whole])
    # Few documents: then the second, stable sort is by radix.
    order = np.argsort(hashes)
    narrow = doc[order].astype(np.uint16 if len(words.counts) < 1 << 16 else np.int64)
    order = order[np.argsort(narrow, kind="stable")]
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return doc[new], hashes[new]


def _summed(doc: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    ends = np.searchsorted(doc, np.arange(rows + 1))
    return total[ends[1:]] - total[ends[:-1]]


def set_marks(doc: np.ndarray, hashes: np.ndarray, rows: int) -> tuple[np.ndarray, ...]:
    """Size and a 128-bit mark of each set, the same for equal sets."""
    return (
        np.bincount(doc, minlength=rows),
        _summed(doc, mix(hashes), rows).view(np.int64),
        _summed(doc, mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), rows).view(np.int64),
    )


def _ids(kept: list[pa.RecordBatch]) -> np.ndarray:
    return np.concatenate([b.column(0).to_numpy() for b in kept])


def set_table(texts: DataFrame) -> DataFrame:
    """``(doc_id, n, s1, s2)``: size and mark of each document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, words in word_groups(batches, WordHasher(1, fold_case=True), GROUP_WORDS):
            ids = _ids(kept)
            marks = set_marks(*shingle_sets(words), len(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), *[pa.array(m, pa.int64()) for m in marks]],
                ["doc_id", "n", "s1", "s2"],
            )

    return texts.mapInArrow(run, "doc_id bigint, n bigint, s1 bigint, s2 bigint")


def shared_counts(texts: DataFrame, buckets: int, bits: int) -> DataFrame:
    """``(doc_id, shared)``: shingles of a document that some other document may have too.

    Fingerprints are cut to ``bits``, so the count is never too small.
    """
    shift = np.uint64(64 - bits)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "part", "docs", "here", "once", "once_doc", "more"]
        groups = word_groups(batches, WordHasher(1, fold_case=True), GROUP_WORDS)
        for part, (kept, words) in numbered(groups):
            ids = _ids(kept)
            doc, prints = shingle_sets(words)
            prints = prints >> shift
            order = np.argsort(prints, kind="stable")
            doc, prints = doc[order], prints[order]
            values, first, times = np.unique(prints, return_index=True, return_counts=True)
            single = times == 1
            here = np.bincount(doc[np.repeat(~single, times)], minlength=len(ids))
            once, once_doc, more = values[single], doc[first[single]], values[~single]
            home = part % buckets
            yield from binary_rows(names, (
                (b, part, pack_ints(ids.view(np.uint64)) if b == home else b"",
                 pack_ints(here) if b == home else b"",
                 pack_ints(once[o], True), pack_ints(once_doc[o]), pack_ints(more[m], True))
                for b, (o, m) in by_ranges(bits, buckets, home, once, more)
            ))

    def answer(table: pa.Table) -> pa.Table:
        once = [unpack_ints(x, True) for x in table["once"].to_pylist()]
        more = [unpack_ints(x, True) for x in table["more"].to_pylist()]
        shared = shared_values([*once, *more, *more])
        counts = []
        for prints, doc, here in zip(once, table["once_doc"].to_pylist(), table["here"].to_pylist()):
            hit = unpack_ints(doc)[among(prints, shared)].astype(np.int64)
            found, here = np.bincount(hit), unpack_ints(here).astype(np.int64)
            total = np.zeros(max(len(found), len(here)), np.int64)
            total[: len(found)] += found
            total[: len(here)] += here
            counts.append(pack_ints(total))
        return pa.table([table["part"], table["docs"], pa.array(counts, pa.binary())],
                        names=["part", "docs", "counts"])

    def add_up(table: pa.Table) -> pa.Table:
        ids = next((unpack_ints(x).view(np.int64) for x in table["docs"].to_pylist() if x),
                   np.zeros(0, np.int64))
        total = np.zeros(len(ids), np.int64)
        for packed in table["counts"].to_pylist():
            found = unpack_ints(packed)
            total[: len(found)] += found.astype(np.int64)
        return pa.table([ids, total], names=["doc_id", "shared"])

    shipped = texts.mapInArrow(
        send,
        "bucket int, part bigint, docs binary, here binary, once binary, once_doc binary, "
        "more binary",
    )
    answers = shipped.groupBy("bucket").applyInArrow(
        answer, "part bigint, docs binary, counts binary"
    )
    return answers.groupBy("part").applyInArrow(add_up, "doc_id bigint, shared bigint")


def required(n: int) -> int:
    """Shingles that a set of ``n`` shares at least with any it links to."""
    return (n * PERCENT + 99) // 100


def sets_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(doc_id, n, shingles)`` of the texts in ``wanted`` ``(doc_id, s1, s2)``."""
    rows = texts.join(wanted, "doc_id").select("doc_id", "s1", "s2", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept, words in word_groups(batches, WordHasher(1, fold_case=True), GROUP_WORDS):
            ids = _ids(kept)
            doc, hashes = shingle_sets(words)
            n, s1, s2 = set_marks(doc, hashes, len(ids))
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(doc, np.arange(len(ids) + 1)).astype(np.int32)),
                pa.array(hashes.view(np.int64)),
            )
            same = (np.concatenate([b.column(1).to_numpy() for b in kept]) == s1) & (
                np.concatenate([b.column(2).to_numpy() for b in kept]) == s2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(n, pa.int64()), lists], ["doc_id", "n", "shingles"]
            ).filter(pa.array(same))

    return rows.mapInArrow(run, "doc_id bigint, n bigint, shingles array<bigint>")


def signatures_of(
    n: int, shingles: np.ndarray, times: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set: rare shingles of its prefix, and combinations of frequent ones.

    ``shingles`` are those that occur in other sets too, from rare to frequent; the others
    of the ``n`` come before them in the order but have no one to meet. A set is indexed
    for its own size class and the next one, so sets whose sizes allow a link meet in one.

    The second array is each signature's room: how many shingles the set can share at most
    with a set that it meets here and in no earlier entry. Before the first shingle of a
    combination up to ``classes`` shared ones may stand, as they may be alone in theirs.
    """
    alone = n - len(shingles)
    frequent = times > RARE
    level = int(np.floor(np.log(n) / np.log(4 / 3) + 1e-9))
    room = len(shingles) - np.arange(len(shingles))
    found, rooms = [], []
    for at in (level, level + 1):
        size = (4 / 3) ** at
        classes = int(size) // 16 if size >= SMALL_SET else 0
        prefix = max(n - required(n) + 1 + classes - alone, 0)
        own, often, left_over = shingles[:prefix], frequent[:prefix], room[:prefix]
        single = ~often if classes else np.ones(len(own), bool)
        # Frequent shingles shared before a rare one cannot be: the order is by rarity.
        found.append(own[single])
        rooms.append(left_over[single])
        if not classes:
            continue
        own, left_over = own[often], left_over[often]
        group = own % np.uint64(classes)
        order = np.argsort(group, kind="stable")
        own, group, left_over = own[order], group[order], left_over[order]
        ends = np.searchsorted(group, group, side="right")
        partners = ends - np.arange(len(own)) - 1
        left = np.repeat(np.arange(len(own)), partners)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(partners) - partners, partners)
        low, high = np.minimum(own[left], own[right]), np.maximum(own[left], own[right])
        found.append(mix(low * np.uint64(3) + mix(high) + np.uint64(at) * np.uint64(0x9E3779B9)))
        rooms.append(np.minimum(left_over[left] + classes, len(shingles)))
    signatures, rooms = np.concatenate(found), np.concatenate(rooms)
    order = np.lexsort((-rooms, signatures))
    signatures, rooms = signatures[order], rooms[order]
    new = np.ones(len(signatures), bool)
    new[1:] = signatures[1:] != signatures[:-1]
    return signatures[new], rooms[new]


def parities_of(shingles: np.ndarray) -> np.ndarray:
    """Parities of shingles. Two lists of them differ in at least as many as in parities."""
    times = np.bincount((mix(shingles) % np.uint64(PARITY_BITS)).astype(np.int64),
                        minlength=PARITY_BITS)
    return np.packbits((times & 1).astype(np.uint8)).view(np.int64)


def index_entries(sets: DataFrame) -> DataFrame:
    """``(sig, doc_id, n, room, alone, b0, ...)``: the index entries of all sets.

    ``alone`` counts the set's shingles that no other set has; the parities are those of
    the other shingles.
    """
    tokens = sets.select("doc_id", "n", F.explode("shingles").alias("h"))
    counted = tokens.withColumn("times", F.count("*").over(Window.partitionBy("h")))
    ordered = (
        counted.where("times > 1").groupBy("doc_id")
        .agg(F.first("n").alias("n"),
             F.array_sort(F.collect_set(F.struct("times", "h"))).alias("t"))
        .select("doc_id", "n", F.col("t.h").alias("h"), F.col("t.times").alias("times"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            found = [
                signatures_of(int(n), h.values.to_numpy().view(np.uint64), t.values.to_numpy())
                for n, h, t in zip(sizes, batch.column(2), batch.column(3))
            ]
            counts = [len(own) for own, _ in found]
            alone = sizes - np.array([len(h) for h in batch.column(2)], np.int64)
            parities = np.repeat(
                np.array([parities_of(h.values.to_numpy().view(np.uint64)) for h in batch.column(2)],
                         np.int64).reshape(-1, len(PARITIES)), counts, axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([own.view(np.int64) for own, _ in found])),
                 pa.array(np.repeat(ids, counts)), pa.array(np.repeat(sizes, counts)),
                 pa.array(np.concatenate([room for _, room in found]), pa.int64()),
                 pa.array(np.repeat(alone, counts)),
                 *[pa.array(column) for column in parities.T]],
                ["sig", "doc_id", *TRAITS],
            )

    schema = ", ".join(f"{c} bigint" for c in ("sig", "doc_id", *TRAITS))
    return ordered.mapInArrow(run, schema)


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose sets reach the similarity, verified on all shingles."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    either = F.size("sa") + F.size("sb") - both
    return (
        right.join(small(pairs, SHIPPED_ROWS), "b").join(left, "a")
        .where(both * 100 >= either * PERCENT).select("a", "b")
    )


def may_link(other: str) -> Column:
    """Whether a link of a set and the one with prefix ``other`` is possible at all.

    Sizes and rooms must allow the overlap that it needs, and linked sets differ in at most
    a seventh of their sizes' sum. Shingles that only one set of all has are among those
    that differ, and the unequal parities count others. The bounds lose no link.
    """
    n, room, other_n, other_room = (F.col(c) for c in ("n", "room", f"{other}n", f"{other}room"))
    unequal = sum(F.bit_count(F.col(b).bitwiseXOR(F.col(other + b))) for b in PARITIES)
    differ = unequal + F.col("alone") + F.col(f"{other}alone")
    return (
        (F.least(n, other_n) * 100 >= F.greatest(n, other_n) * PERCENT)
        & (F.least(room, other_room) * (100 + PERCENT) >= (n + other_n) * PERCENT)
        & (differ * (100 + PERCENT) <= (n + other_n) * (100 - PERCENT))
    )


def set_components(sets: DataFrame) -> DataFrame:
    """``(node, component)`` of the sets that link to another one.

    First the smallest id of each index entry is its pivot. What entries then still hold
    in different components is compared whole if those pairs are few for the number of
    entries, and else pivot by pivot, many times more in each round, with components
    merged in between.
    """
    entries = store(index_entries(sets), "entries")
    entries = entries.withColumn("component", F.col("doc_id"))
    edges = labels = None
    done, pivots = 0, 1
    while True:
        state = entries.groupBy("sig").agg(
            F.min("component").alias("lo"), F.max("component").alias("hi"),
            F.count("*").alias("members"),
            F.min(F.struct("doc_id", *TRAITS)).alias("p"),
        ).where(F.col("lo") < F.col("hi")).where(F.col("members") > done)
        held = entries.join(state.select("sig", "members", "p"), "sig")
        if done:
            held = store(held, "entries")
            size = held.agg(F.count("*").alias("rows"),
                            F.sum(F.col("members") - 1).alias("pairs")).first()
            if not size.rows:
                return labels
            whole = size.pairs <= MOST_PAIRS_PER_ENTRY * size.rows
        if not done:
            # A pivot is compared with all others of its entry; the rest waits.
            pairs = held.where("doc_id > p.doc_id").where(may_link("p.")).select(
                F.col("p.doc_id").alias("a"), F.col("doc_id").alias("b"))
        else:
            first = held
            if not whole:
                order = Window.partitionBy("sig").orderBy("doc_id")
                first = held.withColumn("place", F.row_number().over(order)).where(
                    F.col("place") <= pivots)
            first = first.select(
                "sig", F.col("doc_id").alias("a"), F.col("component").alias("ca"),
                *[F.col(c).alias(f"p_{c}") for c in TRAITS],
            )
            pairs = (
                held.join(first, "sig").where("doc_id > a AND component <> ca")
                .where(may_link("p_")).select("a", F.col("doc_id").alias("b"))
            )
        found = linked(store(pairs.distinct(), "pairs"), sets)
        edges = store(found if edges is None else edges.union(found), "links")
        labels = store(components(edges), "labels")
        if done and whole:
            return labels
        entries = follow(
            held.select("sig", "doc_id", *TRAITS, F.col("doc_id").alias("component")),
            "component", small(labels, SHIPPED_ROWS),
        )
        done, pivots = pivots, pivots * PIVOT_GROWTH


def similar_sets(documents: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each document ``(doc_id, text)``.

    Words stand between ASCII white space, A-Z lower-cased. ``component_id`` is the
    smallest doc_id reachable by links; equal sets link. NULL and empty texts have an
    empty set and link with nothing. ``doc_id`` identifies a text: rows without it are
    left out, and of rows that repeat it one counts (by the mark of its set). Other
    columns are ignored; an empty table gives no row.
    """
    texts = documents.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    buckets, bits = ranges_for(texts)
    marks = store(
        set_table(texts).groupBy("doc_id").agg(F.min(F.struct("n", "s1", "s2")).alias("m"))
        .select("doc_id", "m.*"),
        "marks",
    )
    firsts = marks.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"))
    shared = shared_counts(texts, buckets, bits).groupBy("doc_id").agg(F.sum("shared").alias("shared"))
    wanted = store(
        firsts.withColumnRenamed("rep", "doc_id").join(shared, "doc_id")
        .where(F.col("shared") * 100 >= F.col("n") * PERCENT).select("doc_id", "s1", "s2"),
        "wanted",
    )
    sets = store(sets_of(texts, small(wanted, SHIPPED_ROWS)), "sets")
    found = set_components(sets).withColumnRenamed("node", "rep")
    reps = firsts.join(found, "rep", "left").select(
        "n", "s1", "s2", F.coalesce("component", "rep").alias("component_id")
    )
    return marks.join(reps, ["n", "s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
