"""Substring dedup: every repeat of 20 words or more is removed but for its first place.

Reference blocks are the non-overlapping runs of ten words of every document: however a
window of 20 words lies, it holds one whole block. Every rolling run of ten words of every
document probes them. A block that no other place matches cannot be part of a repeat, so
only windows over matched blocks are extended: each is reduced to a hash of all its words,
and the first place of each hash is found by a minimum, never by pairs of places.
Overlapping repeated windows make up the maximal repeats.

Blocks and probes are shuffled as sorted fingerprints in byte planes, two to three bytes a
word, grouped by ranges; a task keeps one of equal probes and the first of equal windows,
so a passage in any number of documents costs one entry for each task. Fingerprints may
only add candidates. Windows are told apart by 96 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passages.llm.common import map_texts
from passages.llm.hashing import (
    Words, WordHasher, among, binary_rows, by_ranges, lists_by_document, pack_ints, run_starts,
    runs, shared_values, unpack_ints, word_groups,
)

WINDOW = 20
GROUP_WORDS = 1_500_000
# Text whose probes make up one range: what one task of the index holds.
RANGE_BYTES = 16 << 20
LOW = np.uint64(0xFFFFFFFF)


def ranges_for(documents: DataFrame) -> tuple[int, int]:
    """Ranges of fingerprints, a power of two, and bits of one, from the bytes of all texts."""
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 1
    return 1 << (-(-size // RANGE_BYTES) - 1).bit_length(), min(max(int(size).bit_length() + 6, 24), 64)


def drop_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` for each document ``(doc_id, text)``.

    Words stand between ASCII white space. A word is removed if a window of ``window``
    words that covers it also starts earlier: in a smaller doc_id, or earlier in the same
    document. Windows are judged on the input. The digest is of the kept words, joined by
    one space. NULL and empty texts have no words. ``doc_id`` identifies a text: rows
    without it are left out, rows that repeat it with the same text are one place and each
    get its answer. Other columns are ignored; an empty table gives no row.
    """
    texts = documents.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    positions = repeated_positions(texts, window)

    def work():
        def step(block: pa.RecordBatch) -> dict:
            words, removed, digests = [], [], []
            for text, starts in zip(block.column(2).to_pylist(), block.column(1)):
                kept = text.encode().split()
                words.append(len(kept))
                if starts.is_valid:
                    gone = covered(starts.values.to_numpy(), window, len(kept))
                    kept = [w for w, g in zip(kept, gone.tolist()) if not g]
                removed.append(words[-1] - len(kept))
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            return {"doc_id": block.column(0), "n_words": words, "n_removed": removed,
                    "kept_sha256": digests}

        return step

    joined = texts.join(positions.hint("shuffle_hash"), "doc_id", "left")
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    return map_texts(joined, schema, work, keys=("doc_id", "starts"))


def covered(starts: np.ndarray, window: int, words: int) -> np.ndarray:
    """Which of ``words`` positions lie in a window that begins at one of ``starts``."""
    change = np.zeros(words + window + 1, np.int32)
    inside = starts[starts + window <= words]
    np.add.at(change, inside, 1)
    np.add.at(change, inside + window, -1)
    return np.cumsum(change)[:words] > 0


def repeated_positions(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, starts)``: where windows start that also start earlier."""
    block = (window + 1) // 2
    buckets, bits = ranges_for(texts)
    matched = matched_blocks(texts, block, buckets, bits)
    candidates = texts.join(matched.hint("shuffle_hash"), "doc_id").select(
        "doc_id", "blocks", "text"
    )

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = word_groups(batches, WordHasher(1, fold_case=False), GROUP_WORDS)
        for part, (kept, words) in numbered(groups):
            docs = np.concatenate([b.column(0).to_numpy() for b in kept])
            over = candidate_windows([b.column(1) for b in kept], words, block, window)
            yield from window_rows(part, docs, words, over, window, buckets)

    shipped = in_order(candidates).mapInArrow(
        windows,
        "bucket int, part bigint, docs binary, h1 binary, h2 binary, id binary, doc binary, "
        "start binary, gone_doc binary, gone_start binary",
    )
    later = shipped.groupBy("bucket").applyInArrow(
        later_places, "part bigint, docs binary, doc binary, starts binary"
    )
    return by_document(later, "starts")


def in_order(texts: DataFrame) -> DataFrame:
    """The rows of each task by document, so that a task run again has the same groups.

    Groups are named by their place in a task and documents by their place in a group.
    Rows of a shuffle come in the order they were fetched; a task that is run again
    after a loss would give the same names to other documents.
    """
    return texts.sortWithinPartitions("doc_id", "text")


def numbered(groups: Iterator) -> Iterator[tuple[int, object]]:
    """Groups of a task with numbers that no other task gives."""
    from pyspark import TaskContext

    task = TaskContext.get().partitionId() << 32
    return ((task + number, group) for number, group in enumerate(groups))


def by_document(rows: DataFrame, value: str) -> DataFrame:
    """``(doc_id, value)``, a list for each document, from ``(part, docs, doc, value)``."""
    lists = rows.groupBy("part").applyInArrow(
        lambda table: lists_by_document(table, value), f"doc_id bigint, {value} array<int>"
    )
    return lists.groupBy("doc_id").agg(F.flatten(F.collect_list(value)).alias(value))


def matched_blocks(texts: DataFrame, block: int, buckets: int, bits: int) -> DataFrame:
    """``(doc_id, blocks)``: numbers of the reference blocks that another place matches."""
    shift = np.uint64(64 - bits)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "part", "docs", "probes", "again", "own", "doc", "number"]
        groups = word_groups(batches, WordHasher(1, fold_case=False), GROUP_WORDS)
        for part, (kept, words) in numbered(groups):
            docs = np.concatenate([b.column(0).to_numpy() for b in kept])
            prints = runs(words.hashes, block) >> shift
            at, counts = run_starts(words.first, block)
            ordered = np.sort(prints[at])
            new = np.r_[True, ordered[1:] != ordered[:-1]] if len(ordered) else np.zeros(0, bool)
            probes, again = ordered[new], shared_values([ordered])
            doc = np.repeat(np.arange(len(docs)), counts)
            offset = at - words.first[doc]
            anchored = offset % block == 0
            doc, number, own = doc[anchored], offset[anchored] // block, prints[at[anchored]]
            order = np.argsort(own, kind="stable")
            doc, number, own = doc[order], number[order], own[order]
            home = part % buckets
            yield from binary_rows(names, (
                (b, part, pack_ints(docs.view(np.uint64)) if b == home else b"",
                 pack_ints(probes[p], True), pack_ints(again[a], True), pack_ints(own[o], True),
                 pack_ints(doc[o]), pack_ints(number[o]))
                for b, (p, a, o) in by_ranges(bits, buckets, home, probes, again, own)
            ))

    def probe(table: pa.Table) -> pa.Table:
        seen = table["probes"].to_pylist() + table["again"].to_pylist()
        shared = shared_values([unpack_ints(x, True) for x in seen])
        docs, blocks = [], []
        for own, doc, number in zip(*(table[n].to_pylist() for n in ("own", "doc", "number"))):
            hit = among(unpack_ints(own, True), shared)
            docs.append(pack_ints(unpack_ints(doc)[hit]))
            blocks.append(pack_ints(unpack_ints(number)[hit]))
        return pa.table(
            [table["part"], table["docs"], pa.array(docs, pa.binary()), pa.array(blocks, pa.binary())],
            names=["part", "docs", "doc", "blocks"],
        )

    shipped = in_order(texts).mapInArrow(
        index,
        "bucket int, part bigint, docs binary, probes binary, again binary, own binary, "
        "doc binary, number binary",
    )
    hits = shipped.groupBy("bucket").applyInArrow(
        probe, "part bigint, docs binary, doc binary, blocks binary"
    )
    return by_document(hits, "blocks")


def candidate_windows(
    lists: list[pa.Array], words: Words, block: int, window: int
) -> np.ndarray:
    """Word indexes of the windows that hold a matched block whole."""
    numbers = np.concatenate([x.flatten().to_numpy() for x in lists]).astype(np.int64)
    counts = np.concatenate([x.value_lengths().to_numpy() for x in lists])
    doc = np.repeat(np.arange(len(counts)), counts)
    length = words.counts[doc]
    low = np.maximum(numbers * block - (window - block), 0)
    high = np.minimum(numbers * block, length - window) + 1
    fits = low < high
    change = np.zeros(len(words.hashes) + 1, np.int32)
    np.add.at(change, words.first[doc[fits]] + low[fits], 1)
    np.add.at(change, words.first[doc[fits]] + high[fits], -1)
    return np.flatnonzero(np.cumsum(change) > 0)


def first_of_each(
    h1: np.ndarray, h2: np.ndarray, docs: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the places of windows by hash and place, the first of each, and the later.

    A place that equals the first (a repeated row) is not a later one.
    """
    order = np.lexsort((start, docs, h2, h1))
    h1, h2, docs, start = h1[order], h2[order], docs[order], start[order]
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    return order, new, (docs != docs[lead]) | (start != start[lead])


def window_rows(
    part: int, docs: np.ndarray, words: Words, at: np.ndarray, window: int, buckets: int
) -> Iterator[pa.RecordBatch]:
    """The first place of each window of a group, by ranges of its hash; later ones apart."""
    if not len(at):
        return
    h1 = runs(words.hashes, window, seed=11)[at]
    h2 = runs(words.hashes, window, seed=12)[at] & LOW
    doc = np.searchsorted(words.first, at, side="right") - 1
    start = at - words.first[doc]
    order, new, later = first_of_each(h1, h2, docs[doc], start)
    gone = np.sort(order[later])
    order = order[new]
    h1, h2, own_doc, own_start = h1[order], h2[order], doc[order], start[order]
    ids, home = docs.view(np.uint64), part % buckets
    yield from binary_rows(
        ["bucket", "part", "docs", "h1", "h2", "id", "doc", "start", "gone_doc", "gone_start"],
        ((b, part, pack_ints(ids) if b == home else b"", pack_ints(h1[o], True),
          pack_ints(h2[o]), pack_ints(ids[own_doc[o]]), pack_ints(own_doc[o]),
          pack_ints(own_start[o]), pack_ints(doc[gone], True) if b == home else b"",
          pack_ints(start[gone]) if b == home else b"")
         for b, (o,) in by_ranges(64, buckets, home, h1)),
    )


def later_places(table: pa.Table) -> pa.Table:
    """Of a range of windows the places that are not the first, by group of documents."""
    columns = {n: table[n].to_pylist() for n in table.column_names}
    h1 = np.concatenate([unpack_ints(x, True) for x in columns["h1"]])
    h2 = np.concatenate([unpack_ints(x) for x in columns["h2"]])
    doc = [unpack_ints(x).astype(np.int64) for x in columns["doc"]]
    docs = np.concatenate([unpack_ints(x) for x in columns["id"]]).view(np.int64)
    start = np.concatenate([unpack_ints(x) for x in columns["start"]]).astype(np.int64)
    order, _, later = first_of_each(h1, h2, docs, start)
    is_later = np.zeros(len(order), bool)
    is_later[order[later]] = True
    ends = np.cumsum([len(d) for d in doc])
    found_doc, found_start = [], []
    for end, own, gone, at in zip(ends, doc, columns["gone_doc"], columns["gone_start"]):
        span = slice(end - len(own), end)
        hit = is_later[span]
        found_doc.append(pack_ints(
            np.concatenate([own[hit], unpack_ints(gone, True).astype(np.int64)])))
        found_start.append(pack_ints(
            np.concatenate([start[span][hit], unpack_ints(at).astype(np.int64)])))
    return pa.table(
        [table["part"], table["docs"], pa.array(found_doc, pa.binary()),
         pa.array(found_start, pa.binary())], names=["part", "docs", "doc", "starts"],
    )
