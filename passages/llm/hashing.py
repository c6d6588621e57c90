"""Hashes of words and of runs of words, computed for whole blocks of texts with NumPy.

Texts are taken as UTF-8. Words are the runs between ASCII white space (0x20, 0x09 to
0x0D). A word's hash is a polynomial over random byte values; a run's hash is a weighted
sum of its words' hashes. Both end in a 64-bit mixer. The tables come from fixed seeds, so
every worker and every retry gives the same values.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa

# A block of texts is hashed at once; the arrays take about 50 bytes for each byte of text.
BLOCK_BYTES = 1 << 20
BATCH_ROWS = 10_000
SPACES = b" \t\n\x0b\x0c\r"
WORD_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(length: int) -> np.ndarray:
    out = np.full(length, WORD_BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _byte_values(seed: int, fold_case: bool) -> np.ndarray:
    values = np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2)
    values += np.uint64(1)
    if fold_case:
        values[65:91] = values[97:123]
    values[list(SPACES)] = 0
    return values


IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True


class Words:
    """Word hashes of a block: ``hashes`` of all words, ``first`` per text and the end."""

    def __init__(self, hashes: np.ndarray, first: np.ndarray):
        self.hashes, self.first = hashes, first

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


class WordHasher:
    def __init__(self, seed: int, fold_case: bool):
        self.values = _byte_values(seed, fold_case)
        self.powers = _powers(64)

    def __call__(self, texts: pa.Array) -> Words:
        """``texts`` without nulls, as a string array."""
        data, ends = _bytes_of(texts)
        if not len(data):
            return Words(np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64))
        inside = ~IS_SPACE[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        at = ends[:-1][ends[:-1] < len(data)]
        begins[at] = inside[at]
        starts = np.flatnonzero(begins)
        first = np.searchsorted(starts, ends).astype(np.int64)
        if not len(starts):
            return Words(np.zeros(0, np.uint64), first)
        spans = np.diff(starts, append=len(data))
        longest = int(spans.max())
        if longest > len(self.powers):
            self.powers = _powers(longest)
        place = np.arange(starts[0], len(data)) - np.repeat(starts, spans)
        terms = self.values[data[starts[0]:]] * self.powers[place]
        return Words(mix(np.add.reduceat(terms, starts - starts[0])), first)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each text begins, with the end."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64, len(texts) + 1 + texts.offset)[texts.offset:]
    low, high = int(ends[0]), int(ends[-1])
    if data is None or high == low:
        return np.zeros(0, np.uint8), ends - low
    return np.frombuffer(data, np.uint8)[low:high], ends - low


def runs(words: np.ndarray, length: int, seed: int = 7) -> np.ndarray:
    """Hash of each run of ``length`` words; item ``i`` starts at word ``i``."""
    size = len(words) - length + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    weights = np.random.default_rng(seed).integers(1, 2**63, length, dtype=np.uint64)
    weights = weights * np.uint64(2) + np.uint64(1)
    total = words[:size] * weights[0]
    for j in range(1, length):
        total += words[j:j + size] * weights[j]
    return mix(total)


def run_starts(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Word indexes at which a run of ``length`` words of one text starts; runs per text."""
    counts = np.maximum(np.diff(first) - length + 1, 0)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(first[:-1], counts) + offset, counts


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text, or of one text."""
    sizes = np.cumsum(_sizes(texts))
    begin, done = 0, 0
    while begin < len(sizes):
        end = max(int(np.searchsorted(sizes, done + limit, side="right")), begin + 1)
        yield begin, end
        begin, done = end, int(sizes[end - 1])


def _sizes(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def word_groups(
    batches: Iterator[pa.RecordBatch], hasher: WordHasher, most_words: int
) -> Iterator[tuple[list[pa.RecordBatch], Words]]:
    """Blocks of batches ``(..., text)`` put together until they have ``most_words`` words.

    Gives the columns before the text, as batches, and the words of all their texts.
    """
    kept: list[pa.RecordBatch] = []
    hashes: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    total = 0

    def together() -> tuple[list[pa.RecordBatch], Words]:
        first = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        return kept, Words(np.concatenate(hashes), first)

    for batch in batches:
        texts = batch.column(batch.num_columns - 1).fill_null("")
        others = batch.select(list(range(batch.num_columns - 1)))
        for begin, end in blocks(texts):
            found = hasher(texts.slice(begin, end - begin))
            kept.append(others.slice(begin, end - begin))
            hashes.append(found.hashes)
            counts.append(found.counts)
            total += len(found.hashes)
            if total >= most_words:
                yield together()
                kept, hashes, counts, total = [], [], [], 0
                pa.default_memory_pool().release_unused()
    if kept:
        yield together()


def pack_ints(values: np.ndarray, rising: bool = False) -> bytes:
    """Unsigned integers as byte planes, as many as the largest needs.

    With ``rising`` the differences of sorted values are kept. Planes of high bytes are
    nearly constant, which the shuffle's compression then removes.
    """
    if not len(values):
        return b""
    values = values.astype(np.uint64)
    if rising:
        values = np.diff(values, prepend=np.uint64(0))
    planes = max((int(values.max()).bit_length() + 7) // 8, 1)
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes() + bytes([planes])


def unpack_ints(data: bytes, rising: bool = False) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    planes = data[-1]
    flat = np.frombuffer(data, np.uint8, len(data) - 1).reshape(planes, -1)
    wide = np.zeros((flat.shape[1], 8), np.uint8)
    wide[:, :planes] = flat.T
    values = wide.view("<u8").reshape(-1)
    return np.cumsum(values, dtype=np.uint64) if rising else values


def by_ranges(
    bits: int, ranges: int, home: int, *columns: np.ndarray
) -> Iterator[tuple[int, list[slice]]]:
    """Where sorted values below ``2**bits`` lie in each of equal ranges, a power of two.

    Only ranges that hold a value, and ``home``, are given: work and rows follow the
    values, however many ranges there are.
    """
    shift = bits - (ranges.bit_length() - 1)
    tops = [v >> np.uint64(shift) if shift < 64 else np.zeros_like(v) for v in columns]
    held = [top[np.r_[True, top[1:] != top[:-1]]] for top in tops if len(top)]
    present = np.unique(np.concatenate([np.array([home], np.uint64), *held]))
    edges = [
        (np.searchsorted(top, present).tolist(), np.searchsorted(top, present, "right").tolist())
        for top in tops
    ]
    for at, number in enumerate(present.tolist()):
        yield number, [slice(low[at], high[at]) for low, high in edges]


def lists_of(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which ``values`` are in ``wanted``, which is sorted."""
    if not len(wanted):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)
    return wanted[at] == values


def shared_values(runs_of_values: list[np.ndarray]) -> np.ndarray:
    """Values that occur more than once in several sorted arrays, sorted."""
    together = np.sort(np.concatenate([np.zeros(0, np.uint64), *runs_of_values]))
    again = together[1:][together[1:] == together[:-1]]
    return again[np.r_[True, again[1:] != again[:-1]]] if len(again) else again


def binary_rows(names: list[str], rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows ``(bucket, part, binary, ...)`` as batches of bounded length."""
    while some := list(islice(rows, BATCH_ROWS)):
        columns = list(zip(*some))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()),
             *[pa.array(c, pa.binary()) for c in columns[2:]]], names,
        )


def lists_by_document(table: pa.Table, value: str) -> pa.Table:
    """``(doc_id, value)`` from the rows ``(docs, doc, value)`` of one group of documents."""
    ids = next((unpack_ints(x) for x in table["docs"].to_pylist() if x), np.zeros(0, np.uint64))
    doc = np.concatenate([unpack_ints(x) for x in table["doc"].to_pylist()]).astype(np.int64)
    found = np.concatenate([unpack_ints(x) for x in table[value].to_pylist()]).astype(np.int64)
    order = np.argsort(doc, kind="stable")
    own, counts = np.unique(doc, return_counts=True)
    return pa.table(
        [ids[own].view(np.int64), lists_of(found[order], counts, pa.int32())],
        names=["doc_id", value],
    )
