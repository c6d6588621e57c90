"""Packing: documents into training sequences of several context sizes.

Each document is routed to the shortest tier (context size) that holds it; what is longer
than the longest tier gives whole windows first. Tiers are packed from long to short: a
window opens with the longest part left, its gap is filled with the largest parts of
shorter tiers that fit, and what then remains is cut from the next one. Full windows have
a tier's length, so they need no padding. Sequences are dealt into steps of near equal
token counts. A task packs its own documents in bounded groups, so nothing is shuffled.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passages.llm.hashing import BLOCK_BYTES, blocks

TIERS = (512, 1024, 2048, 4096)
END_ID = 2
GROUP_TOKENS = 1 << 20
STEP_TOKENS = 32 * 4096
REMEMBERED = 1_500_000
ENCODED_AT_ONCE = 2048
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, tier int, step_id bigint"
)

Part = tuple[int, int, int]  # length, document in the group, start


class Encoder:
    """Ids of texts, as little-endian 32-bit bytes.

    Words between blanks and line ends are encoded by themselves and remembered: the
    tokenizer drops white space, so a text's ids are its words' ids in order. It also
    lower-cases, and a stop or comma behind a Latin letter is a token of its own, so a word
    that differs from one known in no more than that is put together from it. Other letters
    may end in a mark once normalised, which a stop would join.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}
        self.remembered = remembered
        self.end = np.array([END_ID], "<u4").tobytes()

    def _encode(self, words: list[str]) -> None:
        # An encoding takes some kilobytes until its ids are read.
        for begin in range(0, len(words), ENCODED_AT_ONCE):
            some = words[begin:begin + ENCODED_AT_ONCE]
            found = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            for word, encoding in zip(some, found):
                self.known[word] = np.array(encoding.ids, "<u4").tobytes()

    def _learn(self, words: set[str]) -> None:
        known, plain = self.known, {}
        for word in words:
            stop = word[-1] in ".," and word[-2:-1].isalpha() and word[-2] <= "\xff"
            body, tail = (word[:-1], word[-1]) if stop else (word, "")
            plain[word] = (body.lower() if body.isascii() and body.isalpha() else body), tail
        fresh = {part for parts in plain.values() for part in parts}.difference(known)
        self._encode(list(fresh))
        for word, (body, tail) in plain.items():
            known[word] = known[body] + known[tail]

    def __call__(self, texts: list[str]) -> list[bytes]:
        words = [t.replace("\n", " ").split(" ") for t in texts]
        every = set().union(*words)
        fresh = every.difference(self.known)
        if len(self.known) + len(fresh) > self.remembered:
            self.known = {"": b""}
            fresh = every - {""}
        if fresh:
            self._learn(fresh)
        return [b"".join(map(self.known.__getitem__, ws)) + self.end for ws in words]


@lru_cache(2)
def encoder_for(path: str, remembered: int) -> Encoder:
    return Encoder(path, remembered)


def tier_of(length: int, tiers: tuple[int, ...] = TIERS) -> int:
    return next(t for t in tiers if t >= length)


def pack(
    parts: list[Part], tiers: tuple[int, ...] = TIERS
) -> tuple[list[list[Part]], list[Part]]:
    """Full windows, and the parts of the one window that nothing was left to fill."""
    longest, full, pool = tiers[-1], [], []
    for length, document, start in parts:
        while length > longest:
            full.append([(longest, document, start)])
            length, start = length - longest, start + longest
        pool.append((length, document, start))
    pool.sort()
    while pool:
        window = [pool.pop()]
        gap = tier_of(window[0][0], tiers) - window[0][0]
        while gap and pool:
            fits = bisect_right(pool, gap, key=lambda part: part[0])
            length, document, start = pool.pop(fits - 1 if fits else 0)
            if length > gap:
                insort(pool, (length - gap, document, start + gap))
                length = gap
            window.append((length, document, start))
            gap -= length
        if gap:
            return full, window
        full.append(window)
    return full, []


def by_powers_of_two(window: list[Part]) -> list[list[Part]]:
    """The parts of a window that stayed short, recut so that no sequence needs padding."""
    total, out = sum(p[0] for p in window), []
    parts = window[::-1]
    while total:
        size = gap = 1 << (total.bit_length() - 1)
        out.append([])
        while gap:
            length, document, start = parts.pop()
            if length > gap:
                parts.append((length - gap, document, start + gap))
                length = gap
            out[-1].append((length, document, start))
            gap -= length
        total -= size
    return out


def deal_steps(sizes: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step for each sequence: long ones first, always to the step with fewest tokens."""
    steps: list[tuple[int, int]] = []
    for step in range(max(-(-sum(sizes) // step_tokens), 1)):
        heappush(steps, (0, step))
    out = [0] * len(sizes)
    for at in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        tokens, step = heappop(steps)
        out[at] = step
        heappush(steps, (tokens + sizes[at], step))
    return out


class Packer:
    """Packs the documents of one task group by group; what stays open goes to the next."""

    def __init__(self, task: int, tiers: tuple[int, ...]):
        self.tiers, self.sequence, self.step = tiers, task << 40, task << 40
        self.documents: list[tuple[object, bytes]] = []
        self.parts: list[Part] = []
        self.tokens = 0

    def add(self, doc_id: object, ids: bytes) -> None:
        length = len(ids) // 4
        self.parts.append((length, len(self.documents), 0))
        self.documents.append((doc_id, ids))
        self.tokens += length

    def flush(self, last: bool) -> pa.RecordBatch:
        windows, left = pack(self.parts, self.tiers)
        if last:
            windows, left = windows + by_powers_of_two(left), []
        sizes = [sum(p[0] for p in w) for w in windows]
        steps = deal_steps(sizes)
        rows = []
        for window, size, step in zip(windows, sizes, steps):
            offset = 0
            for length, document, start in window:
                doc_id, ids = self.documents[document]
                crc = zlib.crc32(ids[4 * start:4 * (start + length)])
                rows.append((doc_id, start, length, crc, len(ids) // 4, self.sequence, offset,
                             size, self.step + step))
                offset += length
            self.sequence += 1
        self.step += max(steps, default=-1) + 1
        kept = sorted({p[1] for p in left})
        place = {document: at for at, document in enumerate(kept)}
        self.documents = [self.documents[d] for d in kept]
        self.parts = [(length, place[d], start) for length, d, start in left]
        self.tokens = sum(p[0] for p in self.parts)
        columns = list(zip(*rows)) or [[]] * 9
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names
        )


def pack_documents(
    documents: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS,
    group_tokens: int = GROUP_TOKENS, remembered: int = REMEMBERED,
) -> DataFrame:
    """One row per piece of a document ``(doc_id, text)``, with its place in a sequence.

    A document is its ids and then id 2; a NULL or empty text is that id alone. Each id
    lies in one piece. All sequences have the length of a tier, but for the end of a task:
    its last open window is recut at powers of two, so that nothing is padded at all.
    ``tiers`` are powers of two, rising. A sequence's number holds its task's number, which
    depends on the layout of the input only, so a retried task gives the same rows. NULL
    ids stay NULL, repeated rows are packed each, an empty table gives no piece. A worker
    remembers the ids of at most ``remembered`` words, some 170 bytes each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder_for(tokenizer, remembered)
        packer = Packer(TaskContext.get().partitionId(), tiers)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for begin, end in blocks(texts, BLOCK_BYTES):
                found = encode(texts.slice(begin, end - begin).to_pylist())
                for doc_id, ids in zip(batch.column(0).slice(begin, end - begin).to_pylist(), found):
                    packer.add(doc_id, ids)
                    if packer.tokens >= group_tokens:
                        yield packer.flush(last=False)
        yield packer.flush(last=True)

    return documents.select("doc_id", F.col("text")).mapInArrow(run, SCHEMA)
