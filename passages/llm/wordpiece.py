"""Token counts: greedy longest-match pieces counted by an automaton in linear time.

The vocabulary is a trie. Each state has a failure link to the state that remains after
the pieces it is bound to give off are popped, and the number of those pieces, worked out
once when the automaton is built. A word is read one byte at a time, never goes back, and
adds up popped pieces without building any.
"""

from __future__ import annotations

import json
from collections import deque
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from passages.llm.common import map_texts

END_MARK = "</w>"
LAST = 256  # added to a word's last byte, so that pieces for a word's end match only there
SYMBOLS = 512
REMEMBERED = 500_000
LOWER = bytes(range(256)).lower()


def byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def pieces_of(path: str) -> list[tuple[int, ...]]:
    """Symbols of each piece of a byte-level vocabulary with word ends; others are left out."""
    letters = byte_letters()
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    pieces = []
    for piece in vocabulary:
        last = piece.endswith(END_MARK)
        body = piece.removesuffix(END_MARK) if last else piece
        if body and all(c in letters for c in body):
            symbols = [letters[c] for c in body]
            if last:
                symbols[-1] += LAST
            pieces.append(tuple(symbols))
    return pieces


class LongestMatch:
    """``count(word)``: pieces of a word by greedy longest match, 1 if it has no match."""

    def __init__(self, pieces: list[tuple[int, ...]]):
        self.moves: dict[int, int] = {}
        accepts = [False]
        for piece in pieces:
            state = 0
            for symbol in piece:
                key = state * SYMBOLS + symbol
                state = self.moves.setdefault(key, len(accepts))
                if state == len(accepts):
                    accepts.append(False)
            accepts[state] = True
        self.link, self.popped = [-1] * len(accepts), [0] * len(accepts)
        self._links(accepts)

    def _links(self, accepts: list[bool]) -> None:
        children: dict[int, list[tuple[int, int]]] = {}
        for key, state in self.moves.items():
            children.setdefault(key // SYMBOLS, []).append((key % SYMBOLS, state))
        queue = deque([0])
        while queue:
            above = queue.popleft()
            for symbol, state in children.get(above, ()):
                queue.append(state)
                if accepts[state]:
                    self.link[state], self.popped[state] = 0, 1
                    continue
                back, popped = self.link[above], self.popped[above]
                while back >= 0 and back * SYMBOLS + symbol not in self.moves:
                    popped += self.popped[back]
                    back = self.link[back]
                if back >= 0:
                    self.link[state] = self.moves[back * SYMBOLS + symbol]
                    self.popped[state] = popped

    def count(self, word: bytes) -> int:
        moves, link, popped = self.moves, self.link, self.popped
        symbols = list(word)
        symbols[-1] += LAST
        state = total = 0
        for symbol in symbols:
            while (following := moves.get(state * SYMBOLS + symbol)) is None:
                if link[state] < 0:
                    return 1
                total += popped[state]
                state = link[state]
            state = following
        while state:
            if link[state] < 0:
                return 1
            total += popped[state]
            state = link[state]
        return total


class Remembered(dict):
    """Counts of words seen by this worker; forgotten when there are too many."""

    def __init__(self, counter: LongestMatch):
        self.counter = counter

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        count = self[word] = self.counter.count(word)
        return count


@lru_cache(2)
def counter_for(path: str) -> Remembered:
    return Remembered(LongestMatch(pieces_of(path)))


SCHEMA = "doc_id bigint, n_words bigint, n_tokens bigint, longest_word bigint"


def token_counts(documents: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, n_words, n_tokens, longest_word)`` for each row ``(doc_id, text)``.

    Words stand between ASCII white space, A-Z lower-cased; each is cut greedily into the
    longest pieces of ``vocabulary`` (a file that every worker can read), the last piece
    one that may end a word; ``longest_word`` is the most tokens of one word. A word
    without a match counts as one token. NULL and empty texts have no tokens; a NULL id
    stays NULL; repeated rows are all counted. Nothing is shuffled.
    """

    def work():
        known = counter_for(vocabulary)

        def step(block: pa.RecordBatch) -> dict:
            words, tokens, longest = [], [], []
            for text in block.column(1).to_pylist():
                found = [known[w] for w in text.encode().translate(LOWER).split()]
                words.append(len(found))
                tokens.append(sum(found))
                longest.append(max(found, default=0))
            return {"doc_id": block.column(0), "n_words": words, "n_tokens": tokens,
                    "longest_word": longest}

        return step

    return map_texts(documents, SCHEMA, work)


