"""License scans: notice phrases and identifier tags by automaton, expressions by parser.

One automaton over a text's words finds every phrase and tag in one pass. The expression
behind a tag is read by a shunting-yard parser for ``with``, ``and`` and ``or``, from the
tightest to the loosest, and evaluated to its labels and to whether a reader may choose
terms that ask for no more than notice.
"""

from __future__ import annotations

import re
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from passages.llm.common import map_texts

BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
MORE_PHRASES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons zero": "cc0",
    "released into the public domain": "public-domain",
    "all rights reserved": "reserved",
}
TAG = "spdx license identifier"
PERMISSIVE = re.compile(
    r"(?:mit|apache|bsd|isc|cc0|cc-by(?=-\d)|zlib|unlicense|0bsd|public-domain)(?![a-z0-9])"
)
# What a reader sees of a phrase, a tag counting for more: the score's halvings.
PHRASE_WEIGHT, TAG_WEIGHT = 1, 3

_keep = re.compile(rb"[0-9a-z\x80-\xff]")
WORD_BYTES = bytes(
    c if _keep.match(bytes([c])) else 32 for c in bytes(range(256)).lower()
)
_after_tag = re.compile(rb"[^\S\n]*:[^\S\n]*([^\n]*)")
_token = re.compile(r"\s*(\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
BINDS = {"with": 3, "and": 2, "or": 1}


@cache
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, label in {**BASE_PHRASES, **MORE_PHRASES, TAG: ""}.items():
        found.add_word(f" {phrase} ", (phrase, label))
    found.make_automaton()
    return found


def _apply(operator: str, right: tuple, left: tuple) -> tuple:
    if operator == "with":  # the exception only adds permissions to the license
        return ([f"{name} with {added}" for name in left[0] for added in right[0]], left[1])
    free = left[1] and right[1] if operator == "and" else left[1] or right[1]
    return (left[0] + right[0], free)


def parse_expression(text: str) -> tuple[list[str], bool]:
    """``(labels, permissive)`` of the longest valid expression ``text`` begins with.

    Anything that cannot follow, such as a second identifier in a row, ends the
    expression; brackets left open are closed there, an operator without right side is
    dropped. No identifier at all gives ``([], False)``.
    """
    values: list[tuple] = []
    pending: list[str] = []
    at, wants_value = 0, True

    def reduce(lowest: int) -> None:
        while pending and pending[-1] != "(" and BINDS[pending[-1]] >= lowest:
            values.append(_apply(pending.pop(), values.pop(), values.pop()))

    while match := _token.match(text, at):
        token = match[1].lower()
        if wants_value:
            if token == "(":
                pending.append(token)
            elif token == ")" or token in BINDS:
                break
            else:
                token = token.rstrip(".:-")
                values.append(([token], bool(PERMISSIVE.match(token))))
                wants_value = False
        elif token in BINDS:
            reduce(BINDS[token])
            pending.append(token)
            wants_value = True
        elif token == ")":
            reduce(0)
            if not pending:
                break
            pending.pop()
        else:
            break
        at = match.end()
    while wants_value and pending:
        wants_value = pending.pop() == "("
    while pending:
        reduce(0)
        if pending:
            pending.pop()
    return values[0] if values else ([], False)


def scan_text(text: str) -> dict:
    """Places, labels and score of one text."""
    data = text.encode()
    spaced = data.translate(WORD_BYTES)
    words = spaced.split()
    joined = " " + b" ".join(words).decode("latin-1") + " "
    hits = list(automaton().iter(joined))
    out = {
        "n_words": len(words), "n_base": 0, "first_word": None, "last_word": None,
        "base_labels": "", "labels": "", "score": 0.0, "expressions": [], "permissive": False,
    }
    if not hits:
        return out
    gaps = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 32)
    base, labels, starts, tags, weight, free = set(), set(), [], [], 0, []
    for end, (phrase, label) in hits:
        start = int(np.searchsorted(gaps, end - len(phrase) - 1))
        if phrase in BASE_PHRASES:
            base.add(label)
            starts.append(start)
        if phrase == TAG:
            tags.append(start + len(TAG.split()) - 1)
        if label:
            labels.add(label)
            free.append(bool(PERMISSIVE.match(label)))
            weight += PHRASE_WEIGHT
    if tags:  # where the tag's last word ends in the text
        word = np.frombuffer(spaced + b" ", np.uint8) != 32
        ends = np.flatnonzero(word[:-1] & ~word[1:]) + 1
        for tag in tags:
            match = _after_tag.match(data, ends[tag])
            written = match[1].decode() if match else ""
            found, permissive = parse_expression(written)
            if found:
                labels.update(name.replace(",", " ") for name in found)
                out["expressions"].append(written.strip())
                free.append(permissive)
                weight += TAG_WEIGHT
    if starts:
        out.update(n_base=len(starts), first_word=min(starts), last_word=max(starts))
    out["base_labels"], out["labels"] = ",".join(sorted(base)), ",".join(sorted(labels))
    out["score"] = 1.0 - 0.5 ** min(weight, 50)
    out["permissive"] = bool(free) and all(free)
    return out


SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels string, labels string, score double, expressions array<string>, "
    "permissive boolean"
)


def license_scan(documents: DataFrame) -> DataFrame:
    """One row per document ``(doc_id, text)``: license places, labels and score.

    Words are runs of letters, digits and anything beyond ASCII, A-Z lower-cased.
    ``n_base`` counts every place of a base phrase, also overlapping ones; without one
    the places are NULL. ``labels`` also holds other notices and what the expressions of
    tags name; a tag is its three words, a colon and an expression on the same line.
    ``score`` is ``1 - 2^-w``, where a notice adds 1 to ``w`` and a tag 3.
    ``permissive``: all notices and expressions found ask for notice only. NULL and empty
    texts have no words and score 0; an empty table gives no row; a NULL id stays NULL; repeated rows are all answered;
    other columns are ignored. Rows are independent, so nothing is shuffled.
    """

    def work():
        def step(block: pa.RecordBatch) -> dict[str, list]:
            rows = [scan_text(t) for t in block.column(1).to_pylist()]
            return {"doc_id": block.column(0)} | {
                name: [row[name] for row in rows]
                for name in ("n_words", "n_base", "first_word", "last_word", "base_labels",
                             "labels", "score", "expressions", "permissive")
            }

        return step

    return map_texts(documents, SCHEMA, work)
