"""Secret scans: patterns, and the guess cost of values that stand where credentials do.

The cost of a value is the logarithm of the guesses that the cheapest segmentation into
known words, dates, repeats, keyboard walks and brute-force characters needs, found by
dynamic programming over its positions. Known words are the first guesses below and the
words of all documents, the most frequent first.
"""

from __future__ import annotations

import hashlib
import math
import re
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passages.llm.common import map_rows, map_texts, store

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.I | re.A,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
CONTEXT = re.compile(
    r"""(?:passw(?:or)?d|passphrase|pwd|secret|token|api[_-]?key|credentials?|private[_-]?key|"""
    r"""access[_-]?key|client[_-]?secret|auth(?:orization)?)["']?\x20*(?:[:=]|=>)\x20*"""
    r"""(?:bearer\x20+|basic\x20+)?["']?([^\s"'<>,;]{8,})""",
    re.I | re.A,
)
KINDS = ("assign", "access", "hex", "cost")
# Values that take at least 10^STRONG guesses are taken for real credentials.
STRONG = 8.0

# A text without any of these has no match of ASSIGN or CONTEXT.
HINTS = (b"passw", b"passphrase", b"pwd", b"secret", b"token", b"api", b"credential", b"private",
         b"access", b"auth")
_is_hex = bytes(49 if c in b"0123456789abcdef" else 48 for c in range(256))

# Words that guessing starts with.
FIRST_WORDS = (
    "password passwd secret token admin root user login welcome dragon master monkey letmein "
    "qwerty test demo example sample default change change_me changeme none null true false "
    "hello world love sun moon star spring summer autumn winter january february march april "
    "may june july august september october november december monday tuesday wednesday "
    "thursday friday saturday sunday key value string your here api auth bearer client access "
    "public private placeholder redacted hidden todo dummy fake guest system server database "
    "princess football baseball superman batman trustno iloveyou sunshine shadow michael "
    "jennifer jordan hunter killer soccer hockey ranger daniel george andrew charlie thomas "
    "robert matthew joshua pepper ginger cookie cheese banana orange flower purple silver "
    "golden diamond angel freedom whatever computer internet tigger buster mustang harley "
    "maggie jessica ashley nicole chelsea matrix phoenix starwars pokemon samsung google "
    "secure security support service backup manager office company"
).split()
# At most so many words of the documents are known besides, of 3 to LONGEST_WORD letters a-z.
CORPUS_WORDS = 20_000
LONGEST_WORD = 16
RANK = {word: place + 1 for place, word in enumerate(FIRST_WORDS)}
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LEET = str.maketrans("4301$57@", "aeolssta")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
_year = re.compile(r"(?:19|20)[0-9][0-9]")
_date = re.compile(r"[0-9]{1,4}([-/._]?)[0-9]{1,2}\1[0-9]{1,4}")
DATE_COST, YEAR_COST = math.log10(365 * 120), math.log10(120)
BRUTE = 1.0


@cache
def _neighbours() -> frozenset[tuple[str, str]]:
    pairs = set()
    for row in ROWS:
        pairs.update(zip(row, row[1:]))
        pairs.update(zip(row[1:], row))
    for upper, lower in zip(ROWS, ROWS[1:]):
        for column, char in enumerate(lower):
            for beside in upper[column:column + 2]:
                pairs.update({(char, beside), (beside, char)})
    for first in "abcdefghijklmnopqrstuvwxyz"[:-1]:
        pairs.update({(first, chr(ord(first) + 1)), (chr(ord(first) + 1), first)})
    return frozenset(pairs)


def word_cost(value: str, plain: str, read: str, at: int, end: int, ranks: dict) -> float:
    """Price of a span as a known word, infinite if it is none."""
    rank = ranks.get(plain[at:end])
    swapped = rank is None
    rank = rank or ranks.get(read[at:end])
    if not rank:
        return math.inf
    return math.log10(rank + 1) + 0.3 * ((value[at:end] != plain[at:end]) + swapped) + 0.3


def date_cost(value: str, at: int, end: int) -> float:
    """Price of a span as a year or a date, infinite if it is none."""
    if end - at == 4 and _year.fullmatch(value, at, end):
        return YEAR_COST
    if end - at >= 6 and (date := _date.fullmatch(value, at, end)):
        return DATE_COST + (0.6 if date[1] else 0.0)
    return math.inf


# Repeats of one character, keyboard walks, and repeats of 2, 3 and 4 characters: length of
# a unit, least number of units, price of n units. All prices are concave in n.
SERIES = (
    (1, 3, lambda n: BRUTE + math.log10(n)),
    (1, 3, lambda n: math.log10(47) + 0.5 * math.log10(n) + 0.3),
    *((unit, 2, lambda n, unit=unit: unit * BRUTE + math.log10(n)) for unit in (2, 3, 4)),
)


def most_units(plain: str, kind: int) -> list[int]:
    """For each position, how many units of a kind of series stand there at most."""
    size, unit = len(plain), SERIES[kind][0]
    beside = _neighbours()
    links = [0] * (size + 1)
    for at in range(size - unit - 1, -1, -1):
        if kind == 1:
            linked = (plain[at], plain[at + 1]) in beside
        else:
            linked = plain[at] == plain[at + unit]
        links[at] = links[at + 1] + 1 if linked else 0
    return [1 + links[at] // unit for at in range(size)]


def guess_cost(value: str, ranks: dict[str, int] = RANK) -> float:
    """Logarithm (base 10) of the guesses the cheapest segmentation of ``value`` needs.

    It is the minimum over all segmentations, with every part of a repeat or walk a span of
    its own. A start inside a series is kept only if its shortest span is cheaper than what
    starts before offer: as prices are concave, it is at no longer one if not there. So
    few starts are open at a time, and the time is about linear in the value's length.
    """
    plain = value.translate(LOWER)
    read = plain.translate(LEET)
    size = len(value)
    best = [0.0] + [math.inf] * size
    units = [most_units(plain, kind) for kind in range(len(SERIES))]
    started: list[dict] = [{} for _ in SERIES]  # place within a unit -> [(start, last end)]
    for at in range(size + 1):
        for kind, (unit, least, price) in enumerate(SERIES):
            starts = started[kind].get(at % unit)
            if starts:
                starts[:] = [s for s in starts if s[1] >= at]
                for start, _ in starts:
                    count = (at - start) // unit
                    if count >= least:
                        best[at] = min(best[at], best[start] + price(count))
        if at == size:
            break
        here = best[at]
        best[at + 1] = min(best[at + 1], here + BRUTE)
        for kind, (unit, least, price) in enumerate(SERIES):
            if units[kind][at] >= least:
                starts = started[kind].setdefault(at % unit, [])
                first = at + unit * least
                offered = min(
                    (best[s] + price((first - s) // unit) for s, last in starts if last >= first),
                    default=math.inf,
                )
                if here + price(least) < offered:
                    starts.append((at, at + unit * units[kind][at]))
        for end in range(at + 3, min(at + LONGEST_WORD, size) + 1):
            cost = word_cost(value, plain, read, at, end, ranks)
            if here + cost < best[end]:
                best[end] = here + cost
        if "0" <= value[at] <= "9":
            for end in range(at + 4, min(at + 12, size) + 1):
                cost = date_cost(value, at, end)
                if here + cost < best[end]:
                    best[end] = here + cost
    return best[size]


def known_words(documents: DataFrame, most: int = CORPUS_WORDS) -> dict[str, int]:
    """Ranks of the first guesses, then of the most frequent words of all texts.

    Words are runs of 3 to LONGEST_WORD letters a-z with A-Z lower-cased. Frequencies fall in
    classes of an eighth of a doubling; the highest classes that together hold at most
    ``most`` words are taken whole, so no more than that reach the driver whatever the number
    of tasks. Equal counts rank by the word.
    """
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = documents.select(F.explode(F.split(lowered, "[^a-z]+")).alias("word"))
    counts = words.where(F.length("word").between(3, LONGEST_WORD)).groupBy("word").count()
    counts = store(
        counts.withColumn("class", F.floor(8 * F.log2("count")).cast("int")), "word-counts"
    )
    total, lowest = 0, None
    for row in counts.groupBy("class").agg(F.count("*").alias("n")).orderBy(F.desc("class")).collect():
        total += row["n"]
        if total > most:
            break
        lowest = row["class"]
    ranks = dict(RANK)
    if lowest is not None:
        found = counts.where(F.col("class") >= lowest).select("word", "count").collect()
        for row in sorted(found, key=lambda r: (-r["count"], r["word"])):
            ranks.setdefault(row["word"], len(ranks) + 1)
    return ranks


def base_spans(text: str, data: bytes, lowered: bytes) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the three patterns; failing matches are dropped."""
    found = []
    if any(hint in lowered for hint in (b"passw", b"secret", b"token", b"api")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                  if len(m[2]) >= LEAST["assign"]]
    if b"AKIA" in data:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= LEAST["access"]]
    if b"1" * LEAST["hex"] in data.translate(_is_hex):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)
                  if m.end() - m.start() >= LEAST["hex"]]
    return found


def scan_text(text: str, ranks: dict[str, int] = RANK) -> dict:
    data = text.encode()
    lowered = data.lower()
    base = sorted(base_spans(text, data, lowered))
    added = {}
    if any(hint in lowered for hint in HINTS):
        for match in CONTEXT.finditer(text):
            cost = guess_cost(match[1], ranks)
            if cost >= STRONG:
                added[match.start(1), 3, match.end(1)] = cost
    spans = sorted([*base, *added])
    written = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base)
    return {
        "n_assign": sum(k == 0 for _, k, _ in base),
        "n_access": sum(k == 1 for _, k, _ in base),
        "n_hex": sum(k == 2 for _, k, _ in base),
        "base_sha256": hashlib.sha256(written.encode()).hexdigest(),
        "spans": ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans),
        "n_cost": len(added),
        "largest_cost": max(added.values(), default=None),
    }


def redact_text(text: str, ranks: dict[str, int] = RANK, mask: str = "[secret]") -> str:
    """``text`` with every span found replaced; spans that overlap become one mask."""
    spans = [tuple(map(int, s.split(":")[1:])) for s in scan_text(text, ranks)["spans"].split(",") if s]
    out, at = [], 0
    for start, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


SCHEMA = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
    "spans string, n_cost bigint, largest_cost double"
)


def secret_scan(documents: DataFrame) -> DataFrame:
    """One row per document ``(doc_id, text)``: secrets by pattern and by guess cost.

    ``spans`` lists ``kind:start:end`` in code points, end exclusive, by start and then
    kind; kind ``cost`` is a value in a credential context that takes at least 10^8
    guesses, where ``known_words`` of these documents are guessed first. NULL and empty texts
    have no spans; a NULL id stays NULL; repeated rows are all answered; an empty table gives
    no row; other columns are ignored. Only counts of words are shuffled.
    """
    ranks = documents.sparkSession.sparkContext.broadcast(known_words(documents))

    def work():
        known = ranks.value

        def step(block: pa.RecordBatch) -> dict[str, list]:
            rows = [scan_text(t, known) for t in block.column(1).to_pylist()]
            return {"doc_id": block.column(0)} | {
                name: [row[name] for row in rows]
                for name in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_cost",
                             "largest_cost")
            }

        return step

    return map_texts(documents, SCHEMA, work)


def redact_secrets(documents: DataFrame) -> DataFrame:
    """``documents`` with every secret in ``text`` masked; NULL texts and other columns stay.

    Every row stays, repeated ones too; an empty table stays empty.
    """
    at = documents.columns.index("text")
    ranks = documents.sparkSession.sparkContext.broadcast(known_words(documents))

    def work():
        known = ranks.value

        def step(rows: pa.RecordBatch, _: pa.Array) -> pa.RecordBatch:
            masked = [None if t is None else redact_text(t, known) for t in rows.column(at).to_pylist()]
            return rows.set_column(at, rows.schema.field(at), pa.array(masked, rows.schema.field(at).type))

        return step

    return map_rows(documents, work)
