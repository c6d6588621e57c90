"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees are boosted in turns, one feature after the other, so each feature ends in a
lookup table over its bins; then the same for chosen pairs of features over a grid. A score
is the sum of one table entry for each feature and pair. Trees are fitted on histograms of
a bounded sample of labelled rows; features and scores cover every row in one narrow pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passages.llm.common import map_rows, map_texts
from passages.llm.hashing import WordHasher, _bytes_of

FEATURES = (
    "log_words", "word_bytes", "upper_share", "digit_share", "symbol_share", "bar_share",
    "stop_share", "repeat_share", "distinct_share", "line_words", "beyond_ascii_share",
    "longest_run", "top_word_share", "capital_share",
)
SCHEMA = "doc_id bigint, features array<double>"
# The classifier is fitted on at most this many labelled rows, drawn by a hash of the id.
SAMPLE_ROWS = 20_000
BINS, GRID, ROUNDS, PAIR_ROUNDS, PAIRS, RATE, RIDGE = 32, 8, 150, 60, 6, 0.15, 2.0


def _table(chars: bytes | range) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


UPPER, LOWER, DIGIT = _table(range(65, 91)), _table(range(97, 123)), _table(range(48, 58))
STOP, BAR, LINE = _table(b".,;:"), _table(b"|"), _table(b"\n")
SYMBOL = _table(b"!\"#$%&'()*+-/<=>?@[\\]^_`{}~")
HIGH = _table(range(128, 256))


def features_of(texts: pa.Array, hasher: WordHasher) -> np.ndarray:
    """``(texts, features)``; a text without words has zeros in all but a few columns."""
    data, ends = _bytes_of(texts)
    words = hasher(texts)
    rows = len(texts)

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return np.diff(total[ends]).astype(float)

    counts = words.counts.astype(float)
    chars = np.diff(ends).astype(float)
    upper, lower = per_text(UPPER[data]), per_text(LOWER[data])
    text = np.repeat(np.arange(rows), words.counts)
    same = np.zeros(len(text))
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (text[1:] == text[:-1])
    order = np.lexsort((words.hashes, text))
    t, h = text[order], words.hashes[order]
    fresh = np.ones(len(t), bool)
    fresh[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    begins = np.flatnonzero(fresh)
    times = np.diff(np.append(begins, len(t)))
    top = np.zeros(rows)
    np.maximum.at(top, t[begins], times)
    broken = np.flatnonzero(same == 0)
    longest = np.zeros(rows)
    np.maximum.at(longest, text[broken], np.diff(np.append(broken, len(same))))
    at_word = np.ones(len(data), bool)
    at_word[1:] = (data[:-1] == 32) | (data[:-1] == 10)
    some, any_char = np.maximum(counts, 1), np.maximum(chars, 1)
    return np.column_stack([
        np.log1p(counts),
        (chars - per_text((data == 32) | (data == 10))) / some,
        upper / np.maximum(upper + lower, 1),
        per_text(DIGIT[data]) / any_char,
        per_text(SYMBOL[data]) / any_char,
        per_text(BAR[data]) / some,
        per_text(STOP[data]) / some,
        np.bincount(text, same, rows) / some,
        np.bincount(t[begins], minlength=rows) / some,
        counts / (per_text(LINE[data]) + 1),
        per_text(HIGH[data]) / any_char,
        longest / some,
        top / some,
        per_text(at_word & UPPER[data]) / some,
    ])


def text_features(documents: DataFrame) -> DataFrame:
    """``(doc_id, features)`` from the text alone, in a narrow pass."""

    def work():
        hasher = WordHasher(1, fold_case=False)

        def step(block: pa.RecordBatch) -> dict:
            found = features_of(block.column(1), hasher)
            return {"doc_id": block.column(0), "features": list(found)}

        return step

    return map_texts(documents, SCHEMA, work)


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables; ``pairs`` index coarse grids of two features."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    grids: list[np.ndarray]

    def bins(self, features: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, features[:, j], side="right") for j, e in enumerate(self.edges)]

    def score(self, features: np.ndarray) -> np.ndarray:
        at = self.bins(features)
        total = np.full(len(features), self.base)
        for table, where in zip(self.tables, at):
            total += table[where]
        for (i, j), grid in zip(self.pairs, self.grids):
            total += grid[at[i] * GRID // BINS, at[j] * GRID // BINS]
        return 1.0 / (1.0 + np.exp(-total))


def _best_cut(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, int]:
    """Gain of the best cut of ordered bins, and the bins left of it (0: none)."""
    left_g, left_w = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    all_g, all_w = gradient.sum(), weight.sum()
    gain = (
        left_g**2 / (left_w + RIDGE) + (all_g - left_g) ** 2 / (all_w - left_w + RIDGE)
        - all_g**2 / (all_w + RIDGE)
    )
    if not len(gain) or gain.max() <= 1e-9:
        return 0.0, 0
    return float(gain.max()), int(gain.argmax()) + 1


def _tree(gradient: np.ndarray, weight: np.ndarray, depth: int) -> np.ndarray:
    """Leaf values of a shallow tree, one for each bin."""
    _, cut = _best_cut(gradient, weight) if depth else (0.0, 0)
    if not cut:
        return np.full(len(gradient), gradient.sum() / (weight.sum() + RIDGE))
    return np.concatenate([
        _tree(gradient[:cut], weight[:cut], depth - 1),
        _tree(gradient[cut:], weight[cut:], depth - 1),
    ])


def _grid_tree(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A cut along one axis and, in each half, one along the other."""
    by_row = _best_cut(gradient.sum(1), weight.sum(1))
    by_column = _best_cut(gradient.sum(0), weight.sum(0))
    if by_column[0] > by_row[0]:
        return _grid_tree_by_row(gradient.T, weight.T, by_column[1]).T
    return _grid_tree_by_row(gradient, weight, by_row[1])


def _grid_tree_by_row(gradient: np.ndarray, weight: np.ndarray, cut: int) -> np.ndarray:
    halves = [slice(0, cut), slice(cut, None)] if cut else [slice(None)]
    return np.concatenate([
        np.broadcast_to(_tree(gradient[h].sum(0), weight[h].sum(0), 1), gradient[h].shape)
        for h in halves
    ])


def fit(features: np.ndarray, labels: np.ndarray) -> AdditiveModel:
    """Boost tables feature by feature, then pair by pair; the same input, the same model.

    Without rows, or with one label only, the model is a constant.
    """
    share = (labels.sum() + 1) / (len(labels) + 2)
    cuts = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = [np.unique(np.quantile(f, cuts)) if len(f) else np.zeros(0) for f in features.T]
    model = AdditiveModel(
        float(np.log(share / (1 - share))), edges, [np.zeros(BINS) for _ in edges], [], []
    )
    if not 0 < labels.sum() < len(labels):
        return model
    at = model.bins(features)
    total = np.full(len(labels), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        chance = 1 / (1 + np.exp(-total))
        return labels - chance, chance * (1 - chance)

    for _ in range(ROUNDS):
        for j, where in enumerate(at):
            gradient, weight = slopes()
            step = RATE * _tree(
                np.bincount(where, gradient, BINS), np.bincount(where, weight, BINS), 2
            )
            model.tables[j] += step
            total += step[where]
    cells = {
        (i, j): (at[i] * GRID // BINS) * GRID + at[j] * GRID // BINS
        for i, j in combinations(range(len(at)), 2)
    }

    def histograms(pair: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        gradient, weight = slopes()
        shape, size = (GRID, GRID), GRID * GRID
        return (np.bincount(cells[pair], gradient, size).reshape(shape),
                np.bincount(cells[pair], weight, size).reshape(shape))

    def gain(pair: tuple[int, int]) -> float:
        gradient, weight = histograms(pair)
        return float((gradient**2 / (weight + RIDGE)).sum())

    model.pairs = sorted(cells, key=lambda pair: (-gain(pair), pair))[:PAIRS]
    model.grids = [np.zeros((GRID, GRID)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for pair, grid in zip(model.pairs, model.grids):
            step = RATE * _grid_tree(*histograms(pair))
            grid += step
            total += step.reshape(-1)[cells[pair]]
    return model


def held_out(doc_id: str = "doc_id"):
    """True for the third of all ids that training never sees; False for a NULL id."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % 3 == 1, F.lit(False))


def train_quality(
    documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS
) -> AdditiveModel:
    """Fit on labelled rows that are not held out, at most ``sample_rows`` of them.

    The sample is drawn by a hash of the id, so it does not depend on the layout of the
    tables; its ids are few enough to be shipped to the documents, and its features to be
    fitted on the driver. Of several labels of one id the largest counts, of several texts
    the one with the smallest features.
    """
    wanted = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    drawn = F.broadcast(wanted.select(F.col("doc_id").alias("_id"), "quality"))
    texts = documents.select("doc_id", "text").join(
        F.broadcast(wanted.select("doc_id")), "doc_id", "left_semi"
    )
    rows = (
        text_features(texts).groupBy("doc_id").agg(F.min("features").alias("features"))
        .join(drawn, F.col("doc_id") == F.col("_id"))
        .select("doc_id", "features", "quality").toArrow().sort_by("doc_id")
    )
    features = np.array(rows["features"].to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(features, (rows["quality"].to_numpy() > 0).astype(float))


def score_quality(documents: DataFrame, model: AdditiveModel) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``documents``.

    A score is the chance of label 1; empty and NULL texts are scored like any other. A
    NULL id stays NULL and is not held out; repeated rows are all scored.
    """

    def work():
        hasher = WordHasher(1, fold_case=False)

        def step(block: pa.RecordBatch) -> dict:
            scores = model.score(features_of(block.column(1), hasher))
            return {"doc_id": block.column(0), "score": scores}

        return step

    scored = map_texts(documents, "doc_id bigint, score double", work)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, model: AdditiveModel) -> DataFrame:
    """The rows of ``documents`` that the model does not reject, with all their columns.

    Empty and NULL texts are scored like any other; repeated rows and NULL ids stay or go
    by their text alone; an empty table stays empty.
    """

    def work():
        hasher = WordHasher(1, fold_case=False)

        def step(rows: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
            return rows.filter(pa.array(model.score(features_of(texts, hasher)) >= 0.5))

        return step

    return map_rows(documents, work)
