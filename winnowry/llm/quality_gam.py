"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins and owns a lookup table of log-odds; cyclic boosting
visits the features in turn and adds a small step of a shallow tree over the bins,
then the same over pairs of features that explain most of what is left. A text is
scored by adding table entries. Only the text is looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry.llm.common import (
    _power_tables, buffers, first_by_hash, join_hashes, row_groups, text_bytes, word_hashes, word_spans,
)

SAMPLE_ROWS = 20_000  # labelled rows used to fit
BINS = 48
PAIR_BINS = 8
PAIRS = 10
ROUNDS = 150
RATE = 0.1

_KINDS = 14
_KIND = np.zeros(256, np.uint8)  # 0: control bytes


def _kinds(number: int, characters: bytes) -> None:
    _KIND[list(characters)] = number


_kinds(1, b"abcdefghijklmnopqrstuvwxyz")
_kinds(2, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_kinds(3, b"0123456789")
_kinds(4, b" ")
_kinds(5, b"\n")
_kinds(6, b"\t\v\f\r")
_kinds(7, b".")
_kinds(8, b",;:")
_kinds(9, b"!?")
_kinds(10, b"'\"()-")
_kinds(11, b"|")
_kinds(12, b"#$%&*@^~_=+<>{}[]\\/`")
_KIND[128:] = 13

FEATURES = (
    "log_bytes", "log_words", "log_lines", "word_length", "longest_word", "words_per_line",
    "upper_share", "digit_share", "symbol_share", "bar_share", "comma_share", "exclaim_share", "foreign_share",
    "letter_share", "blank_share", "sentence_ends", "symbol_ends", "exclaim_ends", "upper_words", "capital_words",
    "wordless", "short_words", "distinct_words", "distinct_lines", "stop_rate",
)


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text; an empty text gives zeros."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    kind = _KIND[data]
    row_of = np.repeat(np.arange(n, dtype=np.int64) * _KINDS, size)
    count = np.bincount(row_of + kind, minlength=n * _KINDS).reshape(n, _KINDS)
    starts, ends, first = word_spans(data, offsets)
    words = np.diff(first)
    row = np.repeat(np.arange(n), words)
    length = ends - starts

    def per_row(values: np.ndarray) -> np.ndarray:
        return np.bincount(row, weights=values, minlength=n)

    begin, end = kind[starts], kind[ends - 1]
    uppers = np.concatenate(([0], np.cumsum(kind == 2)))
    letters = np.concatenate(([0], np.cumsum((kind == 1) | (kind == 2) | (kind == 13))))
    upper_in, letters_in = uppers[ends] - uppers[starts], letters[ends] - letters[starts]
    h = word_hashes(data, starts, ends)
    distinct = np.bincount(
        row[np.unique(join_hashes(h, row.astype(np.uint64)), return_index=True)[1]], minlength=n
    )
    breaks = np.concatenate(([0], np.cumsum(kind == 5)))
    line = breaks[starts] + row  # lines numbered through all rows; a row begins a line
    new = np.ones(len(line), bool)
    new[1:] = line[1:] != line[:-1]
    at = np.flatnonzero(new)
    powers, inverses = _power_tables(len(h))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * powers[: len(h)])))
    line_hash = (sums[np.append(at[1:], len(h))] - sums[at]) * inverses[at] if len(at) else sums[:0]
    line_row = row[at]
    lines = np.bincount(line_row, minlength=n)
    kinds_of_lines = np.unique(join_hashes(line_hash, line_row.astype(np.uint64)), return_index=True)[1]
    distinct_lines = np.bincount(line_row[kinds_of_lines], minlength=n)
    longest = np.zeros(n)
    np.maximum.at(longest, row, length)
    cased = count[:, 1] + count[:, 2]
    full = [
        np.log1p(size), np.log1p(words), np.log1p(lines), _ratio(per_row(length), words), np.log1p(longest),
        np.log1p(_ratio(words, lines)), _ratio(count[:, 2], cased), _ratio(count[:, 3], size),
        _ratio(count[:, 12], size), _ratio(count[:, 11], words), _ratio(count[:, 8], words),
        _ratio(count[:, 9], words), _ratio(count[:, 13], size), _ratio(cased + count[:, 13], size),
        _ratio(count[:, 4] + count[:, 5] + count[:, 6], size), _ratio(per_row(end == 7), words),
        _ratio(per_row(end == 12), words), _ratio(per_row(end == 9), words),
        _ratio(per_row((upper_in == letters_in) & (letters_in > 1)), words), _ratio(per_row(begin == 2), words),
        _ratio(per_row(letters_in == 0), words), _ratio(per_row(length <= 3), words), _ratio(distinct, words),
        _ratio(distinct_lines, lines), _ratio(count[:, 7], words),
    ]
    return np.column_stack(full).astype(np.float64)


@dataclass
class Additive:
    """Bin edges and log-odds tables of single features and of pairs."""

    edges: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    coarse: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, (edge, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edge, x[:, f], "right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[
                np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")
            ]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Edges between quantiles; equal values share a bin."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _split(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """Best cut of bins into two runs, and what it gains; 0 for no cut."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = (
        _gain(left_g, left_h, ridge) + _gain(g.sum() - left_g, h.sum() - left_h, ridge)
        - _gain(g.sum(), h.sum(), ridge)
    )
    best = int(np.argmax(gains))
    return (float(gains[best]), best + 1) if gains[best] > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, ridge: float = 5.0) -> np.ndarray:
    """Leaf values per bin of a tree of depth two over neighbouring bins."""
    _, cut = _split(g, h, ridge)
    edges = {0, cut, len(g)}
    for low, high in ((0, cut), (cut, len(g))):
        _, inner = _split(g[low:high], h[low:high], ridge)
        edges.add(low + inner)
    value = np.empty(len(g))
    ordered = sorted(edges)
    for low, high in zip(ordered, ordered[1:]):
        value[low:high] = g[low:high].sum() / (h[low:high].sum() + ridge)
    return value


def _pair_tree(g: np.ndarray, h: np.ndarray, ridge: float = 5.0) -> tuple[np.ndarray, float]:
    """Leaf values per cell of a tree that cuts one feature, then the other in each half; and its gain."""
    best, found = -1.0, np.zeros_like(g)
    for flip in (False, True):
        gg, hh = (g.T, h.T) if flip else (g, h)
        for cut in range(1, len(gg)):
            value, gain = np.empty_like(gg), -float(_gain(g.sum(), h.sum(), ridge))
            for rows in (slice(0, cut), slice(cut, None)):
                a, b = gg[rows].sum(0), hh[rows].sum(0)
                _, inner = _split(a, b, ridge)
                for part in (slice(0, inner), slice(inner, None)):
                    if a[part].size:
                        value[rows, part] = a[part].sum() / (b[part].sum() + ridge)
                        gain += float(_gain(a[part].sum(), b[part].sum(), ridge))
            if gain > best:
                best, found = gain, value.T if flip else value
    return found, best


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS, rate: float = RATE) -> Additive:
    """Fit on features and 0/1 labels; one class or no rows give the constant model."""
    features = x.shape[1]
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    constant = [np.zeros(0)] * features, base, [np.zeros(1)] * features, [], [np.zeros(0)] * features, []
    if len(np.unique(y)) < 2:
        return Additive(*constant)
    edges = [_cuts(x[:, f], BINS) for f in range(features)]
    coarse = [_cuts(x[:, f], PAIR_BINS) for f in range(features)]
    bins = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)]
    cells = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(coarse)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(y), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f in range(features):
            g, h = slopes()
            k = len(tables[f])
            step = rate * _tree(np.bincount(bins[f], g, k), np.bincount(bins[f], h, k))
            tables[f] += step
            total += step[bins[f]]

    def grid(a: int, b: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, columns = len(coarse[a]) + 1, len(coarse[b]) + 1
        cell = cells[a] * columns + cells[b]
        return tuple(np.bincount(cell, v, rows * columns).reshape(rows, columns) for v in (g, h))

    g, h = slopes()
    ranked = sorted(combinations(range(features), 2), key=lambda p: -_pair_tree(*grid(*p, g, h))[1])
    chosen = ranked[:pairs]
    pair_tables = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in chosen]
    for _ in range(rounds // 3):
        for (a, b), table in zip(chosen, pair_tables):
            g, h = slopes()
            step = rate * _pair_tree(*grid(a, b, g, h))[0]
            table += step
            total += step[cells[a], cells[b]]
    return Additive(edges, base, tables, chosen, coarse, pair_tables)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        data, offsets = buffers(batch.column(batch.num_columns - 1))
        parts = [
            text_features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            for a, b in row_groups(offsets)
        ]
        yield batch, np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``rows`` labelled documents, the ones first by hash; a repeated label counts once."""
    spark = docs.sparkSession
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("id"), F.col("quality").cast("int").alias("y")
    )
    drawn = first_by_hash(known, rows).collect()
    if not drawn:
        return np.zeros((0, len(FEATURES))), np.zeros(0)
    chosen = F.broadcast(spark.createDataFrame(drawn, "id bigint, y int"))  # at most the sample
    texts = docs.join(chosen, F.col("doc_id").cast("bigint") == F.col("id")).select("id", "y", text_bytes())

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _feature_batches(batches):
            lists = pa.array(list(x), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["id", "y", "x"])

    found = texts.mapInArrow(per_batch, "id bigint, y int, x array<double>").collect()
    found.sort(key=lambda r: (r["id"], r["y"], r["x"]))
    x = np.array([r["x"] for r in found], np.float64).reshape(len(found), len(FEATURES))
    return x, np.array([r["y"] for r in found], np.float64)


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Additive:
    """The model from the given labels; which of them may be learned from is the caller's choice."""
    return fit(*training_rows(docs.select("doc_id", "text"), labels, rows))


def score_quality(docs: DataFrame, model: Additive) -> DataFrame:
    """``(doc_id, score)`` per row; null and empty texts are scored like any other, from zero features."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _feature_batches(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.score(x))], names=["doc_id", "score"]
            )

    return docs.select("doc_id", text_bytes()).mapInArrow(per_batch, "doc_id bigint, score double")


def accepted(docs: DataFrame, model: Additive, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores ``least`` or more, with the same columns."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _feature_batches(batches):
            kept = batch.select(range(batch.num_columns - 1))
            yield kept.filter(pa.array(model.score(x) >= least, pa.bool_()))

    return docs.withColumn("__text", text_bytes()).mapInArrow(per_batch, docs.schema)


def fold(doc_id: str = "doc_id", parts: int = 3):
    """The part a document falls in: crc32 of its id as text; a null id falls in none."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(parts))
