"""Quality rules by compression bands.

Prose shrinks to a share of its bytes that depends, above all, on how much of
it there is. zstandard measures that share for a whole document and for each of
its fixed chunks; a band of allowed shares per length, read off between the
points of ``BANDS``, rejects what shrinks too well (repetitive text) or hardly
at all (encoded or random text). Nothing is learned from the corpus, so a
document is judged alike whatever else the table holds, and rows are only read
once: no shuffle.

Plain rules come first: a document with few words, or with many of its words in
eight-word windows that repeat, fails before any ratio is looked at.

Null texts are empty, and an empty text has zero words and fails the plain
rules. Rows come out as they came in: a null or repeated ``doc_id`` changes
nothing, and other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry.llm.common import _SPACE, buffers, join_hashes, row_groups, text_bytes, word_hashes, word_spans

LEAST_WORDS = 20
REPEAT_WINDOW = 8
MOST_REPEATED = 30  # percent of the words
LEVEL = 3
CHUNK_BYTES = 4096
LEAST_CHUNK = 1024  # a shorter rest belongs to the chunk before it
MOST_BAD = 0.3  # share of a document's bytes in chunks outside their band

#: Bytes of text, least and most allowed compressed share. Prose lies near the middle of
#: a band in any script: about 0.75 at 128 bytes, 0.5 at 1,024, 0.45 at 4,096, 0.4 at 65,536.
BANDS = (
    (128, 0.42, 1.00), (256, 0.36, 0.90), (512, 0.33, 0.82), (1024, 0.30, 0.75),
    (4096, 0.27, 0.68), (16384, 0.25, 0.64), (65536, 0.22, 0.62),
)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LEADING = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point


@dataclass(frozen=True)
class Bands:
    """Allowed compressed shares by length, linear in the logarithm of the length between the points.

    Texts shorter than the first point have no band; those longer than the last have its band.
    """

    points: tuple[tuple[int, float, float], ...] = BANDS
    most_bad: float = MOST_BAD

    def inside(self, size: np.ndarray, ratio: np.ndarray) -> np.ndarray:
        at, low, high = (np.array(part, float) for part in zip(*self.points))
        where = np.log2(np.maximum(size, 1))
        ends = np.interp(where, np.log2(at), low), np.interp(where, np.log2(at), high)
        return (size < at[0]) | ((ratio >= ends[0]) & (ratio <= ends[1]))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the values of each row's bytes."""
    upto = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return np.diff(upto[offsets])


def _per_row(starts: np.ndarray, marked: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the marked places lie in each row."""
    return np.diff(np.searchsorted(starts[marked], offsets))


def repeated_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, window: int = REPEAT_WINDOW) -> np.ndarray:
    """Per row, its words in windows of ``window`` (a power of two) words that occur twice or more in the row.

    Windows are told apart by 64-bit hashes of their words.
    """
    words = np.diff(first)
    row = np.repeat(np.arange(len(words)), words)
    h, reach = word_hashes(data, starts, ends), 1
    while reach < window and len(h):
        h, reach = join_hashes(h[: len(h) - reach], h[reach:], reach), 2 * reach
    whole = np.arange(len(h)) + window <= first[1:][row[: len(h)]]  # windows within one row
    places = np.flatnonzero(whole)
    key = join_hashes(h[places], row[places].astype(np.uint64))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    edges = np.zeros(len(starts) + window + 1, np.int64)
    np.add.at(edges, places[again], 1)
    np.add.at(edges, places[again] + window, -1)
    covered = np.cumsum(edges)[: len(starts)] > 0
    return np.bincount(row[covered], minlength=len(words))


def repeated_lines(data: np.ndarray, offsets: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    """Per row, its lines that hold a word and equal an earlier line of the row."""
    breaks = np.flatnonzero(data == 10)
    begins = np.sort(np.concatenate((offsets[:-1], breaks + 1)), kind="stable")
    # a line ends at its line break, or where the next row begins
    stops = np.sort(np.concatenate((offsets[1:], breaks)), kind="stable")
    worded = np.searchsorted(word_starts, stops) > np.searchsorted(word_starts, begins)
    begins, stops = begins[worded], stops[worded]
    row = np.searchsorted(offsets, begins, "right") - 1
    key = join_hashes(word_hashes(data, begins, stops), row.astype(np.uint64))
    rows = len(offsets) - 1
    return np.bincount(row, minlength=rows) - np.bincount(row[np.unique(key, return_index=True)[1]], minlength=rows)


def chunks_of(size: int, chunk: int = CHUNK_BYTES, least: int = LEAST_CHUNK) -> list[tuple[int, int]]:
    """Fixed chunks of a text; a rest shorter than ``least`` joins the chunk before it."""
    edges = list(range(0, size, chunk)) or [0]
    if len(edges) > 1 and size - edges[-1] < least:
        edges.pop()
    return list(zip(edges, [*edges[1:], size]))


def compressed_shares(text: memoryview, compressor: zstandard.ZstdCompressor) -> tuple[float, np.ndarray, np.ndarray]:
    """Compressed share of a whole text, then lengths and shares of its chunks; an empty text has share 1."""
    whole = len(compressor.compress(text)) / len(text) if len(text) else 1.0
    spans = chunks_of(len(text))
    if len(spans) == 1:
        return whole, np.array([len(text)]), np.array([whole])
    sizes = np.array([b - a for a, b in spans])
    return whole, sizes, np.array([len(compressor.compress(text[a:b])) for a, b in spans]) / sizes


def measure(data: np.ndarray, offsets: np.ndarray, bands: Bands = Bands()) -> dict[str, np.ndarray]:
    """All columns of ``quality_rules`` for a run of texts."""
    size = np.diff(offsets)
    starts, ends, first = word_spans(data, offsets)
    words = np.diff(first)
    repeated = repeated_words(data, starts, ends, first)
    failed = (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * words)
    compressor, raw = zstandard.ZstdCompressor(level=LEVEL), memoryview(np.ascontiguousarray(data))
    ratio, bad = np.ones(len(size)), np.zeros(len(size))
    for i in range(len(size)):
        ratio[i], sizes, shares = compressed_shares(raw[offsets[i] : offsets[i + 1]], compressor)
        bad[i] = sizes[~bands.inside(sizes, shares)].sum() / max(size[i], 1)
    return {
        "n_words": words, "word_chars": _sums(_LEADING[data] & ~_SPACE[data], offsets),
        "n_symbols": _sums(_SYMBOL[data], offsets), "n_dup_lines": repeated_lines(data, offsets, starts),
        "n_repeat_words": repeated, "base_failed": failed,
        "kept": ~failed & bands.inside(size, ratio) & (bad <= bands.most_bad),
        "compressed_share": ratio, "bad_chunks": bad,
    }


COLUMNS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, compressed_share double, bad_chunks double"
)


def _measured(column: pa.Array, bands: Bands) -> dict[str, np.ndarray]:
    data, offsets = buffers(column)
    parts = [
        measure(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], bands) for a, b in row_groups(offsets)
    ] or [measure(data, offsets, bands)]
    return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}


def quality_rules(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, what the plain rules count, and the verdicts.

    ``kept`` is false where the plain rules fail, where the whole text lies outside
    its band, or where more than ``bands.most_bad`` of its bytes are in chunks that do.
    """

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _measured(batch.column(1), bands)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, found.values())], names=["doc_id", *found]
            )

    return docs.select(F.col("doc_id").cast("bigint"), text_bytes()).mapInArrow(per_batch, f"doc_id bigint, {COLUMNS}")


def accepted(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the same columns."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = batch.num_columns - 1
            kept = pa.array(_measured(batch.column(width), bands)["kept"], pa.bool_())
            yield batch.select(range(width)).filter(kept)

    return docs.select("*", text_bytes().alias("__text")).mapInArrow(per_batch, docs.schema)
