"""Words, hashes and Arrow buffers shared by the text operators.

Texts reach Python as binary Arrow columns: one batch is one byte buffer with
offsets, so most work is numpy over the buffer and makes no Python object per
word. A word is a run of bytes other than space and ``\\t \\n \\v \\f \\r``; that is
the same split as ``[^\\x20\\x09-\\x0D]+`` on the decoded text, because no byte of a
longer UTF-8 sequence lies in that range.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
CHUNK = 1 << 20  # bytes of text hashed at a time
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE_VALUES = np.random.default_rng(42).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def text_bytes(name: str = "text") -> Column:
    """UTF-8 bytes of a text; a null text is an empty one."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a binary Arrow column."""
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_groups(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``size`` bytes; a longer row stands alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, min(last, rows)
        first = min(last, rows)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of each row's first word (rows + 1)."""
    inside = ~_SPACE[data]
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]
    begins[filled] = inside[filled]
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    closes[last] = inside[last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    global _powers
    if len(_powers[0]) <= size:
        inverse, made = pow(_BASE, -1, 1 << 64), []
        for base in (_BASE, inverse):
            table = np.full(size + 1, base, np.uint64)
            table[0] = 1
            made.append(np.cumprod(table))
        _powers = made[0], made[1]
    return _powers


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over its bytes, from prefix sums."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + CHUNK)))
        low, high = starts[first], ends[last - 1]
        powers, inverses = _power_tables(max(int(high - low), CHUNK))
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data[low:high]] * powers[: high - low], out=sums[1:])
        begin, end = starts[first:last] - low, ends[first:last] - low
        h = (sums[end] - sums[begin]) * inverses[begin]
        out[first:last] = mix(h + (end - begin).astype(np.uint64))
        first = last
    return out


def join_hashes(left: np.ndarray, right: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hash of two adjoining pieces from the hashes of the pieces; the order counts."""
    return mix(left * np.uint64(_BASE) + (right ^ np.uint64(0x2545F4914F6CDD1D + salt)))


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in smaller batches than Spark's default, unless the session has chosen a size.

    A batch of texts is in memory on both sides at once; these are still some megabytes.
    """
    if spark.conf.get(BATCH_SETTING) == "10000":
        spark.conf.set(BATCH_SETTING, "2000")


def first_by_hash(keys: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` of the distinct, narrow rows of ``keys``: those first by hash.

    A hash limit that leaves a little over ``rows`` comes before the sort, so what
    reaches the driver does not grow with the number of tasks.
    """
    keys = keys.distinct()
    h = F.xxhash64(*keys.columns)
    share = (rows + 6 * math.sqrt(rows) + 20) / max(keys.count(), 1)
    if share < 1:
        keys = keys.where(h < F.lit(int(share * 2**64) - 2**63))
    return keys.orderBy(h, *keys.columns).limit(rows)


class Codes(dict):
    """Numbers for keys in the order of their first look-up; ``fresh`` lists the new ones."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list = []

    def __missing__(self, key) -> int:
        self.fresh.append(key)
        number = self[key] = len(self)
        return number

    def of(self, groups: list[list]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all keys of all groups, and where each group begins (one more than groups)."""
        begins = np.cumsum([0, *map(len, groups)])
        found = np.fromiter(map(self.__getitem__, chain.from_iterable(groups)), np.int64, int(begins[-1]))
        return found, begins


def ragged(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of runs that begin at ``starts``, one after another, and where each run ends in the result."""
    stops = np.concatenate(([0], np.cumsum(lengths)))
    return np.repeat(starts - stops[:-1], lengths) + np.arange(stops[-1]), stops


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a narrow written table for broadcast if it has few rows; else leave it to a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df
