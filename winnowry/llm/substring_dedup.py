"""Substring dedup by level-wise doubling of repeated windows.

A window is ``length`` consecutive words of one document. Levels have lengths
``first, 2 * first, ..., length``. At each level every window still alive is
stood for by the smallest hash among its sub-windows of the level's length (equal
windows choose the same one, neighbours mostly share theirs); only windows whose
stand-in occurs in several documents are extended to twice the length. At the last
level the windows themselves are compared, by 128-bit hash, and each is owned by
the smallest ``doc_id`` it starts in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnowry.llm.common import (
    _power_tables, buffers, checked_broadcast, join_hashes, mix, row_groups, text_bytes, word_hashes,
    word_spans,
)
from winnowry.staging import stage

LENGTH = 50
FIRST = 25


def levels(length: int, first: int) -> list[int]:
    """The doubling lengths; ``length`` must be ``first`` times a power of two."""
    found = [first]
    while found[-1] < length:
        found.append(2 * found[-1])
    if found[-1] != length:
        raise ValueError(f"{length} is not {first} doubled")
    return found


def run_hashes(h: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """Hash of every run of ``length`` words, built from runs of 1, 2, 4, ... words."""
    whole, size, piece, step = None, 0, h, 1
    while True:
        if length & step:
            if whole is None:
                whole = piece
            else:
                n = max(0, len(h) - size - step + 1)
                whole = join_hashes(whole[:n], piece[size : size + n], salt)
            size += step
        if 2 * step > length:
            return whole
        n = max(0, len(h) - 2 * step + 1)
        piece, step = join_hashes(piece[:n], piece[step : step + n], salt), 2 * step


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbouring values."""
    step = 1
    while 2 * step <= width:
        values, step = np.minimum(values[:-step], values[step:]), 2 * step
    rest = width - step
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class Words:
    """The words of a few rows: hashes, and which of them start a window inside their row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int) -> None:
        self.starts, self.ends, self.first = word_spans(data, offsets)
        self.h = word_hashes(data, self.starts, self.ends)
        self.length = length
        self.rows = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.h))
        self.begins = np.flatnonzero(left >= length)

    def stand_ins(self, size: int) -> np.ndarray:
        """For each window, the smallest hash of a run of ``size`` words in it."""
        if not len(self.begins):
            return np.zeros(0, np.uint64)
        return sliding_min(run_hashes(self.h, size), self.length - size + 1)[self.begins]

    def sequence_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each row's whole word sequence."""
        powers, inverses = _power_tables(len(self.h))
        found = []
        for h in (self.h, mix(self.h + np.uint64(1))):
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * powers[: len(h)])))
            ends, begins = self.first[1:], self.first[:-1]
            found.append(mix((sums[ends] - sums[begins]) * inverses[begins]))
        return found[0], found[1]


def distinct_in_rows(rows: np.ndarray, *values: np.ndarray) -> np.ndarray:
    """Indices of one occurrence of each (row, values)."""
    if not len(rows):
        return np.zeros(0, np.int64)
    new = np.ones(len(rows), bool)  # runs first: most repeats are neighbours
    new[1:] = rows[1:] != rows[:-1]
    for v in values:
        new[1:] |= v[1:] != v[:-1]
    kept = np.flatnonzero(new)
    order = kept[np.lexsort([v[kept] for v in values] + [rows[kept]])]
    new = np.ones(len(order), bool)
    new[1:] = rows[order][1:] != rows[order][:-1]
    for v in values:
        new[1:] |= v[order][1:] != v[order][:-1]
    return order[new]


def listed(rows: np.ndarray, values: np.ndarray, lists: pa.ListArray, first: int, last: int) -> np.ndarray:
    """Which values are in the list of their row; the lists are those of rows first to last."""
    part = lists.slice(first, last - first)
    lengths = np.asarray(part.value_lengths().fill_null(0))
    given = np.asarray(part.flatten()).astype(np.int64).view(np.uint64)
    owner = np.repeat(np.arange(last - first), lengths).astype(np.uint64)
    return np.isin(join_hashes(values, rows.astype(np.uint64)), join_hashes(given, owner))


def _rows(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = buffers(batch.column(column))
    for first, last in row_groups(offsets):
        low, high = offsets[first], offsets[last]
        yield first, last, data[low:high], offsets[first : last + 1] - low


def _summaries(docs: DataFrame, length: int, first_length: int) -> DataFrame:
    """Per document: words, 128 bits of the sequence, distinct stand-ins of the first level."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in _rows(batch, 1):
                words = Words(data, offsets, length)
                a, b = words.sequence_hashes()
                stand_ins = words.stand_ins(first_length)
                rows = words.rows[words.begins]
                kept = distinct_in_rows(rows, stand_ins)
                counts = np.bincount(rows[kept], minlength=last - first)
                ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(stand_ins[kept].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first), pa.array(np.diff(words.first)),
                        pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), lists,
                    ],
                    names=["id", "words", "a", "b", "stand_ins"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), text_bytes()).mapInArrow(
        per_batch, "id bigint, words bigint, a bigint, b bigint, stand_ins array<bigint>"
    )


def _extended(texts: DataFrame, length: int, before: int, size: int) -> DataFrame:
    """Distinct ``(a, b, id)`` of the windows whose stand-in of length ``before`` is listed.

    Below the last level ``a`` is the stand-in of ``size`` words and ``b`` is 0;
    at the last level both make up the hash of the window.
    """

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for first, last, data, offsets in _rows(batch, 1):
                words = Words(data, offsets, length)
                rows = words.rows[words.begins]
                alive = listed(rows, words.stand_ins(before), batch.column(2), first, last)
                a = words.stand_ins(size)[alive]
                b = np.zeros(len(a), np.uint64)
                if size == length:
                    b = run_hashes(words.h, size, 1)[words.begins][alive] if len(a) else b
                rows = rows[alive]
                kept = distinct_in_rows(rows, a, b)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(a[kept].view(np.int64)), pa.array(b[kept].view(np.int64)),
                        pa.array(ids[first:last][rows[kept]]),
                    ],
                    names=["a", "b", "id"],
                )

    return texts.mapInArrow(per_batch, "a bigint, b bigint, id bigint")


def _repeated(seen: DataFrame) -> DataFrame:
    """Hashes that occur in several documents, with the smallest: sums before the shuffle."""
    return (
        seen.groupBy("a", "b").agg(F.min("id").alias("owner"), F.max("id").alias("last"))
        .where("owner < last").select("a", "b", "owner")
    )


def _per_document(pairs: DataFrame, rows: int) -> DataFrame:
    """``(id, listed)``: a document's hashes; at most as many as it has windows.

    Sent to every task if all lists together are short, else shuffled.
    """
    pairs = stage(pairs, "hashes")
    lists = pairs.groupBy("id").agg(F.collect_set("a").alias("listed"))
    return F.broadcast(lists) if pairs.count() <= rows else lists


def repeated_windows(docs: DataFrame, length: int = LENGTH, first: int = FIRST, rows: int = 1_000_000) -> DataFrame:
    """``(id, copy, listed)`` for the documents that lose words.

    ``copy``: the whole word sequence is that of a smaller ``doc_id``, so all
    words go if there are ``length`` of them. Copies leave before any window is
    made. ``listed``: hashes of the windows owned by smaller documents. A window
    in any number of documents is summed up before each shuffle, and met by
    joins that adaptive execution may split.
    """
    lengths = levels(length, first)
    known = docs.where("doc_id IS NOT NULL")
    seen = stage(_summaries(known, length, first), "windows")
    long = seen.where(F.col("words") >= length)
    owners = long.groupBy("a", "b", "words").agg(F.min("id").alias("owner"), F.count("*").alias("n"))
    several = checked_broadcast(stage(owners.where("n > 1").drop("n"), "owners"), rows)
    same = long.select("id", "a", "b", "words").join(several, ["a", "b", "words"], "left")
    copies = stage(
        same.groupBy("id").agg(F.bool_and(F.coalesce(F.col("id") > F.col("owner"), F.lit(False))).alias("copy"))
        .where("copy").select("id"), "copies",
    )
    rest = long.join(checked_broadcast(copies), "id", "left_anti")
    level = rest.select(F.explode("stand_ins").alias("a"), F.lit(0).cast("bigint").alias("b"), "id")
    for before, size in zip(lengths, lengths[1:]):
        several = stage(_repeated(level), "repeated").select("a")
        alive = _per_document(level.join(checked_broadcast(several, rows), "a").select("id", "a"), rows)
        texts = known.select(F.col("doc_id").cast("bigint").alias("id"), text_bytes().alias("text"))
        level = stage(_extended(texts.join(alive, "id"), length, before, size), "windows")
    owned = level.join(_repeated(level), ["a", "b"]).where(F.col("id") > F.col("owner"))
    lists = owned.groupBy("id").agg(F.collect_set("a").alias("listed"))
    nothing = F.array().cast("array<bigint>")
    return copies.select("id", F.lit(True).alias("copy"), nothing.alias("listed")).union(
        lists.select("id", F.lit(False).alias("copy"), "listed")
    )


def _covered(words: Words, copy: np.ndarray, lists: pa.ListArray, first: int, last: int) -> np.ndarray:
    """Which words lie in a window that is listed for their row, or in a copy."""
    length, n = words.length, len(words.h)
    gone = (copy & (np.diff(words.first) >= length))[words.rows] if n else np.zeros(0, bool)
    if len(words.begins) and np.asarray(lists.slice(first, last - first).value_lengths().fill_null(0)).any():
        hit = words.begins[
            listed(words.rows[words.begins], run_hashes(words.h, length)[words.begins], lists, first, last)
        ]
        depth = np.zeros(n + 1, np.int32)
        np.add.at(depth, hit, 1)
        np.add.at(depth, hit + length, -1)
        gone |= np.cumsum(depth[:-1]) > 0
    return gone


def _marked(docs: DataFrame, length: int, first: int) -> DataFrame:
    marks = repeated_windows(docs, length, first).select(
        F.col("id").alias("__id"), F.col("copy").alias("__copy"), F.col("listed").alias("__listed")
    )
    joined = docs.join(marks, F.col("doc_id").cast("bigint") == F.col("__id"), "left").drop("__id")
    return joined.withColumn("__copy", F.coalesce("__copy", F.lit(False)))


def _digest(text: bytes, gone: np.ndarray) -> str:
    found = text.split()
    return hashlib.sha256(b" ".join(compress(found, ~gone) if gone.any() else found)).hexdigest()


def _cut(text: bytes, gone: np.ndarray, starts: np.ndarray) -> bytes:
    """The text without the words that go, each with the white space after it."""
    ends = np.append(starts[1:], len(text))
    kept = [text[: starts[0]]] + [text[s:e] for s, e, g in zip(starts.tolist(), ends.tolist(), gone) if not g]
    return b"".join(kept)


def removed_words(docs: DataFrame, length: int = LENGTH, first: int = FIRST) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` per row of ``docs``.

    A word goes if a window of ``length`` words over it also starts in a
    document with a smaller ``doc_id``. Null texts have no words. Rows with a
    null ``doc_id`` lose nothing and take nothing; rows that repeat a ``doc_id``
    are parts of one document and take nothing from each other.
    """
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copy = np.asarray(batch.column(2).cast(pa.int8())).astype(bool)
            for first_row, last, data, offsets in _rows(batch, 1):
                words = Words(data, offsets, length)
                gone = _covered(words, copy[first_row:last], batch.column(3), first_row, last)
                parts = [gone[s:e] for s, e in zip(words.first[:-1], words.first[1:])]
                texts = [data[s:e].tobytes() for s, e in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first_row, last - first_row), pa.array(np.diff(words.first)),
                        pa.array([int(p.sum()) for p in parts], pa.int64()),
                        pa.array([_digest(t, p) for t, p in zip(texts, parts)], pa.string()),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256"],
                )

    narrow = docs.select("doc_id", "text")
    marked = _marked(narrow, length, first).select("doc_id", text_bytes(), "__copy", "__listed")
    return marked.mapInArrow(per_batch, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def without_repeats(docs: DataFrame, length: int = LENGTH, first: int = FIRST) -> DataFrame:
    """``docs`` with the same rows and columns, repeated words cut from ``text``.

    White space between kept words stays as it is; ``n_chars``, if there is such
    a column, follows a text that was cut. A text that loses nothing is unchanged.
    """
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.schema.get_field_index("__text")
            copies = batch.column(batch.schema.get_field_index("__copy"))
            copy = np.asarray(copies.cast(pa.int8())).astype(bool)
            lists = batch.column(batch.schema.get_field_index("__listed"))
            cut: list[str | None] = []
            for first_row, last, data, offsets in _rows(batch, column):
                words = Words(data, offsets, length)
                gone = _covered(words, copy[first_row:last], lists, first_row, last)
                for r in range(last - first_row):
                    s, e = words.first[r], words.first[r + 1]
                    text = data[offsets[r] : offsets[r + 1]].tobytes()
                    any_gone = e > s and gone[s:e].any()
                    cut.append(
                        _cut(text, gone[s:e], words.starts[s:e] - offsets[r]).decode() if any_gone else None
                    )
            yield batch.set_column(column, "__text", pa.array(cut, pa.string()))

    marked = _marked(docs, length, first)
    loses = F.col("__copy") | F.col("__listed").isNotNull()
    whole = marked.withColumn("__text", F.when(loses, text_bytes()).otherwise(F.lit("").cast("binary")))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    done = whole.mapInArrow(per_batch, f"{kinds}, __copy boolean, __listed array<bigint>, __text string")
    changed = F.col("__text").isNotNull()

    def result(name: str) -> Column:
        if name == "text":
            return F.coalesce("__text", "text").alias("text")
        if name == "n_chars":
            kind = docs.schema["n_chars"].dataType
            return F.when(changed, F.char_length("__text").cast(kind)).otherwise(F.col("n_chars")).alias("n_chars")
        return F.col(f"`{name}`")

    return done.select(*[result(c) for c in docs.columns])


SQL = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), runs AS (
  SELECT doc_id, unnest(range(1, len(ws) - {LENGTH - 2})) AS p, ws FROM w WHERE len(ws) >= {LENGTH}
), windows AS (
  SELECT doc_id, p, md5(array_to_string(list_slice(ws, p, p + {LENGTH - 1}), ' ')) AS h FROM runs
), owners AS (
  SELECT h, min(doc_id) AS owner FROM windows GROUP BY h
), gone AS (
  SELECT DISTINCT doc_id, p + unnest(range({LENGTH})) AS q FROM windows JOIN owners USING (h) WHERE owner < doc_id
), words AS (
  SELECT doc_id, generate_subscripts(ws, 1) AS q, unnest(ws) AS word FROM w
), kept AS (
  SELECT a.doc_id, string_agg(a.word, ' ' ORDER BY a.q) AS t, count(*) AS n
  FROM words a LEFT JOIN gone g ON a.doc_id = g.doc_id AND a.q = g.q WHERE g.q IS NULL GROUP BY a.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id
"""
