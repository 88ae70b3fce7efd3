"""Token ids in word-aligned binary shards (Simple-8b), written in document order.

A 64-bit word holds a selector in its top 4 bits and, below, as many ids as fit
at the selector's width: 60 of 1 bit, 30 of 2, ... 1 of 60. Blocks of ``BLOCK``
ids begin at a word of their own, whose place is kept, so blocks pack and
unpack side by side. Selector 0 is the escape: its payload is the place of one
value of more than 60 bits in a list after the words.

Shard, little-endian: ``MAGIC``, then as unsigned 64-bit integers the number of
ids, ids per block, blocks, words and escaped values; first word of each block
(unsigned 32-bit); words; escaped values (both unsigned 64-bit).
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnowry.llm.common import Codes, checked_broadcast, ragged
from winnowry.staging import stage

MAGIC = b"S8BLOCKS"
BLOCK = 128
#: Ids per word of selectors 1 to 14 (selector 0 escapes one); a word has 60 bits for them.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
PAYLOAD = np.uint64((1 << 60) - 1)
_SHORT = np.array([i.bit_length() for i in range(1 << 16)], np.uint8)
GROUP_CHARS = 2_000_000
CACHED_WORDS = 400_000
#: Words of ASCII and Latin-1 letters without marks that a pattern or a special token may join: runs of letters, digits, other signs.
PLAIN = re.compile(rb"(?:[^\x00-\x20\x7f-\xff'<]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
PARTS = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")
LATIN = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    if not len(values) or values.max() < 1 << 16:
        return _SHORT[values.astype(np.uint16)]
    out = np.zeros(values.shape, np.uint8)
    rest = values.copy()
    for step in (32, 16, 8, 4, 2, 1):
        high = rest >= np.uint64(1) << np.uint64(step)
        out[high] += step
        rest[high] >>= np.uint64(step)
    return out + (rest > 0)


def _selectors(bits: np.ndarray) -> np.ndarray:
    """For each place of each padded block, the selector that takes most values from there."""
    size = bits.shape[1] - 64
    doubled = {1: bits}
    for p in (1, 2, 4, 8, 16):
        wide = doubled[p].copy()
        wide[:, :-p] = np.maximum(wide[:, :-p], wide[:, p:])
        doubled[2 * p] = wide
    best = np.where(bits[:, :size] <= 60, 14, 0).astype(np.uint8)
    for k in range(13, 0, -1):
        count = int(COUNTS[k])
        p = 1 << (count.bit_length() - 1)
        widest = np.maximum(doubled[p][:, :size], doubled[p][:, count - p : count - p + size])
        best[widest <= WIDTHS[k]] = k
    return best


def pack(values: np.ndarray) -> bytes:
    """A shard of unsigned 64-bit values; all its blocks are packed side by side."""
    values = np.ascontiguousarray(values, np.uint64)
    blocks = -(-len(values) // BLOCK)
    padded = np.zeros((blocks, BLOCK + 64), np.uint64)
    flat = np.zeros(blocks * BLOCK, np.uint64)
    flat[: len(values)] = values
    padded[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    bits = np.zeros(padded.shape, np.uint8)
    bits[:, :BLOCK] = _bit_lengths(flat).reshape(blocks, BLOCK)
    best = _selectors(bits)
    sizes = np.full(blocks, BLOCK)
    if blocks:
        sizes[-1] = len(values) - (blocks - 1) * BLOCK
    at, active, used = np.zeros(blocks, np.int64), np.arange(blocks), np.zeros(blocks, np.int64)
    steps = []
    while len(active):
        selector = best[active, at[active]]
        steps.append((active, at[active], selector))
        at[active] += COUNTS[selector]
        used[active] += 1
        active = active[at[active] < sizes[active]]
    begins = np.concatenate(([0], np.cumsum(used)))
    words = np.zeros(begins[-1], np.uint64)
    source, chosen = np.zeros(len(words), np.int64), np.zeros(len(words), np.uint8)
    for step, (block, place, selector) in enumerate(steps):
        target = begins[block] + step
        source[target], chosen[target] = block * (BLOCK + 64) + place, selector
    every, escaped = padded.reshape(-1), np.flatnonzero(chosen == 0)
    words[escaped] = np.arange(len(escaped), dtype=np.uint64)
    for k in range(1, 15):
        rows = np.flatnonzero(chosen == k)
        total = np.zeros(len(rows), np.uint64)
        for j in range(int(COUNTS[k])):
            total |= every[source[rows] + j] << np.uint64(j * WIDTHS[k])
        words[rows] = total | np.uint64(k << 60)
    header = np.array([len(values), BLOCK, blocks, len(words), len(escaped)], "<u8")
    parts = header, begins[:-1].astype("<u4"), words.astype("<u8"), every[source[escaped]].astype("<u8")
    return MAGIC + b"".join(p.tobytes() for p in parts)


def unpack(shard: bytes) -> np.ndarray:
    """The values of a shard."""
    if shard[:8] != MAGIC:
        raise ValueError("not a shard of token ids")
    size, per_block, blocks, n_words, n_escaped = np.frombuffer(shard, "<u8", 5, 8).astype(np.int64).tolist()
    begins = np.frombuffer(shard, "<u4", blocks, 48).astype(np.int64)
    words = np.frombuffer(shard, "<u8", n_words, 48 + 4 * blocks)
    escaped = np.frombuffer(shard, "<u8", n_escaped, 48 + 4 * blocks + 8 * n_words)
    selector = (words >> np.uint64(60)).astype(np.uint8)
    counts = COUNTS[selector]
    ends = np.cumsum(counts)
    per_word = np.diff(np.append(begins, n_words))
    block = np.repeat(np.arange(blocks), per_word)
    first = ends - counts
    place = first - first[begins][block] if n_words else first
    limit = np.minimum((block + 1) * per_block, size)
    out = np.zeros(size, np.uint64)
    for k in range(15):
        rows = np.flatnonzero(selector == k)
        if not len(rows):
            continue
        target, most = block[rows] * per_block + place[rows], limit[rows]
        payload = words[rows] & PAYLOAD
        if k == 0:
            out[target] = escaped[payload.astype(np.int64)]
            continue
        mask = np.uint64((1 << int(WIDTHS[k])) - 1)
        for j in range(int(COUNTS[k])):
            value = (payload >> np.uint64(j * WIDTHS[k])) & mask
            inside = target + j < most
            out[(target + j)[inside]] = value[inside]
    return out


@contextmanager
def _uncollected() -> Iterator[None]:
    """Without the collector of cycles: words, codes and ids form none, and it would walk all of them again and again."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


class WordTokenizer:
    """Ids of texts whose tokens never span white space: each distinct word is encoded once."""

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.lowers = '"Lowercase"' in definition
        self.spelled = self._spelling()
        self.by_parts = self._treats_parts_alone()
        self._forget()

    def _part_ids(self, word: str) -> list[int]:
        """Ids of a plain word: each of its parts goes straight to the library's model."""
        merge, parts = self.tokenizer.model.tokenize, PARTS.findall(word.lower())
        if not word.isascii():
            parts = [part.translate(self.spelled) for part in parts]
        return [t.id for part in parts for t in merge(part)]

    def _spelling(self) -> dict[int, str]:
        """What the library's model is given for each Latin-1 letter: byte-level tokenizers spell its bytes."""
        split = self.tokenizer.pre_tokenizer
        return {ord(c): "".join(p for p, _ in split.pre_tokenize_str(c)) for c in LATIN} if split is not None else {}

    def _treats_parts_alone(self) -> bool:
        """Whether this tokenizer lower-cases plain words and merges within their parts only.

        Asked of the library itself, for every two neighbouring signs.
        """
        signs = [chr(c) for c in range(33, 127) if chr(c) not in "'<"] + LATIN
        words = [f"{a}{b}" for a in signs for b in signs] + [f"Ab{a}{b}cd" for a in signs for b in signs]
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return all(e.ids == self._part_ids(w) for w, e in zip(words, found))

    def _word_ids(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word; what is not plain takes the whole way through the library."""
        plain = [self.by_parts and PLAIN.fullmatch(w) is not None for w in words]
        rest = [w.decode() for w, p in zip(words, plain) if not p]
        encoded = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else ())
        return [self._part_ids(w.decode()) if p else next(encoded).ids for w, p in zip(words, plain)]

    def _forget(self) -> None:
        self.codes = Codes()
        self.pool, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _plain(self, text: bytes) -> bytes:
        """The text lower-cased where the tokenizer would do just that, so that fewer words differ.

        In other than ASCII texts marks are joined to letters first, and a special
        token, which may follow ``<``, must keep its case.
        """
        return text.lower() if self.lowers and text.isascii() and b"<" not in text else text

    @_uncollected()
    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each begins (one more than texts)."""
        if len(self.codes) > CACHED_WORDS:
            self._forget()
        code, begins = self.codes.of([self._plain(t).split() for t in texts])
        new, self.codes.fresh = self.codes.fresh, []
        if new:
            ids = self._word_ids(new)
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(lengths)))
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
            self.pool = np.concatenate((self.pool, flat))
        places, stops = ragged(self.ends[code], self.ends[code + 1] - self.ends[code])
        return self.pool[places], stops[begins]


_loaded: dict[str, WordTokenizer] = {}


def _tokenizer(definition: str) -> WordTokenizer:
    """One tokenizer per Python worker and definition."""
    if definition not in _loaded:
        _loaded.clear()
        _loaded[definition] = WordTokenizer(definition)
    return _loaded[definition]


def _groups(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    first, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and total + size > limit:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


SHARD_SCHEMA = "part int, before bigint, ids bigint, doc_ids array<bigint>, lengths array<int>, shard binary"


def write_ids(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Tokenize all texts and write shards in ascending ``doc_id`` order; returns the written table.

    Documents are dealt out by ranges of ``doc_id`` and sorted within them, a null
    id first, rows of one id by text; each range is a part, numbered in order.
    ``before`` counts the ids of the part before the shard. A null text is empty,
    so it has the end id alone.
    """
    with open(path, encoding="utf-8") as definition:
        given = docs.sparkSession.sparkContext.broadcast(definition.read())  # one tokenizer file

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(given.value)
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column(1)
            sizes = np.fromiter((len(t.as_buffer()) for t in texts), np.int64, len(texts))
            for a, b in _groups(sizes, GROUP_CHARS):
                ids, begins = tokenizer.encode(texts.slice(a, b - a).to_pylist())
                whole = np.insert(ids, begins[1:], end_id).astype(np.uint64)
                lengths = np.diff(begins) + 1
                one = pa.array([0, b - a], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()), pa.array([before]), pa.array([len(whole)]),
                        pa.ListArray.from_arrays(one, batch.column(0).slice(a, b - a)),
                        pa.ListArray.from_arrays(one, pa.array(lengths.astype(np.int32))),
                        pa.array([pack(whole)], pa.binary()),
                    ],
                    names=["part", "before", "ids", "doc_ids", "lengths", "shard"],
                )
                before += len(whole)

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stage(ordered.select("doc_id", F.col("text").cast("binary")).mapInArrow(per_batch, SHARD_SCHEMA), "ids")


def with_starts(shards: DataFrame) -> DataFrame:
    """Shards with ``start``: ids of all documents before the shard.

    Ids are summed per part first, so one row per part meets in the last window.
    """
    totals = shards.groupBy("part").agg(F.sum("ids").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("parts_before"))
    joined = shards.join(checked_broadcast(stage(parts, "parts")), "part")
    return joined.withColumn("start", F.col("parts_before") + F.col("before")).drop("parts_before")


def read_ids(shards: DataFrame) -> DataFrame:
    """``(doc_id, ids)`` of written shards."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, lengths, shard in zip(*(batch.column(i) for i in range(3))):
                ends = np.cumsum(np.asarray(lengths.values))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(unpack(shard.as_py()).astype(np.int64))
                )
                yield pa.RecordBatch.from_arrays([doc_ids.values, lists], names=["doc_id", "ids"])

    return shards.select("doc_ids", "lengths", "shard").mapInArrow(per_batch, "doc_id bigint, ids array<bigint>")


def id_digests(shards: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of written shards; ids are hashed as unsigned 32-bit integers."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, lengths, shard, start in zip(*(batch.column(i) for i in range(4))):
                raw = unpack(shard.as_py()).astype("<u4").tobytes()
                n = np.asarray(lengths.values).astype(np.int64)
                begins = np.concatenate(([0], np.cumsum(n)))
                at = (4 * begins).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.values, pa.array(start.as_py() + begins[:-1]), pa.array(n),
                        pa.array([zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:])], pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return with_starts(shards).select("doc_ids", "lengths", "shard", "start").mapInArrow(
        per_batch, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
