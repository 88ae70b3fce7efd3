"""Near duplicates by SimHash and meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits have a point halfway between them. So
every distinct fingerprint emits all variants within half the radius, variants
are shuffled, and fingerprints that meet on a variant are linked. All that meet
on one variant lie within the radius of each other, hence a link from each to
the first of them keeps every group together without making all pairs.

Texts with similar shingle sets (``near_copies``) meet by their fingerprints in
the same way, and each such link is verified on the sets. Pairs above the threshold
whose fingerprints lie further apart are found by a prefix-filter join, which misses none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnowry.llm.common import buffers, checked_broadcast, row_groups, text_bytes
from winnowry.llm.components import connected_components
from winnowry.llm.substring_dedup import Words, distinct_in_rows, run_hashes
from winnowry.operators.joins import left_join_hot
from winnowry.staging import stage

SEED = 42
SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 2
SAMPLE, COMMON = 20_000, 200_000  # texts read for common shingles, and how many of these are kept
HOT_ROWS = 256  # a key with more rows is sent to them, not they to its task
CROWD = 32  # a key with more unsettled pairs than so many per row is crowded
LEVELS = 4  # how often prefixes are made anew without their crowded keys
DEMOTED = 1 << 40  # ranks above those of any key that was not counted
DENSE = 1 / 3  # a crowd is compared as a whole if one key holds so much of it
BLOCK_TEXTS, BLOCK_BYTES = 256, 4 << 20  # texts, and bytes of their shingle sets, in a block of a crowd
COLUMNS = 1 << 12  # shingles counted at a time between two blocks

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of each run of ``words`` words, A-Z lower-cased and joined by one space.

    Repeats stay. A text with fewer words gives its whole sequence, one with
    none gives nothing.
    """
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined, size = b" ".join(found), len(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, size)) + np.arange(size)
    starts = np.concatenate(([0], ends[:-1] + 1))
    words = min(words, size)
    spans = zip(starts[: size - words + 1].tolist(), ends[words - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64, size - words + 1)


def majority(hashes: np.ndarray) -> int:
    """The bits set in more than half the hashes; none for no hashes."""
    ones = np.zeros(64, np.int64)
    for first in range(0, len(hashes), 1 << 16):
        part = hashes[first : first + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``(doc_id, fp)``: the 64-bit SimHash of each whole text, as a signed long."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [majority(shingle_hashes(t.as_py(), words)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"]
            )

    return docs.select(F.col("doc_id").cast("bigint"), text_bytes()).mapInArrow(
        per_batch, "doc_id bigint, fp bigint"
    )


def ball(bits: int, radius: int) -> list[int]:
    """All masks of ``bits`` bits with at most ``radius`` of them set, as signed longs."""
    masks = [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(bits), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def with_variants(prints: DataFrame, fp: str, bits: int, radius: int) -> DataFrame:
    """One row per value within ``radius`` bits of ``fp``, as ``variant``."""
    masked = prints.withColumn("__mask", F.explode(F.lit(ball(bits, radius))))
    return masked.withColumn("variant", F.col(fp).bitwiseXOR(F.col("__mask"))).drop("__mask")


def fingerprint_links(classes: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``(a, b)`` between the first documents of fingerprints that meet on a variant.

    ``classes`` has a row ``(fp, first)`` per distinct fingerprint. ``radius`` is
    even. A variant meets at most the fingerprints of its own ball, 65 for
    radius 2, whatever the number of documents.
    """
    if radius % 2:
        raise ValueError("the radius must be even: balls of half the radius meet in the middle")
    emitted = with_variants(classes.select("fp", "first"), "fp", 64, radius // 2).select(
        "variant", F.struct("first", "fp").alias("node")
    )
    head = F.min("node").over(Window.partitionBy("variant"))
    return (
        emitted.withColumn("head", head).where(F.col("node.fp") != F.col("head.fp"))
        .where(F.bit_count(F.col("node.fp").bitwiseXOR(F.col("head.fp"))) <= radius)
        .select(F.col("node.first").alias("a"), F.col("head.first").alias("b")).distinct()
    )


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row of ``docs``.

    Equal fingerprints form one class before anything is emitted, so a group of
    copies of any size costs one class. The component is the smallest ``doc_id``
    reachable over links of at most ``radius`` differing bits. Null and empty
    texts have fingerprint zero and are linked like any other; rows that repeat
    a ``doc_id`` come out as often as they came in; a null ``doc_id`` never
    becomes a component unless its class has no other.
    """
    printed = stage(fingerprints(docs, words), "fingerprints")
    classes = stage(printed.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    grouped = connected_components(fingerprint_links(classes.where("first IS NOT NULL"), radius))
    named = classes.join(grouped, classes["first"] == grouped["id"], "left").select(
        "fp", F.coalesce("component_id", "first").alias("component_id")
    )
    return printed.join(named, "fp").select("doc_id", "fp", "component_id")


def _row_shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of all runs of ``words.length`` words; repeats stay, a shorter row has none."""
    return words.rows[words.begins], run_hashes(words.h, words.length)[words.begins]


def _common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles found in several of about ``SAMPLE`` texts, sorted, and in how many; the most frequent ``COMMON``.

    They only say which shingles to avoid as keys: the pairs found do not depend on them.
    """
    h = F.xxhash64(F.col("doc_id").cast("bigint"))
    share = SAMPLE / max(docs.count(), 1)
    drawn = docs.where(h < F.lit(int(share * 2**64) - 2**63)) if share < 1 else docs

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            for first, last in row_groups(offsets):
                low = offsets[first]
                words = Words(_LOWER[data[low : offsets[last]]], offsets[first : last + 1] - low, SHINGLE)
                rows, found = _row_shingles(words)
                found = found[distinct_in_rows(rows, found)]
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["shingle"])

    counted = drawn.select(text_bytes()).mapInArrow(per_batch, "shingle bigint").groupBy("shingle").count()
    # at most COMMON narrow rows reach the driver
    most = counted.where("count > 1").orderBy(F.desc("count"), "shingle").limit(COMMON).toArrow()
    shingles = most["shingle"].to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], most["count"].to_numpy()[order]


def prefixes(
    words: Words, rows: int, common: tuple[np.ndarray, np.ndarray], similarity: float, shared: int = 1
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the rows' shingle sets, hashes of their prefixes, and where each row's prefix begins (rows + 1).

    In one order for all texts, the uncommon first, the prefix of a set of n is
    its first n - ceil(similarity * n) + ``shared``. Sets that similar have
    ``shared`` of them in common, if they have so many in common at all.
    """
    row, h = _row_shingles(words)
    known, often = common
    rank = np.zeros(len(h), np.int64)
    if len(known):
        place = np.minimum(np.searchsorted(known, h), len(known) - 1)
        rank = np.where(known[place] == h, often[place], 0)
    order = np.lexsort((h, rank, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    row, h = row[new], h[new]
    sizes = np.bincount(row, minlength=rows)
    first = np.cumsum(sizes) - sizes
    lengths = np.minimum(sizes, sizes - np.ceil(similarity * sizes - 1e-9).astype(np.int64) + shared)
    kept = np.arange(len(h)) - first[row] < lengths[row]
    return sizes, h[kept], np.concatenate(([0], np.cumsum(lengths)))


def _copy_prints(docs: DataFrame, common: Broadcast, similarity: float) -> DataFrame:
    """``(id, a, b, words, fp, size, prefix)``: 128 bits of the lower-cased word sequence, SimHash, shingles, prefix."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for first, last in row_groups(offsets, 1 << 20):
                low, high = offsets[first], offsets[last]
                words = Words(_LOWER[data[low:high]], offsets[first : last + 1] - low, SHINGLE)
                a, b = words.sequence_hashes()
                prints = [majority(shingle_hashes(t.as_py(), SHINGLE)) for t in batch.column(1).slice(first, last - first)]
                sizes, prefix, ends = prefixes(words, last - first, common.value, similarity)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first), pa.array(a.view(np.int64)),
                        pa.array(b.view(np.int64)), pa.array(np.diff(words.first)),
                        pa.array(prints, pa.int64()), pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(prefix.view(np.int64))),
                    ],
                    names=["id", "a", "b", "words", "fp", "size", "prefix"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), text_bytes()).mapInArrow(
        per_batch, "id bigint, a bigint, b bigint, words bigint, fp bigint, size bigint, prefix array<bigint>"
    )


def _held_shingles(texts: DataFrame) -> DataFrame:
    """``(id, key)``: the distinct shingles of each row of ``(id, text)``."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for first, last in row_groups(offsets):
                low = offsets[first]
                words = Words(_LOWER[data[low : offsets[last]]], offsets[first : last + 1] - low, SHINGLE)
                rows, found = _row_shingles(words)
                new = distinct_in_rows(rows, found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows[new] + first)), pa.array(found[new].view(np.int64))],
                    names=["id", "key"],
                )

    return texts.mapInArrow(per_batch, "id bigint, key bigint")


def _ranked_prefixes(texts: DataFrame, common: Broadcast, similarity: float, shared: int) -> DataFrame:
    """``(key, id, size, at)``: prefixes of rows ``(id, text, keys, ranks)``, whose ``keys`` come last, by ``ranks``."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ranks = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (2, 3))
            known, often = common.value
            merged = np.concatenate((keys.astype(np.int64).view(np.uint64), known))
            merged, at = np.unique(merged, return_index=True)  # a key of the rows goes before a sampled one
            order = merged, np.concatenate((ranks.astype(np.int64) + DEMOTED, often))[at]
            data, offsets = buffers(batch.column(1))
            for first, last in row_groups(offsets, 1 << 20):
                low = offsets[first]
                words = Words(_LOWER[data[low : offsets[last]]], offsets[first : last + 1] - low, SHINGLE)
                sizes, prefix, ends = prefixes(words, last - first, order, similarity, shared)
                row = np.repeat(np.arange(last - first), np.diff(ends))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(prefix.view(np.int64)), batch.column(0).take(pa.array(row + first)),
                        pa.array(sizes[row].astype(np.int64)), pa.array((np.arange(len(row)) - ends[row]).astype(np.int32)),
                    ],
                    names=["key", "id", "size", "at"],
                )

    return texts.select("id", "text", "keys", "ranks").mapInArrow(per_batch, "key bigint, id bigint, size bigint, at int")


@dataclass(frozen=True)
class Order:
    """The order of the shingles in prefixes: crowded keys, found by counting, come last.

    A pair of similar texts whose first common shingle is crowded has it in both
    prefixes. So only texts with a crowded key in their prefix get a new one, and
    need to meet only each other on it. A key that stays in a prefix although it
    comes last leads a text made of crowded shingles: such texts meet on two keys.
    """

    texts: DataFrame
    common: Broadcast
    similarity: float
    demoted: DataFrame | None = None
    level: int = 0

    def fresh(self, crowded: DataFrame) -> DataFrame:
        """Those of the crowded keys that can still be put last."""
        if self.level == LEVELS:
            return crowded.limit(0)
        return crowded if self.demoted is None else crowded.join(self.demoted.select("key"), "key", "left_anti")

    def after(self, crowded: DataFrame) -> Order:
        demoted = crowded if self.demoted is None else stage(self.demoted.union(crowded), "demoted")
        return replace(self, demoted=demoted, level=self.level + 1)

    def prefixes(self, hit: DataFrame, shared: int = 1) -> DataFrame:
        """``(key, id, size, at, n)`` for the ids of ``hit``, on keys that several of them have."""
        texts = self.texts.join(checked_broadcast(hit), "id")
        if self.demoted is None:
            none = F.array().cast("array<bigint>")
            ranked = texts.withColumns({"keys": none, "ranks": none})
        else:
            last = _held_shingles(texts).join(checked_broadcast(self.demoted), "key").groupBy("id").agg(
                F.collect_set(F.struct("key", "rank")).alias("last")
            )
            ranked = texts.join(last, "id", "left").select(
                "id", "text", *(F.coalesce(F.col(f"last.{c}"), F.array().cast("array<bigint>")).alias(f"{c}s") for c in ("key", "rank"))
            )
        found = _ranked_prefixes(ranked, self.common, self.similarity, shared)
        return _shared(stage(found.groupBy("key", "id").agg(F.min(F.struct("at", "size")).alias("r")).select("key", "id", "r.size", "r.at"), "keyed"))

    def paired(self, stuck: DataFrame) -> DataFrame:
        """``(key, id, size, at, n)`` of texts ``(key, id)`` on a key that stays crowded: with a second shingle each.

        Similar sets of two or more shingles have two in common, both among the
        first n - ceil(similarity * n) + 2 of either. A place of 0 rules out nothing but sizes.
        """
        longer = self.prefixes(stage(stuck.select("id").distinct(), "hit"), 2).select("id", "size", F.col("key").alias("second"))
        both = longer.join(stuck, "id").where("key != second")
        key = F.xxhash64(F.least("key", "second"), F.greatest("key", "second"))
        return _shared(stage(both.select(key.alias("key"), "id", "size", F.lit(0).alias("at")).distinct(), "paired"))


def _shingle_sets(texts: DataFrame) -> DataFrame:
    """``(id, shingles)``: sorted distinct 32-bit hashes of runs of ``SHINGLE`` words, as bytes.

    A text with fewer words has its whole sequence as its one shingle. Two of n
    shingles share a hash with a chance of n * n / 2**33.
    """

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for first, last in row_groups(offsets):
                found = []
                low = offsets[first]
                words = Words(_LOWER[data[low : offsets[last]]], offsets[first : last + 1] - low, SHINGLE)
                for s, e in zip(words.first, words.first[1:]):
                    runs = run_hashes(words.h[s:e], min(SHINGLE, e - s)) if e > s else words.h[:0]
                    found.append(np.unique(runs.astype(np.uint32)).tobytes())
                ids = batch.column(0).slice(first, last - first)
                yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.binary())], names=["id", "shingles"])

    return texts.mapInArrow(per_batch, "id bigint, shingles binary")


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` whose shingle sets overlap enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            close = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint32) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                close.append(both >= similarity * (len(x) + len(y) - both))
            yield batch.filter(pa.array(close, pa.bool_())).select([0, 1])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(per_batch, "a bigint, b bigint")


def _may_reach(similarity: float, size: Column, at: Column, other: Column, other_at: Column) -> Column:
    """Whether sets of these sizes, whose first common shingle has these places, can be similar enough."""
    return (1 + similarity) * F.least(size - at, other - other_at) >= similarity * (size + other) - 1e-6


def _shared(keyed: DataFrame) -> DataFrame:
    """Rows ``(key, id, size, at)`` on keys that several have, with their number ``n``."""
    met = stage(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "met")
    return stage(keyed.join(checked_broadcast(met), "key").select("key", "id", "size", "at", "n"), "shared")


def _with_heads(shared: DataFrame, heads: DataFrame) -> DataFrame:
    """Each row with the head of its key. Heads of keys with many rows are sent to the rows, others meet by shuffle."""
    hot = f"n > {HOT_ROWS}"
    sent = checked_broadcast(stage(heads.where(hot).drop("n"), "hot"))
    cold = shared.where(f"NOT {hot}").join(heads.where(f"NOT {hot}").drop("n"), "key")
    return shared.where(hot).join(sent, "key").unionByName(cold)


def _open(rows: DataFrame) -> DataFrame:
    """``(key, rows, squares)`` of keys on which several components meet: rows in all, and squared by component."""
    crowds = rows.groupBy("key", "part").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("n")).alias("squares")
    )
    return stage(crowds.where("rows * rows > squares"), "open")


def _on(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows on keys ``(key, rows)``, with the number of them now."""
    counted = checked_broadcast(keys.select("key", F.col("rows").alias("n")))
    return rows.drop("n").join(counted, "key").select("key", "id", "size", "at", "n", "part")


def _overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many values each set of ``x`` shares with each of ``y``: products of 0-1 matrices, some columns at a time."""
    both = np.intersect1d(np.concatenate(x), np.concatenate(y))
    sides = []
    for sets in (x, y):
        values, rows = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        held = np.isin(values, both)
        at = np.searchsorted(both, values[held])
        order = np.argsort(at, kind="stable")
        sides.append((at[order], rows[held][order], len(sets)))
    out = np.zeros((len(x), len(y)), np.float32)
    for first in range(0, len(both), COLUMNS):
        made = []
        for at, rows, n in sides:
            low, high = np.searchsorted(at, [first, first + COLUMNS])
            matrix = np.zeros((n, COLUMNS), np.float32)
            matrix[rows[low:high], at[low:high] - first] = 1
            made.append(matrix)
        out += made[0] @ made[1].T
    return out


def _all_similar(texts: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links ``(a, b)`` that join all similar ones of the texts ``(id, crowd)`` of each crowd.

    Every text is compared with every other: crowds are dealt out in blocks, and a
    task holds two blocks of bounded size at a time, whatever the crowd. Its links
    are a star for each of the groups it finds, not all pairs.
    """
    held = stage(texts.join(sets, "id"), "held")
    sizes = held.groupBy("crowd").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_TEXTS, F.sum(F.length("shingles")) / BLOCK_BYTES)).alias("blocks")
    )
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    dealt = held.join(checked_broadcast(stage(sizes, "blocks")), "crowd").withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("id", "shingles", "crowd", "block", other).select(
        "id", "shingles", "crowd", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block"
    )

    def per_pair(table: pa.Table) -> pa.Table:
        block, low, high = (table[c].to_numpy() for c in ("block", "low", "high"))
        ids = table["id"].to_numpy()
        found = [np.frombuffer(v.as_buffer(), np.uint32) for c in table["shingles"].chunks for v in c]
        x, y = (np.flatnonzero(block == c[0]) for c in (low, high))
        if not len(x) or not len(y):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        shared = _overlaps([found[i] for i in x], [found[i] for i in y])
        n = np.array([len(f) for f in found])
        near = shared >= similarity * (n[x][:, None] + n[y][None, :] - shared)
        group = np.arange(len(ids))
        while True:  # the smallest index of each group is passed on over links
            least = group.copy()
            np.minimum.at(least, x, np.where(near, group[y][None, :], len(ids)).min(axis=1))
            np.minimum.at(least, y, np.where(near, least[x][:, None], len(ids)).min(axis=0))
            if (least == group).all():
                break
            group = least
        linked = np.flatnonzero(group != np.arange(len(ids)))
        return pa.table({"a": pa.array(ids[linked]), "b": pa.array(ids[group[linked]])})

    return dealt.groupBy("crowd", "low", "high").applyInArrow(per_pair, "a bigint, b bigint")


def _dense(rows: DataFrame) -> DataFrame:
    """``(key, crowd)`` of keys ``(key, id)`` among whose texts one key holds ``DENSE`` or more of all that hang together."""
    heads = stage(rows.groupBy("key").agg(F.min("id").alias("head"), F.count("*").alias("n")), "heads")
    stars = rows.join(checked_broadcast(heads.select("key", "head")), "key").select(F.col("id").alias("a"), F.col("head").alias("b"))
    crowds = stage(connected_components(stars), "crowds")
    sizes = crowds.groupBy("component_id").agg(F.count("*").alias("texts"))
    keys = heads.join(checked_broadcast(crowds), F.col("head") == F.col("id")).select("key", "n", F.col("component_id").alias("crowd"))
    most = stage(keys.groupBy("crowd").agg(F.max("n").alias("most")), "most")
    dense = most.join(sizes, F.col("crowd") == F.col("component_id")).where(F.col("most") >= DENSE * F.col("texts")).select("crowd")
    return stage(keys.join(checked_broadcast(stage(dense, "dense")), "crowd").select("key", "crowd"), "dense_keys")


def _with_part(shared: DataFrame, grouped: DataFrame | None) -> DataFrame:
    """``(key, id, size, at, n, part)``: each row with the component of its text so far."""
    columns = ["key", "id", "size", "at", "n"]
    if grouped is None:
        return shared.select(*columns, F.col("id").alias("part"))
    named = shared.select(*columns).join(checked_broadcast(grouped), F.col("id") == F.col("member"), "left")
    return named.select(*columns, F.coalesce("component_id", "id").alias("part"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)


def _unsettled(keys: DataFrame) -> tuple[int, int]:
    """Pairs of unconnected texts on ``(key, rows, squares)``, and rows."""
    return keys.agg(F.coalesce(F.sum(F.expr("(rows * rows - squares) / 2")), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0))).first()


def _grouped(links: DataFrame) -> DataFrame:
    """``(member, component_id)`` of all ids on the links."""
    return stage(connected_components(links).withColumnRenamed("id", "member"), "grouped")


def _stars(grouped: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that stand for all of a component: later components need few rounds."""
    return grouped.select(F.col("member").alias("a"), F.col("component_id").alias("b")).where("a != b")


def fingerprint_pairs(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs ``(a, b)`` of rows ``(first, fp)`` that SimHash links: of one fingerprint, or within ``radius`` bits."""
    heads = stage(classes.groupBy("fp").agg(F.min("first").alias("head"), F.count("*").alias("n")), "fingerprints")
    same = left_join_hot(classes.select("first", "fp"), heads, ["fp"], "n", HOT_ROWS)
    same = same.where(F.col("first") != F.col("head")).select(F.col("first").alias("a"), F.col("head").alias("b"))
    return same.union(fingerprint_links(heads.select("fp", F.col("head").alias("first")), radius))


def shingle_links(
    shared: DataFrame, sets: DataFrame, similarity: float, order: Order | None = None,
    grouped: DataFrame | None = None,
) -> DataFrame:
    """Links ``(a, b)`` that join all similar texts among those that meet on a key.

    What is ``grouped`` before, ``(member, component_id)``, is connected by the links too.

    ``shared`` has a row ``(key, id, size, at)`` per shingle of a prefix. A round
    verifies all on a key against the smallest of them, which then leaves the
    key: all its pairs are settled. Texts that are connected by now need no
    link, so a group of copies of any size ends after a few rounds; a key whose
    texts are all connected is done. A key on which many unlike texts remain is
    crowded: with an ``order`` it is given up, and its texts meet on other prefixes, without
    it or on pairs of keys. Crowds that stay together on new prefixes are alike but
    for some edits: these are compared block by block. Once few pairs are left, or rounds no
    longer halve them, all that are left are verified.
    """
    before, given_up, stuck_rows = None, [], []
    shared = _with_part(shared if "n" in shared.columns else _shared(shared), grouped)
    while True:
        head = F.min(F.struct("size", "id", "at", "part")).alias("head")
        heads = stage(shared.groupBy("key").agg(head, F.max("n").alias("n")), "heads")
        headed = _with_heads(shared, heads).where(F.col("id") != F.col("head.id"))
        near = _may_reach(similarity, F.col("size"), F.col("at"), F.col("head.size"), F.col("head.at"))
        pairs = headed.where(near & (F.col("part") != F.col("head.part"))).select(
            F.col("id").alias("a"), F.col("head.id").alias("b")
        )
        links = stage(_similar(stage(pairs.distinct(), "pairs"), sets, similarity), "links")
        if grouped is None or not links.isEmpty():
            grouped = _grouped(links if grouped is None else _stars(grouped).union(links))
        rest = stage(_with_part(headed, grouped), "rest")
        open_keys = _open(rest)
        left, rows = _unsettled(open_keys)
        if order is not None and rows:
            crowd = f"rows * rows - squares > {2 * CROWD} * rows"
            crowded = stage(open_keys.where(crowd), "crowded")
            many, members = _unsettled(crowded)
            if members:
                left, rows = left - many, rows - members
                open_keys = open_keys.where(f"NOT ({crowd})")
                on_keys = stage(_on(rest, crowded).select("key", "id"), "on_keys")
                if order.level:
                    dense = _dense(on_keys)
                    texts = stage(on_keys.join(checked_broadcast(dense), "key").select("id", "crowd").distinct(), "texts")
                    links = stage(_all_similar(texts, sets, similarity), "links")
                    if not links.isEmpty():
                        grouped = _grouped(_stars(grouped).union(links))
                    crowded = stage(crowded.join(checked_broadcast(dense.select("key")), "key", "left_anti"), "crowded")
                fresh = stage(order.fresh(crowded.select("key", F.col("rows").alias("rank"))), "fresh")
                stuck = crowded.join(checked_broadcast(fresh), "key", "left_anti")
                given_up.append((fresh, on_keys.join(checked_broadcast(fresh), "key").select("id")))
                stuck_rows.append(on_keys.join(checked_broadcast(stage(stuck.select("key"), "stuck")), "key"))
        if not rows:
            break
        shared = stage(_on(rest, open_keys), "shared")
        if left <= 8 * rows or before is not None and 2 * left > before:
            other = shared.select("key", *(F.col(c).alias(f"other_{c}") for c in ("id", "size", "at", "part")))
            near = _may_reach(similarity, *map(F.col, ("size", "at", "other_size", "other_at")))
            pairs = shared.join(other, "key").where("id > other_id AND part != other_part").where(near).select(
                F.col("id").alias("a"), F.col("other_id").alias("b")
            )
            links = stage(_similar(stage(pairs.distinct(), "pairs"), sets, similarity), "links")
            if not links.isEmpty():
                grouped = _grouped(_stars(grouped).union(links))
            break
        before = left
    if given_up:
        hit = stage(_union([ids for _, ids in given_up]).distinct(), "hit")
        if not hit.isEmpty():
            later = order.after(stage(_union([keys for keys, _ in given_up]), "demoted"))
            grouped = _grouped(shingle_links(later.prefixes(hit), sets, similarity, later, grouped))
        stuck = stage(_union(stuck_rows), "stuck")
        if not stuck.isEmpty():
            return shingle_links(order.paired(stuck), sets, similarity, None, grouped)
    return _stars(grouped)


def near_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(id, component_id)`` per row of ``docs`` with a ``doc_id``: groups of equal or similar texts.

    Texts with the same lower-cased words are one class. Classes whose SimHash
    fingerprints lie within ``RADIUS`` bits are linked as in ``near_duplicates``,
    if their shingle sets are similar. The rest is exact: texts whose sets of
    ``SHINGLE``-word shingles have a Jaccard similarity of ``similarity`` or more
    share a shingle of their prefixes; one document of each class emits its
    prefix, and those that meet on a shingle are verified until every such pair is
    linked, known to be connected, or known not to be similar. Texts without words
    are copies of each other. A null ``doc_id`` takes no part.
    """
    docs = docs.where("doc_id IS NOT NULL")
    common = docs.sparkSession.sparkContext.broadcast(_common_shingles(docs))
    printed = stage(_copy_prints(docs, common, similarity), "prints")
    sequence = ["a", "b", "words"]
    classes = stage(
        printed.groupBy(*sequence).agg(F.min(F.struct("id", "fp", "size", "prefix")).alias("head"))
        .select(*sequence, F.col("head.id").alias("first"), "head.fp", "head.size", "head.prefix"), "classes",
    )
    near = stage(fingerprint_pairs(classes).distinct(), "pairs")
    keyed = classes.select(F.col("first").alias("id"), "size", F.posexplode("prefix").alias("at", "key"))
    shared = _shared(keyed)
    named = stage(shared.select("id").union(near.select("a")).union(near.select("b")).distinct(), "named")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), text_bytes().alias("text"))
    sets = _shingle_sets(texts.join(checked_broadcast(named), "id")).groupBy("id").agg(F.min("shingles").alias("shingles"))
    # below 0.5 similar sets of two shingles may have one in common: no second key leads to them
    order = Order(texts, common, similarity) if similarity > 0.5 else None
    sets = stage(sets, "shingles")
    linked = _grouped(stage(_similar(near, sets, similarity), "links"))
    links = shingle_links(shared, sets, similarity, order, linked)
    grouped = connected_components(links).withColumnRenamed("id", "member")
    found = classes.join(grouped, F.col("first") == F.col("member"), "left").select(
        *sequence, F.coalesce("component_id", "first").alias("component_id")
    )
    found = checked_broadcast(stage(found, "found"))
    return printed.join(found, sequence).select("id", "component_id")


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without near copies: of each group the smallest ``doc_id`` stays.

    Rows that repeat a ``doc_id`` stay or go together; a null ``doc_id`` stays.
    """
    groups = stage(near_copies(docs, similarity), "groups")
    gone = groups.groupBy(F.col("id").alias("__id")).agg(F.min("component_id").alias("least")).where("__id != least")
    gone = stage(gone.select("__id"), "gone")
    return docs.join(checked_broadcast(gone), F.col("doc_id").cast("bigint") == F.col("__id"), "left_anti")
