"""Language-model scoring by prediction by partial matching over bytes.

A trie of byte contexts up to ``ORDER`` bytes long holds how often each byte
followed. A byte is coded in the longest context seen in training; if it never
followed there, an escape is coded and the next shorter context is tried, in
which the bytes of the longer one, already ruled out, are excluded. Escapes are
estimated by the number of different bytes of a context (method C). What ends
the chain is a uniform choice among bytes never seen at all.

Bytes that followed a context also followed its suffix, so all exclusions of a
level are known by two numbers per context: the counts its bytes have in the
suffix, and how many bytes there are. That makes scoring a few table look-ups
per byte, for all bytes of a batch at once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry.llm.common import CHUNK, buffers, row_groups, text_bytes
from winnowry.operators.joins import left_join_hot
from winnowry.staging import stage

ORDER = 5
BEFORE, END = 0xFE, 0xFF  # bytes that UTF-8 never has: before a text, and after it
PART_CELLS = 2_000_000  # no more cells of the trie are sent to the tasks
TASK_CELLS = 500_000  # cells of a larger trie that meet in one task
COMMON_TOKENS = 1_000_000  # no more than so many tokens make up 1/COMMON_TOKENS of all each

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def low_bytes(n: int) -> int:
    return (1 << 8 * n) - 1


def framed(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts, each after ``order`` bytes BEFORE and followed by END; and their new offsets."""
    rows = len(offsets) - 1
    begins = offsets + np.arange(rows + 1) * (order + 1)
    out = np.full(begins[-1], BEFORE, np.uint8)
    shift = np.repeat(np.arange(1, rows + 1) * (order + 1) - 1, np.diff(offsets))
    out[np.arange(len(data)) + shift] = _LOWER[data]
    out[begins[1:] - 1] = END
    return out, begins


def cells_at(data: np.ndarray, begins: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Per coded byte its context and itself as one number, and the row it is in."""
    cell = np.zeros(max(len(data) - order, 0), np.uint64)
    for j in range(order + 1):
        cell = (cell << np.uint64(8)) | data[j : j + len(cell)]
    kept = np.ones(len(cell), bool)
    for j in range(order):  # runs of BEFORE are contexts, not coded
        inner = begins[1:-1] - order + j
        kept[inner[inner >= 0]] = False
    rows = np.repeat(np.arange(len(begins) - 1), np.diff(begins) - order)
    return cell[kept], rows


def count_cells(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """``(cell, n)``: how often each byte followed each context of ``order`` bytes, over all rows."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            for first, last in row_groups(offsets, 1 << 21):
                low, high = offsets[first], offsets[last]
                cells, _ = cells_at(*framed(data[low:high], offsets[first : last + 1] - low, order), order)
                cell, n = np.unique(cells, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(n)], names=["cell", "n"])

    return texts.mapInArrow(per_batch, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(values, first) if len(first) else values[:0]


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys in a sorted table; -1 where absent."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


class HashTable:
    """Values of 64-bit keys, looked up for whole arrays: open addressing, at most half full."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(8, (2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        place = np.full(1 << bits, -1, np.int32)
        rest, slot = np.arange(len(keys), dtype=np.int32), self._slots(keys)
        while len(rest):
            free = place[slot] < 0
            place[slot[free]] = rest[free]  # of several for one slot the last one stays
            missed = place[slot] != rest
            rest, slot = rest[missed], (slot[missed] + 1) & self.mask
        filled = place >= 0
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, np.nan, np.float32)
        self.keys[filled], self.values[filled] = keys[place[filled]], values[place[filled]]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values in the order of the keys; NaN where a key is absent."""
        slot = self._slots(keys)
        found = self.values[slot]
        wrong = np.flatnonzero((self.keys[slot] != keys) & ~np.isnan(found))
        slot = slot[wrong]
        while len(wrong):
            slot = (slot + 1) & self.mask
            value = self.values[slot]
            found[wrong] = value
            more = (self.keys[slot] != keys[wrong]) & ~np.isnan(value)
            wrong, slot = wrong[more], slot[more]
        return found


class Trie:
    """Counts of all levels from the cells of the longest contexts.

    ``low`` are cells of two-byte contexts over the whole corpus; ``cells`` may
    be one part of the trie, all contexts with certain last three bytes.
    """

    def __init__(self, cells: np.ndarray, n: np.ndarray, low: np.ndarray, low_n: np.ndarray, order: int) -> None:
        self.order = order
        self.cells: list[np.ndarray] = [None] * (order + 1)
        self.counts: list[np.ndarray] = [None] * (order + 1)
        self.cells[order], self.counts[order] = _summed(cells.astype(np.uint64), n.astype(np.int64))
        for k in range(order - 1, -1, -1):
            above, counted = (low, low_n) if k == min(2, order - 1) else (self.cells[k + 1], self.counts[k + 1])
            self.cells[k], self.counts[k] = _summed(above.astype(np.uint64) & np.uint64(low_bytes(k + 1)), counted)
        self.contexts, self.total, self.kinds, self.shared = [], [], [], []
        for k in range(order + 1):
            context = self.cells[k] >> np.uint64(8)
            first = np.flatnonzero(np.concatenate((np.ones(min(len(context), 1), bool), context[1:] != context[:-1])))
            self.contexts.append(context[first])
            sums = lambda v: np.add.reduceat(v, first) if len(first) else np.zeros(0, np.int64)  # noqa: E731, B023
            self.total.append(sums(self.counts[k]))
            self.kinds.append(np.diff(np.append(first, len(context))))
            if k:
                below = _find(self.cells[k - 1], self.cells[k] & np.uint64(low_bytes(k)))
                self.shared.append(sums(self.counts[k - 1][below]))
            else:
                self.shared.append(np.zeros(len(first), np.int64))
        owner = np.repeat(np.arange(len(self.kinds[order])), self.kinds[order])
        seen = self.total[order] + self.kinds[order]
        logs = np.log10(self.counts[order] / seen[owner]) if len(owner) else np.zeros(0)
        self.table = HashTable(self.cells[order], logs)
        self.cells[order] = self.counts[order] = np.zeros(0, np.int64)  # all they say is in the table

    def score(self, cells: np.ndarray) -> np.ndarray:
        """log10 of the probability of each coded byte in its context."""
        out = self.table.get(cells).astype(np.float64)
        rest = np.flatnonzero(np.isnan(out))
        out[rest] = 0.0
        ruled_counts, ruled_kinds = np.zeros(len(rest), np.int64), np.zeros(len(rest), np.int64)
        for k in range(self.order, -1, -1):
            if not len(rest):
                return out
            cell = cells[rest] & np.uint64(low_bytes(k + 1))
            here, hit = _find(self.contexts[k], cell >> np.uint64(8)), _find(self.cells[k], cell)
            known = here >= 0
            left = np.where(known, self.total[k][here] - ruled_counts, 0) if len(self.total[k]) else ruled_counts * 0
            kinds = np.where(known, self.kinds[k][here] - ruled_kinds, 0) if len(self.total[k]) else ruled_kinds * 0
            counted = np.where(hit >= 0, self.counts[k][hit], kinds) if len(self.cells[k]) else kinds
            asked = kinds > 0  # a context whose bytes are all ruled out says nothing
            out[rest[asked]] += np.log10(counted[asked] / (left + kinds)[asked])
            miss = hit < 0
            if len(self.total[k]):
                ruled_counts = np.where(known, self.shared[k][here], 0)[miss]
                ruled_kinds = np.where(known, self.kinds[k][here], 0)[miss]
            else:
                ruled_counts, ruled_kinds = ruled_counts[miss], ruled_kinds[miss]
            rest = rest[miss]
        seen = int(self.kinds[0][0]) if len(self.kinds[0]) else 0
        out[rest] -= math.log10(max(256 - seen, 1))
        return out


def _collected(cells: DataFrame, name: str = "n") -> tuple[np.ndarray, np.ndarray]:
    table = cells.select("cell", name).toArrow()
    return table.column("cell").to_numpy().view(np.uint64), table.column(name).to_numpy()


class Model:
    """A trie counted over a corpus, as a written table of its longest contexts.

    ``low`` are the cells of two-byte contexts, at most 256**3. A trie of at most
    ``part_cells`` cells is sent to the tasks; of a larger one only cells that each
    make up 1/``part_cells`` of the corpus are, so never more than that.
    """

    def __init__(self, texts: DataFrame, order: int = ORDER, part_cells: int = PART_CELLS) -> None:
        if not 1 <= order <= 6:
            raise ValueError("a cell must fit 56 bits: the order is 1 to 6")
        self.order, self.part_cells = order, part_cells
        self.cells = stage(count_cells(texts, order), "cells")
        self.size = self.cells.count()
        self.whole = self.size <= part_cells
        low = self.cells.groupBy(F.col("cell").bitwiseAND(low_bytes(min(3, order))).alias("cell"))
        self.low = _collected(low.agg(F.sum("n").alias("n")))

    def trie(self) -> Trie:
        """The whole trie; only where it has at most ``part_cells`` cells."""
        return Trie(*_collected(self.cells), *self.low, self.order)

    def common(self) -> HashTable:
        """log10 of the probability of the most frequent cells."""
        total = self.cells.agg(F.sum("n")).first()[0]
        contexts = self.cells.groupBy(F.shiftright("cell", 8).alias("context")).agg(
            F.sum("n").alias("total"), F.count("*").alias("kinds")
        )
        often = self.cells.where(F.col("n") * self.part_cells >= F.lit(total))
        often = often.withColumn("context", F.shiftright("cell", 8)).join(contexts, "context")
        log = F.log10(F.col("n") / (F.col("total") + F.col("kinds")))
        return HashTable(*_collected(often.select("cell", log.alias("log")), "log"))

    def scored(self, asked: DataFrame) -> DataFrame:
        """``(cell, copies, log)`` of distinct cells ``(cell, copies)``, seen in training or not.

        Asked cells meet the trie by the last three bytes of their context, with
        ``low`` beside: all that their chain of shorter contexts can ask for. A group
        of such contexts holds some ``TASK_CELLS`` cells, and one context of three
        bytes alone at most 256**3.
        """
        low, order = asked.sparkSession.sparkContext.broadcast(self.low), self.order
        groups = max(1, -(-self.size // min(self.part_cells, TASK_CELLS)))
        suffix = F.shiftright("cell", 8).bitwiseAND(low_bytes(min(3, order)))
        group = F.pmod(F.xxhash64(suffix), F.lit(groups)).alias("part")

        def score(wanted: pa.Table, known: pa.Table) -> pa.Table:
            found = [known.column(c).to_numpy() for c in ("cell", "n")]
            trie = Trie(found[0].view(np.uint64), found[1], *low.value, order)
            cells = wanted.column("cell").to_numpy()
            logs = [trie.score(cells[i : i + CHUNK].view(np.uint64)) for i in range(0, len(cells), CHUNK)]
            return pa.table({
                "cell": wanted.column("cell"), "copies": wanted.column("copies"),
                "log": pa.array(np.concatenate([np.zeros(0), *logs])),
            })

        return asked.select("*", group).groupBy("part").cogroup(
            self.cells.select("*", group).groupBy("part")
        ).applyInArrow(score, "cell bigint, copies bigint, log double")


Scorer = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, pa.Array, pa.Array]]


def _batch_scores(model: Model, sc) -> Scorer:
    """A function from texts to the log10 probability of their bytes, as far as the tasks can tell.

    Per text also the distinct cells they cannot tell, and how often it has each:
    none if the whole trie is there.
    """
    sent = sc.broadcast(model.trie() if model.whole else model.common())
    order, whole = model.order, model.whole

    def score(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
        table, found = sent.value, np.zeros(len(offsets) - 1)
        sizes, rare, times = np.zeros(len(offsets), np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for first, last in row_groups(offsets):
            low, high = offsets[first], offsets[last]
            cells, rows = cells_at(*framed(data[low:high], offsets[first : last + 1] - low, order), order)
            logs = table.score(cells) if whole else table.get(cells).astype(np.float64)
            if not whole:
                unknown = np.flatnonzero(np.isnan(logs))
                logs[unknown] = 0.0
                places = unknown[np.lexsort((cells[unknown], rows[unknown]))]
                cell, row = cells[places], rows[places]
                new = np.ones(len(places), bool)
                new[1:] = (cell[1:] != cell[:-1]) | (row[1:] != row[:-1])
                starts = np.flatnonzero(new)
                rare.append(cell[starts].view(np.int64))
                times.append(np.diff(np.append(starts, len(places))))
                sizes[first + 1 : last + 1] = np.bincount(row[starts], minlength=last - first)
            found[first:last] = np.bincount(rows, logs, last - first)
        begins = pa.array(np.cumsum(sizes), pa.int32())
        lists = [pa.ListArray.from_arrays(begins, pa.array(np.concatenate(v), pa.int64())) for v in (rare, times)]
        return found, *lists

    return score


def _rare_sums(read: DataFrame, model: Model) -> DataFrame:
    """``(row, more)``: what the cells that the tasks could not tell add to a row's score."""
    asked = read.select("row", F.explode(F.arrays_zip("cells", "times")).alias("t")).select("row", "t.cells", "t.times")
    asked = asked.withColumnRenamed("cells", "cell")
    distinct = asked.groupBy("cell").agg(F.count("*").alias("copies"))
    logs = stage(model.scored(distinct), "cell_scores")
    met = left_join_hot(asked, logs, ["cell"], "copies")
    return met.groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("more"))


def token_counts(texts: DataFrame) -> DataFrame:
    """``(token, c)``: lower-cased words of all rows."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            for first, last in row_groups(offsets, 1 << 23):
                counted: Counter[bytes] = Counter()
                for a, b in zip(offsets[first:last], offsets[first + 1 : last + 1]):
                    counted.update(data[a:b].tobytes().lower().split())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(counted.keys(), pa.binary()), pa.array(counted.values(), pa.int64())], names=["token", "c"]
                )

    return texts.mapInArrow(per_batch, "token binary, c bigint").groupBy("token").agg(F.sum("c").alias("c"))


def _scored(docs: DataFrame, common: dict[bytes, float], model: Model) -> DataFrame:
    """Per row its number of words, what is known of their log sum, the words not common; the same for bytes."""
    sc = docs.sparkSession.sparkContext
    given = sc.broadcast(common)  # at most COMMON_TOKENS
    score = _batch_scores(model, sc)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = given.value
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            scores, cells, times = score(data, offsets)
            for first, last in row_groups(offsets, 1 << 21):
                sizes, sums, rare = [], [], []
                for a, b in zip(offsets[first:last], offsets[first + 1 : last + 1]):
                    words = data[a:b].tobytes().lower().split()
                    sizes.append(len(words))
                    rare.append([w for w in words if w not in logs])
                    sums.append(math.fsum(logs[w] for w in words if w in logs))
                kept = [batch.column(i).slice(first, last - first) for i in range(2)]
                made = [
                    pa.array(sizes, pa.int64()), pa.array(sums, pa.float64()), pa.array(rare, pa.list_(pa.binary())),
                    pa.array(scores[first:last]), *[v.slice(first, last - first) for v in (cells, times)],
                ]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=names)

    names = ["doc_id", "held_out", "words", "common", "rare", "score", "cells", "times"]
    return docs.select("doc_id", "held_out", text_bytes()).mapInArrow(
        per_batch,
        "doc_id bigint, held_out boolean, words bigint, common double, rare array<binary>, score double, "
        "cells array<bigint>, times array<bigint>",
    )


def language_scores(
    docs: DataFrame, held_out: str, order: int = ORDER, part_cells: int = PART_CELLS, common_tokens: int = COMMON_TOKENS
) -> DataFrame:
    """Scores of all rows of ``docs`` by models of the rows where ``held_out`` is false.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score``. Tokens are lower-cased words and one end per text; ``base_score`` sums
    log10((c + 1) / (N + V + 1)) over them, ``score`` is the byte model's log10
    probability of the lower-cased text. Null texts are empty, rows that repeat
    a ``doc_id`` count as often as they occur, and nothing to learn from leaves
    N = V = 0 and a uniform byte model.

    A trie of more than ``part_cells`` cells stays in the cluster: the texts are
    read once, their rarer cells are scored where the trie is and summed per row.
    Tokens that each make up 1/``common_tokens`` of all training tokens, so at
    most that many, go to every task; the others are joined to their counts.
    """
    keyed = docs.select(
        F.col("doc_id").cast("bigint"), F.coalesce(F.expr(held_out), F.lit(False)).alias("held_out"), "text"
    )
    learned = keyed.where("NOT held_out").select(text_bytes())
    tokens = stage(token_counts(learned), "tokens")
    n_docs = keyed.where("NOT held_out").count()
    total, kinds = tokens.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, kinds = total + n_docs, kinds + bool(n_docs)  # with the end of each text
    often = tokens.where(F.col("c") * common_tokens >= F.lit(total)).toArrow()
    common = dict(zip(often.column("token").to_pylist(), np.log10(often.column("c").to_numpy() + 1.0).tolist()))
    model = Model(learned, order, part_cells)
    read = stage(_scored(keyed, common, model).withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = read.select("row", F.explode("rare").alias("token"))
    summed = rare.join(tokens, "token").groupBy("row").agg(
        F.sum(F.log10(F.col("c") + 1)).alias("rare_sum"), F.count("*").alias("rare_known")
    )
    n_tokens = F.col("words") + 1
    known = n_tokens - F.size("rare") + F.coalesce("rare_known", F.lit(0)) - (0 if n_docs else 1)
    logs = F.col("common") + F.coalesce("rare_sum", F.lit(0.0)) + math.log10(n_docs + 1)
    rows = read.join(summed, "row", "left")
    score = F.col("score")
    if not model.whole:
        rows = rows.join(_rare_sums(read, model), "row", "left")
        score = (score + F.coalesce("more", F.lit(0.0))).alias("score")
    return rows.select(
        "doc_id", "held_out", n_tokens.alias("n_tokens"), known.cast("bigint").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (logs - n_tokens * math.log10(total + kinds + 1)).alias("base_score"), score,
    )
