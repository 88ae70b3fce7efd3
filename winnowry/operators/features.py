"""Text features: TF-IDF over uni- and bigrams, and encoded distinct texts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from itertools import chain
from math import ceil, log, log2, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnowry.functions.text import tokens
from winnowry.operators.joins import left_join_hot
from winnowry.operators.ranking import staged_in_order
from winnowry.schema import col
from winnowry.session import short_shuffles, small_buffers
from winnowry.staging import DENSE, drop, stage

# --- fixed values -------------------------------------------------------------
ENCODER_BATCH = 128
# ------------------------------------------------------------------------------

BROADCAST_TERMS = 200_000
CELLS = 50_000  # list entries that are Python objects at a time
SLICE = 200_000  # cells of consecutive rows that ask for their terms together
BUCKET_TERMS, BUCKET_CELLS = 200_000, 1_000_000  # of a vocabulary, and asked for, that meet in a task
TERMS, COUNTS, ROW = "__terms", "__counts", "__row"
PRINTS = ["__p1", "__p2"]


def _fingerprint(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("__h1"), F.xxhash64(F.lit(71), text).alias("__h2")]


def _short_print(text: Column) -> tuple[Column, Column]:
    """A fingerprint of 96 bits: a bigint and an int."""
    return F.xxhash64(text), F.shiftright(F.xxhash64(F.lit(71), text), 32).cast("int")


def _fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [df.schema[n] for n in names]


def _in_slices(batch: pa.RecordBatch, lists: int, cells: int = CELLS) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with about ``cells`` entries in its column ``lists``; a longer row stands alone.

    What a task holds as Python objects does not grow with the rows of a batch.
    """
    ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(lists)), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + cells, "right")))
        yield batch.slice(first, last - first)
        first = last


def term_counts(df: DataFrame, key: str, text_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(key, keep…, __terms, __counts)``: the distinct uni- and bigrams of each text.

    A text is one row, so its terms are counted within the row and nothing is
    shuffled. A frame that has the two columns already is used as it is.
    """
    names = [key, *keep]
    if TERMS in df.columns:
        return df.select(*[col(c) for c in names], TERMS, COUNTS, *({ROW} & set(df.columns)))
    small_buffers(df.sparkSession)
    words = df.select(*[col(c) for c in names], tokens(F.coalesce(col(text_col), F.lit(""))).alias("__words"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(_in_slices(b, len(names)) for b in batches):
            found = []
            for row in batch.column(len(names)).to_pylist():
                counted = Counter(row)
                counted.update(map(" ".join, zip(row, row[1:])))
                found.append(counted)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1], pa.array([list(c) for c in found], pa.list_(pa.string())),
                    pa.array([list(c.values()) for c in found], pa.list_(pa.int64())),
                ],
                names=[*names, TERMS, COUNTS],
            )

    counted = [T.StructField(TERMS, T.ArrayType(T.StringType())), T.StructField(COUNTS, T.ArrayType(T.LongType()))]
    return words.mapInArrow(count, T.StructType(_fields(df, names) + counted))


def numbered(counts: DataFrame) -> DataFrame:
    """Counted terms with a number per row, written once; a frame that has numbers is used as it is."""
    return counts if ROW in counts.columns else stage(counts.withColumn(ROW, F.monotonically_increasing_id()), "counts", DENSE)


@dataclass
class TfidfModel:
    """Vocabulary ``(term, idx, cf, df, idf)``, numbered in term order.

    ``columns`` has ``(term, idf, place, scale)`` where terms share features: a
    feature is the sum of its terms' weights, each times ``scale``. Of ``terms``
    terms there are then ``size`` features.
    """

    vocabulary: DataFrame
    size: int
    rows: int
    columns: DataFrame | None = None
    terms: int = 0


def tfidf_fit(
    labeled: DataFrame, key: str, text_col: str, max_terms: int | None = None, min_df: int = 1, prints: bool = False
) -> TfidfModel:
    """Vocabulary and idf of the labeled texts: terms in ``min_df`` texts or more.

    All of them, or the ``max_terms`` most frequent. Terms are summed before they
    are shuffled and numbered in ranges, so no task sorts a whole vocabulary. With
    ``prints``, for texts that have a number each, a term carries a fingerprint of
    its texts and counts, as ``fold_columns`` needs it.
    """
    short_shuffles(labeled.sparkSession)
    rows = labeled.count()
    counts = term_counts(labeled, key, text_col)
    own = [ROW] if prints else []
    cells = counts.select(*own, F.explode(F.arrays_zip(TERMS, COUNTS)).alias("t"))
    n = F.col(f"t.{COUNTS}")
    marks = [F.bit_xor(h).alias(c) for c, h in zip(PRINTS, (F.xxhash64(*own, n), F.xxhash64(F.lit(71), n, *own)))]
    terms = cells.groupBy(F.col(f"t.{TERMS}").alias("term")).agg(
        F.sum(n).alias("cf"), F.count(F.lit(1)).alias("df"), *(marks if prints else [])
    ).where(F.col("df") >= min_df)
    if max_terms is not None:
        terms = terms.orderBy(F.desc("cf"), F.asc("term")).limit(max_terms)
    idf = F.ln((1.0 + rows) / (1.0 + F.col("df"))) + 1.0
    placed, size = staged_in_order(terms, "term", "idx", "vocabulary")
    vocabulary = placed.select("term", "idx", "cf", "df", idf.alias("idf"), *(PRINTS if prints else []))
    return TfidfModel(vocabulary, size, rows, terms=size)


WEIGHTED = [
    T.StructField("idx", T.ArrayType(T.IntegerType())), T.StructField("term", T.ArrayType(T.StringType())),
    T.StructField("weight", T.ArrayType(T.DoubleType())),
]


def _weighted_here(counts: DataFrame, model: TfidfModel, names: list[str]) -> DataFrame:
    """Weights from a vocabulary small enough to be sent to every task."""
    table = model.vocabulary.select("term", "idx", "idf").toArrow()
    known = dict(zip(
        table.column("term").to_pylist(), zip(table.column("idx").to_pylist(), table.column("idf").to_pylist())
    ))
    sent = counts.sparkSession.sparkContext.broadcast(known)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        for batch in chain.from_iterable(_in_slices(b, len(names)) for b in batches):
            indices, terms, weights = [], [], []
            for row, times in zip(batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist()):
                cells = sorted(
                    (vocabulary[t][0], t, (1.0 + log(n)) * vocabulary[t][1]) for t, n in zip(row, times) if t in vocabulary
                )
                norm = sqrt(sum(c[2] * c[2] for c in cells))
                indices.append([c[0] for c in cells])
                terms.append([c[1] for c in cells])
                weights.append([c[2] / norm for c in cells])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(names)], pa.array(indices, pa.list_(pa.int32())),
                    pa.array(terms, pa.list_(pa.string())), pa.array(weights, pa.list_(pa.float64())),
                ],
                names=[*names, "idx", "term", "weight"],
            )

    return counts.mapInArrow(weigh, T.StructType(_fields(counts, names) + WEIGHTED))


def _slice_rows(texts: DataFrame) -> tuple[int, int]:
    """Bits by which row numbers are shifted so that a slice has some ``SLICE`` cells, and the number of cells."""
    cells, rows = texts.agg(F.sum(F.size(COUNTS)), F.count(F.lit(1))).first()
    return max(0, int(log2(max(1.0, SLICE * rows / max(1, cells or 0))))), cells or 0


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    """One list per end: the values up to there."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(values))


def _distinct(terms: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The place of each term among the distinct ones, which stand in order of appearance; and these."""
    found = terms.dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), found.dictionary


def _asked(texts: DataFrame, shift: int, bits: int) -> DataFrame:
    """``(__slice, __part, bucket, at, h1, h2)``: distinct terms of consecutive rows by fingerprint.

    A part are the rows of a slice that a task reads in a row, named by the first of them.
    """
    prints = [F.transform(TERMS, lambda t: _short_print(t)[0]), F.transform(TERMS, lambda t: _short_print(t)[1])]

    def ask(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        codes, terms = _distinct(table.column(1).combine_chunks().flatten())
        if not len(terms):
            return
        most = np.maximum.accumulate(codes)
        first = np.flatnonzero(np.append(True, most[1:] > most[:-1]))
        h1, h2 = (table.column(i).combine_chunks().flatten().to_numpy()[first] for i in (2, 3))
        bucket = (h1.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(h1), np.int32)
        order = np.argsort(bucket, kind="stable")
        bucket, h1, h2 = bucket[order], h1[order], h2[order]
        ends = np.append(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket))
        part = table.column(0)[0].as_py()
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(ends), part >> shift)), pa.array(np.full(len(ends), part)), pa.array(bucket[ends - 1]),
            _lists(order.astype(np.int32), ends), _lists(h1, ends), _lists(h2, ends),
        ], names=["__slice", "__part", "bucket", "at", "h1", "h2"])

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = [], None
        for batch in batches:
            slices = batch.column(0).to_numpy() >> shift
            cuts = np.append(np.flatnonzero(slices[1:] != slices[:-1]) + 1, len(slices)) if len(slices) else []
            for low, high in zip([0, *cuts], cuts):
                if held and slices[low] != own:
                    yield from ask(held)
                    held = []
                held.append(batch.slice(low, high - low))
                own = slices[low]
        if held:
            yield from ask(held)

    return texts.select(ROW, TERMS, *prints).mapInArrow(
        per_batch, "__slice bigint, __part bigint, bucket int, at array<int>, h1 array<bigint>, h2 array<int>"
    )


def _answered(asked: DataFrame, table: DataFrame, bits: int, values: Sequence[str]) -> DataFrame:
    """``(__slice, __part, at, values…)``: what the table has for each term that it knows.

    A bucket of asked terms meets the bucket of the table's; both are bounded by their number.
    """
    h1, h2 = _short_print(F.col("term"))
    bucket = F.shiftrightunsigned(h1, 64 - bits).cast("int") if bits else F.lit(0)
    known = table.select(bucket.alias("bucket"), h1.alias("h1"), h2.alias("h2"), *values)
    kinds = {"int": pa.int32(), "double": pa.float64()}
    given = [(v, table.schema[v].dataType.simpleString()) for v in values]

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        lists = [left.column(c).combine_chunks() for c in ("at", "h1", "h2")]
        ends = np.cumsum(pc.list_value_length(lists[0]).to_numpy(zero_copy_only=False)) if left.num_rows else np.zeros(0, np.int64)
        at, a, b = (c.flatten().to_numpy() for c in lists)
        ka, kb = right.column("h1").to_numpy(), right.column("h2").to_numpy()
        order = np.lexsort((kb, ka))
        ka, kb = ka[order], kb[order]
        place = np.searchsorted(ka, a)
        while True:  # terms with the same first fingerprint stand beside each other
            near = np.minimum(place, len(ka) - 1)
            same = (place < len(ka)) & (ka[near] == a) if len(ka) else np.zeros(len(a), bool)
            hit = same & (kb[near] == b) if len(ka) else same
            if not (same & ~hit).any():
                break
            place = place + (same & ~hit)
        found = [right.column(v).to_numpy()[order[place[hit]]] for v in values]
        ends = np.append(0, np.cumsum(hit))[ends]
        return pa.table(
            [left.column("__slice"), left.column("__part"), _lists(at[hit], ends), *[_lists(f, ends) for f in found]],
            schema=pa.schema([("__slice", pa.int64()), ("__part", pa.int64()), ("at", pa.list_(pa.int32())),
                              *[(v, pa.list_(kinds[k])) for v, k in given]]),
        )

    # dealt out by number, else buckets that are small once compressed are put together
    asked, known = (df.repartition(1 << bits, "bucket") for df in (asked, known))
    return asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(
        answer, "__slice bigint, __part bigint, at array<int>, " + ", ".join(f"{v} array<{k}>" for v, k in given)
    )


def _met(
    counts: DataFrame, table: DataFrame, size: int, names: list[str], values: Sequence[str], fields: list[T.StructField],
    weigh: Callable[[np.ndarray, pa.Array, np.ndarray, np.ndarray, list[np.ndarray], int], list[pa.Array]],
) -> DataFrame:
    """``(names…, fields…)``: rows whose terms have met those of a table of ``size`` terms, of any size.

    Neither texts nor terms meet the table: a slice of rows asks for its distinct terms
    by fingerprint, in as many buckets as bound what meets in a task, and gets arrays of
    values back. ``weigh`` gets the rows and terms of a slice's known cells, the distinct
    terms, counts, the values, and the number of rows.
    """
    short_shuffles(counts.sparkSession)
    texts = numbered(counts)
    shift, cells = _slice_rows(texts)
    bits = max(0, ceil(log2(max(1, size / BUCKET_TERMS, cells / BUCKET_CELLS))))
    # written, so that the fingerprints asked for are gone before the rows move
    answers = stage(_answered(_asked(texts, shift, bits), table, bits, values), "answers", DENSE)
    schema = T.StructType(_fields(texts, names) + fields)
    columns = [f.name for f in fields]

    def give(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by(ROW)
        numbers = left.column(ROW).to_numpy()
        parts, mine = np.unique(right.column("__part").to_numpy()), right.column("__part").to_numpy()
        done = []
        cuts = np.searchsorted(numbers, parts).tolist()
        for low, high, part in zip([0, *cuts], [*cuts, len(numbers)], [None, *parts.tolist()]):
            if low == high:
                continue
            rows = left.slice(low, high - low)
            lists, times = rows.column(TERMS).combine_chunks(), rows.column(COUNTS).combine_chunks().flatten().to_numpy()
            row = np.repeat(np.arange(high - low), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            code, terms = _distinct(lists.flatten())
            told = right.filter(pa.array(mine == part))
            at = told.column("at").combine_chunks().flatten().to_numpy()
            known, found = np.zeros(len(terms), bool), []
            known[at] = True
            for v in values:
                value = told.column(v).combine_chunks().flatten().to_numpy()
                every = np.zeros(len(terms), value.dtype)
                every[at] = value
                found.append(every)
            on = known[code]
            code, row = code[on], row[on]
            done.append(pa.table(
                [*[rows.column(c) for c in names], *weigh(row, code, terms, times[on], [f[code] for f in found], high - low)],
                names=[*names, *columns],
            ))
        return pa.concat_tables(done) if done else left.select(names).slice(0, 0)

    cut = F.shiftright(ROW, shift).alias("__slice")
    rows = texts.select(cut, ROW, *[col(c) for c in names if c != ROW], TERMS, COUNTS)
    return rows.groupBy("__slice").cogroup(answers.groupBy("__slice")).applyInArrow(give, schema)


def _weighted_by_join(counts: DataFrame, model: TfidfModel, names: list[str], terms: bool) -> DataFrame:
    """Weights from a vocabulary of any size."""
    def weigh(row, code, known, times, values, n):
        idx, idf = values
        w = (1.0 + np.log(times)) * idf
        norm = np.sqrt(np.bincount(row, w * w, n))
        order = np.lexsort((idx, row))
        ends = np.cumsum(np.bincount(row, minlength=n))
        found = [_lists(idx[order], ends)]
        if terms:
            found.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), known.take(pa.array(code[order]))))
        return [*found, _lists((w / norm[row])[order], ends)]

    fields = [f for f in WEIGHTED if terms or f.name != "term"]
    return _met(counts, model.vocabulary, model.terms, names, ["idx", "idf"], fields, weigh)


def fold_columns(model: TfidfModel) -> TfidfModel:
    """The model with one feature for all terms that have the same weights in all labeled rows.

    Most terms of a large vocabulary are in one text, or in copies of one. A
    feature of m terms is their sum over the root of m: this is an orthonormal
    change of basis onto a subspace that holds every labeled row, so a linear
    model with a squared penalty has the same optimum and the same predictions.
    Terms in the same rows have one idf, so equal counts there are equal weights:
    the fingerprints of a vocabulary fitted with ``prints`` tell them.
    """
    alike = ["df", *PRINTS]
    groups = model.vocabulary.groupBy(*alike).agg(F.min("idx").alias("__head"), F.count(F.lit(1)).alias("__m"))
    ranked, size = staged_in_order(groups, "__head", "place", "groups")
    scales = ranked.select(*alike, "place", (1.0 / F.sqrt("__m")).alias("scale"))
    columns = stage(model.vocabulary.join(scales, alike).select("term", "idf", "place", "scale"), "folded", DENSE)
    drop(ranked)
    return replace(model, size=size, columns=columns)


def _folded(counts: DataFrame, model: TfidfModel, names: list[str]) -> DataFrame:
    """``(names…, idx, weight)``: weights over the features of a folded model."""
    size = model.size

    def weigh(row, code, known, times, values, n):
        idf, place, scale = values
        w = (1.0 + np.log(times)) * idf
        norm = np.sqrt(np.bincount(row, w * w, n))
        cells, own = np.unique(row * size + place, return_inverse=True)
        row_of = cells // size
        ends = np.cumsum(np.bincount(row_of, minlength=n))
        sums = np.bincount(own, w * scale, len(cells)) / norm[row_of]
        return [_lists((cells % size).astype(np.int32), ends), _lists(sums, ends)]

    fields = [f for f in WEIGHTED if f.name != "term"]
    return _met(counts, model.columns, model.terms, names, ["idf", "place", "scale"], fields, weigh)


def _weighted(
    df: DataFrame, model: TfidfModel, key: str, text_col: str, keep: Sequence[str], broadcast_terms: int, terms: bool = True
) -> DataFrame:
    """``(key, keep…, idx, term, weight)``: arrays over the known terms of each text, by index; ``term`` where asked for."""
    keep = [c for c in keep if c not in (TERMS, COUNTS)]
    counts = term_counts(df, key, text_col, keep)
    if model.size <= broadcast_terms:
        return _weighted_here(counts, model, [key, *keep])
    return _weighted_by_join(counts, model, [key, *keep], terms)


def tfidf_weights(
    df: DataFrame, model: TfidfModel, key: str, text_col: str, keep: Sequence[str] = (),
    broadcast_terms: int = BROADCAST_TERMS,
) -> DataFrame:
    """``(key, keep…, idx, term, weight)``, rows L2-normalised; unknown terms drop out.

    A vocabulary of more than ``broadcast_terms`` terms is joined instead of sent.
    """
    names = [col(c) for c in (key, *keep)]
    rows = _weighted(df, model, key, text_col, keep, broadcast_terms)
    cells = rows.select(*names, F.explode(F.arrays_zip("idx", "term", "weight")).alias("c"))
    return cells.select(*names, "c.idx", "c.term", "c.weight")


def as_vectors(df: DataFrame, size: int, names: Sequence[str], indices: str = "idx", values: str = "weight") -> DataFrame:
    """``(names…, features)``: Spark ML sparse vectors from two array columns, passed as Arrow buffers."""
    names = list(names)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            vectors = pa.StructArray.from_arrays(
                [pa.array([0] * n, pa.int8()), pa.array([size] * n, pa.int32()), *batch.columns[-2:]],
                names=["type", "size", "indices", "values"],
            )
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], vectors], names=[*names, "features"])

    schema = T.StructType(_fields(df, names) + [T.StructField("features", VectorUDT())])
    return df.select(*[col(c) for c in names], indices, values).mapInArrow(build, schema)


def tfidf_transform(
    df: DataFrame, model: TfidfModel, key: str, text_col: str, keep: Sequence[str] = (),
    broadcast_terms: int = BROADCAST_TERMS,
) -> DataFrame:
    """``(key, keep…, features)``; a text without known terms gets the zero vector."""
    if model.columns is not None:
        rows = _folded(term_counts(df, key, text_col, keep), model, [key, *keep])
    else:
        rows = _weighted(df, model, key, text_col, keep, broadcast_terms, terms=False)
    return as_vectors(rows, model.size, [key, *keep])


def encode_distinct(
    df: DataFrame, text_col: str, encoder: Callable[[list[str]], np.ndarray],
    name: str = "embedding", batch: int = ENCODER_BATCH, parallelism: int | None = None,
) -> DataFrame:
    """Encode each distinct text once and join the vectors back.

    Distinct texts are dealt out to ``parallelism`` tasks, one per core by default.

    ``encoder`` maps a list of texts to a matrix. Distinct texts are keyed by
    fingerprint, so copies cost one call and the join back shuffles no text twice.
    """
    marked = df.select("*", *_fingerprint(col(text_col)))
    texts = marked.where(col(text_col).isNotNull()).groupBy(
        "__h1", "__h2", col(text_col).alias("text")
    ).agg(F.count(F.lit(1)).alias("copies"))

    def encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), batch):
                rows = part.iloc[at:at + batch]
                matrix = np.asarray(encoder(rows["text"].tolist()), dtype="float32")
                yield pd.DataFrame({
                    "__h1": rows["__h1"].to_numpy(), "__h2": rows["__h2"].to_numpy(),
                    name: list(matrix), "copies": rows["copies"].to_numpy(),
                })

    tasks = parallelism or df.sparkSession.sparkContext.defaultParallelism
    vectors = stage(
        texts.repartition(tasks).mapInPandas(
            encode, f"__h1 bigint, __h2 bigint, {name} array<float>, copies bigint"
        ),
        "vectors",
    )
    joined = left_join_hot(marked, vectors, ["__h1", "__h2"], "copies")
    return joined.drop("__h1", "__h2", "copies")
