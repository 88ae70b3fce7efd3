"""Embedding whitening with distributed block matrices.

Entries become whole numbers, ``floor(64 c) + 1,000,000``, so that counts and
sums are exact. The distinct vectors are numbered and centred, indexed as rows
of an MLlib ``BlockMatrix`` and multiplied with their transpose, split along the
rows: what reaches the driver is the scatter matrix, as large as the number of
dimensions squared. Its eigenvectors over the roots of their eigenvalues are the
whitening matrix; a second block product projects the rows onto it, and a third
takes the covariance of what came out.

Left out are rows whose vector is null or holds a null, NaN or infinite entry.
Vectors of different lengths cannot share a space: each length is fitted on its
own. Entries beyond 2**61 count as 2**61. A component without any variance, as
when all vectors are equal, has ``whitened`` null and takes no part in
``identity_error``; without variance at all ``explained`` is null too. A
``deviation`` that no long holds is null. A null or repeated ``vec_id`` changes
nothing: every remaining row gives its components. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnowry.operators.joins import left_join_hot
from winnowry.staging import stage

STEPS, SHIFT = 64, 1_000_000
LARGEST = 2**61
COMPONENTS = 16
BLOCK_ROWS, BLOCK_COLUMNS = 1024, 1024
MOST_BLOCKS = 100_000  # of rows: their coordinates reach the driver
SPLITS = 2_000  # partial scatter matrices at most
HOT_ROWS = 1_000
_ROOT = 3_037_000_499  # the largest number whose square is a long
_PART_BITS = 33  # bits of a row's number within its task in monotonically_increasing_id


@dataclass
class Whitening:
    """Exact sums of the distinct vectors, and the components found from their covariance."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling; zero where there is no variance
    matrix: np.ndarray  # dimensions x components: unit eigenvectors over the roots of the eigenvalues
    trace: float

    @property
    def floors(self) -> list[int]:
        return [s // self.n for s in self.sums]

    @property
    def rests(self) -> list[int]:
        return [s % self.n for s in self.sums]


def whole_vectors(frame: DataFrame) -> DataFrame:
    """``(vec_id, x)``: the usable vectors as whole numbers."""
    entry = lambda c: c.cast("double")
    usable = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(entry(c)) < F.lit(float("inf"))))
    limit = F.lit(float(LARGEST))
    whole = lambda c: F.floor(F.greatest(F.least(F.lit(float(STEPS)) * entry(c), limit), -limit)) + F.lit(SHIFT)
    # NaN compares as the largest value, so the test for infinity leaves it out
    return frame.where(F.col("embedding").isNotNull()).where(usable).select(
        F.col("vec_id").cast("bigint"), F.transform("embedding", whole).alias("x")
    )


def distinct_vectors(vectors: DataFrame) -> tuple[DataFrame, int]:
    """``(index, x, copies)`` of the distinct vectors, numbered from 0, and their number.

    Numbers within a task are written down with the rows, and the tasks' row counts
    (one row each) turn them into consecutive ones.
    """
    counted = vectors.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))
    table = stage(counted.withColumn("slot", F.monotonically_increasing_id()), "vectors")
    task = F.shiftright("slot", _PART_BITS)
    sizes = sorted(table.groupBy(task.alias("task")).count().collect())
    ends = np.cumsum([0, *(r["count"] for r in sizes)]).tolist()
    starts = table.sparkSession.createDataFrame(
        [(r["task"], start) for r, start in zip(sizes, ends)], "task bigint, start bigint"
    )
    place = F.col("slot").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    numbered = table.withColumn("task", task).join(F.broadcast(starts), "task")
    return numbered.select((F.col("start") + place).alias("index"), "x", "copies"), ends[-1]


def exact_sums(vectors: DataFrame, dims: int) -> list[int]:
    """Sums per dimension: every task adds up the high and the low 31 bits of its rows on their own."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for batch in batches:
            x = np.asarray(batch.column(0).flatten()).reshape(-1, dims)
            high += (x >> 31).sum(0)
            low += (x & (2**31 - 1)).sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dims)), pa.array(high), pa.array(low)], names=["at", "high", "low"]
        )

    parts = vectors.select("x").mapInArrow(per_task, "at bigint, high bigint, low bigint")
    total = parts.groupBy("at").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")])
    return [int(r["high"]) * 2**31 + int(r["low"]) for r in sorted(total.collect())]


def _longs(values: list[int]) -> Column:
    return F.lit(np.array(values, np.int64))


def _doubles(values: list[float | None]) -> Column:
    return F.array(*[F.lit(v).cast("double") for v in values])


def centred(x: str, n: int, sums: list[int]) -> Column:
    """``x - sums / n`` in doubles, the whole part of the mean taken off as a whole number first."""
    floors, rests = [s // n for s in sums], [(s % n) / n for s in sums]
    less = F.zip_with(F.col(x), _longs(floors), lambda a, m: (a - m).cast("double"))
    return F.zip_with(less, _doubles(rests), lambda a, r: a - r)


def deviation(x: str, n: int, sums: list[int]) -> Column:
    """Exact sum of ``(n x - sums)**2``; null if no long holds it."""
    floors, rests = [s // n for s in sums], [s % n for s in sums]
    reach = F.lit(_ROOT // n + 2)
    less = F.zip_with(F.col(x), _longs(floors), lambda a, m: a - m)
    scaled = F.zip_with(less, _longs(rests), lambda e, r: F.when(F.abs(e) <= reach, e * F.lit(n) - r))
    squares = F.transform(scaled, lambda d: F.when(F.abs(d) <= F.lit(_ROOT), d * d))
    return F.aggregate(squares, F.lit(0).cast("bigint"), lambda total, s: F.try_add(total, s))


def block_rows(rows: DataFrame, n: int, dims: int) -> BlockMatrix:
    """Rows ``(index, values)`` as a matrix of blocks, kept on disk where the blocks were made.

    A product reads both of its sides, and one matrix takes part in two: blocks that
    are kept are not put together again. Those of a lost executor are.
    """
    vectors = rows.select("index", array_to_vector("values").alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, dims)
    blocks = matrix.toBlockMatrix(max(BLOCK_ROWS, -(-n // MOST_BLOCKS)), min(dims, BLOCK_COLUMNS))
    return blocks.persist(StorageLevel.DISK_ONLY)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The matrix multiplied by its transpose: tasks add up a few row blocks each, then their sums are added.

    The Python wrapper of ``multiply`` leaves out its second argument, without which
    one task would add up all row blocks; so the wrapped matrix is asked.
    """
    splits = min(SPLITS, -(-matrix.numRowBlocks // 8))
    left = matrix.transpose()._java_matrix_wrapper
    product = left.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    side = matrix.colsPerBlock
    return BlockMatrix(product, side, side).toLocalMatrix().toArray()


def project(spark: SparkSession, matrix: BlockMatrix, onto: np.ndarray) -> DataFrame:
    """``(index, z)``: the rows times a small matrix."""
    step = matrix.colsPerBlock
    blocks = [
        ((i, 0), Matrices.dense(*part.shape, part.ravel(order="F").tolist()))
        for i, part in enumerate(onto[a : a + step] for a in range(0, len(onto), step))
    ]
    right = BlockMatrix(spark.sparkContext.parallelize(blocks, len(blocks)), step, onto.shape[1], *onto.shape)
    rows_per_block = matrix.rowsPerBlock

    def rows(block) -> Iterator[tuple[int, list[float]]]:
        (i, _), values = block
        return ((i * rows_per_block + r, z) for r, z in enumerate(values.toArray().tolist()))

    return spark.createDataFrame(matrix.multiply(right).blocks.flatMap(rows), "index bigint, z array<double>")


def _components(n: int, sums: list[int], covariance: np.ndarray, count: int) -> Whitening:
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:count]
    top = values[order]
    top = np.where(top > len(sums) * np.finfo(float).eps * max(top[0], 0), top, 0.0)
    roots = np.where(top > 0, np.sqrt(top), np.inf)
    return Whitening(n, sums, top, vectors[:, order] / roots, float(np.trace(covariance)))


def _covariance(rows: DataFrame, n: int, dims: int) -> tuple[np.ndarray, BlockMatrix]:
    matrix = block_rows(rows, n, dims)
    return scatter(matrix) / n, matrix


def _whiten_length(vectors: DataFrame, dims: int, count: int) -> DataFrame:
    """All components of the vectors of one length."""
    classes, n = distinct_vectors(vectors)
    sums = exact_sums(classes, dims)
    covariance, matrix = _covariance(classes.select("index", centred("x", n, sums).alias("values")), n, dims)
    found = _components(n, sums, covariance, count)
    projected = stage(project(vectors.sparkSession, matrix, found.matrix), "whitened")

    k = len(found.values)
    means = projected.agg(*[F.avg(F.col("z")[i]) for i in range(k)]).first()
    around = F.zip_with("z", _doubles(list(means)), lambda a, m: a - m)
    spread, _ = _covariance(projected.select("index", around.alias("values")), n, k)
    real = found.values > 0
    wrong = np.abs(spread - np.eye(k))[np.ix_(real, real)]
    error = float(wrong.max()) if wrong.size else None

    known = classes.join(projected, "index").select(
        "x", "copies", deviation("x", n, sums).alias("deviation"), "z"
    )
    joined = left_join_hot(vectors, known, ["x"], "copies", HOT_ROWS)
    cells = F.posexplode(F.arrays_zip(
        F.zip_with("z", F.lit(real.tolist()), lambda z, ok: F.when(ok, z)).alias("whitened"),
        _doubles([e / found.trace if found.trace > 0 else None for e in found.values.tolist()]).alias("explained"),
    )).alias("at", "cell")
    return joined.select("vec_id", "deviation", cells).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation",
        F.col("cell.whitened").alias("whitened"), F.col("cell.explained").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def whiten(embeddings: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """Per usable row and component up to ``count``: the whitened coordinate, and what the fit says of itself.

    ``(vec_id, component, n, deviation, whitened, explained, identity_error)``.
    """
    vectors = whole_vectors(embeddings)
    lengths = [r[0] for r in vectors.where(F.size("x") > 0).select(F.size("x")).distinct().collect()]
    parts = [
        _whiten_length(vectors.where(F.size("x") == dims), dims, count) for dims in sorted(lengths)
    ]
    if not parts:
        return embeddings.sparkSession.createDataFrame([], (
            "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
            "identity_error double"
        ))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
