"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors with a cosine of at least ``c`` have a squared distance of at most
``2 - 2c``. Rotated vectors are split into blocks of ``BLOCK_DIMS`` coordinates, and each
block gets its proportional share of that budget: a close pair keeps within
the budget in one block at least. So each block is range-joined on its own: a
vector lies in the grid cell of the block's first coordinates, visits half of
the neighbouring cells, and is compared in the block's coordinates with what it
meets. Pairs within the budget are then verified by exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry.llm.common import mix
from winnowry.llm.components import connected_components
from winnowry.staging import stage

COSINE = 0.95
BLOCK_DIMS = 16
CHUNK_ROWS = 16_384  # rows of a cell that one task compares with as many
TILE = 256
PAIRS_AT_ONCE = 1 << 15
SLACK = 1e-6
CELLS = 1 << 12  # more than the cells of one coordinate


def rotation(dims: int, seed: int = 42) -> np.ndarray:
    """A fixed random orthogonal matrix; every block gets its share of every direction."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dims]).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def blocks(dims: int, budget: float, block_dims: int = BLOCK_DIMS) -> list[tuple[slice, float]]:
    """Coordinates and squared-distance budget of each block."""
    edges = [*range(0, dims, block_dims), dims]
    return [(slice(a, b), budget * (b - a) / dims) for a, b in zip(edges, edges[1:])]


def grid_dims(rows: int, chunk_rows: int = CHUNK_ROWS) -> int:
    """Coordinates that make the grid: each cuts cells, and multiplies the visits, about threefold."""
    return next((g for g in (1, 2) if rows <= chunk_rows * 8**g), 3)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow in the squares
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _as_bytes(frame: DataFrame, wide: bool) -> DataFrame:
    """``(vec_id, vec)``: the vector as bytes; null unless it can be linked."""
    kind = np.float64 if wide else np.float32

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            ids, lists = batch.column(0), batch.column(1)
            for known, values in zip(ids.is_valid(), lists):
                usable = None
                if known.as_py() and values.is_valid and len(values.values) and not values.values.null_count:
                    vector = values.values.to_numpy(zero_copy_only=False).astype(kind)
                    if np.isfinite(vector).all() and vector.any():
                        usable = (vector + kind(0)).tobytes()  # -0.0 becomes 0.0
                found.append(usable)
            yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.binary())], names=["vec_id", "vec"])

    given = frame.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast(f"array<{'double' if wide else 'float'}>"))
    return given.mapInArrow(per_batch, "vec_id bigint, vec binary")


def _by_length(column: pa.Array, kind: type) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and matrix of the vectors of each length."""
    raw = column.to_pylist()
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, np.frombuffer(b"".join(raw[r] for r in rows), kind).reshape(len(rows), -1)


def _cells(vectors: np.ndarray, budget: float, g: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per block and step: the cell of each vector there, as a number, and whether it is its own.

    The steps are the zero step and that half of the neighbours that is not
    the mirror image of the other half: two vectors in neighbouring cells meet once.
    """
    dims = vectors.shape[1]
    turned = unit_rows(vectors) @ rotation(dims)
    for number, (part, share) in enumerate(blocks(dims, budget)):
        width = np.sqrt(share) * (1 + SLACK) + 1e-12
        first = turned[:, part][:, :g]
        at = np.floor(first / width).astype(np.int64) + CELLS // 2
        for step in product((-1, 0, 1), repeat=first.shape[1]):
            if step >= (0,) * len(step):
                moved = at + np.array(step)
                yield number, moved @ (CELLS ** np.arange(moved.shape[1], dtype=np.int64)), np.full(len(at), not any(step))


def _crowded(classes: DataFrame, budget: float, g: int, kind: type, chunk_rows: int) -> dict[tuple[int, int, int], int]:
    """How many chunks each cell with more than ``chunk_rows`` rows is cut into.

    Coordinates of unit vectors lie between -1 and 1, so there are at most
    ``blocks * (2 / width + 3) ** g`` cells however many vectors there are: some
    20,000 for 64 dimensions and a cosine of 0.95.
    """

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, vectors in _by_length(batch.column(0), kind):
                for number, cell, _ in _cells(vectors, budget, g):
                    found, n = np.unique(cell, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), vectors.shape[1])), pa.array(np.full(len(n), number)), pa.array(found), pa.array(n)],
                        names=["dims", "block", "cell", "n"],
                    )

    counted = classes.select("vec").mapInArrow(per_batch, "dims bigint, block bigint, cell bigint, n bigint")
    large = counted.groupBy("dims", "block", "cell").agg(F.sum("n").alias("n")).where(F.col("n") > chunk_rows)
    return {(r["dims"], r["block"], r["cell"]): -(-r["n"] // chunk_rows) for r in large.collect()}


PLACED = "dims bigint, block bigint, cell bigint, i int, j int, chunk int, own boolean, id bigint, copies bigint, vec binary"


def _placed(classes: DataFrame, budget: float, g: int, kind: type, chunks: dict) -> DataFrame:
    """A row per vector and pair of chunks it takes part in.

    A cell is cut into chunks by hash of the id, and every two chunks meet in a
    group of their own, so no group grows with its cell.
    """

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 2048):
                batch = whole.slice(begin, 2048)
                ids = batch.column(0).to_numpy()
                for rows, vectors in _by_length(batch.column(2), kind):
                    dims = vectors.shape[1]
                    for number, cell, own in _cells(vectors, budget, g):
                        cut = np.array([chunks.get((dims, number, c), 1) for c in cell.tolist()])
                        mine = (mix(ids[rows].astype(np.uint64)) % cut.astype(np.uint64)).astype(np.int64)
                        again = np.repeat(np.arange(len(rows)), cut)
                        other = np.arange(len(again)) - np.repeat(np.cumsum(cut) - cut, cut)
                        taken = rows[again]
                        i, j = np.minimum(mine[again], other), np.maximum(mine[again], other)
                        n = len(again)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(n, dims)), pa.array(np.full(n, number)), pa.array(cell[again]),
                                pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                pa.array(mine[again].astype(np.int32)), pa.array(own[again]),
                                batch.column(0).take(pa.array(taken)), batch.column(1).take(pa.array(taken)),
                                batch.column(2).take(pa.array(taken)),
                            ],
                            names=["dims", "block", "cell", "i", "j", "chunk", "own", "id", "copies", "vec"],
                        )

    return classes.select(F.col("first").alias("id"), "copies", "vec").mapInArrow(per_batch, PLACED)


def _close_pairs(
    turned: np.ndarray, left: np.ndarray, right: np.ndarray, number: int, cosine: float, same: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of rows from ``left`` and ``right`` whose first block within its budget is ``number``.

    ``same``: both are the same rows, and each pair counts once.
    """
    parts = blocks(turned.shape[1], 2 - 2 * cosine)
    part, share = parts[number]
    x, y = (turned[rows][:, part].astype(np.float32) for rows in (left, right))
    one = lambda v: np.ones((len(v), 1), np.float32)
    half = lambda v: -(v * v).sum(1, keepdims=True) / 2
    x, y = np.hstack((x, half(x), one(x))), np.hstack((y, one(y), half(y))).T.copy()
    limit = np.float32(-(share + 1e-5) / 2)  # the product is minus half the squared distance
    for top in range(0, len(left), TILE):
        a, b = np.nonzero(x[top : top + TILE] @ y >= limit)
        a += top
        if same:
            a, b = a[a < b], b[a < b]
        for s in range(0, len(a), PAIRS_AT_ONCE):
            p, q = left[a[s : s + PAIRS_AT_ONCE]], right[b[s : s + PAIRS_AT_ONCE]]
            linked = np.einsum("ij,ij->i", turned[p], turned[q]) >= cosine
            p, q = p[linked], q[linked]
            apart = (turned[p] - turned[q]) ** 2
            within = np.column_stack([apart[:, at].sum(1) <= most * (1 + SLACK / 2) for at, most in parts[: number + 1]])
            first = within[:, number] & ~within[:, :number].any(1)
            yield p[first], q[first]


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node reachable from each of ``n`` nodes over the edges ``(a, b)``."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            return root


def _compare(cosine: float, kind: type):
    """Compare the vectors of one group; emits link counts and a spanning forest, never pairs."""

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        dims, number = group.column("dims")[0].as_py(), group.column("block")[0].as_py()
        cut = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        ids, copies = group.column("id").to_numpy(), group.column("copies").to_numpy()
        own = group.column("own").to_numpy(zero_copy_only=False)
        vectors = np.frombuffer(b"".join(group.column("vec").to_pylist()), kind).reshape(-1, dims)
        turned = unit_rows(vectors) @ rotation(dims)
        home, visit = np.flatnonzero(own), np.flatnonzero(~own)
        if cut[0] == cut[1]:
            meetings = [(home, home, True), (home, visit, False)]
        else:
            chunk = group.column("chunk").to_numpy()
            one, two = chunk == cut[0], chunk == cut[1]
            meetings = [
                (home[one[home]], home[two[home]], False), (home[one[home]], visit[two[visit]], False),
                (home[two[home]], visit[one[visit]], False),
            ]
        n = len(ids)
        links, edges_a, edges_b = np.zeros(n, np.int64), [], []
        root = np.arange(n)
        for left, right, same in meetings:
            for p, q in _close_pairs(turned, left, right, number, cosine, same):
                links += np.bincount(p, copies[q], n).astype(np.int64) + np.bincount(q, copies[p], n).astype(np.int64)
                apart = root[p] != root[q]  # only what joins two trees is kept
                edges_a.append(root[p[apart]])
                edges_b.append(root[q[apart]])
                if len(edges_a[-1]):
                    root = local_roots(n, np.concatenate((root, edges_a[-1])), np.concatenate((np.arange(n), edges_b[-1])))
        linked = np.flatnonzero(links)
        return pa.table(
            {"id": pa.array(ids[linked]), "other": pa.array(ids[root[linked]]), "links": pa.array(links[linked])}
        )

    return compare


def linked_vectors(embeddings: DataFrame, cosine: float = COSINE, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``embeddings``.

    Links are pairs of rows with a cosine of ``cosine`` or more, found with full
    recall. Null vectors, zero vectors and those with null or non-finite
    components, rows with a null ``vec_id``, and vectors of different lengths link
    with nothing. Equal vectors are one class with a number of copies; a row that
    repeats a ``vec_id`` is another vector of the same name.
    """
    wide = "double" in dict(embeddings.dtypes)["embedding"]
    kind = np.float64 if wide else np.float32
    budget = 2 - 2 * cosine
    given = stage(_as_bytes(embeddings, wide), "vectors")
    classes = stage(
        given.where("vec IS NOT NULL").groupBy("vec").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies")), "classes"
    )
    g = grid_dims(classes.count(), chunk_rows)
    chunks = _crowded(classes, budget, g, kind, chunk_rows)
    placed = _placed(classes, budget, g, kind, chunks)
    found = stage(
        placed.groupBy("dims", "block", "cell", "i", "j")
        .applyInArrow(_compare(cosine, kind), "id bigint, other bigint, links bigint"), "links",
    )
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    members = connected_components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    named = (
        classes.join(counts, F.col("first") == counts["id"], "left").drop("id")
        .join(members, F.col("first") == members["id"], "left")
        .select(
            "vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "first").alias("component_id"),
        )
    )
    component = F.coalesce("component_id", "vec_id")
    return given.join(named, "vec", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
