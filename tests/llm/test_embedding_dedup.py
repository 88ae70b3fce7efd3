"""Links and components against all pairs."""

import math

import numpy as np
import pytest

from winnowry.llm import embedding_dedup as ed


def brute(rows, cosine):
    """rows: (id, vector) -> id -> (links, component)."""
    usable = {}
    for i, v in rows:
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            v = np.array(v, np.float64)
            v = v / np.abs(v).max()
            usable[i] = v / np.linalg.norm(v)
    ids, root, links = sorted(usable), {i: i for i, _ in rows}, {i: 0 for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, j in enumerate(ids):
        for i in ids[:n]:
            if len(usable[i]) == len(usable[j]) and usable[i] @ usable[j] >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (links[i], find(i), find(i) == i) for i in root}


def result(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


@pytest.mark.parametrize("dims,cosine,chunk_rows", [(64, 0.95, 4096), (64, 0.95, 40), (10, 0.9, 30), (3, 0.99, 25), (1, 0.95, 4)])
def test_planted_groups(spark, dims, cosine, chunk_rows):
    rng = np.random.default_rng(dims)
    made = []
    for i in range(400):
        if i % 4 and made:
            v = made[rng.integers(len(made))] + rng.normal(0, rng.choice([0.0, 0.05, 0.25]), dims)
        else:
            v = rng.normal(0, 1, dims)
        made.append(v)
    rows = [(int(i), np.float32(v * rng.choice([0.5, 1, 7])).tolist()) for i, v in zip(rng.permutation(400), made)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    wanted = brute(rows, cosine)
    assert result(ed.linked_vectors(frame, cosine, chunk_rows)) == wanted
    assert sum(w[0] for w in wanted.values()) > 100


def test_crowd_of_near_copies(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(0, 1, 16)
    rows = [(i, (base + rng.normal(0, 0.02, 16)).tolist()) for i in range(300)] + [(i, rng.normal(0, 1, 16).tolist()) for i in range(300, 330)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert result(ed.linked_vectors(frame, 0.95, 64)) == brute(rows, 0.95)


def test_blocks_share_the_budget():
    for dims in (1, 7, 8, 20, 64):
        parts = ed.blocks(dims, 0.1)
        assert sum(p.stop - p.start for p, _ in parts) == dims and math.isclose(sum(b for _, b in parts), 0.1)
        r = ed.rotation(dims)
        assert np.allclose(r @ r.T, np.eye(dims)) and (r == ed.rotation(dims)).all()


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, "a", 1), (2, [0.0, 0.0], "b", 1), (3, [1.0, None], "c", 1), (4, [nan, 1.0], "d", 1), (5, [inf, 1.0], "e", 1),
        (6, [1.0, 2.0], "f", 1), (9, [2.0, 4.0], "g", 1), (8, [1.0, 2.0], "h", 1), (7, [1.0, 2.0, 0.0], "i", 1), (10, [], "j", 1),
        (None, [1.0, 2.0], "k", 1), (11, [-1.0, -2.0], "l", 1), (12, [1e300, 2e300], "m", 1), (13, [1e-300, 2e-300], "n", 1),
    ]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, vec string, block int")
    found = result(ed.linked_vectors(docs))
    assert all(found[i] == (0, i, True) for i in (1, 2, 3, 4, 5, 7, 10, 11))
    assert all(found[i] == (4, 6, i == 6) for i in (6, 8, 9, 12, 13)) and found[None] == (0, None, False)
    twice = spark.createDataFrame([(1, [1.0]), (1, [1.0]), (2, [-3.0])], "vec_id bigint, embedding array<double>")
    assert sorted(tuple(r) for r in ed.linked_vectors(twice).collect()) == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]
    assert ed.linked_vectors(docs.limit(0)).count() == 0
