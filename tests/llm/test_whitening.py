"""Whitening against numpy on whole tables, exact numbers against Python integers, edge rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnowry.llm import queries, whitening

KIND = "vec_id bigint, embedding array<double>, label int"


def plain(vectors, count=16):
    """Rows and fit by the letter, with Python integers where numbers must be exact."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n = len(fit)
    sums = [sum(column) for column in zip(*fit)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    mean = np.array(sums) / n
    data = np.array(fit) - mean
    values, turned = np.linalg.eigh(data.T @ data / n)
    values, turned = values[::-1][:count], turned[:, ::-1][:, :count]
    white = (np.array(x) - mean) @ turned / np.sqrt(values)
    return n, deviation, white, values / np.trace(data.T @ data / n)


def check(rows, ids, vectors, count=16):
    n, deviation, white, explained = plain(vectors, count)
    found = {}
    for r in rows:
        found.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(found) == set(ids) and len(rows) == len(ids) * len(explained)
    got = np.array([[found[i][c + 1]["whitened"] for c in range(len(explained))] for i in ids])
    signs = np.sign((got * white).sum(0))
    assert np.allclose(got * signs, white, rtol=1e-7, atol=1e-7)
    for i, d in zip(ids, deviation):
        for c, r in found[i].items():
            assert r["n"] == n and r["deviation"] == d and r["identity_error"] <= 1e-4
            assert math.isclose(r["explained"], explained[c - 1], rel_tol=1e-6)


def test_query_equals_numpy(spark):
    sf = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    rows = queries.op12_embedding_whitening(spark, sf).collect()
    check(rows, [r["vec_id"] for r in given], [r["embedding"] for r in given])


@pytest.mark.parametrize("block_rows, block_columns", [(7, 3), (64, 5), (1024, 1024)])
def test_any_blocks_and_copies(spark, monkeypatch, block_rows, block_columns):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", block_columns)
    monkeypatch.setattr(whitening, "HOT_ROWS", 20)
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, rng.uniform(0.5, 3, 9), (200, 9)).tolist()
    vectors += [vectors[0]] * 60 + [vectors[5]] * 2
    rows = [(i, v, None) for i, v in enumerate(vectors)]
    found = whitening.whiten(spark.createDataFrame(rows, KIND).repartition(4), 5).collect()
    check(found, range(len(vectors)), vectors, 5)


def test_exact_numbers_at_the_edge_of_longs(spark):
    rows = [(i, [(-1) ** i * 1e7 * (i + 1), float(i * i)], 0) for i in range(40)] + [(90, [1e300, 1.0], 0), (91, [2.0**50, 5.0], 0)]
    df = whitening.whole_vectors(spark.createDataFrame(rows, KIND))
    x = {r["vec_id"]: r["x"] for r in df.collect()}
    exact = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v, _ in rows[:40]}
    exact |= {90: [2**61 + 1_000_000, 1_000_064], 91: [2**56 + 1_000_000, 1_000_320]}
    assert x == exact
    classes, n = whitening.distinct_vectors(df)
    sums = whitening.exact_sums(classes, 2)
    assert sums == [sum(v[d] for v in exact.values()) for d in (0, 1)] and n == 42
    small = spark.createDataFrame([(i, exact[i]) for i in range(40)], "vec_id bigint, x array<bigint>")
    totals = [sum(exact[i][d] for i in range(40)) for d in (0, 1)]
    for r in small.select("vec_id", whitening.deviation("x", 40, totals).alias("d")).collect():
        want = sum((40 * a - s) ** 2 for a, s in zip(exact[r["vec_id"]], totals))
        assert r["d"] == (want if want < 2**63 else None)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [1.0, None], 2), (3, [nan, 1.0], 3), (4, [1.0, -inf], 4), (5, [], 5)]
    good = [(6, [0.1, 0.2], None), (None, [0.3, -0.5], 1), (7, [0.1, 0.2], 2), (7, [-0.4, 0.9], 2), (8, [5.0], 3), (9, [0.0, -0.0], 4)]
    df = spark.createDataFrame(rows + good, "vec_id bigint, embedding array<double>, n int")
    found = whitening.whiten(df).collect()
    two = [r for r in found if r["vec_id"] != 8]
    assert len(found) == 11 and sorted(str(r["vec_id"]) for r in two) == ["6"] * 2 + ["7"] * 4 + ["9"] * 2 + ["None"] * 2
    assert all(r["n"] == 4 and r["identity_error"] <= 1e-4 for r in two)
    alone = [r for r in found if r["vec_id"] == 8][0]
    assert (alone["component"], alone["n"], alone["deviation"], alone["whitened"], alone["explained"], alone["identity_error"]) == (1, 1, 0, None, None, None)
    flat = whitening.whiten(df.where("vec_id = 6").select("*", F.lit(1).alias("z"), F.lit(2).alias("x"))).collect()
    assert [(r["deviation"], r["whitened"]) for r in flat] == [(0, None)] * 2
    lined = spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0], 0) for i in range(9)], KIND)
    parts = {r["component"]: r for r in whitening.whiten(lined).where("vec_id = 8").collect()}
    assert parts[1]["whitened"] is not None and parts[2]["whitened"] is None and parts[3]["whitened"] is None
    assert math.isclose(parts[1]["explained"], 1.0) and parts[1]["identity_error"] <= 1e-9
    assert whitening.whiten(df.limit(0)).count() == 0 and whitening.whiten(df.where("vec_id < 6")).count() == 0
