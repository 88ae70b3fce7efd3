import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from winnowry.operators import quantiles
from winnowry.operators.quantiles import exact_quantiles
from winnowry.staging import staged_so_far

PROBS = [0.0, 0.25, 0.5, 0.75, 1.0]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(1)
    n = 3000
    return pd.DataFrame({
        "normal": rng.normal(size=n),
        "few": rng.integers(0, 5, n).astype(float),
        "hot": np.where(rng.random(n) < 0.4, 7.0, rng.exponential(size=n)),
        "holes": np.where(rng.random(n) < 0.5, np.nan, rng.random(n)),
        "same": np.full(n, 3.0),
    })


@pytest.mark.parametrize("limits", [
    {},
    {"per_octave": 1, "cuts": 64},
    {"per_octave": 1, "cuts": 2},     # many passes
])
def test_equals_pandas_exactly(spark, frame, limits):
    found = exact_quantiles(spark.createDataFrame(frame).repartition(5), list(frame.columns), PROBS, **limits)
    for c in frame.columns:
        assert found[c] == (frame[c].count(), frame[c].quantile(PROBS).tolist()), c


def test_empty_and_short_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, float("nan")), (None, 2.0)], "a double, b double")
    found = exact_quantiles(df, ["a", "b"], [0.5])
    assert found == {"a": (0, None), "b": (2, [1.5])}


def test_integers_and_decimals(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 5)], "i int").selectExpr("i", "cast(i as decimal(9,2)) d")
    found = exact_quantiles(df, ["i", "d"], [0.25])
    assert found["i"] == (4, [1.75]) and found["d"] == (4, [1.75])


def test_extreme_numbers(spark):
    """Zeros of both signs, subnormal, largest and infinite numbers: any order statistic of them."""
    values = [0.0, -0.0, 5e-324, -5e-324, 1e-323, 2.2250738585072014e-308, 1.7976931348623157e308, 1.79e308, -1.7976931348623157e308,
              float("inf"), float("-inf"), float("-inf"), 1.0, 2.0, 0.1, 1 - 2**-53, 1 + 2**-52, 3.0, -2.5, 2.0**52, 2.0**53 + 2]
    n = len(values)
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    for per_octave, cuts in ((16, 4096), (1, 2)):
        found = exact_quantiles(df, ["x"], [i / (n - 1) for i in range(n)], per_octave=per_octave, cuts=cuts)
        assert found["x"] == (n, sorted(values))


def test_no_more_than_six_passes(spark, monkeypatch):
    """Values that differ in their last bits only, the worst case, and everyday columns."""
    rng = np.random.default_rng(3)
    n = 20_000
    close = (np.float64(1.0).view(np.int64) + rng.integers(0, 2**18, n)).view(np.float64)
    spread = rng.integers(-2**63, 2**63, n).view(np.float64)
    far = rng.integers(-2**62, 2**62, n)
    frames = {"close": close, "spread": np.where(np.isfinite(spread), spread, 0), "price": rng.lognormal(5, 2, n), "key": far}
    passes = []
    seen = quantiles._counted
    monkeypatch.setattr(quantiles, "_counted", lambda cells: passes.append(1) or seen(cells))
    for name, values in frames.items():
        passes.clear()
        df = spark.createDataFrame(pd.DataFrame({name: values}))
        assert exact_quantiles(df, [name], PROBS)[name] == (n, pd.Series(values).astype(float).quantile(PROBS).tolist())
        assert len(passes) <= (2 if name == "price" else 6), name


def test_parts_are_measured_together(spark, frame):
    marked = pd.concat([frame.assign(part=0), frame.iloc[:900].assign(part=1), frame.iloc[:3].assign(part=4)])
    found = quantiles.quantiles_by_part(spark.createDataFrame(marked).repartition(3), list(frame.columns), PROBS, "part")
    for part, rows in ((0, 3000), (1, 900), (4, 3)):
        for c in frame.columns:
            some = frame.iloc[:rows][c]
            assert found.get((part, c), (0, [])) == (some.count(), some.quantile(PROBS).tolist() if some.count() else []), (part, c)


@pytest.mark.parametrize("cuts", [4096, 3])
def test_quantiles_after_drops(spark, frame, monkeypatch, cuts):
    """Rows go in several ways; one pass finds the quantiles of the rest."""
    rng = np.random.default_rng(7)
    gone = [rng.random(3000) < 0.1, frame["normal"] > 1, frame["hot"] == 7.0, np.ones(3000, bool)]
    df = frame.assign(row=np.arange(3000))
    values = quantiles.present_values(spark.createDataFrame(df), list(frame.columns) + ["row"])
    counted = quantiles.first_pass(values, len(frame.columns))
    passes, seen = [], quantiles._counted
    monkeypatch.setattr(quantiles, "_counted", lambda cells: passes.append(1) or seen(cells))
    for mask in gone:
        ids = [int(i) for i in np.flatnonzero(~mask)]
        left = values.where(F.col(f"v{len(frame.columns)}").isin(ids))
        for i, c in enumerate(frame.columns):
            passes.clear()
            n, found, buckets = quantiles.quantiles_left(left, i, counted[0, i], int(mask.sum()) + 5, [0.25, 0.75], cuts)
            rest = frame[~mask][c]
            assert (n, found or []) == (rest.count(), rest.quantile([0.25, 0.75]).tolist() if n else []), c
            assert sum(b.rows for b in buckets) == n and (cuts < 9 or len(passes) <= 2)


def test_many_passes_read_few_rows(spark, monkeypatch):
    """Buckets cut in two: values outside the open ones are not read in every pass."""
    rng = np.random.default_rng(7)
    rows = 20_000
    data = {"x": rng.normal(50, 9, rows), "y": rng.integers(0, 10**9, rows).astype(float)}
    df = spark.createDataFrame(list(zip(*(v.tolist() for v in data.values()))), "x double, y double")
    read, passes = [], quantiles.next_pass

    def counting(values, wanted, cuts):
        read.append(values.count())
        return passes(values, wanted, cuts)

    monkeypatch.setattr(quantiles, "next_pass", counting)
    staged = staged_so_far()
    found = exact_quantiles(df, ["x", "y"], [0.25, 0.5, 0.999], per_octave=1, cuts=2)
    for c, v in data.items():
        assert found[c][0] == rows and np.allclose(found[c][1], np.quantile(v, [0.25, 0.5, 0.999]), rtol=1e-14)
    assert len(read) > 10 and sum(read) < 8 * rows
    assert staged_so_far() == staged
