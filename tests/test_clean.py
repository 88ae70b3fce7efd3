import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from winnowry.operators import clean as c
from winnowry.operators import compare as cmp
from winnowry.operators import profile as p
from winnowry.streaming.rowwise import clean_rows

NAN = float("nan")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_nan_and_null_are_both_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (NAN, None), (None, "b")], "x double, s string")
    found = {r["column"]: (r["count"], r["pct"]) for r in p.missing_profile(df).collect()}
    assert found == {"x": (2, 66.67), "s": (1, 33.33)}


def test_duplicates_treat_nan_as_null_and_negative_zero_as_zero(spark):
    df = spark.createDataFrame(
        [(0.0, "a"), (-0.0, "a"), (NAN, "b"), (None, "b"), (None, None), (1.0, None)], "x double, s string"
    )
    assert p.duplicate_count(df).first()[0] == 2
    assert c.dedup(df).count() == 4


def test_missing_cells_do_not_shift_the_fingerprint(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("", None), (None, "")], "x string, y string")
    assert p.duplicate_count(df).first()[0] == 0


@pytest.mark.parametrize("keep,want", [("drop", [1, 3]), ("keep_first", [1, 3]), ("keep_last", [3, 4])])
def test_dedup_with_a_key(spark, keep, want):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", 1), (4, "a", 1)], "k int, s string, n int")
    assert sorted(r["k"] for r in c.dedup(df, keep, "k").collect()) == want
    assert rows(c.dedup(df, "none", "k")) == rows(df)


def test_dedup_of_a_hot_row(spark):
    df = spark.range(0, 3000).withColumn("s", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")))
    kept = c.dedup(df, "keep_first", "id")
    assert kept.count() == 2001 and kept.where("s = 'hot'").first()["id"] == 0


def test_different_provenance_is_no_duplicate(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y")], "text string, _source string")
    assert p.duplicate_count(df).first()[0] == 0
    assert p.duplicate_count(df, ["text"]).first()[0] == 1


@pytest.mark.parametrize("per_bucket", [10, 1000])
def test_forward_fill_equals_pandas(spark, per_bucket):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({
        "k": np.arange(300),
        "x": np.where(rng.random(300) < 0.7, np.nan, rng.random(300)),
        "late": [np.nan] * 200 + [1.0] * 50 + [np.nan] * 50,
        "s": [None if v < 0.9 else f"s{i}" for i, v in enumerate(rng.random(300))],
        "full": np.arange(300),
    })
    df = spark.createDataFrame(pdf).repartition(6)
    got = c.forward_fill(df, "k", rows_per_bucket=per_bucket).orderBy("k").collect()
    want = pdf.ffill()
    for i, r in enumerate(got):
        for name in pdf.columns:
            v = want[name][i]
            assert (r[name] is None) if pd.isna(v) else (r[name] == v), (i, name)


def test_constant_is_cast_to_the_column_type(spark):
    df = spark.createDataFrame([(None, None, None), (1, 2.0, "x")], "i int, d double, s string")
    assert rows(c.fix_missing(df, "constant:7")) == [(1, 2.0, "x"), (7, 7.0, "7")]
    filled = c.fix_missing(df, "constant:abc").where("s = 'abc'").first()
    assert tuple(filled) == (None, None, "abc")


def test_modes_take_the_smallest_on_ties(spark):
    df = spark.createDataFrame(
        [(1, "b"), (2, "a"), (2, "b"), (1, "a"), (None, None)], "n int, s string"
    )
    fills = c.missing_fills(df, "mode")
    assert fills == {"n": 1, "s": "a"}


def test_all_null_columns(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "n double, s string")
    assert c.missing_fills(df, "median") == {"s": "unknown"}
    assert c.missing_fills(df, "mode") == {"s": "unknown"}


def test_protection(spark):
    df = spark.createDataFrame(
        [(1.0, None, None, "x"), (None, 2.0, 5.0, None), (3.0, 2.0, 9.0, "x")],
        "a double, label double, mine double, _s string",
    )
    out = c.fix(df, {"missing": "median"}, ["mine"])
    assert rows(out.select("a", "label", "mine", "_s")) == sorted(
        [(1.0, None, None, "x"), (2.0, 2.0, 5.0, None), (3.0, 2.0, 9.0, "x")], key=str
    )
    assert out.dropna().count() == 1
    assert c.fix(df, {"missing": "drop"}, ["mine"]).count() == 1


def test_fewer_than_four_values_have_no_outliers(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (1000.0,), (None,)], "x double")
    assert p.outlier_bounds(df) == {}
    assert p.outlier_profile(df).count() == 0
    assert rows(c.fix_outliers(df, "clip_iqr")) == rows(df)


def test_zero_iqr_flattens_and_is_reported(spark):
    df = spark.createDataFrame([(1.0,)] * 9 + [(0.0,)], "x double")
    assert p.zero_iqr_columns(df) == ["x"]
    assert {r["x"] for r in c.fix_outliers(df, "clip_iqr").collect()} == {1.0}


def test_clipping_leaves_missing_alone(spark):
    df = spark.createDataFrame([(float(i),) for i in range(8)] + [(None,), (NAN,), (500.0,)], "x double")
    out = [r["x"] for r in c.fix_outliers(df, "clip_iqr").collect()]
    assert out.count(None) == 2 and max(v for v in out if v is not None) < 500


def test_outliers_are_dropped_column_by_column(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.normal(size=300), "b": rng.normal(size=300)})
    pdf.loc[:20, "a"] += 50
    pdf.loc[:20, "b"] += 3
    want = pdf
    for name in ("a", "b"):
        q1, q3 = want[name].quantile(0.25), want[name].quantile(0.75)
        want = want[(want[name] >= q1 - 1.5 * (q3 - q1)) & (want[name] <= q3 + 1.5 * (q3 - q1))]
    got = c.fix_outliers(spark.createDataFrame(pdf), "drop")
    assert rows(got) == sorted(map(tuple, want.to_numpy().tolist()), key=str)


def test_fix_is_idempotent_for_duplicates_and_frozen_bounds(spark):
    df = spark.createDataFrame([(float(i % 10), "s") for i in range(40)] + [(99.0, "t")], "x double, s string")
    once = c.dedup(df)
    assert rows(c.dedup(once)) == rows(once)
    bounds = p.outlier_bounds(df)
    clipped = c.apply_clip(df, bounds)
    assert rows(c.apply_clip(clipped, bounds)) == rows(clipped)


def test_compare_totals_equal_the_single_operators(spark):
    df = spark.createDataFrame(
        [(1.0, "a"), (1.0, "a"), (None, None), (None, None), (2.0, None), (900.0, "z"), (1.5, "b"), (1.7, "c")],
        "x double, s string",
    )
    totals = cmp.quality_totals(df)
    assert totals == {"Rows": 8, "Missing values": 5, "Duplicates": 2, "Outliers (IQR)": 1}
    other = df.select("s", (F.col("x") * 2).cast("int").alias("x"), F.lit("k").alias("key"))
    frames = [df, df.limit(0), other, df.where("x < 2").select("s")]
    assert cmp.totals_of(frames, ["key"]) == [cmp.quality_totals(f, ["key"]) for f in frames]
    table = {r["metric"]: r for r in cmp.compare(df, df.limit(0)).collect()}
    assert table["Rows"]["change"] == "-100.0%" and table["Rows"]["delta"] == -8
    zero = {r["metric"]: r["change"] for r in cmp.compare(df.limit(0), df).collect()}
    assert zero["Rows"] == "n/a"


def test_golden_values(spark):
    from registry.base import docs
    from winnowry.operators.clean import DEFAULT_STRATEGIES

    df = docs(spark, "/root/testdata/sf0.01")
    body = df.drop("doc_id")
    totals = cmp.quality_totals
    assert list(totals(body).values()) == [1000, 1202, 1, 204]
    strict = c.fix(body, DEFAULT_STRATEGIES["strict"])
    assert list(totals(strict).values()) == [311, 0, 0, 47]
    assert strict.agg(F.sum("n_chars")).first()[0] == 548285
    medium = c.fix(body, DEFAULT_STRATEGIES["medium"])
    assert list(totals(medium).values()) == [999, 600, 0, 51]
    assert medium.agg(F.sum("n_chars")).first()[0] == 2019564.25
    mild = c.fix(df, DEFAULT_STRATEGIES["mild"], order_col="doc_id").drop("doc_id")
    assert list(totals(mild).values()) == [1000, 0, 1, 352]


def test_cleaning_a_stream_with_frozen_numbers(spark, folder):
    df = spark.createDataFrame([(float(i), "a") for i in range(20)] + [(None, None), (700.0, "b")], "x double, s string")
    fills, bounds = c.missing_fills(df, "median"), p.outlier_bounds(df)
    df.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{folder}/in")
    query = (
        clean_rows(stream, fills, bounds).writeStream.format("memory").queryName("cleaned")
        .option("checkpointLocation", f"{folder}/state").start()
    )
    query.processAllAvailable()
    query.stop()
    assert rows(spark.table("cleaned")) == rows(clean_rows(df, fills, bounds))


def shuffles(df):
    """Output columns of the plan's exchanges of rows."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


@pytest.mark.parametrize("position", [None, c.FILE_POSITION])
@pytest.mark.parametrize("few", [10**6, 0])
def test_copies_without_a_key(spark, folder, monkeypatch, position, few):
    """Rows are told apart by number or by place in their files, whatever the copies are sent with."""
    monkeypatch.setattr(c, "BROADCAST_ROWS", few)
    data = [(i % 7, None if i % 3 else float(i % 5), "t" * (i % 4), {"a": i % 2}) for i in range(500)]
    data += [(9, float("nan"), None, None), (9, None, None, None)]
    spark.createDataFrame(data, "a int, b double, s string, m map<string,int>").repartition(6).write.parquet(f"{folder}/in.parquet")
    df = spark.read.parquet(f"{folder}/in.parquet")
    out = c.dedup(df, position=position)
    expected = {(a, None if b != b else b, s, str(m)) for a, b, s, m in data}
    found = [(r["a"], r["b"], r["s"], str(r["m"])) for r in out.collect()]
    assert len(found) == len(expected) and set(found) == expected and out.columns == df.columns
    if few:
        assert not shuffles(out)
    filtered = c.dedup(df.where("a < 3").select("s", "a"), position=position)
    assert rows(filtered) == rows(df.where("a < 3").select("s", "a").distinct())


def test_cleaning_a_parquet_stage_shuffles_no_text(spark):
    from registry.base import docs

    body = docs(spark, "/root/testdata/sf0.001").drop("doc_id")
    for strategy in ("strict", "medium"):
        assert not any("text" in line for line in shuffles(c.fix(body, c.DEFAULT_STRATEGIES[strategy])))
    assert not any("text" in line for line in shuffles(c.dedup(body)))
