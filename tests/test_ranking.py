import hashlib

import pytest
from pyspark.sql import functions as F

from winnowry.operators.joins import left_join_hot
from winnowry.operators.ranking import (
    BUCKET, global_rank, hash_cutoffs, order_bucket, sample_n, take_ranked, top_per_group,
)


def hashed(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


@pytest.mark.parametrize("parts", [1, 7])
def test_global_rank_over_many_buckets(spark, parts):
    df = spark.range(0, 5000).withColumn("day", (F.col("id") % 13).cast("int")).repartition(parts)
    ranked = global_rank(df, ["day", "id"], rows_per_bucket=200).collect()
    order = sorted(ranked, key=lambda r: (r["day"], r["id"]))
    assert [r["rank"] for r in order] == list(range(1, 5001))


def test_buckets_are_bounded_even_when_a_third_shares_the_leading_key(spark):
    df = spark.range(0, 6000).withColumn("day", F.when(F.col("id") < 2000, 0).otherwise(F.col("id")))
    bucketed, n = order_bucket(df, ["day", "id"], rows_per_bucket=300)
    sizes = [r["count"] for r in bucketed.groupBy(BUCKET).count().collect()]
    assert n > 10 and max(sizes) < 1500


def test_text_order_keys(spark):
    df = spark.range(0, 1000).select(F.md5(F.col("id").cast("string")).alias("k"))
    ranked = global_rank(df, ["k"], rows_per_bucket=100).orderBy("rank").collect()
    assert [r["k"] for r in ranked] == sorted(r["k"] for r in ranked)


@pytest.mark.parametrize("n,take", [(10, 100_000), (37, 5), (10_000, 5), (0, 5)])
def test_sample_is_the_smallest_hashes(spark, n, take):
    df = spark.range(0, 400).repartition(3)
    got = sorted(r["id"] for r in sample_n(df, n, "id", 42, take_rows=take).collect())
    want = sorted(sorted(range(400), key=lambda k: (hashed(42, k), k))[:n])
    assert got == want


def test_small_sample_of_a_large_table_is_prefiltered(spark):
    df = spark.range(0, 20_000)
    got = sorted(r["id"] for r in sample_n(df, 20, "id", 1).collect())
    assert got == sorted(sorted(range(20_000), key=lambda k: (hashed(1, k), k))[:20])


def test_cutoffs_of_a_dominating_group(spark):
    df = spark.range(0, 3000).withColumn("g", F.when(F.col("id") < 2500, "big").otherwise("small"))
    found = {(r["g"], r["rank"]): r["k"] for r in hash_cutoffs(
        df, "g", "id", 7, {"big": [1, 2000], "small": [500, 501]}
    ).collect()}
    big = sorted(range(2500), key=lambda k: (hashed(7, k), k))
    small = sorted(range(2500, 3000), key=lambda k: (hashed(7, k), k))
    assert found == {("big", 1): big[0], ("big", 2000): big[1999], ("small", 500): small[499]}


def test_top_per_group_with_a_hot_group(spark):
    df = spark.range(0, 2000).withColumn("g", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")))
    top = top_per_group(df, ["g"], [F.desc("id")], "id", 3).collect()
    hot = sorted((r["rank"], r["id"]) for r in top if r["g"] == "hot")
    assert hot == [(1, 1999), (2, 1997), (3, 1996)]
    assert len(top) == 3 + len([i for i in range(2000) if i % 3 == 0])


def test_take_ranked(spark):
    rows = take_ranked(spark.range(0, 100), [F.desc("id")], 3).collect()
    assert sorted((r["rank"], r["id"]) for r in rows) == [(1, 99), (2, 98), (3, 97)]


def test_left_join_hot(spark):
    left = spark.range(0, 900).withColumn("k", F.when(F.col("id") < 500, 0).otherwise(F.col("id")))
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("copies")).where("k <> 600").withColumn("v", F.col("k") * 2)
    plain = left.join(right, ["k"], "left")
    split = left_join_hot(left, right, ["k"], "copies", hot_rows=100)
    assert sorted(map(tuple, split.select(plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_wide_rows_make_more_buckets(spark, monkeypatch):
    """A bucket is bounded by its bytes too: whole texts of few rows are not one task's."""
    from winnowry.operators import ranking

    monkeypatch.setattr(ranking, "BUCKET_BYTES", 100_000)
    df = spark.range(0, 400).select("id", F.repeat(F.lit("x"), F.lit(5_000)).alias("text"), F.array(F.lit(None).cast("string")).alias("a"))
    bucketed, n = order_bucket(df, ["id"])
    sizes = [r["count"] for r in bucketed.groupBy(BUCKET).count().collect()]
    assert 15 <= n <= 25 and max(sizes) < 80
    ranked = {r["id"]: r["rank"] for r in global_rank(df, ["id"]).select("id", "rank").collect()}
    assert ranked == {i: i + 1 for i in range(400)}
    assert order_bucket(df.limit(0), ["id"])[1] == 1 and order_bucket(df.select("id"), ["id"])[1] == 1
