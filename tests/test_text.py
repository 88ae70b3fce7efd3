"""Sizes of files as text."""

from pyspark.sql import functions as F

from winnowry.functions.text import size_on_disk


def test_halves_of_sizes_print_as_in_python(spark):
    sizes = [8192 * 100_000, 3 * 8192 * 100_000, 1, 1 << 20, (1 << 30) * 9 // 8, (1 << 30) * 11 // 8, 51 << 10, 153 << 10]
    rows = spark.createDataFrame([(s,) for s in sizes], "size bigint").select("size", size_on_disk(F.col("size")).alias("text"))
    mebi = lambda s: s / 1024 / 1024
    want = {s: f"{mebi(s):.1f} MB" if mebi(s) < 1024 else f"{mebi(s) / 1024:.2f} GB" for s in sizes}
    assert {r["size"]: r["text"] for r in rows.collect()} == want and want[8192 * 100_000] == "781.2 MB"
