"""Order, rank, sampling and top-k operators that never sort in one task."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnowry.schema import col
from winnowry.staging import DENSE, stage

ROWS_PER_BUCKET = 250_000
BUCKET_BYTES = 64 << 20  # bytes of texts and arrays in a bucket
MAX_BUCKETS = 100_000
BOUNDS_PER_BUCKET = 20
MOST_BOUNDS = 400_000
PREFIX_ROWS = 50_000
TAKE_ROWS = 100_000
SALTS = 64
MAX_CLASSES = 10_000
BUCKET = "__bucket"
AT = "__at"


def _nulls_first(values: tuple) -> tuple:
    return tuple((v is not None, v) for v in values)


def _cut_points(keys: DataFrame, buckets: int, rows: int) -> list[tuple]:
    """Order keys that split the rows into about equal ranges, from a bounded sample."""
    wanted = min(buckets * BOUNDS_PER_BUCKET, max(MOST_BOUNDS, 3 * buckets))
    drawn = keys.sample(fraction=min(1.0, wanted / rows), seed=42).collect()
    drawn = sorted({tuple(r) for r in drawn}, key=_nulls_first)
    step = max(1, len(drawn) // buckets)
    return drawn[step::step][: buckets - 1]


def _literals(values: Sequence, kind: T.DataType) -> Column:
    """Many values as one literal array."""
    if isinstance(kind, (T.IntegralType, T.StringType)):
        return F.from_json(F.lit(json.dumps(list(values))), T.ArrayType(kind))
    return F.array(*[F.lit(v) for v in values]).cast(T.ArrayType(kind))


def _wide_bytes(df: DataFrame) -> Column:
    """Bytes of the texts and of the flat arrays of a row."""
    parts = [F.lit(0).cast("bigint")]
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(col(f.name)), F.lit(0)).cast("bigint"))
        elif isinstance(f.dataType, T.ArrayType):
            texts = isinstance(f.dataType.elementType, T.StringType)
            cells = F.octet_length(F.array_join(col(f.name), "")) if texts else 8 * F.size(col(f.name))
            parts.append(F.greatest(cells, F.lit(0)).cast("bigint"))
    return sum(parts[1:], parts[0])


def order_bucket(
    df: DataFrame, order: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET,
    spread: Sequence[str] = (),
) -> tuple[DataFrame, int]:
    """Add ``__bucket``: consecutive ranges of the order key of about ``rows_per_bucket`` rows.

    Wide rows are cut finer: a bucket has some ``BUCKET_BYTES`` of texts and arrays.

    Cut points become literals, so the bucket of a row depends on its key alone
    and stays the same however often, or wherever, the plan is evaluated again.
    The lookup is a native binary search over the literal cut points. NULL comes
    first and is cut like any value; rows tied in ``order``, NULLs too, are cut
    by a hash of the ``spread`` columns, which must then order them everywhere.
    Beyond ``MAX_BUCKETS`` buckets (25 billion rows at the default size) buckets
    grow with the rows, and a window over one spills.
    """
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_wide_bytes(df)), F.lit(0))).first()
    buckets = min(MAX_BUCKETS, max(math.ceil(rows / rows_per_bucket), math.ceil(size / BUCKET_BYTES)), rows)
    parts = [col(c).alias(f"k{i}") for i, c in enumerate(order)]
    if spread:
        parts.append(tie_breaker(spread).alias(f"k{len(order)}"))
    keys = df.select(*parts)
    cuts = _cut_points(keys, buckets, rows) if buckets > 1 else []
    if not cuts:
        return df.withColumn(BUCKET, F.lit(0)), 1
    bounds = [_literals(part, f.dataType) for part, f in zip(zip(*cuts), keys.schema.fields)]
    key = F.struct(*parts)

    def halve(state: Column, _: Column) -> Column:
        middle = F.shiftright(state["lo"] + state["hi"], 1)
        cut = F.struct(*[F.get(b, middle).alias(f"k{i}") for i, b in enumerate(bounds)])
        right = F.struct((middle + 1).alias("lo"), state["hi"].alias("hi"))
        left = F.struct(state["lo"].alias("lo"), middle.alias("hi"))
        return F.when(state["lo"] >= state["hi"], state).when(cut <= key, right).otherwise(left)

    steps = math.ceil(math.log2(len(cuts) + 1)) + 1
    found = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi")),
        halve,
        lambda s: s["lo"],
    )
    return df.withColumn(BUCKET, found), len(cuts) + 1


def global_rank(
    df: DataFrame, order: Sequence[str], name: str = "rank", rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Exact 1-based position in ``order`` (a unique key): offset of the bucket + place in it."""
    bucketed, n = order_bucket(df, order, rows_per_bucket)
    sizes = {r[BUCKET]: r["count"] for r in bucketed.groupBy(BUCKET).count().collect()}
    starts = list(accumulate([sizes.get(b, 0) for b in range(n)], initial=0))[:n]
    place = F.row_number().over(Window.partitionBy(BUCKET).orderBy(*[col(c) for c in order]))
    offset = F.get(F.lit(starts), F.col(BUCKET)).cast("bigint")
    return bucketed.withColumn(name, offset + place).drop(BUCKET)


def staged_in_order(df: DataFrame, by: str, name: str, table: str) -> tuple[DataFrame, int]:
    """``df`` written in ranges of the unique column ``by``, with 0-based places in its order; and the number of rows.

    A place is where the row's range begins, counted once written, and the place in the range.
    """
    placed = df.repartitionByRange(col(by)).sortWithinPartitions(by).withColumn(AT, F.monotonically_increasing_id())
    written = stage(placed, table, DENSE)
    # an id has the number of the range above its 33 lower bits
    part, within = F.shiftright(AT, 33).cast("int"), F.col(AT).bitwiseAND((1 << 33) - 1)
    sizes = {r["p"]: r["count"] for r in written.groupBy(part.alias("p")).count().collect()}
    starts = list(accumulate([sizes.get(p, 0) for p in range(max(sizes, default=0) + 1)], initial=0))
    found = written.withColumn(name, (F.get(F.lit(starts[:-1]), part) + within).cast("int")).drop(AT)
    found.staged_path = written.staged_path
    return found, starts[-1]


def tie_breaker(columns: Sequence[str]) -> Column:
    """What orders rows that are tied otherwise: a hash of the given columns."""
    return F.xxhash64(*[col(c) for c in columns])


def seeded_hash(key: str, seed: int) -> Column:
    """Uniform, portable order: md5 of ``seed:key``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), col(key).cast("string")))


def hash_cutoffs(
    df: DataFrame, group: str, key: str, seed: int, ranks: dict[object, list[int]],
    prefix_rows: int = PREFIX_ROWS,
) -> DataFrame:
    """Per group and wanted rank, the ``(hash, key)`` of the row holding that rank.

    Counts per hash prefix locate the prefix of each rank; only the rows of that
    prefix are then ordered. Prefixes are as long as the largest group needs for
    about ``PREFIX_ROWS`` rows each, so a slice is bounded whatever rank is wanted.
    """
    spark = df.sparkSession
    wanted_rows = [(g, int(r)) for g, rs in ranks.items() for r in rs if r > 0]
    kind = df.schema[group].dataType.simpleString()
    wanted = spark.createDataFrame(wanted_rows, f"g {kind}, rank bigint")
    narrow = df.select(col(group).alias("g"), col(key).alias("k"), seeded_hash(key, seed).alias("h"))
    largest = narrow.groupBy("g").count().agg(F.max("count")).first()[0] or 1
    digits = max(1, math.ceil(math.log(max(largest / prefix_rows, 1.0001), 16)))
    keyed = narrow.withColumn("prefix", F.substring("h", 1, digits))
    upto = F.sum("count").over(Window.partitionBy("g").orderBy("prefix"))
    homes = (
        keyed.groupBy("g", "prefix").count()
        .withColumn("upto", upto)
        .join(F.broadcast(wanted), "g")
        .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("count")))
        .select("g", "prefix", "rank", (F.col("rank") - F.col("upto") + F.col("count")).alias("local"))
    )
    # one row per (group, wanted rank): as small as the list it was made from
    placed = keyed.join(F.broadcast(homes), ["g", "prefix"]).withColumn(
        "place",
        F.row_number().over(Window.partitionBy("g", "prefix", "rank").orderBy("h", "k")),
    )
    return placed.where("place = local").select("g", "rank", "h", "k")


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42, take_rows: int = TAKE_ROWS) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, the same ones every time.

    The sample is the ``n`` smallest seeded hashes. In a large table a hash
    limit that leaves a little over ``n`` rows, checked by counting, keeps the
    sort as small as the sample; a sample too large to sort is cut at the
    counted hash of its last row.
    """
    if n <= 0:
        return df.limit(0)
    h = seeded_hash(key, seed)
    whole, rows = df, df.count()
    if rows <= n:
        return df
    if n <= take_rows:
        share = (n + 6 * math.sqrt(n) + 20) / rows
        if share < 0.1:
            near = df.where(h < F.lit(f"{math.ceil(share * 16**8):08x}"))
            if near.count() >= n:
                df = near
        # only hashes and keys meet in one task; the rows stay where they are
        keys = df.select(col(key)).orderBy(h, col(key)).limit(n)
        return whole.join(F.broadcast(keys), key, "left_semi")
    grouped = df.withColumn("__all", F.lit(0))
    cut = hash_cutoffs(grouped, "__all", key, seed, {0: [n]}).first()
    return df.where((h < cut["h"]) | ((h == cut["h"]) & (col(key) <= F.lit(cut["k"]))))


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], salt_key: str, k: int,
    name: str = "rank", rows_per_slice: int = ROWS_PER_BUCKET, rows: int | None = None,
) -> DataFrame:
    """The first ``k`` rows of each group with their rank.

    A hot group is first cut down inside salted slices, so the last ranking sees
    at most ``k`` rows per slice. There are slices enough that one holds about
    ``rows_per_slice`` rows even if all rows are one group. Rows that are dear to
    make are not made to be counted if their number is given as ``rows``.
    """
    salts = max(SALTS, math.ceil((df.count() if rows is None else rows) / rows_per_slice))
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(col(salt_key)), F.lit(salts)))
    inner = Window.partitionBy(*[col(g) for g in group], "__salt").orderBy(*order)
    outer = Window.partitionBy(*[col(g) for g in group]).orderBy(*order)
    return (
        salted.withColumn(name, F.row_number().over(inner)).where(F.col(name) <= k)
        .withColumn(name, F.row_number().over(outer)).where(F.col(name) <= k)
        .drop("__salt")
    )


def take_ranked(df: DataFrame, order: Sequence[Column], n: int, name: str = "rank") -> DataFrame:
    """The first ``n`` rows with their rank; only those ``n`` rows meet in one task."""
    top = df.orderBy(*order).limit(n)
    return top.withColumn(name, F.row_number().over(Window.orderBy(*order)))
