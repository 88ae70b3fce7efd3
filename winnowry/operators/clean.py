"""Cleaning: duplicates, then missing values, then outliers.

Every fix is split in two: learn a few numbers from the data (fill values,
bounds), then apply them as plain column expressions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnowry.operators.profile import (
    MIN_VALUES, iqr_bounds, missing_counts, outlier_bounds, outside, row_fingerprint,
)
from winnowry.operators.quantiles import exact_quantiles, first_pass, present_values, quantiles_left
from winnowry.operators.ranking import BUCKET, ROWS_PER_BUCKET, order_bucket, tie_breaker
from winnowry.schema import (
    col, is_missing, nan_to_null, numeric_columns, protected_columns, string_columns,
)
from winnowry.staging import stage

# --- fixed values -------------------------------------------------------------
DEFAULT_STRATEGIES = {
    "strict": {"missing": "drop", "duplicates": "drop", "outliers": "drop"},
    "medium": {"missing": "median", "duplicates": "drop", "outliers": "clip_iqr"},
    "mild": {"missing": "ffill", "duplicates": "none", "outliers": "none"},
}
CONSTANT_PREFIX = "constant:"
UNKNOWN = "unknown"
# ------------------------------------------------------------------------------

BROADCAST_ROWS = 200_000


# --- duplicates ---------------------------------------------------------------

#: Where a row lies in the Parquet files it was read from: for frames that are filters
#: and projections of files, and only for those.
FILE_POSITION = ("_metadata.file_path", "_metadata.row_index")


def dedup(
    df: DataFrame, keep: str = "drop", order_col: str | None = None,
    subset: Sequence[str] | None = None, position: Sequence[str] | None = None,
) -> DataFrame:
    """Keep one row of each group of equal rows.

    With ``order_col`` (a unique key, left out of the comparison) the first or last row
    of each group survives. Without it the rows of a group are identical, so any
    will do: rows are told apart by ``position`` (``FILE_POSITION``), or are numbered
    in the order in which they are written to a table. Only fingerprints and keys
    are shuffled either way; rows meet the keys of the copies where they are, unless
    there are more than ``BROADCAST_ROWS`` copies.
    """
    if keep == "none":
        return df
    df = nan_to_null(df)
    shown = [col(c) for c in df.columns]
    if order_col is not None:
        names = list(subset or [c for c in df.columns if c != order_col])
        rows, keys = df, [col(order_col)]
        marks = row_fingerprint(df, names)
    elif subset:
        raise ValueError("a subset needs order_col to say which row survives")
    elif position is not None:
        rows = df.select("*", *[F.col(p).alias(f"__at{i}") for i, p in enumerate(position)])
        keys = [F.col(f"__at{i}") for i in range(len(position))]
        marks = row_fingerprint(df)
    else:
        marks = [h.alias(f"__{i}") for i, h in enumerate(row_fingerprint(df))]
        rows = stage(df.select("*", *marks, F.monotonically_increasing_id().alias("__row")), "numbered")
        keys, marks = [F.col("__row")], [F.col("__0").alias("h1"), F.col("__1").alias("h2")]
    names = [f"k{i}" for i in range(len(keys))]
    narrow = rows.select(*marks, *[k.alias(n) for k, n in zip(keys, names)])
    if order_col is not None or position is not None:
        narrow = stage(narrow, "fingerprints")  # else they were written with the rows
    key = F.struct(*names)
    chosen = F.max(key) if keep == "keep_last" else F.min(key)
    winners = narrow.groupBy("h1", "h2").agg(chosen.alias("k")).select("k.*")
    # joined on the unique key, not on the fingerprint: no hot group can form
    losers = stage(narrow.select(names).join(winners, names, "left_anti"), "duplicates")
    few = losers.count() <= BROADCAST_ROWS
    same = reduce(and_, [k == losers[n] for k, n in zip(keys, names)])
    left = rows.join(F.broadcast(losers) if few else losers, same, "left_anti").select(shown)
    return left if few else stage(left, "deduplicated")


# --- missing values -----------------------------------------------------------

def forward_fill(
    df: DataFrame, order_cols: Sequence[str] | str, rows_per_bucket: int = ROWS_PER_BUCKET,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Every column takes the last present value above it, in the order given.

    NULL order keys come first. Rows tied in the order may be put in one by the
    hash of the ``ties`` columns, so that a value held by very many rows is cut too.

    Rows are cut into consecutive buckets; a bucket is filled on its own, and
    what is still empty at its top takes the last present value of the buckets
    before it. Only that carry table, one row per bucket, is ordered globally.
    """
    order = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    df = nan_to_null(df)
    _, missing = missing_counts(df)
    gaps = [c for c in df.columns if missing[c] and c not in order]
    if not gaps:
        return df
    bucketed, buckets = order_bucket(df, order, rows_per_bucket, ties)
    keys = [col(c) for c in order] + ([tie_breaker(ties)] if ties else [])
    within = Window.partitionBy(BUCKET).orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    filled = bucketed.withColumns({c: F.last(col(c), True).over(within) for c in gaps})
    if buckets == 1:
        return filled.drop(BUCKET)

    key = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    lasts = bucketed.groupBy(BUCKET).agg(*[
        F.max_by(col(c), F.when(col(c).isNotNull(), key)).alias(f"carry{i}")
        for i, c in enumerate(gaps)
    ])
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carry = lasts.select(BUCKET, *[
        F.last(f"carry{i}", True).over(before).alias(f"carry{i}") for i in range(len(gaps))
    ])
    # both sides are hashed by bucket already: the join adds no shuffle of the rows
    joined = filled.join(carry, BUCKET, "left")
    return joined.select([
        F.coalesce(col(c), F.col(f"carry{gaps.index(c)}")).alias(c) if c in gaps else col(c)
        for c in df.columns
    ])


def column_mode(df: DataFrame, name: str):
    """Most frequent value, the smallest one on ties; None for an empty column."""
    present = df.where(~is_missing(df, name)).select(col(name).alias("v"))
    if not isinstance(df.schema[name].dataType, T.StringType):
        top = present.groupBy("v").count().orderBy(F.desc("count"), F.asc("v")).first()
        return top["v"] if top else None
    # count by fingerprint, so that long texts are never shuffled
    marked = present.select("v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(71), "v").alias("h2"))
    counts = marked.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    best = counts.agg(F.max("n")).first()[0]
    if best is None:
        return None
    if best > 1:
        winners = stage(counts.where(F.col("n") == best).select("h1", "h2"), "modes")
        if winners.count() <= BROADCAST_ROWS:
            winners = F.broadcast(winners)
        marked = marked.join(winners, ["h1", "h2"], "left_semi")
    return marked.agg(F.min("v")).first()[0]


def missing_fills(df: DataFrame, how: str, protected: Iterable[str] = ()) -> dict[str, object]:
    """Fill value per unprotected column that has missing cells.

    Numeric columns follow ``how`` (mean, median, mode; anything else leaves
    them alone), string columns always take their mode, or "unknown" if empty.
    """
    df = nan_to_null(df)
    _, missing = missing_counts(df)
    numbers = [c for c in numeric_columns(df, protected) if missing[c]]
    fills: dict[str, object] = {}
    if how == "median" and numbers:
        for c, (n, q) in exact_quantiles(df, numbers, [0.5]).items():
            if n:
                fills[c] = q[0]
    elif how == "mean" and numbers:
        row = df.agg(*[F.avg(col(c)).cast("double").alias(c) for c in numbers]).first()
        fills.update({c: row[c] for c in numbers if row[c] is not None})
    elif how == "mode":
        modes = {c: column_mode(df, c) for c in numbers}
        fills.update({c: v for c, v in modes.items() if v is not None})
    for c in string_columns(df, protected):
        if missing[c]:
            mode = column_mode(df, c)
            fills[c] = UNKNOWN if mode is None else mode
    return fills


def apply_fills(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """Put the fill values in; an integer column widens for a fractional value."""
    df = nan_to_null(df)
    if not fills:
        return df
    out = {}
    for c, value in fills.items():
        kind = df.schema[c].dataType
        whole = isinstance(kind, T.IntegralType) and isinstance(value, float)
        out[c] = F.coalesce(col(c).cast("double") if whole else col(c), F.lit(value))
    return df.withColumns(out)


def fix_missing(
    df: DataFrame, how: str, protected: Iterable[str] = (),
    order_col: Sequence[str] | str | None = None,
) -> DataFrame:
    """drop | ffill | constant:<v> | mean | median | mode.

    Dropping, forward filling and constants touch every column; the statistics
    leave protected ones alone.
    """
    if how == "drop":
        return nan_to_null(df).dropna("any")
    if how == "ffill":
        if order_col is None:
            raise ValueError("ffill needs order_col")
        return forward_fill(df, order_col)
    if how.startswith(CONSTANT_PREFIX):
        text = how[len(CONSTANT_PREFIX):]
        df = nan_to_null(df)
        atomic = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType,
                  T.TimestampNTZType)
        return df.withColumns({
            f.name: F.coalesce(col(f.name), F.lit(text).try_cast(f.dataType))
            for f in df.schema.fields if isinstance(f.dataType, atomic)
        })
    return apply_fills(df, missing_fills(df, how, protected))


# --- outliers -----------------------------------------------------------------

def apply_clip(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Pull values to their bounds; missing stays missing."""
    df = nan_to_null(df)
    if not bounds:
        return df
    return df.withColumns({
        c: F.when(
            col(c).isNotNull(),
            F.least(F.greatest(col(c).cast("double"), F.lit(low)), F.lit(high)),
        )
        for c, (low, high) in bounds.items()
    })


def fix_outliers(df: DataFrame, how: str, protected: Iterable[str] = ()) -> DataFrame:
    """clip_iqr | clip_zscore | drop | none, on unprotected numeric columns.

    Dropping goes column by column in schema order: the bounds of a column come
    from the rows the columns before it have left.
    """
    names = numeric_columns(df, protected)
    if how == "clip_zscore":
        return apply_clip(df, outlier_bounds(df, "zscore", names))
    if how not in ("clip_iqr", "drop") or not names:
        return df
    df = nan_to_null(df)
    if how == "clip_iqr":
        numbers = stage(df.select([col(c) for c in names]), "numbers")
        return apply_clip(df, outlier_bounds(numbers, "iqr", names))
    for c, bounds in drop_bounds(df, names).items():
        df = df.where(~outside(df, c, bounds))
    return df


def drop_bounds(df: DataFrame, names: Sequence[str]) -> dict[str, tuple[float, float]]:
    """IQR bounds per column, each from the rows that the columns before it leave.

    All columns are counted by size in one pass. Rows dropped later move ranks by no
    more than their number, so a column's quartiles are found by one more pass over
    what is left of the numeric columns, written once.
    """
    numbers = stage(present_values(df, names), "numbers")
    counted, left, dropped, found = first_pass(numbers, len(names)), numbers, 0, {}
    for i, name in enumerate(names):
        n, quartiles, buckets = quantiles_left(left, i, counted.get((0, i), []), dropped, [0.25, 0.75])
        if n < MIN_VALUES:
            continue
        low, high = found[name] = iqr_bounds(*quartiles)
        v = F.col(f"v{i}")
        left = left.where(v.isNull() | v.between(low, high))
        dropped += sum(b.rows for b in buckets if b.low < low or b.high > high)
    return found


# --- all together -------------------------------------------------------------

def fix(
    df: DataFrame, strategy: Mapping[str, str], protected_cols: Iterable[str] | None = None,
    order_col: Sequence[str] | str | None = None, dedup_key: str | None = None,
    position: Sequence[str] | None = None,
) -> DataFrame:
    """Apply a strategy; a step missing from it is skipped. ``position`` is handed to ``dedup``."""
    protected = protected_columns(df, protected_cols)
    missing, outliers = strategy.get("missing"), strategy.get("outliers")
    df = dedup(df, strategy.get("duplicates", "none"), dedup_key, position=position)
    if missing is not None:
        df = fix_missing(df, missing, protected, order_col)
    if outliers is not None:
        df = fix_outliers(df, outliers, protected)
    return df
