"""Exact quantiles by descent through counted buckets.

One pass counts the rows of each column in buckets of a logarithmic scale, with
the least and the greatest value of every bucket. The wanted rank lies in one of
them; the next pass counts that bucket alone, cut evenly between its own least and
greatest value, until a bucket holds one value or the rank is its first or last
one. Where a bucket ends is decided by any non-decreasing function of the value,
so rounding in it does no harm: counts, least and greatest values are exact.

A count by bucket is generated code and combined before the shuffle: a pass sends
bucket counts and never values, and the driver sees at most ``CUTS`` of them per
bucket it asked about. A logarithmic bucket holds numbers of one size, of which
there are some 2**48: so there are at most six passes, whatever the data, and two
or three on real columns.

Frames may be measured together: ``part`` names a column of small whole numbers
that tells their rows apart.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnowry.schema import col, is_missing
from winnowry.session import folder_of
from winnowry.staging import drop, stage

PER_OCTAVE = 16
CUTS = 4096
COLUMNS_PER_PASS = 25

WORTH = 4  # open values are written when they are so many times fewer

_OFFSET = 2_000  # more than the exponent of any double


@dataclass(frozen=True)
class Bucket:
    """Rows of one part and column between two values; ``below`` lie before them."""

    part: int
    column: int
    low: float
    high: float
    below: int = 0
    rows: int = 0

    def known(self, rank: int) -> float | None:
        """The value at a rank, if it is the first, the last or the only one."""
        if rank == self.below:
            return self.low
        return self.high if rank == self.below + self.rows - 1 or self.low == self.high else None


Buckets = dict[tuple[int, int], list[Bucket]]


def present_values(df: DataFrame, columns: Sequence[str], part: str | None = None) -> DataFrame:
    """The columns as doubles ``v0, v1, ...``, null where missing, and ``part``."""
    parts = F.lit(0) if part is None else F.col(part).cast("int")
    return df.select(parts.alias("part"), *[
        F.when(~is_missing(df, c), col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(columns)
    ])


def _size_digit(value: Column, per_octave: int) -> Column:
    """Place of a value on the logarithmic scale: negative values below zero, zero, positive values above."""
    size = F.floor((F.least(F.log2(F.abs(value)), F.lit(_OFFSET - 1.0)) + _OFFSET) * per_octave)
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0).cast("bigint"))


def _counted(cells: DataFrame) -> dict[tuple, list[tuple[int, float, float]]]:
    """Per part and group the ``(rows, low, high)`` of its digits, in order."""
    table = cells.groupBy("part", "group", "digit").agg(
        F.count(F.lit(1)).alias("rows"), F.min("v").alias("low"), F.max("v").alias("high")
    ).toArrow()
    part, group, digit, rows, low, high = (table.column(c).to_numpy() for c in table.column_names)
    found = defaultdict(list)
    for i in np.lexsort((digit, group, part)).tolist():
        found[int(part[i]), int(group[i])].append((int(rows[i]), float(low[i]), float(high[i])))
    return found


def _cells(values: DataFrame, columns: Sequence[int]) -> DataFrame:
    """One row ``(part, column, v)`` per present value."""
    long = values.unpivot(["part"], [f"v{i}" for i in columns], "name", "v").where("v IS NOT NULL")
    return long.select("part", F.substring("name", 2, 9).cast("int").alias("column"), "v")


def first_pass(values: DataFrame, columns: int, per_octave: int = PER_OCTAVE) -> Buckets:
    """All values by size: the buckets of each part and column, in order."""
    cells = _cells(values, range(columns)).select(
        "part", F.col("column").alias("group"), _size_digit(F.col("v"), per_octave).alias("digit"), "v"
    )
    return {at: _in_order(Bucket(*at, 0, 0), parts) for at, parts in _counted(cells).items()}


def _in_order(home: Bucket, parts: list[tuple[int, float, float]]) -> list[Bucket]:
    buckets, below = [], home.below
    for rows, low, high in parts:
        buckets.append(Bucket(home.part, home.column, low, high, below, rows))
        below += rows
    return buckets


def _inside(values: DataFrame, wanted: Sequence[Bucket]) -> DataFrame:
    """``(part, column, v, number, low, high)``: the values in the wanted buckets, from a row per row or per value.

    Buckets are a small table, not a condition that tries each of them on every value.
    """
    columns = sorted({b.column for b in wanted})
    cells = values if "v" in values.columns else _cells(values, columns)
    table = values.sparkSession.createDataFrame(
        [(b.part, b.column, number, b.low, b.high) for number, b in enumerate(wanted)],
        "part int, column int, number int, low double, high double",
    )
    held = cells.join(F.broadcast(table), ["part", "column"])
    return held.where((F.col("v") >= F.col("low")) & (F.col("v") <= F.col("high")))


def next_pass(values: DataFrame, wanted: Sequence[Bucket], cuts: int = CUTS) -> dict[Bucket, list[Bucket]]:
    """The wanted buckets, which share no value, cut evenly between their least and greatest value."""
    v, low, high = F.col("v"), F.col("low"), F.col("high")
    # halves, so that the distance cannot overflow
    place = F.floor((v / 2 - low / 2) / (high / 2 - low / 2) * cuts)
    digit = F.when(high / 2 > low / 2, place).otherwise((v > low).cast("bigint"))
    counted = _counted(_inside(values, wanted).select("part", F.col("number").alias("group"), digit.alias("digit"), "v"))
    return {b: _in_order(b, counted[b.part, number]) for number, b in enumerate(wanted)}


def holding(buckets: Sequence[Bucket], rank: int) -> Bucket:
    """The bucket with the row at a rank."""
    return next(b for b in buckets if rank < b.below + b.rows)


Targets = dict[tuple[int, int, int], Bucket]


def descend(values: DataFrame, targets: Targets, cuts: int = CUTS) -> dict[tuple[int, int, int], float]:
    """The value at each ``(part, column, rank)``, given a bucket that holds it.

    Where several more passes are to come, values in open buckets are written once they
    are a quarter of those read so far: all passes together read little more than the first ones.
    """
    found: dict[tuple[int, int, int], float] = {}
    reads, written = 0, None
    narrow = folder_of(values.sparkSession) is not None
    while True:
        open_ones: Targets = {}
        for target, bucket in targets.items():
            value = bucket.known(target[2])
            if value is None:
                open_ones[target] = bucket
            else:
                found[target] = value
        if not open_ones:
            if written is not None:
                drop(written)
            return found
        wanted = list(dict.fromkeys(open_ones.values()))
        rows = sum(b.rows for b in wanted)
        reads = reads or rows
        if narrow and max(b.rows for b in wanted) > cuts and WORTH * rows <= reads:
            values, before = stage(_inside(values, wanted).select("part", "column", "v"), "open"), written
            reads, written = rows, values
            if before is not None:
                drop(before)
        cut = next_pass(values, wanted, cuts)
        targets = {t: holding(cut[b], t[2]) for t, b in open_ones.items()}


# --- quantiles ------------------------------------------------------------------

def ranks_of(n: int, p: float) -> tuple[int, int, float]:
    """The two ranks (from 0) between which a quantile lies, and how far it is from the first."""
    at = (n - 1) * p
    return math.floor(at), math.ceil(at), at - math.floor(at)


def interpolate(low: float, high: float, share: float) -> float:
    """Linear interpolation measured from the nearer end, which rounds evenly."""
    if low == high or share == 0:
        return low
    gap = high - low
    return low + gap * share if share < 0.5 else high - gap * (1 - share)


def quantiles_by_part(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], part: str | None = None,
    per_octave: int = PER_OCTAVE, cuts: int = CUTS,
) -> dict[tuple[int, str], tuple[int, list[float]]]:
    """Per part and column with values: their number and their quantiles."""
    result = {}
    for start in range(0, len(columns), COLUMNS_PER_PASS):
        names = list(columns[start:start + COLUMNS_PER_PASS])
        values = present_values(df, names, part)
        buckets = first_pass(values, len(names), per_octave)
        sizes = {at: sum(b.rows for b in found) for at, found in buckets.items()}
        wanted = {at: [ranks_of(n, p) for p in probs] for at, n in sizes.items()}
        found = descend(values, {
            (*at, rank): holding(buckets[at], rank)
            for at, quantiles in wanted.items() for low, high, _ in quantiles for rank in (low, high)
        }, cuts)
        for (p, c), quantiles in wanted.items():
            result[p, names[c]] = sizes[p, c], [
                interpolate(found[p, c, low], found[p, c, high], share) for low, high, share in quantiles
            ]
    return result


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float],
    per_octave: int = PER_OCTAVE, cuts: int = CUTS,
) -> dict[str, tuple[int, list[float] | None]]:
    """Per column: number of non-missing values and linearly interpolated quantiles."""
    found = quantiles_by_part(df, columns, probs, None, per_octave, cuts)
    return {c: found.get((0, c), (0, None)) for c in columns}


# --- quantiles of what is left --------------------------------------------------

def _recounted(values: DataFrame, column: int, spans: Sequence[tuple[float, float]], cuts: int) -> list[Bucket]:
    """All values of a column in order: one bucket per stretch outside the spans, the spans cut evenly."""
    v = F.col("v")
    group, digit = F.lit(2 * len(spans)), F.lit(0).cast("bigint")
    for i, (low, high) in reversed(list(enumerate(spans))):
        place = F.floor((v / 2 - low / 2) / (high / 2 - low / 2) * cuts) if high / 2 > low / 2 else (v > low).cast("bigint")
        group = F.when(v < low, 2 * i).when(v <= high, 2 * i + 1).otherwise(group)
        digit = F.when(v < low, F.lit(0).cast("bigint")).when(v <= high, place.cast("bigint")).otherwise(digit)
    name = f"v{column}"
    cells = values.where(F.col(name).isNotNull()).select("part", F.col(name).alias("v")).select(
        "part", group.alias("group"), digit.alias("digit"), "v"
    )
    counted = _counted(cells)
    return _in_order(Bucket(0, column, 0, 0), [b for at in sorted(counted) for b in counted[at]])


def quantiles_left(
    values: DataFrame, column: int, before: Sequence[Bucket], dropped: int, probs: Sequence[float], cuts: int = CUTS,
) -> tuple[int, list[float] | None, list[Bucket]]:
    """Number of values, quantiles and buckets of a column after rows were dropped.

    ``before`` are its buckets over all rows, ``dropped`` is at least the number of rows
    gone since, and ``values`` holds the rows left. However the dropped rows lay,
    they move a rank by no more than their number: so the buckets say between which
    values the quantile now lies, and one pass counts what is left there.
    """
    n, buckets = sum(b.rows for b in before), list(before)
    if dropped and n:
        places = []
        for p in probs:
            low, high = max(0, math.floor((n - dropped - 1) * p)), min(n - 1, math.ceil((n - 1) * p) + dropped)
            places.append([buckets.index(holding(buckets, rank)) for rank in (low, high)])
        merged: list[list[int]] = []
        for first, last in sorted(places):
            if merged and first <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], last)
            else:
                merged.append([first, last])
        buckets = _recounted(values, column, [(buckets[a].low, buckets[b].high) for a, b in merged], cuts)
        n = sum(b.rows for b in buckets)
    if n == 0:
        return 0, None, buckets
    ranks = [ranks_of(n, p) for p in probs]
    found = descend(values, {
        (0, column, rank): holding(buckets, rank) for low, high, _ in ranks for rank in (low, high)
    }, cuts)
    return n, [interpolate(found[0, column, low], found[0, column, high], share) for low, high, share in ranks], buckets
