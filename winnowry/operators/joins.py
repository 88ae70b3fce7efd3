"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
HOT_KEYS = 100_000  # keys that each hold 1/HOT_KEYS of the rows: never more than so many


def left_join_hot(
    left: DataFrame, right: DataFrame, keys: Sequence[str], copies: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Left join whose right side (one row per key) knows how often the left side has the key.

    Hot keys are sent to the rows; all others meet by shuffle. Hot is a key with
    more than ``hot_rows`` rows and more than 1/``HOT_KEYS`` of all: there cannot be
    more than ``HOT_KEYS`` of them, however large the tables.
    """
    keys = list(keys)
    total = right.agg(F.sum(copies)).first()[0] or 0
    hot_rows = max(hot_rows, total // HOT_KEYS)
    hot = right.where(F.col(copies) > hot_rows)
    if hot.isEmpty():
        return left.join(right, keys, "left")
    columns = list(dict.fromkeys(left.columns + right.columns))
    meets_hot = left.join(F.broadcast(hot), keys).select(columns)
    rest = left.join(F.broadcast(hot.select(keys)), keys, "left_anti")
    cold = right.where(F.col(copies) <= hot_rows)
    return meets_hot.unionByName(rest.join(cold, keys, "left").select(columns))
