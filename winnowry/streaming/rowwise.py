"""Cleaning of a stream with numbers learned from a table.

There is no stateful operator here: once fill values and bounds are known,
cleaning is row by row and runs unchanged on ``readStream`` frames.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from winnowry.operators.clean import apply_clip, apply_fills


def clean_rows(
    df: DataFrame, fills: Mapping[str, object], bounds: Mapping[str, tuple[float, float]]
) -> DataFrame:
    """Fill and clip every row by values from ``missing_fills`` and ``outlier_bounds``."""
    return apply_clip(apply_fills(df, fills), bounds)
