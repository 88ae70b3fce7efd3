"""Which column holds the text, which the label, and what the classes are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry.functions.text import norm_label
from winnowry.operators.profile import few_distinct
from winnowry.operators.quantiles import exact_quantiles
from winnowry.schema import (
    ANNOTATION, LABEL_NAMES, PROVENANCE, TEXT_NAMES, col, is_missing, string_columns, user_cols,
)

# --- fixed values -------------------------------------------------------------
MAX_CLASSES = 20
# ------------------------------------------------------------------------------


def text_lengths(df: DataFrame, how: str = "mean") -> dict[str, float]:
    """Mean or median length of the values of each user string column."""
    agent = PROVENANCE if how == "mean" else PROVENANCE + ANNOTATION
    names = string_columns(df.select([col(c) for c in user_cols(df, agent)]))
    if not names:
        return {}
    lengths = df.select([F.length(col(c)).alias(c) for c in names])
    if how == "mean":
        row = lengths.agg(*[F.avg(col(c)).alias(c) for c in names]).first()
        return {c: row[c] for c in names}
    if how == "median":
        found = exact_quantiles(lengths, names, [0.5])
        return {c: (q[0] if q else None) for c, (_, q) in found.items()}
    raise ValueError(f"unknown length statistic: {how}")


def find_text_col(df: DataFrame, how: str = "mean") -> str:
    """A known text name, else the string column with the longest values."""
    names = user_cols(df, PROVENANCE if how == "mean" else PROVENANCE + ANNOTATION)
    for name in TEXT_NAMES:
        if name in names:
            return name
    lengths = {c: v for c, v in text_lengths(df, how).items() if v is not None}
    if lengths:
        return max(lengths, key=lambda c: lengths[c])
    if how == "mean" and names:
        return names[0]
    raise ValueError(f"no text column in {df.columns}")


def find_label_col(df: DataFrame) -> str:
    """A known label name, else the first user column with at most 20 values."""
    hidden = set(PROVENANCE + ANNOTATION) - {"_label"}
    names = user_cols(df, hidden)
    for name in LABEL_NAMES:
        if name in names:
            return name
    counts = few_distinct(df, names, MAX_CLASSES)
    for name in names:
        if name in counts:
            return name
    raise ValueError(f"no label column in {df.columns}")


def class_column(df: DataFrame, text_col: str) -> str | None:
    """First column besides the text with 1 to 20 values."""
    names = [c for c in user_cols(df) if c != text_col]
    counts = few_distinct(df, names, MAX_CLASSES)
    return next((c for c in names if counts.get(c, 0) >= 1), None)


def infer_classes(df: DataFrame, text_col: str) -> DataFrame:
    """The sorted classes found in the first class-like column, ``(column, class)``."""
    name = class_column(df, text_col)
    if name is None:
        return df.sparkSession.createDataFrame([], "column string, class string")
    # at most 20 values are left by now, so sorting them is free
    values = df.where(~is_missing(df, name)).select(col(name).alias("v")).distinct().orderBy("v")
    return values.select(F.lit(name).alias("column"), norm_label(F.col("v")).alias("class"))
