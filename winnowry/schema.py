"""Column names with a meaning, type selectors and missing-value handling."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
PROVENANCE = ("_source", "_dataset_id")
ANNOTATION = ("_label", "_confidence", "_reason")
TARGET_NAMES = ("label", "target", "class", "category", "toxic", "sentiment", "y", "split")
TEXT_NAMES = (
    "text", "comment", "comment_text", "review", "sentence",
    "body", "content", "message", "tweet", "post",
)
LABEL_NAMES = ("label", "target", "class", "category", "toxic", "_label", "sentiment")
# ----------------------------------------------------------------------------

CATALOG = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("downloads", T.LongType()),
    T.StructField("likes", T.LongType()),
    T.StructField("size_category", T.StringType()),
    T.StructField("license", T.StringType()),
    T.StructField("description_raw", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
])

RANKED_CATALOG = T.StructType(CATALOG.fields + [
    T.StructField("description", T.StringType()),
    T.StructField("ml_tasks", T.ArrayType(T.StringType())),
    T.StructField("relevance_score", T.DoubleType()),
])


def col(name: str) -> Column:
    """Column by exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_float(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.FloatType, T.DoubleType))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in skip
    ]


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL and NaN both count as missing."""
    missing = col(name).isNull()
    return missing | F.isnan(col(name)) if is_float(df.schema[name]) else missing


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing marker: Spark groups, ranks and averages NaN unlike NULL."""
    floats = [f.name for f in df.schema.fields if is_float(f)]
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(col(c)), col(c)) for c in floats})


def user_cols(df: DataFrame, agent_cols: Iterable[str] = PROVENANCE) -> list[str]:
    skip = set(agent_cols)
    return [c for c in df.columns if c not in skip]


def drop_agent_columns(df: DataFrame, agent_cols: Iterable[str] = PROVENANCE) -> DataFrame:
    return df.select([col(c) for c in user_cols(df, agent_cols)])


def protected_columns(df: DataFrame, extra: Iterable[str] | None = None) -> set[str]:
    """Columns cleaning must not alter: target names, ``_`` columns, the caller's own."""
    named = {c for c in df.columns if c in TARGET_NAMES or c.startswith("_")}
    return named | set(extra or ())


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text, missing as the empty string."""
    return df.select([
        F.when(is_missing(df, c), F.lit("")).otherwise(col(c).cast("string")).alias(c)
        for c in df.columns
    ])


def null_mask(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Missing indicator per cell; ``keep`` columns (a key) pass through."""
    kept = list(keep)
    return df.select(
        [col(c) for c in kept]
        + [is_missing(df, c).alias(c) for c in df.columns if c not in kept]
    )
