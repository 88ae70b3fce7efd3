"""Stage tables and dataset files in and out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnowry.functions.text import norm_label
from winnowry.operators.columns import find_label_col
from winnowry.schema import RANKED_CATALOG, col, nan_to_null

# --- fixed values: where each stage looks for its input, in order ---------------
RAW = "data/raw/combined.parquet"
CLEAN = "data/clean/combined_clean.parquet"
LABELED = "data/labeled/auto_labeled.parquet"
ANY_RAW = "data/raw/*.parquet"
STAGE_INPUTS = {
    "quality": (RAW, ANY_RAW),
    "annotation": (CLEAN, RAW, ANY_RAW),
    "eda": (RAW, ANY_RAW, "*.parquet"),
    "active_learning": (CLEAN, LABELED, RAW),
}
STAGE_OUTPUTS = {"collection": RAW, "quality": CLEAN, "annotation": LABELED}
# ---------------------------------------------------------------------------------


def scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_any(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | str | None = None,
    multi_line: bool = False, json_arrays: bool = False,
) -> DataFrame:
    """CSV, JSON and Parquet files of one dataset as one table, columns united.

    Pass ``schema`` to spare large text files the extra pass that infers one. CSV
    files are split among tasks; ``multi_line`` reads files whose quoted values
    hold line breaks, each in one task. ``json_arrays`` reads files that hold one
    JSON array.
    """
    by_format: dict[str, list[str]] = {}
    for path in paths:
        kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
        by_format.setdefault({"jsonl": "json", "ndjson": "json"}.get(kind, kind), []).append(path)
    frames = []
    for kind, group in by_format.items():
        if kind == "parquet":
            frames.append(spark.read.option("mergeSchema", "true").parquet(*group))
        elif kind == "csv":
            # one reader per file: headers may differ in order
            for path in group:
                reader = spark.read.option("header", "true").option("multiLine", multi_line)
                reader = reader.schema(schema) if schema else reader.option("inferSchema", "true")
                frames.append(reader.csv(path))
        elif kind == "json":
            reader = spark.read.schema(schema) if schema else spark.read
            frames.append(reader.option("multiLine", json_arrays).json(group))
        else:
            raise ValueError(f"unknown file type: {group[0]}")
    return merge(frames)


def merge(frames: Sequence[DataFrame | None]) -> DataFrame:
    """All frames one after the other; a column a frame lacks is NULL there."""
    present = [f for f in frames if f is not None]
    if not present:
        raise ValueError("nothing to merge")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def tag(df: DataFrame, source: str, dataset_id: str) -> DataFrame:
    """Add provenance."""
    return df.withColumns({"_source": F.lit(source), "_dataset_id": F.lit(dataset_id)})


def unify(df: DataFrame, mapping: Mapping[str, str | tuple[str, str]]) -> DataFrame:
    """Rename mapped columns, drop the rest, keep provenance.

    ``mapping`` says ``new: old`` or ``new: (old, type)``.
    """
    picked = []
    for new, old in mapping.items():
        name, kind = old if isinstance(old, tuple) else (old, None)
        picked.append((col(name).try_cast(kind) if kind else col(name)).alias(new))
    kept = [col(c) for c in ("_source", "_dataset_id") if c in df.columns and c not in mapping]
    return df.select(*picked, *kept)


def write_stage(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_catalog(ranked: DataFrame, path: str) -> None:
    """One JSON object per line."""
    ranked.write.mode("overwrite").json(path)


def read_catalog(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """JSON lines, or with ``multi_line`` files that hold one JSON array."""
    return spark.read.schema(RANKED_CATALOG).option("multiLine", multi_line).json(path)


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def _matches(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.globStatus(path)
    return sorted(s.getPath().toString() for s in found) if found else []


def resolve_input(spark: SparkSession, base: str, stage: str, explicit: str | None = None) -> str:
    """The explicit path, else the first existing input of the stage under ``base``."""
    if explicit:
        return explicit
    for pattern in STAGE_INPUTS[stage]:
        found = _matches(spark, f"{base.rstrip('/')}/{pattern}")
        if found:
            return found[0]
    raise FileNotFoundError(f"no input for {stage} under {base}")


def class_count(df: DataFrame, label_col: str | None = None) -> int:
    """Number of distinct normalised labels; 0 if there is no label column."""
    try:
        name = label_col or find_label_col(df)
        labels = nan_to_null(df.select(col(name))).select(norm_label(col(name)).alias("label"))
    except Exception:
        return 0
    return labels.where("label is not null").distinct().count()


def first_multiclass(
    tables: Mapping[str, DataFrame], label_col: str | None = None
) -> tuple[str, DataFrame]:
    """The first table, in the order given, with at least two classes."""
    for name, df in tables.items():
        if class_count(df, label_col) >= 2:
            return name, df
    raise ValueError("no table with two classes")
