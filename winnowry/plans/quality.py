"""Raw table to clean table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from winnowry.operators.clean import DEFAULT_STRATEGIES, FILE_POSITION, fix
from winnowry.operators.compare import compare, compare_strategies
from winnowry.operators.profile import quality_report
from winnowry.sources.files import CLEAN, resolve_input, scan, write_stage
from winnowry.staging import settle, staged_so_far


def report(
    spark: SparkSession, base: str, label_col: str | None = None, path: str | None = None
) -> DataFrame:
    since = staged_so_far()
    return settle(quality_report(scan(spark, resolve_input(spark, base, "quality", path)), label_col), since)


def proposals(
    spark: SparkSession, base: str, label_col: str | None = None,
    order_col: Sequence[str] | str | None = None, key: Iterable[str] = (),
    strategies: Mapping[str, Mapping[str, str]] = DEFAULT_STRATEGIES, path: str | None = None,
) -> DataFrame:
    """Before/After table of every strategy, to choose from."""
    df = scan(spark, resolve_input(spark, base, "quality", path))
    protected = [label_col] if label_col else []
    since = staged_so_far()
    return settle(compare_strategies(df, strategies, protected, order_col, key), since)


def clean(
    spark: SparkSession, base: str, strategy: str | Mapping[str, str] = "medium",
    label_col: str | None = None, order_col: Sequence[str] | str | None = None,
    dedup_key: str | None = None, protected_cols: Iterable[str] = (), path: str | None = None,
) -> DataFrame:
    """Apply a strategy, write the clean stage, return its Before/After table."""
    given = resolve_input(spark, base, "quality", path)
    df = scan(spark, given)
    # rows of Parquet files are told apart by where they lie: nothing but fingerprints is written for copies
    position = FILE_POSITION if dedup_key is None and given.endswith(".parquet") else None
    chosen = DEFAULT_STRATEGIES[strategy] if isinstance(strategy, str) else strategy
    protected = list(protected_cols) + ([label_col] if label_col else [])
    out, since = f"{base.rstrip('/')}/{CLEAN}", staged_so_far()
    write_stage(fix(df, chosen, protected, order_col, dedup_key, position), out)
    return settle(compare(df, scan(spark, out), key=[dedup_key] if dedup_key else []), since)
