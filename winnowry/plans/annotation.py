"""Clean table to labeled table, its quality and its export."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from winnowry.operators.annotate import (
    BATCH_SIZE, CONSISTENCY_PASSES, auto_label, check_quality,
    consistency, to_labelstudio, write_labelstudio,
)
from winnowry.operators.columns import find_text_col, infer_classes
from winnowry.operators.ranking import sample_n
from winnowry.sources.files import LABELED, resolve_input, scan, write_stage
from winnowry.staging import settle, staged_so_far

TASKS = "data/labeled/labelstudio_import.jsonl"


def annotate(
    spark: SparkSession, base: str, key: str, labeler: Callable[[str], str], task: str = "",
    classes: Sequence[str] | None = None, rows: int | None = None, batch_size: int = BATCH_SIZE,
    passes: int = CONSISTENCY_PASSES, consistency_rows: int | None = None,
    human: DataFrame | None = None, human_col: str = "label", path: str | None = None,
) -> DataFrame:
    """Label, write the labeled stage and the export, return the quality metrics."""
    since = staged_so_far()
    df = scan(spark, resolve_input(spark, base, "annotation", path))
    if rows:
        df = sample_n(df, rows, key)
    text = find_text_col(df)
    if classes is None:
        classes = [r["class"] for r in infer_classes(df, text).collect()]
    out = f"{base.rstrip('/')}/{LABELED}"
    write_stage(
        auto_label(df, key, labeler, task=task, classes=classes, text_col=text, batch_size=batch_size),
        out,
    )
    labeled = scan(spark, out)
    write_labelstudio(to_labelstudio(labeled, key, text), f"{base.rstrip('/')}/{TASKS}")
    if human is not None:
        return settle(check_quality(labeled, human, key_col=key, human_col=human_col), since)
    runs = consistency(
        labeled, key, labeler, text, n=consistency_rows, passes=passes, task=task,
        classes=classes, batch_size=batch_size,
    )
    return settle(check_quality(labeled, consistency=runs), since)
