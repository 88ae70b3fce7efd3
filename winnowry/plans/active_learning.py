"""Labeled table to learning curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from winnowry.operators.columns import find_label_col, find_text_col
from winnowry.operators.learn import BASELINE, compare_al_strategies, learning_curve, savings, stratified_split
from winnowry.sources.files import STAGE_INPUTS, _matches, first_multiclass, scan
from winnowry.staging import drop_staged, stage, staged_so_far


def experiment(
    spark: SparkSession, base: str, key: str, n_start: int = 50,
    strategies: Sequence[str] = ("entropy", "random"), label_col: str | None = None,
    test_size: float = 0.2, path: str | None = None, **cycle,
) -> dict[str, DataFrame]:
    """``history`` of every strategy on the first stage table with two classes, its ``savings`` and ``curve``."""
    candidates = [path] if path else [f"{base.rstrip('/')}/{p}" for p in STAGE_INPUTS["active_learning"]]
    tables = {p: scan(spark, p) for p in candidates if _matches(spark, p)}
    _, df = first_multiclass(tables, label_col)
    label = label_col or find_label_col(df)
    text = find_text_col(df, how="median")
    since = staged_so_far()
    parts = stage(
        stratified_split(df.select(key, text, label), label, key, n_start, test_size), "split"
    )
    part = {s: parts.where(parts["split"] == s).drop("split") for s in ("labeled", "pool", "test")}
    history = stage(compare_al_strategies(
        part["labeled"], part["pool"], part["test"], strategies, key=key, label_col=label,
        text_col=text, **cycle,
    ), "history")
    drop_staged(spark, since, keep=[history])
    return {"history": history, "savings": savings(history, BASELINE), "curve": learning_curve(history)}
