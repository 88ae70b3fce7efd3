"""Landed catalog pages to a ranked catalog; dataset files to the combined raw table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from winnowry.operators.catalog import dedup_catalog, filter_relevant, rank
from winnowry.operators.profile import source_counts
from winnowry.sources.files import (
    RAW, merge, scan, scan_any, tag, unify, write_stage,
)


def ranked_catalog(catalogs: Sequence[DataFrame], scores: DataFrame, min_score: float = 4) -> DataFrame:
    """Merge catalogs, add scores ``(id, relevance_score, …)``, dedupe, filter, rank."""
    scored = merge(catalogs).join(scores, "id", "left")
    return rank(filter_relevant(dedup_catalog(scored), min_score))


def combine(
    spark: SparkSession, base: str,
    datasets: Sequence[tuple[str, str, Sequence[str], Mapping[str, str]]], **how,
) -> DataFrame:
    """Write the combined raw table from ``(source, id, files, column mapping)``; ``how`` goes to ``scan_any``.

    Returns the rows per source.
    """
    parts = [
        unify(tag(scan_any(spark, files, **how), source, dataset_id), mapping)
        for source, dataset_id, files, mapping in datasets
    ]
    out = f"{base.rstrip('/')}/{RAW}"
    write_stage(merge(parts), out)
    return source_counts(scan(spark, out))
