"""Independent Spark jobs side by side, as cross-validation runs its folds."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

AT_ONCE = 4


def side_by_side(spark: SparkSession, jobs: Sequence[Callable[[], object]]) -> list:
    """Results of the jobs in order; the scheduler fills idle cores with the next job."""
    if len(jobs) < 2:
        return [job() for job in jobs]
    with ThreadPool(min(AT_ONCE, len(jobs))) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda job: job()), jobs)
