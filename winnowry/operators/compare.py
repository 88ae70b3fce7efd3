"""Before/After tables of a cleaning run."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry import jobs
from winnowry.functions.text import pct_change
from winnowry.operators.clean import DEFAULT_STRATEGIES, dedup, fix
from winnowry.operators.profile import MIN_VALUES, iqr_bounds, row_fingerprint
from winnowry.operators.quantiles import quantiles_by_part
from winnowry.schema import col, is_missing, numeric_columns, user_cols
from winnowry.staging import stage

# --- fixed values -------------------------------------------------------------
METRICS = ("Rows", "Missing values", "Duplicates", "Outliers (IQR)")
# ------------------------------------------------------------------------------


def totals_of(frames: Sequence[DataFrame], key: Iterable[str] = ()) -> list[dict[str, int]]:
    """The four metrics of each frame; key columns take no part.

    Every frame is read once: fingerprint, number of missing cells and the numeric
    columns of its rows are written to one narrow table, marked with the frame's
    number, and all frames are measured together on that table. Equal rows have
    equally many missing cells, so a group counts for all of its copies.
    """
    key = list(key)
    bodies = [df.select([col(c) for c in user_cols(df, key)]) for df in frames]
    numbers = list(dict.fromkeys(c for df in bodies for c in numeric_columns(df)))

    def narrow(part: int, df: DataFrame) -> DataFrame:
        holes = sum((F.when(is_missing(df, c), 1).otherwise(0) for c in df.columns), F.lit(0))
        own = set(numeric_columns(df))
        values = [F.when(~is_missing(df, c), col(c)) if c in own else F.lit(None) for c in numbers]
        return df.select(
            F.lit(part).alias("part"), *[h.alias(f"print{i}") for i, h in enumerate(row_fingerprint(df))],
            holes.cast("bigint").alias("holes"), *[v.cast("double").alias(f"n{i}") for i, v in enumerate(values)],
        )

    table = stage(reduce(DataFrame.unionByName, [narrow(i, df) for i, df in enumerate(bodies)]), "measured")
    names = [f"n{i}" for i in range(len(numbers))]

    def rows_and_copies() -> dict[int, tuple]:
        groups = table.groupBy("part", "print0", "print1").agg(F.count(F.lit(1)).alias("n"), F.max("holes").alias("holes"))
        whole = groups.groupBy("part").agg(F.sum("n"), F.sum(F.col("n") * F.col("holes")), F.sum(F.col("n") - 1))
        return {r[0]: tuple(r[1:]) for r in whole.collect()}

    def outliers() -> dict[int, int]:
        found = quantiles_by_part(table, names, [0.25, 0.75], "part")
        tests = [
            (F.col("part") == part) & ((F.col(c) < low) | (F.col(c) > high))
            for (part, c), (n, quartiles) in found.items() if n >= MIN_VALUES
            for low, high in [iqr_bounds(*quartiles)]
        ]
        if not tests:
            return {}
        cells = sum((F.when(test, 1).otherwise(0) for test in tests), F.lit(0))
        return dict(map(tuple, table.groupBy("part").agg(F.sum(cells)).collect()))

    whole, beyond = jobs.side_by_side(table.sparkSession, [rows_and_copies, outliers])
    return [dict(zip(METRICS, (*whole.get(i, (0, 0, 0)), beyond.get(i, 0)))) for i in range(len(bodies))]


def quality_totals(df: DataFrame, key: Iterable[str] = ()) -> dict[str, int]:
    """The four metrics of one frame."""
    return totals_of([df], key)[0]


def compare_totals(spark, before: Mapping[str, int], after: Mapping[str, int]) -> DataFrame:
    table = spark.createDataFrame(
        [(m, before[m], after[m]) for m in METRICS], "metric string, before bigint, after bigint"
    )
    return table.select(
        "metric", "before", "after", (F.col("after") - F.col("before")).alias("delta"),
        pct_change(F.col("before"), F.col("after")).alias("change"),
    )


def compare(
    before: DataFrame, after: DataFrame, label: str = "", key: Iterable[str] = ()
) -> DataFrame:
    """``(metric, before, after, delta, change)``; ``label`` prefixes the value columns."""
    table = compare_totals(before.sparkSession, *totals_of([before, after], key))
    if not label:
        return table
    return table.select("metric", *[
        F.col(c).alias(f"{label}/{c}") for c in table.columns if c != "metric"
    ])


def compare_strategies(
    df: DataFrame, strategies: Mapping[str, Mapping[str, str]] = DEFAULT_STRATEGIES,
    protected_cols: Iterable[str] | None = None, order_col: Sequence[str] | str | None = None,
    key: Iterable[str] = (),
) -> DataFrame:
    """One Before/After table per strategy; all frames are measured together.

    Strategies that drop copies alike start from the same rows, written once.
    """
    key = list(key)
    body = df.select([col(c) for c in user_cols(df, key)])
    spark = df.sparkSession

    def copies(strategy: Mapping[str, str]) -> str:
        return "none" if strategy.get("missing") == "ffill" else strategy.get("duplicates", "none")

    how = [h for h in dict.fromkeys(map(copies, strategies.values())) if h != "none"]
    unique = dict(zip(how, jobs.side_by_side(spark, [
        lambda h=h: dedup(body, h) for h in how
    ])))

    def after(strategy: Mapping[str, str]) -> DataFrame:
        if strategy.get("missing") == "ffill":
            return fix(df, strategy, protected_cols, order_col)
        return fix(unique.get(copies(strategy), body), {**strategy, "duplicates": "none"}, protected_cols, order_col)

    fixed = jobs.side_by_side(spark, [lambda s=s: after(s) for s in strategies.values()])
    first, *others = totals_of([df, *fixed], key)
    return reduce(DataFrame.unionByName, [
        compare_totals(df.sparkSession, first, totals).withColumn("strategy", F.lit(name))
        for name, totals in zip(strategies, others)
    ])


def side_by_side(first: DataFrame, second: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Two Before/After tables joined by metric, columns prefixed by strategy."""
    def prefixed(table: DataFrame, label: str) -> DataFrame:
        return table.select("metric", *[
            F.col(c).alias(f"{label}/{c}") for c in table.columns if c != "metric"
        ])

    return prefixed(first, labels[0]).join(prefixed(second, labels[1]), "metric", "full")
