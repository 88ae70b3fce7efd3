"""Quality detection and profiling tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnowry.jobs import side_by_side
from winnowry.operators.quantiles import exact_quantiles
from winnowry.schema import (
    PROVENANCE, col, is_float, is_missing, numeric_columns, string_columns, stringify,
)
from winnowry.staging import stage

# --- fixed values -------------------------------------------------------------
IQR_FACTOR = 1.5
SIGMA_FACTOR = 3
MIN_VALUES = 4
STRING_CLASSES = 20
NUMERIC_CLASSES = 10
HISTOGRAM_BINS = 20
# ------------------------------------------------------------------------------

COLUMNS_PER_PASS = 200
# approx_count_distinct only has to tell "a handful" from "many": columns under
# this estimate are counted exactly.
FEW_ESTIMATE = 60


def pct(part: Column, whole: Column | int, digits: int = 2) -> Column:
    return F.round(part / whole * 100, digits)


# --- missing values -----------------------------------------------------------

def missing_counts(df: DataFrame) -> tuple[int, dict[str, int]]:
    """Number of rows and missing cells per column, in one pass per 200 columns."""
    rows, counts = 0, {}
    for start in range(0, len(df.columns), COLUMNS_PER_PASS):
        part = df.columns[start:start + COLUMNS_PER_PASS]
        row = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(part)],
        ).first()
        rows = row["rows"]
        counts.update({c: row[f"m{i}"] for i, c in enumerate(part)})
    return rows, counts


def missing_profile(df: DataFrame) -> DataFrame:
    """``(column, count, pct)`` of the columns with missing cells."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("count"))
        for i, c in enumerate(df.columns)
    ]))
    one_row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)],
    )
    return (
        one_row.select("rows", cells.alias("cell")).where("cell.count > 0")
        .select("cell.column", "cell.count", pct(F.col("cell.count"), F.col("rows")).alias("pct"))
    )


def missing_sorted(df: DataFrame) -> DataFrame:
    return missing_profile(df).orderBy(F.desc("count"), "column")


# --- duplicates ---------------------------------------------------------------

def hashable(value: Column, kind: T.DataType) -> Column:
    """The value with every map in it as its sorted entries: maps cannot be hashed or compared."""
    if isinstance(kind, T.MapType):
        entries = F.transform(
            F.map_entries(value), lambda e: F.struct(e["key"], hashable(e["value"], kind.valueType).alias("value"))
        )
        return F.array_sort(entries)
    if isinstance(kind, T.ArrayType) and "map<" in kind.simpleString():
        return F.transform(value, lambda x: hashable(x, kind.elementType))
    if isinstance(kind, T.StructType) and "map<" in kind.simpleString():
        parts = [hashable(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    return value


def row_fingerprint(df: DataFrame, subset: Sequence[str] | None = None) -> list[Column]:
    """Two 64-bit hashes of the row: shuffling them is far cheaper than whole rows.

    Hashes skip NULLs, so the pattern of missing cells is hashed along; floats
    are normalised so that ``-0.0`` equals ``0.0`` and NaN equals NULL.
    """
    names = list(subset or df.columns)
    parts, gaps = [], []
    for c in names:
        value = hashable(col(c), df.schema[c].dataType)
        if is_float(df.schema[c]):
            value = F.when(~F.isnan(value), value + F.lit(0.0).cast(df.schema[c].dataType))
        parts.append(value)
        gaps.append(F.when(is_missing(df, c), F.lit("1")).otherwise(F.lit("0")))
    pattern = F.concat(*gaps)
    return [
        F.xxhash64(F.lit(17), pattern, *parts).alias("h1"),
        F.xxhash64(F.lit(71), *reversed(parts), pattern).alias("h2"),
    ]


def duplicate_count(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows equal to an earlier row; copies are combined before the shuffle."""
    groups = df.select(row_fingerprint(df, subset)).groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n")
    )
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


# --- outliers -----------------------------------------------------------------

def iqr_bounds(q1: float, q3: float) -> tuple[float, float]:
    return q1 - IQR_FACTOR * (q3 - q1), q3 + IQR_FACTOR * (q3 - q1)


def outlier_bounds(
    df: DataFrame, method: str = "iqr", columns: Sequence[str] | None = None
) -> dict[str, tuple[float, float]]:
    """Lower and upper bound per numeric column with at least four values."""
    names = list(columns if columns is not None else numeric_columns(df))
    if not names:
        return {}
    bounds = {}
    if method == "iqr":
        for name, (n, quartiles) in exact_quantiles(df, names, [0.25, 0.75]).items():
            if n >= MIN_VALUES:
                bounds[name] = iqr_bounds(*quartiles)
    elif method == "zscore":
        for start in range(0, len(names), COLUMNS_PER_PASS):
            part = names[start:start + COLUMNS_PER_PASS]
            present = [F.when(~is_missing(df, c), col(c)).cast("double") for c in part]
            row = df.agg(*[
                e for i, v in enumerate(present)
                for e in (F.count(v).alias(f"n{i}"), F.avg(v).alias(f"a{i}"),
                          F.stddev_samp(v).alias(f"s{i}"))
            ]).first()
            for i, name in enumerate(part):
                if row[f"n{i}"] >= MIN_VALUES:
                    reach = SIGMA_FACTOR * row[f"s{i}"]
                    bounds[name] = (row[f"a{i}"] - reach, row[f"a{i}"] + reach)
    else:
        raise ValueError(f"unknown outlier method: {method}")
    return bounds


def outside(df: DataFrame, name: str, bounds: tuple[float, float]) -> Column:
    low, high = bounds
    return ~is_missing(df, name) & ((col(name) < low) | (col(name) > high))


def outlier_profile(
    df: DataFrame, method: str = "iqr", exclude: Iterable[str] = ()
) -> DataFrame:
    """``(column, count, pct, lower_bound, upper_bound)`` of columns with outliers."""
    bounds = outlier_bounds(df, method, numeric_columns(df, exclude))
    schema = "column string, count bigint, pct double, lower_bound double, upper_bound double"
    if not bounds:
        return df.sparkSession.createDataFrame([], schema)
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(outside(df, c, b)).alias(f"o{i}") for i, (c, b) in enumerate(bounds.items())],
    )
    cells = F.explode(F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.col(f"o{i}").alias("count"),
            F.lit(low).alias("low"), F.lit(high).alias("high"),
        )
        for i, (c, (low, high)) in enumerate(bounds.items())
    ]))
    return (
        counted.select("rows", cells.alias("o")).where("o.count > 0")
        .select(
            "o.column", "o.count", pct(F.col("o.count"), F.col("rows")).alias("pct"),
            F.round("o.low", 4).alias("lower_bound"), F.round("o.high", 4).alias("upper_bound"),
        )
    )


def zero_iqr_columns(df: DataFrame) -> list[str]:
    """Columns whose IQR bounds collapse to one value: cleaning would flatten them."""
    return [c for c, (low, high) in outlier_bounds(df, "iqr").items() if low == high]


# --- class balance ------------------------------------------------------------

def few_distinct(df: DataFrame, columns: Sequence[str], at_most: int) -> dict[str, int]:
    """Exact distinct counts of the columns that have at most ``at_most`` values.

    A sketch rules out the wide columns first, so no column of long texts or
    unique keys is ever shuffled just to learn that it is not a class column.
    """
    names = [c for c in columns if isinstance(df.schema[c].dataType, T.AtomicType)]
    if not names:
        return {}
    present = {c: F.when(~is_missing(df, c), col(c)) for c in names}
    sketch = df.agg(*[
        F.approx_count_distinct(present[c], 0.02).alias(f"d{i}") for i, c in enumerate(names)
    ]).first()
    limit = max(FEW_ESTIMATE, 3 * at_most)
    narrow = [c for i, c in enumerate(names) if sketch[f"d{i}"] <= limit]
    if not narrow:
        return {}
    # the sketch has shown that these columns have few values: their sets are small
    exact = df.agg(*[
        F.size(F.collect_set(present[c])).alias(f"d{i}") for i, c in enumerate(narrow)
    ]).first()
    return {c: exact[f"d{i}"] for i, c in enumerate(narrow) if exact[f"d{i}"] <= at_most}


def _first_with_classes(df: DataFrame, kinds: Sequence[Sequence[str]], shown: dict[str, str]) -> str | None:
    """First string column with 2 to 20 values, else first numeric one with 2 to 10, in two passes over all."""
    counts = few_distinct(df, [c for columns in kinds for c in columns], STRING_CLASSES)
    for columns, at_most in zip(kinds, (STRING_CLASSES, NUMERIC_CLASSES)):
        for c in columns:
            if 2 <= counts.get(c, 0) <= at_most:
                return shown[c]
    return None


def imbalance_column(df: DataFrame) -> str | None:
    """First string column with 2 to 20 values, else first numeric one with 2 to 10."""
    return _first_with_classes(df, (string_columns(df), numeric_columns(df)), {c: c for c in df.columns})


def class_counts(df: DataFrame, label_col: str) -> DataFrame:
    present = df.where(~is_missing(df, label_col))
    return present.groupBy(col(label_col).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("count")
    )


def imbalance(df: DataFrame, label_col: str | None = None) -> DataFrame:
    """``(col, classes, ratio)``: size of the largest over the smallest class."""
    name = label_col or imbalance_column(df)
    if name is None:
        return df.sparkSession.createDataFrame([], "col string, classes bigint, ratio double")
    return class_counts(df, name).agg(
        F.count(F.lit(1)).alias("classes"),
        F.round(F.max("count") / F.min("count"), 2).alias("ratio"),
    ).select(F.lit(name).alias("col"), "classes", "ratio").where("classes > 0")


# --- report -------------------------------------------------------------------

def _report_parts(df: DataFrame, label_col: str | None):
    """Rows and gaps per column, copies, outliers and the class column, from one reading of the frame.

    Written down per row: its fingerprint, which cells are missing, its numbers, and
    a hash of each text. Everything is measured on that narrow table, side by side.
    """
    numbers, texts = numeric_columns(df), string_columns(df)
    gaps = F.concat(*[F.when(is_missing(df, c), F.lit("1")).otherwise(F.lit("0")) for c in df.columns])
    table = stage(df.select(
        *[h.alias(f"print{i}") for i, h in enumerate(row_fingerprint(df))], gaps.alias("gaps"),
        *[F.when(~is_missing(df, c), col(c)).alias(f"n{i}") for i, c in enumerate(numbers)],
        *[F.when(col(c).isNotNull(), F.xxhash64(col(c))).alias(f"t{i}") for i, c in enumerate(texts)],
    ), "measured")
    narrow = {c: f"n{i}" for i, c in enumerate(numbers)} | {c: f"t{i}" for i, c in enumerate(texts)}

    def gap_counts() -> tuple[int, dict[str, int]]:
        row = table.agg(F.count(F.lit(1)), *[
            F.count_if(F.substring("gaps", i + 1, 1) == "1") for i in range(len(df.columns))
        ]).first()
        return row[0], dict(zip(df.columns, row[1:]))

    def copies() -> int:
        groups = table.groupBy("print0", "print1").agg(F.count(F.lit(1)).alias("n"))
        return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint")).first()[0]

    def outliers() -> list[dict]:
        shown = {short: name for name, short in narrow.items()}
        own = table.select([F.col(narrow[c]) for c in numbers])
        return [r.asDict() | {"column": shown[r["column"]]} for r in outlier_profile(own).collect()]

    def class_column() -> str | None:
        return label_col or _first_with_classes(table, ([narrow[c] for c in texts], [narrow[c] for c in numbers]), {
            short: name for name, short in narrow.items()
        })

    return side_by_side(df.sparkSession, [gap_counts, copies, outliers, class_column])


def quality_report(df: DataFrame, label_col: str | None = None) -> DataFrame:
    """All four detections as one long table ``(section, column, metric, value)``."""
    spark = df.sparkSession
    (rows, counts), copies, outliers, name = _report_parts(df, label_col)
    missing = {c: n for c, n in counts.items() if n}
    report = [("duplicates", "", "duplicates", copies)]
    for c, n in missing.items():
        report.append(("missing", c, "count", n))
    for o in outliers:
        report += [("outliers", o["column"], m, o[m]) for m in ("count", "pct", "lower_bound", "upper_bound")]
    report += [
        ("summary", "", "missing_cells", sum(missing.values())),
        ("summary", "", "missing_cols", len(missing)),
        ("summary", "", "outlier_cells", sum(o["count"] for o in outliers)),
        ("summary", "", "outlier_cols", len(outliers)),
    ]
    table = spark.createDataFrame(
        [(s, c, m, float(v)) for s, c, m, v in report],
        "section string, column string, metric string, value double",
    )
    shares = table.where("section = 'missing'").select(
        "section", "column", F.lit("pct").alias("metric"), pct(F.col("value"), rows).alias("value")
    )
    table = table.unionByName(shares)
    if name is not None:
        # one row per class: written once, read for the counts and for the ratio
        classes = stage(class_counts(df, name), "classes")
        lines = classes.select(
            F.concat(F.lit("class "), F.col("value")).alias("metric"),
            F.col("count").cast("double").alias("value"),
        )
        ratio = classes.agg(
            F.lit("ratio").alias("metric"), F.round(F.max("count") / F.min("count"), 2).alias("value")
        ).where("value is not null")
        table = table.unionByName(lines.unionByName(ratio).select(
            F.lit("imbalance").alias("section"), F.lit(name).alias("column"), "metric", "value"
        ))
    return table


# --- distributions ------------------------------------------------------------

def box_stats(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Five-number summary of the numeric columns, or of the first ``limit``."""
    names = numeric_columns(df)[:limit]
    spread = exact_quantiles(df, names, [0.0, 0.25, 0.5, 0.75, 1.0])
    rows = [(c, n, *(q or [None] * 5)) for c, (n, q) in spread.items()]
    return df.sparkSession.createDataFrame(
        rows, "column string, n bigint, min double, q1 double, median double, q3 double, max double"
    )


def histogram(df: DataFrame, name: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins between minimum and maximum, ``(bin, low, high, count)``.

    A column with a single value gets the range half a unit around it. A value on
    an edge belongs to the bin that begins there: the quotient that tells the bin
    is rounded, so it is set right against the edges, as numpy does.
    """
    present = df.where(~is_missing(df, name)).select(col(name).cast("double").alias("x"))
    ends = present.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    low, high = ends["lo"], ends["hi"]
    if low is None:
        return df.sparkSession.createDataFrame([], "bin bigint, low double, high double, count bigint")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.floor((F.col("x") - low) / (high - low) * bins)
    at = F.least(place, F.lit(bins - 1).cast("bigint"))
    edge = lambda k: F.lit(low) + k * F.lit(width)
    number = (
        F.when((at > 0) & (F.col("x") < edge(at)), at)
        .when((at < bins - 1) & (F.col("x") >= edge(at + 1)), at + 2)
        .otherwise(at + 1)
    )
    return present.groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("count")).select(
        "bin",
        F.round(F.lit(low) + (F.col("bin") - 1) * F.lit(width), 4).alias("low"),
        F.round(F.lit(low) + F.col("bin") * F.lit(width), 4).alias("high"),
        "count",
    )


def eda_profile(df: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """Class sizes and text lengths per class: ``(label, rows, share, length stats)``."""
    by_class = df.groupBy(col(label_col).cast("string").alias("label")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg(F.length(col(text_col))), 4).alias("mean_chars"),
        F.min(F.length(col(text_col))).cast("bigint").alias("min_chars"),
        F.max(F.length(col(text_col))).cast("bigint").alias("max_chars"),
    )
    return by_class.withColumn("share", F.round(F.col("rows") / F.lit(df.count()) * 100, 2))


def schema_profile(df: DataFrame, file: str = "") -> DataFrame:
    """Column, type, row count and one sample value as text."""
    rows = df.count()
    first = stringify(df.limit(1)).first()
    return df.sparkSession.createDataFrame(
        [(file, c, t, rows, first[i] if first else "") for i, (c, t) in enumerate(df.dtypes)],
        T.StructType([
            T.StructField("file", T.StringType()), T.StructField("column", T.StringType()),
            T.StructField("dtype", T.StringType()), T.StructField("rows", T.LongType()),
            T.StructField("sample", T.StringType()),
        ]),
    )


def source_counts(df: DataFrame, source_col: str = PROVENANCE[0]) -> DataFrame:
    return df.groupBy(col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("rows"))
