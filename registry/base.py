"""Tables, shared fixtures and SQL fragments of the registered queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


class Book:
    """Collects queries of one area with their oracle SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            key = name or fn.__name__
            self.queries[key] = fn
            if sql is not None:
                self.sql[key] = sql
            return fn
        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels, where there are any; ``doc_id`` is the key."""
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return documents.join(labels, "doc_id", "left").select(
        "doc_id", "text", "lang", F.col("source").alias("_source"), "n_chars", "quality", "toxic"
    )


DOCS = """
docs AS (
  SELECT d.doc_id, d.text, d.lang, d.source AS _source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""

DOC_COLUMNS = ("text", "lang", "_source", "n_chars", "quality", "toxic")
DOC_NUMBERS = ("n_chars", "quality", "toxic")


def gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with more holes: short texts, short documents' languages, long lengths."""
    n = F.col("n_chars")
    return docs(spark, sf_dir).withColumns({
        "text": F.when(n >= 200, F.col("text")),
        "lang": F.when(n >= 500, F.col("lang")),
        "n_chars": F.when(n <= 3000, n),
    })


GAPPY = DOCS + """,
gappy AS (
  SELECT doc_id, CASE WHEN n_chars >= 200 THEN text END AS text,
         CASE WHEN n_chars >= 500 THEN lang END AS lang, _source,
         CASE WHEN n_chars <= 3000 THEN n_chars END AS n_chars, quality, toxic
  FROM docs
)"""


def auto_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as an automatic annotator would leave them."""
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return labels.join(documents, "doc_id").select(
        "doc_id", "text", F.col("toxic").cast("double").cast("string").alias("_label"),
        ((F.col("doc_id") % 101) / 100.0).alias("_confidence"),
        F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("_reason"),
    )


AUTO = """
auto AS (
  SELECT l.doc_id, d.text, CAST(CAST(l.toxic AS DOUBLE) AS VARCHAR) AS _label,
         (l.doc_id % 101) / 100.0::DOUBLE AS _confidence, 'quality ' || l.quality AS _reason
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
)"""


def passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three labeling passes over the labeled documents, one spelled differently."""
    labels = table(spark, sf_dir, "labels")
    given = F.explode(F.array(
        F.struct(F.lit(1).alias("pass"), F.col("toxic").cast("string").alias("label")),
        F.struct(F.lit(2).alias("pass"), F.concat(F.lit(" "), F.col("quality").cast("string"),
                                                  F.lit(".0")).alias("label")),
        F.struct(F.lit(3).alias("pass"),
                 (F.col("toxic") * F.col("quality")).cast("string").alias("label")),
    ))
    return labels.select(F.col("doc_id").alias("key"), given.alias("g")).select("key", "g.*")


PASSES = """
passes AS (
  SELECT doc_id AS key, 1 AS pass, CAST(toxic AS VARCHAR) AS label FROM labels
  UNION ALL SELECT doc_id, 2, CAST(quality AS VARCHAR) FROM labels
  UNION ALL SELECT doc_id, 3, CAST(toxic * quality AS VARCHAR) FROM labels
),
pairs AS (
  SELECT a.key, a.pass AS pass_a, b.pass AS pass_b, a.label AS label_a, b.label AS label_b
  FROM passes a JOIN passes b ON a.key = b.key AND a.pass < b.pass
)"""


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learning curves read off the event log: type as strategy, hour as iteration."""
    events = table(spark, sf_dir, "events")
    strategy = F.when(F.col("event_type") == "click", "random").otherwise(F.col("event_type"))
    hour = F.hour("ts")
    return events.groupBy(strategy.alias("strategy"), hour.alias("iteration")).agg(
        (F.lit(100) * (hour + 1)).cast("bigint").alias("n_labeled"),
        F.round(F.avg("value") / 100, 4).alias("accuracy"),
        F.round(F.avg(F.least("value", F.lit(60.0))) / 100, 4).alias("f1"),
    )


HISTORY = """
history AS (
  SELECT CASE WHEN event_type = 'click' THEN 'random' ELSE event_type END AS strategy,
         hour(ts) AS iteration, 100 * (hour(ts) + 1) AS n_labeled,
         round(avg(value) / 100, 4) AS accuracy, round(avg(least(value, 60.0)) / 100, 4) AS f1
  FROM events GROUP BY 1, 2, 3
)"""


def proba(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class probabilities from the squares of three embedding components."""
    square = lambda i: F.pow(F.col("embedding")[i].cast("double"), F.lit(2.0))
    total = square(0) + square(1) + square(2)
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.array(*[square(i) / total for i in range(3)]).alias("proba")
    )


PROBA = """
sq AS (
  SELECT vec_id, pow(embedding[1]::DOUBLE, 2) AS a, pow(embedding[2]::DOUBLE, 2) AS b,
         pow(embedding[3]::DOUBLE, 2) AS c FROM embeddings
),
proba AS (SELECT vec_id, a / (a + b + c) AS p1, b / (a + b + c) AS p2, c / (a + b + c) AS p3 FROM sq)"""


# --- SQL fragments --------------------------------------------------------------

def iqr_bounds_sql(source: str, column: str) -> str:
    return f"""(SELECT count(x) AS n, quantile_cont(x, 0.25) - 1.5 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) AS lo,
        quantile_cont(x, 0.75) + 1.5 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) AS hi
        FROM (SELECT CAST({column} AS DOUBLE) AS x FROM {source}))"""


def zscore_bounds_sql(source: str, column: str) -> str:
    return f"""(SELECT count(x) AS n, avg(x) - 3 * stddev_samp(x) AS lo, avg(x) + 3 * stddev_samp(x) AS hi
        FROM (SELECT CAST({column} AS DOUBLE) AS x FROM {source}))"""


def outliers_sql(source: str, columns: Sequence[str], bounds=iqr_bounds_sql) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE t.{c} < lo OR t.{c} > hi) AS "count",
        round(count(*) FILTER (WHERE t.{c} < lo OR t.{c} > hi) / count(*) * 100, 2) AS pct,
        round(lo, 4) AS lower_bound, round(hi, 4) AS upper_bound
        FROM {source} t, {bounds(source, c)} b WHERE n >= 4 GROUP BY lo, hi"""
        for c in columns
    ]
    return f'SELECT * FROM ({" UNION ALL ".join(parts)}) WHERE "count" > 0'


def missing_sql(source: str, columns: Sequence[str]) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS "count",
        round(count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100, 2) AS pct FROM {source}"""
        for c in columns
    ]
    return f'SELECT * FROM ({" UNION ALL ".join(parts)}) WHERE "count" > 0'


def duplicates_sql(source: str, columns: Sequence[str]) -> str:
    names = ", ".join(columns)
    return (
        f"SELECT CAST((SELECT count(*) FROM {source}) - "
        f"(SELECT count(*) FROM (SELECT DISTINCT {names} FROM {source})) AS BIGINT) AS duplicates"
    )


def totals_sql(source: str, columns: Sequence[str], numbers: Sequence[str]) -> dict[str, str]:
    """Scalar sub-queries of the four Before/After metrics."""
    missing = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in columns)
    outliers = " + ".join(
        f"(SELECT count(*) FILTER (WHERE n >= 4 AND (t.{c} < lo OR t.{c} > hi)) "
        f"FROM {source} t, {iqr_bounds_sql(source, c)} b)"
        for c in numbers
    )
    return {
        "Rows": f"(SELECT count(*) FROM {source})",
        "Missing values": f"(SELECT {missing} FROM {source})",
        "Duplicates": f"({duplicates_sql(source, columns)})",
        "Outliers (IQR)": f"({outliers})",
    }


def compare_sql(before: str, after: str, columns: Sequence[str], numbers: Sequence[str]) -> str:
    old, new = totals_sql(before, columns, numbers), totals_sql(after, columns, numbers)
    rows = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST({old[m]} AS BIGINT) AS before, CAST({new[m]} AS BIGINT) AS after"
        for m in old
    )
    return f"""SELECT metric, before, after, after - before AS delta,
      CASE WHEN before = 0 THEN 'n/a' ELSE printf('%+.1f%%', (after - before) / before * 100) END AS change
      FROM ({rows})"""
