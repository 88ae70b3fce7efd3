"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import (
    DOC_COLUMNS, DOC_NUMBERS, DOCS, Book, docs, duplicates_sql, missing_sql, outliers_sql, table,
    zscore_bounds_sql,
)
from winnowry.operators import profile as p
from winnowry.operators.quantiles import exact_quantiles
from winnowry.schema import null_mask as null_mask_of
from winnowry.schema import protected_columns as protected_of
from winnowry.schema import stringify as stringify_of

BOOK = Book()

LINEITEM_NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax")


def unkeyed(spark, d):
    return docs(spark, d).drop("doc_id")


@BOOK.add(f"WITH {DOCS} {missing_sql('docs', DOC_COLUMNS)}")
def missing_profile(spark, d):
    return p.missing_profile(unkeyed(spark, d))


@BOOK.add(f"""WITH {DOCS} {missing_sql('docs', DOC_COLUMNS)} ORDER BY "count" DESC, "column" """)
def missing_sorted(spark, d):
    return p.missing_sorted(unkeyed(spark, d))


HOLES = """
WITH holes AS (
  SELECT event_id, user_id, CASE WHEN value < 10 THEN 'NaN'::DOUBLE WHEN value <= 90 THEN value END AS value
  FROM events
)
"""


def holes(spark, d):
    v = F.col("value")
    return table(spark, d, "events").select(
        "event_id", "user_id",
        F.when(v < 10, F.lit(float("nan"))).when(v <= 90, v).alias("value"),
    )


@BOOK.add(HOLES + """
SELECT 'value' AS "column", count(*) FILTER (WHERE value IS NULL OR isnan(value)) AS "count",
       round(count(*) FILTER (WHERE value IS NULL OR isnan(value)) / count(*) * 100, 2) AS pct
FROM holes""")
def missing_profile_nan(spark, d):
    return p.missing_profile(holes(spark, d))


@BOOK.add(HOLES + """
SELECT event_id, FALSE AS user_id, value IS NULL OR isnan(value) AS value FROM holes""")
def null_mask(spark, d):
    return null_mask_of(holes(spark, d), keep=["event_id"])


@BOOK.add(f"""WITH {DOCS} SELECT doc_id::VARCHAR AS doc_id, text, lang, _source, n_chars::VARCHAR AS n_chars,
  coalesce(quality::VARCHAR, '') AS quality, coalesce(toxic::VARCHAR, '') AS toxic FROM docs""")
def stringify(spark, d):
    return stringify_of(docs(spark, d))


@BOOK.add(f"WITH {DOCS} {duplicates_sql('docs', DOC_COLUMNS)}")
def duplicate_count(spark, d):
    return p.duplicate_count(unkeyed(spark, d))


@BOOK.add(duplicates_sql("documents", ["text"]))
def duplicate_texts(spark, d):
    return p.duplicate_count(table(spark, d, "documents"), ["text"])


@BOOK.add(f"WITH {DOCS} {outliers_sql('docs', DOC_NUMBERS)}")
def outliers_iqr(spark, d):
    return p.outlier_profile(unkeyed(spark, d), "iqr")


@BOOK.add(f"WITH {DOCS} {outliers_sql('docs', DOC_NUMBERS, zscore_bounds_sql)}")
def outliers_zscore(spark, d):
    return p.outlier_profile(unkeyed(spark, d), "zscore")


@BOOK.add(outliers_sql("events", ["event_id", "user_id", "value"]))
def outliers_iqr_events(spark, d):
    return p.outlier_profile(table(spark, d, "events"), "iqr")


@BOOK.add(outliers_sql("events", ["event_id", "user_id", "value"], zscore_bounds_sql))
def outliers_zscore_events(spark, d):
    return p.outlier_profile(table(spark, d, "events"), "zscore")


PRICES = """(SELECT *, l_extendedprice / 10000 * (l_extendedprice / 10000) * (l_extendedprice / 10000) * (l_extendedprice / 10000) AS steep FROM lineitem)"""


@BOOK.add(outliers_sql(PRICES, (*LINEITEM_NUMBERS, "steep")))
def outliers_iqr_lineitem(spark, d):
    """Numbers without outliers and one, a fourth power, with many."""
    x = F.col("l_extendedprice") / 10000
    return p.outlier_profile(table(spark, d, "lineitem").withColumn("steep", x * x * x * x), "iqr")


@BOOK.add(f"""WITH {DOCS}
SELECT CASE WHEN count(DISTINCT text) BETWEEN 2 AND 20 THEN 'text' WHEN count(DISTINCT lang) BETWEEN 2 AND 20 THEN 'lang'
            WHEN count(DISTINCT _source) BETWEEN 2 AND 20 THEN '_source' WHEN count(DISTINCT n_chars) BETWEEN 2 AND 10 THEN 'n_chars'
            WHEN count(DISTINCT quality) BETWEEN 2 AND 10 THEN 'quality' WHEN count(DISTINCT toxic) BETWEEN 2 AND 10 THEN 'toxic' END AS "column"
FROM docs""")
def imbalance_column(spark, d):
    return spark.createDataFrame([(p.imbalance_column(unkeyed(spark, d)),)], "column string")


@BOOK.add(f"""WITH {DOCS}, c AS (SELECT lang, count(*) AS n FROM docs WHERE lang IS NOT NULL GROUP BY lang)
SELECT 'lang' AS col, count(*) AS classes, round(max(n) / min(n), 2) AS ratio FROM c""")
def imbalance(spark, d):
    return p.imbalance(unkeyed(spark, d))


@BOOK.add("""SELECT CAST(toxic AS VARCHAR) AS value, count(*) AS "count" FROM labels WHERE toxic IS NOT NULL GROUP BY toxic""")
def class_counts(spark, d):
    return p.class_counts(table(spark, d, "labels"), "toxic")


def report_sql() -> str:
    missing = missing_sql("docs", DOC_COLUMNS)
    outliers = outliers_sql("docs", DOC_NUMBERS)
    return f"""WITH {DOCS}, m AS ({missing}), o AS ({outliers}),
    c AS (SELECT lang, count(*) AS n FROM docs WHERE lang IS NOT NULL GROUP BY lang)
    SELECT 'missing' AS section, "column", 'count' AS metric, CAST("count" AS DOUBLE) AS value FROM m
    UNION ALL SELECT 'missing', "column", 'pct', pct FROM m
    UNION ALL SELECT 'duplicates', '', 'duplicates', CAST(duplicates AS DOUBLE) FROM ({duplicates_sql('docs', DOC_COLUMNS)})
    UNION ALL SELECT 'outliers', "column", 'count', CAST("count" AS DOUBLE) FROM o
    UNION ALL SELECT 'outliers', "column", 'pct', pct FROM o
    UNION ALL SELECT 'outliers', "column", 'lower_bound', lower_bound FROM o
    UNION ALL SELECT 'outliers', "column", 'upper_bound', upper_bound FROM o
    UNION ALL SELECT 'summary', '', 'missing_cells', CAST(coalesce(sum("count"), 0) AS DOUBLE) FROM m
    UNION ALL SELECT 'summary', '', 'missing_cols', CAST(count(*) AS DOUBLE) FROM m
    UNION ALL SELECT 'summary', '', 'outlier_cells', CAST(coalesce(sum("count"), 0) AS DOUBLE) FROM o
    UNION ALL SELECT 'summary', '', 'outlier_cols', CAST(count(*) AS DOUBLE) FROM o
    UNION ALL SELECT 'imbalance', 'lang', 'class ' || lang, CAST(n AS DOUBLE) FROM c
    UNION ALL SELECT 'imbalance', 'lang', 'ratio', round(max(n) / min(n), 2) FROM c"""


@BOOK.add(report_sql())
def quality_report(spark, d):
    return p.quality_report(unkeyed(spark, d))


def box_sql(source, columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(x) AS n, min(x) AS min, quantile_cont(x, 0.25) AS q1,
        quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3, max(x) AS max
        FROM (SELECT CAST({c} AS DOUBLE) AS x FROM {source})""" for c in columns
    )


@BOOK.add(box_sql("lineitem", LINEITEM_NUMBERS))
def box_stats(spark, d):
    return p.box_stats(table(spark, d, "lineitem"))


@BOOK.add(box_sql("lineitem", LINEITEM_NUMBERS[:6]))
def box_stats_6(spark, d):
    """The first six numeric columns, as a caller may ask."""
    return p.box_stats(table(spark, d, "lineitem"), 6)


@BOOK.add(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.999) AS q999
    FROM (SELECT CAST({c} AS DOUBLE) AS x FROM lineitem)""" for c in LINEITEM_NUMBERS
))
def quantiles_narrowed(spark, d):
    """The way of large tables: many passes, each over buckets cut in two."""
    found = exact_quantiles(
        table(spark, d, "lineitem"), LINEITEM_NUMBERS, [0.25, 0.5, 0.999], per_octave=1, cuts=2
    )
    return spark.createDataFrame(
        [(c, *q) for c, (_, q) in found.items()], "column string, q1 double, median double, q999 double"
    )


@BOOK.add("""SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT source, lang, n_chars // 500 FROM documents)) AS BIGINT) AS duplicates
FROM documents""")
def duplicates_map(spark, d):
    """Rows that hold maps, alone and inside an array: equal maps are equal whatever their order."""
    pairs = [F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")]
    ordered, turned = F.create_map(*pairs), F.create_map(*pairs[2:], *pairs[:2])
    even = F.col("doc_id") % 2 == 0
    rows = table(spark, d, "documents").select(
        F.when(even, ordered).otherwise(turned).alias("tags"), F.array(F.when(even, turned).otherwise(ordered)).alias("sets"),
        F.floor(F.col("n_chars") / 500).alias("n"),
    )
    return p.duplicate_count(rows)


def histogram_sql(source: str, x: str, bins: int = 20) -> str:
    return f"""WITH v AS (SELECT CAST({x} AS DOUBLE) AS x FROM {source} WHERE {x} IS NOT NULL),
    e AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
                 CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM v),
    b AS (SELECT least(CAST(floor((x - lo) / (hi - lo) * {bins}) AS BIGINT) + 1, {bins}) AS bin, lo, hi FROM v, e)
    SELECT CAST(bin AS BIGINT) AS bin, round(lo + (bin - 1) * ((hi - lo) / {bins}), 4) AS low,
           round(lo + bin * ((hi - lo) / {bins}), 4) AS high, count(*) AS "count" FROM b GROUP BY bin, lo, hi"""


@BOOK.add(histogram_sql("events", "value"))
def histogram(spark, d):
    return p.histogram(table(spark, d, "events"), "value")


@BOOK.add(histogram_sql("documents", "length(text)"))
def text_length_histogram(spark, d):
    return p.histogram(table(spark, d, "documents").select(F.length("text").alias("chars")), "chars")


@BOOK.add(f"""WITH {DOCS} SELECT CAST(toxic AS VARCHAR) AS label, count(*) AS rows,
  round(avg(length(text)), 4) AS mean_chars, min(length(text)) AS min_chars, max(length(text)) AS max_chars,
  round(count(*) / (SELECT count(*) FROM docs) * 100, 2) AS share FROM docs GROUP BY toxic""")
def eda_profile(spark, d):
    return p.eda_profile(unkeyed(spark, d), "text", "toxic")


@BOOK.add("SELECT source, count(*) AS rows FROM documents GROUP BY source")
def source_counts(spark, d):
    return p.source_counts(table(spark, d, "documents"), "source")


@BOOK.add("""SELECT 'documents' AS file, c AS "column", t AS dtype, (SELECT count(*) FROM documents) AS rows
FROM (VALUES ('doc_id', 'bigint'), ('text', 'string'), ('lang', 'string'), ('source', 'string'), ('n_chars', 'bigint')) AS v(c, t)""")
def schema_profile(spark, d):
    return p.schema_profile(table(spark, d, "documents"), "documents").drop("sample")


@BOOK.add(f"""WITH {DOCS} SELECT '_source' AS "column", count(_source) AS present FROM docs
UNION ALL SELECT 'toxic', count(toxic) FROM docs""")
def protected_columns(spark, d):
    """The columns cleaning leaves alone, with their present values."""
    df = docs(spark, d)
    names = sorted(protected_of(df))
    counts = df.agg(*[F.count(c).alias(c) for c in names])
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("present")) for c in names
    ]))
    return counts.select(cells.alias("c")).select("c.*")
