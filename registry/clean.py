"""Cleaning and comparison queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import (
    DOC_COLUMNS, DOC_NUMBERS, DOCS, GAPPY, Book, compare_sql, docs, gappy, iqr_bounds_sql, table,
    zscore_bounds_sql,
)
from winnowry.operators import clean as c
from winnowry.operators import compare as cmp

BOOK = Book()

PROTECTED = ["_source", "toxic", "doc_id"]
REST = "doc_id, text, lang, _source, n_chars, quality, toxic"


# --- duplicates -----------------------------------------------------------------

@BOOK.add(f"WITH {DOCS} SELECT DISTINCT {', '.join(DOC_COLUMNS)} FROM docs")
def dedup_rows(spark, d):
    return c.dedup(docs(spark, d).drop("doc_id"))


def _dedup_sql(order: str) -> str:
    names = ", ".join(DOC_COLUMNS)
    return f"""WITH {DOCS} SELECT {REST} FROM (SELECT *, row_number() OVER
    (PARTITION BY {names} ORDER BY doc_id {order}) AS rn FROM docs) WHERE rn = 1"""


@BOOK.add(_dedup_sql("ASC"))
def dedup_first(spark, d):
    return c.dedup(docs(spark, d), "keep_first", "doc_id")


@BOOK.add(_dedup_sql("DESC"))
def dedup_last(spark, d):
    return c.dedup(docs(spark, d), "keep_last", "doc_id")


@BOOK.add("""SELECT doc_id, text, lang, source, n_chars FROM (SELECT *, row_number() OVER
(PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def dedup_texts(spark, d):
    return c.dedup(table(spark, d, "documents"), "drop", "doc_id", ["text"])


@BOOK.add(f"WITH {DOCS} SELECT {REST} FROM docs")
def fix_none(spark, d):
    return c.fix(docs(spark, d), {"duplicates": "none", "outliers": "none"})


# --- missing values -------------------------------------------------------------

@BOOK.add(f"""WITH {GAPPY} SELECT {REST} FROM gappy WHERE text IS NOT NULL AND lang IS NOT NULL
AND n_chars IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL""")
def fix_missing_drop(spark, d):
    return c.fix_missing(gappy(spark, d), "drop", PROTECTED)


def _last(x: str) -> str:
    return f"last_value({x} IGNORE NULLS) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS {x}"


@BOOK.add(f"""WITH {GAPPY} SELECT doc_id, _source, {', '.join(_last(x) for x in ('text', 'lang', 'n_chars', 'quality', 'toxic'))}
FROM gappy""")
def fix_missing_ffill(spark, d):
    return c.fix_missing(gappy(spark, d), "ffill", PROTECTED, "doc_id")


@BOOK.add("""SELECT event_id, ts, user_id, event_type, props,
  last_value(CASE WHEN value > 50 THEN value END IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value
FROM events""")
def ffill_events(spark, d):
    events = table(spark, d, "events")
    return c.forward_fill(
        events.withColumn("value", F.when(F.col("value") > 50, F.col("value"))), ["ts", "event_id"]
    )


@BOOK.add("""WITH holes AS (SELECT event_id, CASE WHEN event_id % 10 > 0 THEN date_trunc('hour', ts) END AS ts, user_id,
  CASE WHEN value > 60 THEN value END AS value FROM events)
SELECT event_id, ts, user_id,
  last_value(value IGNORE NULLS) OVER (ORDER BY ts NULLS FIRST, event_id ROWS UNBOUNDED PRECEDING) AS value FROM holes""")
def ffill_small_buckets(spark, d):
    """Many buckets, an order key with NULLs and long ties, and carries from bucket to bucket."""
    events = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 10 > 0, F.date_trunc("hour", "ts")).alias("ts"), "user_id",
        F.when(F.col("value") > 60, F.col("value")).alias("value"),
    )
    return c.forward_fill(events, ["ts", "event_id"], rows_per_bucket=150)


@BOOK.add(f"""WITH {GAPPY} SELECT doc_id, coalesce(text, '0') AS text, coalesce(lang, '0') AS lang, _source,
coalesce(n_chars, 0) AS n_chars, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic FROM gappy""")
def fix_missing_constant(spark, d):
    return c.fix_missing(gappy(spark, d), "constant:0", PROTECTED)


def _mode(x: str) -> str:
    return (f"(SELECT {x} FROM gappy WHERE {x} IS NOT NULL GROUP BY {x} "
            f"ORDER BY count(*) DESC, {x} LIMIT 1)")


def _fill_sql(numeric: str) -> str:
    return f"""WITH {GAPPY} SELECT doc_id, coalesce(text, {_mode('text')}) AS text,
    coalesce(lang, {_mode('lang')}) AS lang, _source, {numeric}, toxic FROM gappy"""


def _stat_fill(stat: str) -> str:
    return ", ".join(
        f"coalesce(CAST({x} AS DOUBLE), (SELECT {stat.format(x=x)} FROM gappy)) AS {x}"
        for x in ("n_chars", "quality")
    )


@BOOK.add(_fill_sql(_stat_fill("avg({x})")))
def fix_missing_mean(spark, d):
    return c.fix_missing(gappy(spark, d), "mean", PROTECTED)


@BOOK.add(_fill_sql(_stat_fill("quantile_cont(CAST({x} AS DOUBLE), 0.5)")))
def fix_missing_median(spark, d):
    return c.fix_missing(gappy(spark, d), "median", PROTECTED)


@BOOK.add(_fill_sql(", ".join(f"coalesce({x}, {_mode(x)}) AS {x}" for x in ("n_chars", "quality"))))
def fix_missing_mode(spark, d):
    return c.fix_missing(gappy(spark, d), "mode", PROTECTED)


@BOOK.add(_fill_sql("n_chars, quality"), name="fix_missing_strings")
def fix_missing_strings(spark, d):
    """A strategy that names no statistic still fills the string columns."""
    return c.fix_missing(gappy(spark, d), "strings", PROTECTED)


# --- outliers -------------------------------------------------------------------

def _clip_sql(source: str, column: str, bounds, rest: str, digits: str = "") -> str:
    clipped = f"least(greatest(CAST(t.{column} AS DOUBLE), lo), hi)"
    clipped = f"round({clipped}, 6)" if digits else clipped
    return f"""SELECT {rest}, CASE WHEN t.{column} IS NOT NULL THEN {clipped} END AS {column}
    FROM {source} t, {bounds(source, column)} b"""


@BOOK.add(_clip_sql("events", "value", iqr_bounds_sql, "event_id, ts, event_type, props, user_id", "6"))
def clip_iqr(spark, d):
    out = c.fix_outliers(table(spark, d, "events"), "clip_iqr", ["event_id", "user_id"])
    return out.withColumn("value", F.round("value", 6))


@BOOK.add(_clip_sql("events", "value", zscore_bounds_sql, "event_id, ts, event_type, props, user_id", "6"))
def clip_zscore(spark, d):
    out = c.fix_outliers(table(spark, d, "events"), "clip_zscore", ["event_id", "user_id"])
    return out.withColumn("value", F.round("value", 6))


@BOOK.add(f"""WITH {DOCS}
SELECT doc_id, text, lang, _source, CASE WHEN n_chars IS NOT NULL THEN least(greatest(CAST(n_chars AS DOUBLE), b1.lo), b1.hi) END AS n_chars,
  CASE WHEN quality IS NOT NULL THEN least(greatest(CAST(quality AS DOUBLE), b2.lo), b2.hi) END AS quality, toxic
FROM docs, {iqr_bounds_sql('docs', 'n_chars')} b1, {iqr_bounds_sql('docs', 'quality')} b2""")
def clip_iqr_docs(spark, d):
    return c.fix_outliers(docs(spark, d), "clip_iqr", PROTECTED)


def drop_chain(first: str, columns) -> tuple[str, str]:
    """CTEs that drop outliers column by column; returns them and the last name."""
    ctes, source = [], first
    for i, x in enumerate(columns):
        ctes.append(
            f"""{first}_d{i} AS (SELECT t.* FROM {source} t, {iqr_bounds_sql(source, x)} b
            WHERE n < 4 OR t.{x} IS NULL OR (t.{x} >= lo AND t.{x} <= hi))"""
        )
        source = f"{first}_d{i}"
    return ", ".join(ctes), source


EVENT_CHAIN, EVENT_LAST = drop_chain("events", ["event_id", "user_id", "value"])
DOC_CHAIN, DOC_LAST = drop_chain("docs", ["n_chars", "quality"])


@BOOK.add(f"WITH {EVENT_CHAIN} SELECT * FROM {EVENT_LAST}")
def drop_outliers(spark, d):
    return c.fix_outliers(table(spark, d, "events"), "drop")


@BOOK.add(f"WITH {DOCS}, {DOC_CHAIN} SELECT {REST} FROM {DOC_LAST}")
def drop_outliers_docs(spark, d):
    return c.fix_outliers(docs(spark, d), "drop", PROTECTED)


# --- strategies -----------------------------------------------------------------

NAMES = ", ".join(DOC_COLUMNS)
UNIQUE = f"uniq AS (SELECT DISTINCT {NAMES} FROM docs)"

STRICT_CHAIN, STRICT_LAST = drop_chain("whole", ["n_chars", "quality"])
STRICT = f"""{UNIQUE}, whole AS (SELECT * FROM uniq WHERE text IS NOT NULL AND lang IS NOT NULL AND _source IS NOT NULL
  AND n_chars IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL),
{STRICT_CHAIN}, strict AS (SELECT * FROM {STRICT_LAST})"""

MEDIUM = f"""{UNIQUE}, filled AS (SELECT text, lang, _source, n_chars,
  coalesce(CAST(quality AS DOUBLE), (SELECT quantile_cont(CAST(quality AS DOUBLE), 0.5) FROM uniq)) AS quality, toxic FROM uniq),
medium AS (SELECT text, lang, _source, least(greatest(CAST(n_chars AS DOUBLE), b1.lo), b1.hi) AS n_chars,
  least(greatest(quality, b2.lo), b2.hi) AS quality, toxic
  FROM filled, {iqr_bounds_sql('filled', 'n_chars')} b1, {iqr_bounds_sql('filled', 'quality')} b2)"""

MILD = f"""mild AS (SELECT doc_id, text, lang, _source, n_chars, {_last('quality')}, {_last('toxic')} FROM docs)"""

STRATEGIES = c.DEFAULT_STRATEGIES


@BOOK.add(f"WITH {DOCS}, {STRICT} SELECT {NAMES} FROM strict")
def fix_strict(spark, d):
    return c.fix(docs(spark, d).drop("doc_id"), STRATEGIES["strict"])


@BOOK.add(f"WITH {DOCS}, {MEDIUM} SELECT {NAMES} FROM medium")
def fix_medium(spark, d):
    return c.fix(docs(spark, d).drop("doc_id"), STRATEGIES["medium"])


@BOOK.add(f"WITH {DOCS}, {MILD} SELECT {REST} FROM mild")
def fix_mild(spark, d):
    return c.fix(docs(spark, d), STRATEGIES["mild"], order_col="doc_id")


@BOOK.add(f"""WITH {DOCS}, {STRICT}, {MEDIUM[len(UNIQUE) + 2:]}, {MILD}
SELECT 'strict' AS label, 'drop' AS missing, 'drop' AS duplicates, 'drop' AS outliers, (SELECT count(*) FROM strict) AS rows
UNION ALL SELECT 'medium', 'median', 'drop', 'clip_iqr', (SELECT count(*) FROM medium)
UNION ALL SELECT 'mild', 'ffill', 'none', 'none', (SELECT count(*) FROM mild)""")
def default_strategies(spark, d):
    """Each default strategy and the rows it leaves."""
    left = []
    for name, strategy in STRATEGIES.items():
        df = docs(spark, d)
        body = df if strategy["missing"] == "ffill" else df.drop("doc_id")
        left.append(c.fix(body, strategy, order_col="doc_id").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("label"), *[F.lit(strategy[k]).alias(k) for k in ("missing", "duplicates", "outliers")],
            "rows",
        ))
    return left[0].unionByName(left[1]).unionByName(left[2])


def _versus(after: str) -> str:
    return compare_sql("docs", after, DOC_COLUMNS, DOC_NUMBERS)


@BOOK.add(f"WITH {DOCS}, {MEDIUM} {_versus('medium')}")
def compare_before_after(spark, d):
    before = docs(spark, d).drop("doc_id")
    return cmp.compare(before, c.fix(before, STRATEGIES["medium"]))


@BOOK.add(f"""WITH {DOCS}, {STRICT}, {MEDIUM[len(UNIQUE) + 2:]}, {MILD}
SELECT *, 'strict' AS strategy FROM ({_versus('strict')})
UNION ALL SELECT *, 'medium' FROM ({_versus('medium')})
UNION ALL SELECT *, 'mild' FROM ({_versus('mild')})""")
def compare_strategies(spark, d):
    return cmp.compare_strategies(docs(spark, d), order_col="doc_id", key=["doc_id"])


@BOOK.add(f"""WITH {DOCS}, {STRICT}, {MEDIUM[len(UNIQUE) + 2:]}
SELECT a.metric, a.before AS "strict/before", a.after AS "strict/after", a.delta AS "strict/delta", a.change AS "strict/change",
  b.before AS "medium/before", b.after AS "medium/after", b.delta AS "medium/delta", b.change AS "medium/change"
FROM ({_versus('strict')}) a FULL JOIN ({_versus('medium')}) b ON a.metric = b.metric""")
def side_by_side(spark, d):
    before = docs(spark, d).drop("doc_id")
    tables = [cmp.compare(before, c.fix(before, STRATEGIES[s])) for s in ("strict", "medium")]
    return cmp.side_by_side(*tables, ["strict", "medium"])
