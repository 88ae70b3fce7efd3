"""Annotation queries: columns and classes, requests and responses, agreement, export."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import AUTO, DOCS, PASSES, Book, auto_labeled, docs, passes, table
from winnowry.functions.scores import interpret_kappa as words_for
from winnowry.functions.text import norm_label as norm
from winnowry.operators import agreement as agr
from winnowry.operators import annotate as ann
from winnowry.operators import columns as cols

BOOK = Book()


# --- which column is what ---------------------------------------------------------

PART_LENGTHS = """SELECT 'p_name' AS "column", avg(length(p_name)) AS mean_chars, quantile_cont(CAST(length(p_name) AS DOUBLE), 0.5) AS median_chars FROM part
UNION ALL SELECT 'p_brand', avg(length(p_brand)), quantile_cont(CAST(length(p_brand) AS DOUBLE), 0.5) FROM part
UNION ALL SELECT 'p_type', avg(length(p_type)), quantile_cont(CAST(length(p_type) AS DOUBLE), 0.5) FROM part"""


@BOOK.add(f"""SELECT "column", round(mean_chars, 6) AS mean_chars, median_chars FROM ({PART_LENGTHS})""")
def text_lengths(spark, d):
    part = table(spark, d, "part")
    mean, median = cols.text_lengths(part, "mean"), cols.text_lengths(part, "median")
    return spark.createDataFrame(
        [(c, round(mean[c], 6), median[c]) for c in mean],
        "column string, mean_chars double, median_chars double",
    )


@BOOK.add(f"""SELECT (SELECT "column" FROM ({PART_LENGTHS}) ORDER BY mean_chars DESC LIMIT 1) AS by_mean,
(SELECT "column" FROM ({PART_LENGTHS}) ORDER BY median_chars DESC LIMIT 1) AS by_median, 'text' AS by_name
FROM (SELECT count(*) FROM documents)""")
def find_text_col(spark, d):
    part = table(spark, d, "part")
    found = (cols.find_text_col(part), cols.find_text_col(part, "median"),
             cols.find_text_col(table(spark, d, "documents")))
    return spark.createDataFrame([found], "by_mean string, by_median string, by_name string")


@BOOK.add("""SELECT 'toxic' AS by_name, CASE WHEN count(DISTINCT event_id) <= 20 THEN 'event_id' WHEN count(DISTINCT ts) <= 20 THEN 'ts'
WHEN count(DISTINCT user_id) <= 20 THEN 'user_id' WHEN count(DISTINCT event_type) <= 20 THEN 'event_type' END AS by_values FROM events""")
def find_label_col(spark, d):
    found = (cols.find_label_col(table(spark, d, "labels")), cols.find_label_col(table(spark, d, "events")))
    return spark.createDataFrame([found], "by_name string, by_values string")


@BOOK.add(f"""WITH {DOCS} SELECT DISTINCT 'lang' AS "column", lang AS class FROM docs WHERE lang IS NOT NULL""")
def infer_classes(spark, d):
    return cols.infer_classes(docs(spark, d), "text")


@BOOK.add("""SELECT vec_id, CAST(label AS VARCHAR) AS whole, 'class ' || label AS lower FROM embeddings""")
def norm_label(spark, d):
    label = F.col("label")
    return table(spark, d, "embeddings").select(
        "vec_id", norm(label.cast("double")).alias("whole"),
        norm(F.concat(F.lit("\t CLASS "), label.cast("string"), F.lit(".0 \n")), lower=True).alias("lower"),
    )


# --- requests and responses ---------------------------------------------------------

NUMBERED = """
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents),
batched AS (SELECT *, pos // 20 AS batch_id, CAST(pos % 20 AS INTEGER) AS id FROM numbered),
sizes AS (SELECT batch_id, count(*) AS asked FROM batched GROUP BY batch_id)"""


def batched(spark, d):
    return ann.assign_batches(table(spark, d, "documents"), "doc_id")


@BOOK.add(f"WITH {NUMBERED} SELECT doc_id, batch_id, id FROM batched")
def assign_batches(spark, d):
    return batched(spark, d).select("doc_id", "batch_id", "id")


def requests_sql(text: str) -> str:
    return f"""WITH {NUMBERED} SELECT batch_id, id, {text} AS text, CAST(asked AS INTEGER) AS size
    FROM batched JOIN sizes USING (batch_id)"""


@BOOK.add(requests_sql("text"))
def label_requests(spark, d):
    return _requests(spark, d, None)


@BOOK.add(requests_sql("substring(text, 1, 500)"))
def label_requests_500(spark, d):
    """A caller's limit of 500 characters a text."""
    return _requests(spark, d, 500)


def _requests(spark, d, chars):
    requests = ann.label_requests(batched(spark, d), "text", "language", ["en", "de"], chars)
    texts = F.from_json(F.get_json_object("request", "$.texts"), "array<struct<id: int, text: string>>")
    return requests.select("batch_id", "size", F.explode(texts).alias("t")).select(
        "batch_id", "t.id", "t.text", "size"
    )


def responses(spark, d):
    """Answers of four kinds, by batch: in order with wrong ids, short, fenced with a
    repeated id, and not JSON at all."""
    rows = batched(spark, d)
    item = F.struct(
        F.when(F.col("batch_id") % 4 == 0, F.col("id") + 7).otherwise(F.col("id")).alias("id"),
        F.col("lang").alias("label"), ((F.col("n_chars") % 100) / 100.0).alias("confidence"),
        F.col("source").alias("reason"),
    )
    given = F.collect_list(F.when(
        (F.col("batch_id") % 4 != 1) | (F.col("n_chars") > 1000), F.struct(F.col("id").alias("at"), item.alias("x"))
    ))
    answers = rows.groupBy("batch_id").agg(F.to_json(
        F.transform(F.array_sort(given), lambda e: e["x"])
    ).alias("body"))
    four = F.col("batch_id") % 4
    extra = F.lit(',{"id":0,"label":"dup"}]\n```')
    return answers.select("batch_id", (
        F.when(four <= 1, F.col("body"))
        .when(four == 2, F.concat(F.lit("```json\n"), F.expr("left(body, length(body) - 1)"), extra))
        .otherwise(F.lit("sorry"))
    ).alias("response"))


ANSWERED = NUMBERED + """,
answered AS (SELECT b.*, asked, b.batch_id % 4 AS four, CAST((n_chars % 100) / 100.0 AS DOUBLE) AS conf FROM batched b JOIN sizes USING (batch_id))"""


@BOOK.add(f"""WITH {ANSWERED}
SELECT batch_id, CASE WHEN four = 0 THEN id + 7 ELSE id END AS id, lang AS label, conf AS confidence, source AS reason
FROM answered WHERE four IN (0, 2) OR (four = 1 AND n_chars > 1000)
UNION ALL SELECT DISTINCT batch_id, 0, 'dup', 0.5, '' FROM answered WHERE four = 2
UNION ALL SELECT DISTINCT batch_id, CAST(NULL AS INTEGER), 'unknown', 0.0, '' FROM answered WHERE four = 3""")
def parse_responses(spark, d):
    return ann.parse_responses(responses(spark, d)).drop("pos")


ALIGNED = f"""WITH {ANSWERED},
hit AS (SELECT *, four = 0 OR (four = 1 AND n_chars > 1000) OR four = 2 AS found, four = 2 AND id = 0 AS again FROM answered)
SELECT doc_id, CASE WHEN again THEN 'dup' WHEN found THEN lang ELSE 'unknown' END AS _label,
  CASE WHEN again THEN 0.5 WHEN found THEN conf ELSE 0.0 END AS _confidence,
  CASE WHEN again THEN '' WHEN found THEN source ELSE '' END AS _reason FROM hit"""


@BOOK.add(ALIGNED)
def align_responses(spark, d):
    done = ann.align_responses(batched(spark, d), responses(spark, d))
    return done.select("doc_id", "_label", "_confidence", "_reason")


@BOOK.add(ALIGNED)
def align_repeated(spark, d):
    """Every batch answered three times: unreadably, readably, and unreadably again later."""
    good = responses(spark, d).withColumn("attempt", F.lit(2))
    bad = good.select("batch_id", F.explode(F.array(
        F.struct(F.lit("none yet").alias("response"), F.lit(1).alias("attempt")),
        F.struct(F.lit("").alias("response"), F.lit(3).alias("attempt")),
    )).alias("r")).select("batch_id", "r.response", "r.attempt")
    done = ann.align_responses(batched(spark, d), good.unionByName(bad))
    return done.select("doc_id", "_label", "_confidence", "_reason")


@BOOK.add(f"""WITH {NUMBERED} SELECT doc_id, lang AS _label, CASE WHEN n_chars % 3 = 0 THEN 0.5 ELSE (n_chars % 100) / 100.0::DOUBLE END AS _confidence,
'' AS _reason FROM batched""")
def text_confidences(spark, d):
    """Confidences given as texts, some of which hold no number."""
    rows = batched(spark, d)
    number = ((F.col("n_chars") % 100) / 100.0).cast("string")
    said = F.when(F.col("n_chars") % 6 == 0, F.lit("high")).when(F.col("n_chars") % 3 == 0, F.lit("NaN")).otherwise(number)
    item = F.struct("id", F.col("lang").alias("label"), said.alias("confidence"))
    landed = rows.groupBy("batch_id").agg(F.to_json(F.array_sort(F.collect_list(item))).alias("response"))
    done = ann.align_responses(rows, landed)
    return done.select("doc_id", "_label", "_confidence", "_reason")


@BOOK.add(ALIGNED)
def auto_label(spark, d):
    """The whole labeling step over landed responses."""
    done = ann.auto_label(table(spark, d, "documents"), "doc_id", responses=responses(spark, d))
    return done.select("doc_id", "_label", "_confidence", "_reason")


def length_labeler():
    """A stand-in labeler: long texts are 1, short ones 0."""
    import json

    def label(request: str) -> str:
        texts = json.loads(request)["texts"]
        return json.dumps([
            {"id": t["id"], "label": str(int(len(t["text"]) > 1000)), "confidence": 0.9, "reason": "length"}
            for t in texts
        ])

    return label  # a closure, so that executors need not import this module


def flaky_labeler():
    """The stand-in labeler, but the first answer to every request is no JSON."""
    steady, asked = length_labeler(), set()

    def label(request: str) -> str:
        if request in asked:
            return steady(request)
        asked.add(request)
        return "Sure, here you go:"

    return label


def by_length_sql(text: str, over: int) -> str:
    return f"""SELECT doc_id, CASE WHEN length({text}) > {over} THEN '1' ELSE '0' END AS _label,
    CAST(0.9 AS DOUBLE) AS _confidence, 'length' AS _reason FROM documents"""


def _by_length(spark, d, labeler, **how):
    done = ann.auto_label(
        table(spark, d, "documents"), "doc_id", labeler, task="length", classes=["0", "1"], **how
    )
    return done.select("doc_id", "_label", "_confidence", "_reason")


@BOOK.add(by_length_sql("text", 1000))
def auto_label_callable(spark, d):
    return _by_length(spark, d, length_labeler())


@BOOK.add(by_length_sql("substring(text, 1, 500)", 1000))
def auto_label_500(spark, d):
    """A caller's limit of 500 characters: no text is long any more."""
    return _by_length(spark, d, length_labeler(), chars=500)


@BOOK.add(by_length_sql("text", 1000))
def auto_label_flaky(spark, d):
    """Each request is answered unreadably first; the second attempt counts."""
    return _by_length(spark, d, flaky_labeler(), parallelism=3)


# --- label statistics -----------------------------------------------------------------

@BOOK.add("""SELECT CAST(toxic AS VARCHAR) AS label, count(*) AS "count",
round(count(*) / (SELECT count(*) FROM labels) * 100, 1) AS pct FROM labels WHERE toxic IS NOT NULL GROUP BY toxic""")
def label_distribution(spark, d):
    return ann.label_distribution(table(spark, d, "labels"), "toxic")


STATS = """count(*) AS total, round(avg(c), 4) AS mean, round(stddev_samp(c), 4) AS std,
round(quantile_cont(c, 0.5), 6) AS median, min(c) AS min, max(c) AS max,
count(*) FILTER (WHERE c < 0.6) AS low_0_6, round(count(*) FILTER (WHERE c < 0.6) / count(*) * 100, 1) AS low_0_6_pct,
count(*) FILTER (WHERE c < 0.7) AS low_0_7, round(count(*) FILTER (WHERE c < 0.7) / count(*) * 100, 1) AS low_0_7_pct,
max(c) = 0 AS all_zero"""


@BOOK.add(f"WITH {AUTO}, given AS (SELECT _confidence AS c FROM auto) SELECT {STATS} FROM given")
def confidence_stats(spark, d):
    stats = ann.confidence_stats(auto_labeled(spark, d))
    return stats.withColumn("median", F.round("median", 6))


@BOOK.add(f"WITH {AUTO}, gaps AS (SELECT CASE WHEN doc_id % 7 > 0 THEN _confidence END AS c FROM auto) SELECT {STATS} FROM gaps")
def confidence_stats_nan(spark, d):
    """Every seventh confidence is NaN, which is missing."""
    rows = auto_labeled(spark, d).withColumn(
        "_confidence", F.when(F.col("doc_id") % 7 > 0, F.col("_confidence")).otherwise(F.lit(float("nan")))
    )
    return ann.confidence_stats(rows).withColumn("median", F.round("median", 6))


@BOOK.add(f"""WITH {AUTO} SELECT doc_id, text, _label, _confidence, _reason FROM auto WHERE _confidence < 0.6""")
def low_confidence(spark, d):
    return ann.low_confidence(auto_labeled(spark, d), key="doc_id")


@BOOK.add(f"""WITH {AUTO} SELECT doc_id, text, _label, _confidence, _reason FROM auto WHERE _confidence < 0.6 ORDER BY doc_id LIMIT 20""")
def low_confidence_20(spark, d):
    """The first 20 rows, as a caller may ask."""
    return ann.low_confidence(auto_labeled(spark, d), n=20, key="doc_id")


# --- agreement -------------------------------------------------------------------------

@BOOK.add("""SELECT CAST(quality AS VARCHAR) AS a, CAST(toxic AS VARCHAR) AS b, count(*) AS "count" FROM labels GROUP BY 1, 2""")
def confusion(spark, d):
    labels = table(spark, d, "labels").select(
        F.col("quality").cast("string").alias("quality"), F.col("toxic").cast("string").alias("toxic")
    )
    return agr.confusion(labels, "quality", "toxic")


def kappa_sql(pairs: str, a: str, b: str, by: str = "") -> str:
    keep = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    on = " AND ".join(f"m.{c.strip()} = t.{c.strip()}" for c in by.split(",")) if by else "TRUE"
    picked = ", ".join(f"t.{c.strip()}" for c in by.split(",")) + ", " if by else ""
    return f"""
    (WITH sides AS (SELECT {keep}{a} AS cls, 1 AS na, 0 AS nb FROM {pairs} UNION ALL SELECT {keep}{b}, 0, 1 FROM {pairs}),
    marg AS (SELECT {keep}cls, CAST(sum(na) AS DOUBLE) * sum(nb) AS cross FROM sides GROUP BY {keep}cls),
    tot AS (SELECT {keep}count(*) AS n, avg(CASE WHEN {a} = {b} THEN 1.0 ELSE 0.0 END) AS po FROM {pairs} {group}),
    pe AS (SELECT {picked}t.n, t.po, sum(m.cross) / (CAST(t.n AS DOUBLE) * t.n) AS pe FROM tot t JOIN marg m ON {on} GROUP BY {picked}t.n, t.po)
    SELECT {keep}n, CASE WHEN pe = 1 THEN 1.0 ELSE round((po - pe) / (1 - pe), 4) END AS kappa,
           round(po * 100, 1) AS agreement_pct FROM pe)"""


@BOOK.add(f"SELECT * FROM {kappa_sql('labels', 'quality', 'toxic')}")
def cohens_kappa(spark, d):
    return agr.cohens_kappa(table(spark, d, "labels"), "quality", "toxic")


@BOOK.add(f"WITH {DOCS}, both_labels AS (SELECT lang, quality, toxic FROM docs WHERE toxic IS NOT NULL) "
          f"SELECT * FROM {kappa_sql('both_labels', 'quality', 'toxic', 'lang')}")
def cohens_kappa_by(spark, d):
    labeled = docs(spark, d).where("toxic is not null")
    return agr.cohens_kappa(labeled, "quality", "toxic", by=["lang"])


@BOOK.add("SELECT count(*) AS n, round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END) * 100, 1) AS agreement_pct FROM labels")
def percent_agreement(spark, d):
    return agr.agreement(table(spark, d, "labels"), "quality", "toxic")


GAPS = """gaps AS (SELECT CASE WHEN doc_id % 3 > 0 THEN quality END AS a, CASE WHEN doc_id % 5 > 0 THEN toxic END AS b FROM labels),
judged AS (SELECT * FROM gaps WHERE a IS NOT NULL AND b IS NOT NULL)"""


def _gaps(spark, d):
    """Pairs of which either side, or both, may lack a label."""
    return table(spark, d, "labels").select(
        F.when(F.col("doc_id") % 3 > 0, F.col("quality")).alias("a"),
        F.when(F.col("doc_id") % 5 > 0, F.col("toxic").cast("double")).otherwise(F.lit(float("nan"))).alias("b"),
    )


@BOOK.add(f"WITH {GAPS} SELECT count(*) AS n, round(avg(CASE WHEN a = b THEN 1.0 ELSE 0.0 END) * 100, 1) AS agreement_pct FROM judged")
def percent_agreement_gaps(spark, d):
    return agr.agreement(_gaps(spark, d), "a", "b")


@BOOK.add(f"WITH {GAPS} SELECT * FROM {kappa_sql('judged', 'a', 'b')}")
def cohens_kappa_gaps(spark, d):
    return agr.cohens_kappa(_gaps(spark, d), "a", "b")


@BOOK.add("""SELECT event_id, CASE WHEN value / 100 - 0.5 < 0 THEN 'poor (worse than chance)' WHEN value / 100 - 0.5 < 0.2 THEN 'slight'
WHEN value / 100 - 0.5 < 0.4 THEN 'fair' WHEN value / 100 - 0.5 < 0.6 THEN 'moderate' WHEN value / 100 - 0.5 < 0.8 THEN 'substantial'
ELSE 'almost perfect' END AS words FROM events""")
def interpret_kappa(spark, d):
    return table(spark, d, "events").select("event_id", words_for(F.col("value") / 100 - 0.5).alias("words"))


@BOOK.add(f"WITH {PASSES} SELECT key, pass_a, pass_b, label_a, label_b FROM pairs")
def pass_pairs(spark, d):
    return agr.pass_pairs(passes(spark, d))


@BOOK.add(f"WITH {PASSES} SELECT * FROM {kappa_sql('pairs', 'label_a', 'label_b', 'pass_a, pass_b')}")
def kappa_by_pass(spark, d):
    return agr.kappa_by_pass(passes(spark, d))


ROWS = """votes AS (SELECT key, label, count(*) AS v FROM passes GROUP BY key, label),
shares AS (SELECT key, max(v) AS majority, CAST(sum(v) AS BIGINT) AS n FROM votes GROUP BY key),
agreed AS (SELECT count(*) AS rows, round(avg(majority / n) * 100, 1) AS row_agreement,
  count(*) FILTER (WHERE majority = n) AS full_consensus, round(count(*) FILTER (WHERE majority = n) / count(*) * 100, 1) AS full_consensus_pct FROM shares)"""


@BOOK.add(f"WITH {PASSES}, {ROWS} SELECT * FROM agreed")
def row_agreement(spark, d):
    return agr.row_agreement(passes(spark, d))


CONSISTENT = f"""{PASSES}, {ROWS}, k AS (SELECT * FROM {kappa_sql('pairs', 'label_a', 'label_b', 'pass_a, pass_b')}),
exact AS (SELECT pass_a, pass_b, avg(CASE WHEN label_a = label_b THEN 1.0 ELSE 0.0 END) * 100 AS share FROM pairs GROUP BY ALL),
pairwise AS (SELECT count(*) AS pairs, round(avg(kappa), 4) AS kappa, round(stddev_pop(kappa), 4) AS kappa_std FROM k),
consistent AS (SELECT p.*, (SELECT round(avg(share), 1) FROM exact) AS pairwise_agreement, a.*,
  p.kappa = 0 AND a.row_agreement > 50 AS paradox FROM pairwise p, agreed a)"""


@BOOK.add(f"WITH {CONSISTENT} SELECT * FROM consistent")
def self_consistency(spark, d):
    return agr.self_consistency(passes(spark, d))


METRICS = """round(avg(_confidence), 4) AS confidence_mean, round(stddev_samp(_confidence), 4) AS confidence_std,
count(*) FILTER (WHERE _confidence < 0.6) AS low_confidence_count,
round(count(*) FILTER (WHERE _confidence < 0.6) / count(*) * 100, 1) AS low_confidence_pct, count(*) AS total_labeled"""
WORDS = """CASE WHEN kappa < 0 THEN 'poor (worse than chance)' WHEN kappa < 0.2 THEN 'slight' WHEN kappa < 0.4 THEN 'fair'
WHEN kappa < 0.6 THEN 'moderate' WHEN kappa < 0.8 THEN 'substantial' ELSE 'almost perfect' END AS kappa_interpretation"""


def flat_metrics(df):
    return df.withColumn("labels", F.to_json("label_distribution")).drop(
        "label_distribution", "label_distribution_pct"
    )


LABELS_JSON = """(SELECT '{' || string_agg('"' || _label || '":' || n, ',' ORDER BY _label) || '}' FROM
  (SELECT _label, count(*) AS n FROM auto GROUP BY _label)) AS labels"""


@BOOK.add(f"""WITH {AUTO}, both_labels AS (SELECT regexp_replace(_label, '\\.0$', '') AS a, CAST(quality AS VARCHAR) AS b FROM auto JOIN labels USING (doc_id)),
k AS (SELECT kappa, agreement_pct FROM {kappa_sql('both_labels', 'a', 'b')}), m AS (SELECT {METRICS} FROM auto)
SELECT m.*, k.*, {WORDS}, {LABELS_JSON} FROM m, k""")
def check_quality(spark, d):
    human = table(spark, d, "labels").select("doc_id", F.col("quality").alias("label"))
    return flat_metrics(ann.check_quality(auto_labeled(spark, d), human, key_col="doc_id", label_maps=True))


@BOOK.add(f"""WITH {AUTO}, {CONSISTENT}, m AS (SELECT {METRICS} FROM auto)
SELECT m.*, kappa, row_agreement AS agreement_pct, {WORDS}, {LABELS_JSON} FROM m, consistent""")
def check_quality_consistency(spark, d):
    runs = agr.self_consistency(passes(spark, d))
    return flat_metrics(ann.check_quality(auto_labeled(spark, d), consistency=runs, label_maps=True))


@BOOK.add(f"""WITH {AUTO} SELECT doc_id, _label AS auto, labels.quality AS human FROM auto JOIN labels USING (doc_id)""")
def auto_vs_human(spark, d):
    human = table(spark, d, "labels").select("doc_id", F.col("quality").alias("label"))
    return ann.auto_vs_human(auto_labeled(spark, d), human, "doc_id")


# --- export --------------------------------------------------------------------------

def _tasks(spark, d, kind):
    """Documents with a label on most rows and "unknown" on the short ones."""
    rows = docs(spark, d).select(
        "doc_id", "text",
        F.when(F.col("n_chars") < 300, F.lit("unknown")).when(F.col("lang") != "fr", F.col("lang")).alias("_label"),
        F.when(F.col("lang") != "de", (F.col("doc_id") % 101) / 100.0).alias("_confidence"),
    )
    tasks = ann.to_labelstudio(rows, "doc_id", "text", task_type=kind)
    one = "$.predictions[0].result[0]."
    get = lambda path: F.get_json_object("task", path)
    return tasks.select(
        "doc_id", get("$.data.text").alias("text"), get("$.predictions[0].model_version").alias("model"),
        get("$.predictions[0].score").cast("double").alias("score"), get(one + "id").alias("result_id"),
        get(one + "type").alias("type"), get(one + "from_name").alias("from_name"),
        get(one + "to_name").alias("to_name"), get("$.annotations").alias("annotations"),
        F.coalesce(get(one + "value.choices[0]"), get(one + "value.labels[0]")).alias("label"),
        get(one + "value.end").cast("bigint").alias("end_at"),
    )


def tasks_sql(kind: str, end: str) -> str:
    return f"""WITH {DOCS}, r AS (SELECT *, n_chars >= 300 AND lang <> 'fr' AS named,
      CASE WHEN lang = 'de' THEN 0.5 ELSE (doc_id % 101) / 100.0::DOUBLE END AS s FROM docs)
    SELECT doc_id, text, CASE WHEN named THEN 'AnnotationAgent-v1' END AS model, CASE WHEN named THEN s END AS score,
      CASE WHEN named THEN substring(md5(CAST(doc_id AS VARCHAR)), 1, 8) END AS result_id, CASE WHEN named THEN '{kind}' END AS type,
      CASE WHEN named THEN 'label' END AS from_name, CASE WHEN named THEN 'text' END AS to_name, '[]' AS annotations,
      CASE WHEN named THEN lang END AS label, CASE WHEN named THEN {end} END AS end_at FROM r"""


@BOOK.add(tasks_sql("choices", "CAST(NULL AS BIGINT)"))
def labelstudio(spark, d):
    return _tasks(spark, d, "classification")


@BOOK.add(tasks_sql("labels", "length(text)"))
def labelstudio_ner(spark, d):
    return _tasks(spark, d, "ner")


# --- consistency run -------------------------------------------------------------------

def passes_sql(rows: str) -> str:
    return f"""SELECT doc_id AS key, p AS pass, CASE WHEN length(text) > 1000 THEN '1' ELSE '0' END AS label
    FROM {rows}, (VALUES (1), (2), (3)) AS v(p)"""


def _passes(spark, d, n):
    labeled = ann.auto_label(
        table(spark, d, "documents"), "doc_id", length_labeler(), task="length", classes=["0", "1"]
    )
    return ann.consistency_passes(
        labeled, "doc_id", length_labeler(), "text", n, task="length", classes=["0", "1"]
    )


@BOOK.add(passes_sql("documents"))
def consistency_passes(spark, d):
    """All rows, labeled three times by a steady labeler."""
    return _passes(spark, d, None)


@BOOK.add(passes_sql("(SELECT * FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 30)"))
def consistency_sample(spark, d):
    """A sampling operator: 30 rows."""
    return _passes(spark, d, 30)
