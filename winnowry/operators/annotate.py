"""Label requests and responses, label statistics and the annotation-tool export."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnowry.functions.scores import interpret_kappa
from winnowry.functions.text import FENCE, FENCED_BLOCK, FENCE_MARK, strip_fences, truncate
from winnowry.operators.agreement import cohens_kappa, self_consistency
from winnowry.operators.columns import find_text_col, infer_classes
from winnowry.operators.quantiles import exact_quantiles
from winnowry.operators.ranking import BUCKET_BYTES, global_rank, sample_n
from winnowry.schema import col, nan_to_null
from winnowry.session import small_buffers
from winnowry.staging import stage

# --- fixed values -------------------------------------------------------------
BATCH_SIZE = 20
CONSISTENCY_PASSES = 3
ATTEMPTS = 2
UNKNOWN = "unknown"
UNMATCHED_CONFIDENCE = 0.0
DEFAULT_CONFIDENCE = 0.5
LOW_CONFIDENCE = 0.6
REPORT_LOW_CONFIDENCE = 0.7
NO_LABEL = ("", "unknown", "nan")
MODEL_VERSION = "AnnotationAgent-v1"
RESPONSE_ITEMS = "array<struct<id: int, label: string, confidence: string, reason: string>>"
# ------------------------------------------------------------------------------


# --- requests and responses ---------------------------------------------------

def assign_batches(df: DataFrame, key: str, size: int = BATCH_SIZE) -> DataFrame:
    """Consecutive batches in key order.

    Adds ``batch_id``, the place ``id`` within the batch and its length
    ``asked``: ``size`` rows, fewer only in the last batch.
    """
    rows = df.count()
    ranked = global_rank(df, [key], "__rank")
    at = F.col("__rank") - 1
    batch = F.floor(at / size).cast("bigint")
    return ranked.withColumns({
        "batch_id": batch, "id": F.pmod(at, F.lit(size)).cast("int"),
        "asked": F.least(F.lit(size), F.lit(rows) - batch * size).cast("int"),
    }).drop("__rank")


def label_requests(
    batched: DataFrame, text_col: str, task: str = "", classes: Sequence[str] = (),
    chars: int | None = None, tasks: int | None = None,
) -> DataFrame:
    """One request per batch: ``(batch_id, size, request)``, the request as JSON text.

    Texts go in whole; ``chars`` sends only so many characters of each. With
    ``tasks`` the batches are dealt out to so many tasks in turn, and put together there.
    """
    by = ["batch_id"]
    if tasks is not None:
        by = ["__task", "batch_id"]
        dealt = batched.withColumn("__task", F.pmod("batch_id", F.lit(tasks)).cast("int"))
        batched = dealt.repartitionById(tasks, F.col("__task"))
    item = F.struct(
        F.col("id"), truncate(F.coalesce(col(text_col), F.lit("")), chars).alias("text")
    )
    grouped = batched.groupBy(*by).agg(F.array_sort(F.collect_list(item)).alias("texts"))
    body = F.struct(
        F.lit(task).alias("task"),
        F.array(*[F.lit(c) for c in classes]).cast("array<string>").alias("classes"), "texts",
    )
    return grouped.select(
        "batch_id", F.size("texts").alias("size"), F.to_json(body).alias("request")
    )


def parse_items(response: Column) -> Column:
    """Items of a response text, NULL unless it holds a JSON array.

    A confidence may be a number or a text that holds one; anything else is missing.
    """
    body = F.ltrim(strip_fences(response))
    items = F.when(F.startswith(body, F.lit("[")), F.from_json(body, RESPONSE_ITEMS))

    def typed(x: Column) -> Column:
        number = x["confidence"].try_cast("double")
        return F.when(x.isNotNull(), F.struct(
            x["id"].alias("id"), x["label"].alias("label"),
            F.when(~F.isnan(number), number).alias("confidence"), x["reason"].alias("reason"),
        ))

    return F.transform(items, typed)


def readable(response: str) -> bool:
    """Whether a response holds a JSON array, bare or in a Markdown code block."""
    if FENCE in response:
        block = re.search(FENCED_BLOCK, response)
        response = block[1] if block else re.sub(FENCE_MARK, "", response)
    try:
        return isinstance(json.loads(response), list)
    except ValueError:
        return False


def parse_responses(responses: DataFrame, response_col: str = "response") -> DataFrame:
    """``(batch_id, pos, id, label, confidence, reason)``; bad JSON gives one row of defaults."""
    items = responses.select("batch_id", F.posexplode_outer(parse_items(F.col(response_col))))
    return items.select(
        "batch_id", "pos", F.coalesce("col.id", "pos").alias("id"),
        F.coalesce("col.label", F.lit(UNKNOWN)).alias("label"),
        F.when(F.col("col").isNull(), F.lit(UNMATCHED_CONFIDENCE))
        .otherwise(F.coalesce("col.confidence", F.lit(DEFAULT_CONFIDENCE))).alias("confidence"),
        F.coalesce("col.reason", F.lit("")).alias("reason"),
    )


def align_responses(
    batched: DataFrame, responses: DataFrame, response_col: str = "response",
    classes: Sequence[str] | None = None,
) -> DataFrame:
    """Every row of ``assign_batches`` with ``_label``, ``_confidence`` and ``_reason``.

    A response with exactly one item per text is trusted by position; otherwise
    items are matched by id (the position where it is missing), the last one
    wins, and a text nobody answered gets ("unknown", 0.0, ""). Of several
    responses to one batch a readable one counts before an unreadable one, then
    the latest ``attempt`` if there is such a column, then the last in text order.
    """
    items = parse_items(F.col("response"))
    attempt = F.col("attempt") if "attempt" in responses.columns else F.lit(0)
    given = responses.select("batch_id", attempt.alias("attempt"), col(response_col).alias("response"))
    best = F.max_by("response", F.struct(items.isNotNull().alias("readable"), "attempt", "response"))
    parsed = given.groupBy("batch_id").agg(best.alias("response")).select("batch_id", items.alias("items"))
    numbered = F.transform("items", lambda x, i: F.struct(F.coalesce(x["id"], i).alias("n"), x.alias("x")))
    answers = parsed.select("batch_id", "items", numbered.alias("numbered"))
    rows = batched.join(answers, "batch_id", "left").withColumn(
        "in_order", F.size("items") == F.col("asked")
    )
    by_id = F.filter("numbered", lambda e: e["n"] == F.col("id"))
    hit = F.when(F.col("in_order"), F.get("items", F.col("id"))).otherwise(
        F.try_element_at(by_id, F.lit(-1))["x"]
    )
    rows = rows.withColumn("__hit", hit)
    label = F.coalesce("__hit.label", F.lit(UNKNOWN))
    if classes is not None:
        label = F.when(label.isin(*classes), label).otherwise(F.lit(UNKNOWN))
    confidence = F.when(F.col("__hit").isNull(), F.lit(UNMATCHED_CONFIDENCE)).otherwise(
        F.coalesce("__hit.confidence", F.lit(DEFAULT_CONFIDENCE))
    )
    return rows.withColumns({
        "_label": label, "_confidence": confidence,
        "_reason": F.coalesce("__hit.reason", F.lit("")),
    }).drop("__hit", "items", "numbered", "in_order")


def run_labeler(
    requests: DataFrame, labeler: Callable[[str], str], pass_no: int = 0, parallelism: int | None = None
) -> DataFrame:
    """``(batch_id, response)``: one pass of ``run_passes``."""
    return run_passes(requests, labeler, [pass_no], parallelism).drop("pass")


def run_passes(
    requests: DataFrame, labeler: Callable[[str], str], passes: Sequence[int], parallelism: int | None = None,
    dealt: bool = False,
) -> DataFrame:
    """``(batch_id, pass, response)``: ask ``labeler`` (request text in, response text out) for every batch.

    Answers are written down at once: a lost executor never pays for them again.
    A call that fails, or answers with no JSON array, is made a second time; after
    that the last answer stays, empty if there was none. Requests are dealt out
    to ``parallelism`` tasks (one per core by default), however few bytes they are,
    once for all passes, unless they are ``dealt`` out already. A task has one
    request at a time as a Python object.
    """
    tasks = parallelism or requests.sparkSession.sparkContext.defaultParallelism

    def ask(request: str) -> str:
        answer = ""
        for _ in range(ATTEMPTS):
            try:
                answer = labeler(request) or ""
            except Exception:
                continue
            if readable(answer):
                break
        return answer

    numbers, names = list(passes), ["batch_id", "pass", "response"]

    def ask_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in numbers:
                answers = pa.array([ask(r.as_py()) for r in batch.column(1)], pa.string())
                passed = pa.array([number] * batch.num_rows, pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0), passed, answers], names=names)

    small_buffers(requests.sparkSession)
    asked = requests.select(F.col("batch_id").cast("bigint"), "request")
    answered = (asked if dealt else asked.repartition(tasks)).mapInArrow(
        ask_all, "batch_id bigint, pass int, response string"
    )
    return stage(answered, f"responses-{'-'.join(map(str, numbers))}")


def _labeling_tasks(df: DataFrame, text_col: str, parallelism: int | None) -> int:
    """The tasks asked for; else one per core, and more where one would get over ``BUCKET_BYTES`` of texts."""
    if parallelism is not None:
        return parallelism
    size = df.agg(F.coalesce(F.sum(F.octet_length(col(text_col)).cast("bigint")), F.lit(0))).first()[0]
    return max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(size / BUCKET_BYTES))


def auto_label(
    df: DataFrame, key: str, labeler: Callable[[str], str] | None = None,
    responses: DataFrame | None = None, task: str = "", classes: Sequence[str] | None = None,
    text_col: str | None = None, batch_size: int = BATCH_SIZE, chars: int | None = None,
    parallelism: int | None = None,
) -> DataFrame:
    """Label every row by a callable or from landed responses ``(batch_id, response)``.

    Requests show whole texts, or ``chars`` characters of each.
    """
    if (labeler is None) == (responses is None):
        raise ValueError("give a labeler or landed responses")
    text = text_col or find_text_col(df)
    if responses is None:
        if classes is None:
            classes = [r["class"] for r in infer_classes(df, text).collect()]
        # only what a request shows is moved into batches
        shown = df.select(col(key), truncate(col(text), chars).alias(text))
        tasks = _labeling_tasks(shown, text, parallelism)
        requests = label_requests(assign_batches(shown, key, batch_size), text, task, classes, tasks=tasks)
        responses = run_passes(requests, labeler, [0], dealt=True).drop("pass")
    # batches are rebuilt from the keys alone; the rows themselves move once, by key
    answered = align_responses(assign_batches(df.select(col(key)), key, batch_size), responses)
    given = ("_label", "_confidence", "_reason")
    rows = df.drop(*given)
    return rows.join(answered.select(col(key), *given), key, "left").select(
        *[col(c) for c in rows.columns], *given
    )


def consistency_passes(
    labeled: DataFrame, key: str, labeler: Callable[[str], str], text_col: str,
    n: int | None = None, passes: int = CONSISTENCY_PASSES, seed: int = 42,
    task: str = "", classes: Sequence[str] = (), batch_size: int = BATCH_SIZE,
    chars: int | None = None, parallelism: int | None = None,
) -> DataFrame:
    """Long table ``(key, pass, label)``: pass 1 is the main run, the rest is new.

    All rows are labeled again, or a random sample of ``n``.
    """
    sample = stage(labeled if n is None else sample_n(labeled, n, key, seed), "consistency")
    out = sample.select(col(key).alias("key"), F.lit(1).alias("pass"), F.col("_label").alias("label"))
    batched = assign_batches(sample.drop("_label", "_confidence", "_reason"), key, batch_size)
    tasks = _labeling_tasks(sample, text_col, parallelism)
    requests = label_requests(batched, text_col, task, classes, chars, tasks)
    numbers = range(2, passes + 1)
    # whole texts are moved into requests once, whatever the number of passes
    answers = run_passes(requests, labeler, numbers, dealt=True) if numbers else None
    for number in numbers:
        again = align_responses(batched.select(col(key), "batch_id", "id", "asked"), answers.where(F.col("pass") == number))
        out = out.unionByName(again.select(
            col(key).alias("key"), F.lit(number).alias("pass"), F.col("_label").alias("label")
        ))
    return out


def consistency(labeled: DataFrame, key: str, labeler: Callable[[str], str], text_col: str, **how) -> DataFrame:
    return self_consistency(consistency_passes(labeled, key, labeler, text_col, **how))


# --- label statistics ---------------------------------------------------------

def label_distribution(df: DataFrame, label_col: str = "_label") -> DataFrame:
    """``(label, count, pct)``, most frequent first; unlabeled rows count in the total only."""
    total = df.count()
    counts = df.where(col(label_col).isNotNull()).groupBy(
        col(label_col).cast("string").alias("label")
    ).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("pct", F.round(F.col("count") / F.lit(total) * 100, 1)).orderBy(
        F.desc("count"), "label"
    )


def confidence_stats(
    df: DataFrame, confidence_col: str = "_confidence",
    thresholds: Sequence[float] = (LOW_CONFIDENCE, REPORT_LOW_CONFIDENCE),
) -> DataFrame:
    """One row: mean, std, median, min, max and the rows below each threshold.

    Without the column every row counts as 0.5; NaN is missing like NULL;
    ``all_zero`` flags a run that failed silently.
    """
    if confidence_col not in df.columns:
        df = df.withColumn(confidence_col, F.lit(DEFAULT_CONFIDENCE))
    scores = nan_to_null(df.select(col(confidence_col).cast("double").alias("c")))
    median = exact_quantiles(scores, ["c"], [0.5])["c"][1]
    below = []
    for t in thresholds:
        low = F.count_if(F.col("c") < t)
        name = str(t).replace(".", "_")
        below += [low.alias(f"low_{name}"),
                  F.round(low / F.count(F.lit(1)) * 100, 1).alias(f"low_{name}_pct")]
    return scores.agg(
        F.count(F.lit(1)).alias("total"),
        F.round(F.avg("c"), 4).alias("mean"), F.round(F.stddev_samp("c"), 4).alias("std"),
        F.lit(median[0] if median else None).cast("double").alias("median"),
        F.min("c").alias("min"), F.max("c").alias("max"),
        *below, F.coalesce(F.max("c") == 0.0, F.lit(False)).alias("all_zero"),
    )


def low_confidence(
    df: DataFrame, threshold: float = LOW_CONFIDENCE, n: int | None = None,
    text_col: str = "text", key: str | None = None,
) -> DataFrame:
    """Rows whose confidence is below the threshold, for review: all, or the first ``n`` by ``key``."""
    if n is not None and key is None:
        raise ValueError("the first rows need a key to be ordered by")
    rows = df.where(F.col("_confidence") < threshold)
    names = ([key] if key else []) + [text_col, "_label", "_confidence", "_reason"]
    if n is not None:
        rows = rows.orderBy(col(key)).limit(n)
    return rows.select([col(c) for c in names])


def auto_vs_human(
    auto: DataFrame, human: DataFrame, key_col: str, label_col: str = "_label",
    human_col: str = "label",
) -> DataFrame:
    """Rows labeled by both, joined by key: ``(key, auto, human)``."""
    left = auto.select(col(key_col), col(label_col).alias("auto"))
    right = human.select(col(key_col), col(human_col).alias("human"))
    return left.join(right, key_col, "inner")


def check_quality(
    auto: DataFrame, human: DataFrame | None = None, consistency: DataFrame | None = None,
    key_col: str | None = None, label_col: str = "_label", human_col: str = "label",
    confidence_col: str = "_confidence", threshold: float = LOW_CONFIDENCE, label_maps: bool = False,
) -> DataFrame:
    """One row of annotation metrics.

    Kappa and agreement come from human labels if given, else from a
    consistency run. ``label_maps`` adds the label distribution as two maps, for
    label sets known to be small; ``label_distribution`` is the table for any.
    """
    low = f"low_{str(threshold).replace('.', '_')}"
    facts = confidence_stats(auto, confidence_col, [threshold]).select(
        F.lit(1).alias("one"), F.col("mean").alias("confidence_mean"),
        F.col("std").alias("confidence_std"), F.col(low).alias("low_confidence_count"),
        F.col(f"{low}_pct").alias("low_confidence_pct"), F.col("total").alias("total_labeled"),
    )
    if human is not None:
        pairs = auto_vs_human(auto, human, key_col, label_col, human_col)
        kappa = cohens_kappa(pairs, "auto", "human").select("kappa", "agreement_pct")
    elif consistency is not None:
        kappa = consistency.select("kappa", F.col("row_agreement").alias("agreement_pct"))
    else:
        kappa = auto.sparkSession.createDataFrame([(0.0, 0.0)], "kappa double, agreement_pct double")
    kappa = kappa.withColumn("one", F.lit(1))
    joined = facts.join(kappa, "one")
    if label_maps:
        joined = joined.join(label_distribution(auto, label_col).agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "count")))).alias("label_distribution"),
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "pct")))).alias("label_distribution_pct"),
        ).withColumn("one", F.lit(1)), "one")
    joined = joined.drop("one")
    return joined.withColumn("kappa_interpretation", interpret_kappa(F.col("kappa")))


# --- export -------------------------------------------------------------------

def to_labelstudio(
    df: DataFrame, key: str, text_col: str | None = None, label_col: str = "_label",
    confidence_col: str = "_confidence", task_type: str = "classification",
    from_name: str = "label", to_name: str = "text",
) -> DataFrame:
    """One import task per row, ``(key, task)`` with the task as JSON text.

    The label becomes a prediction for review; a row without one gets none.
    """
    text = F.coalesce(col(text_col or find_text_col(df)).cast("string"), F.lit(""))
    label = col(label_col).cast("string") if label_col in df.columns else F.lit(None).cast("string")
    score = col(confidence_col).cast("double") if confidence_col in df.columns else F.lit(DEFAULT_CONFIDENCE)
    score = F.coalesce(score, F.lit(DEFAULT_CONFIDENCE))
    if task_type == "ner":
        kind = "labels"
        value = F.struct(
            F.lit(0).alias("start"), F.length(text).alias("end"), F.array(label).alias("labels")
        )
    else:
        kind = "choices"
        value = F.struct(F.array(label).alias("choices"))
    result = F.struct(
        F.substring(F.md5(col(key).cast("string")), 1, 8).alias("id"), F.lit(kind).alias("type"),
        value.alias("value"), F.lit(from_name).alias("from_name"), F.lit(to_name).alias("to_name"),
        score.alias("score"),
    )
    prediction = F.struct(
        F.lit(MODEL_VERSION).alias("model_version"), score.alias("score"),
        F.array(result).alias("result"),
    )
    named = label.isNotNull() & ~label.isin(*NO_LABEL)
    task = F.struct(
        F.struct(text.alias(to_name)).alias("data"),
        F.when(named, F.array(prediction)).otherwise(F.array()).alias("predictions"),
        F.array().cast("array<string>").alias("annotations"),
    )
    return df.select(col(key), F.to_json(task).alias("task"))


def write_labelstudio(tasks: DataFrame, path: str) -> None:
    """One task per line, written in parallel."""
    tasks.select("task").write.mode("overwrite").text(path)
