"""Active learning: splits, queries, the labeling loop and its learning curves."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry.functions.scores import entropy, margin
from winnowry.functions.text import norm_label
from winnowry.jobs import side_by_side
from winnowry.operators.agreement import evaluate
from winnowry.operators.clean import BROADCAST_ROWS
from winnowry.operators.features import term_counts
from winnowry.operators.models import Classifier, fit, predict_all
from winnowry.operators.ranking import MAX_CLASSES, hash_cutoffs, sample_n, seeded_hash, top_per_group
from winnowry.schema import col, nan_to_null
from winnowry.staging import stage

# --- fixed values -------------------------------------------------------------
TEST_SIZE = 0.2
SEED = 42
ITERATIONS = 5
BATCH = 20
BASELINE = "random"
STRATEGIES = ("entropy", "margin", "random")
HISTORY = "strategy string, iteration int, n_labeled bigint, accuracy double, f1 double"
# ------------------------------------------------------------------------------


# --- split --------------------------------------------------------------------

def largest_remainder(counts: Mapping[str, int], wanted: int) -> dict[str, int]:
    """``wanted`` rows shared out in proportion to the class sizes, ties to the first class."""
    total = sum(counts.values())
    share = {c: n * wanted // total for c, n in counts.items()}
    rest = {c: n * wanted % total for c, n in counts.items()}
    missing = wanted - sum(share.values())
    for c in sorted(counts, key=lambda c: (-rest[c], c))[:missing]:
        share[c] += 1
    return share


def stratified_split(
    df: DataFrame, label_col: str, key: str, n_start: int, test_size: float = TEST_SIZE,
    seed: int = SEED, max_classes: int = MAX_CLASSES,
) -> DataFrame:
    """Add ``split``: test, labeled or pool, each class in proportion.

    Rows of a class are ordered by a seeded hash of their key. The hashes at
    which test and labeled end are found by counting, so a class of any size is
    cut without ever being sorted as a whole. Rows without a label stay out.
    More than ``max_classes`` classes are an error: sizes are kept on the driver.
    """
    rows = nan_to_null(df).withColumn("__y", norm_label(col(label_col))).where("__y is not null")
    sizes = rows.groupBy("__y").count().limit(max_classes + 1).collect()
    if len(sizes) > max_classes:
        raise ValueError("too many classes: is this a label column?")
    counts = {r["__y"]: r["count"] for r in sizes}
    total = sum(counts.values())
    n_train = total - math.ceil(test_size * total)
    if n_start > n_train:
        raise ValueError(f"{n_start} labeled rows wanted, {n_train} training rows there")
    train = largest_remainder(counts, n_train)
    labeled = largest_remainder(train, n_start)
    test = {c: counts[c] - train[c] for c in counts}
    ranks = {c: sorted({test[c], test[c] + labeled[c]}) for c in counts}
    cuts = hash_cutoffs(rows, "__y", key, seed, ranks)
    at = {(r["g"], r["rank"]): (r["h"], r["k"]) for r in cuts.collect()}
    ends = df.sparkSession.createDataFrame(
        [
            (c, *at.get((c, test[c]), ("", None)), *at.get((c, test[c] + labeled[c]), ("", None)))
            for c in counts
        ],
        f"__y string, h_test string, k_test {rows.schema[key].dataType.simpleString()}, "
        f"h_lab string, k_lab {rows.schema[key].dataType.simpleString()}",
    )
    h = seeded_hash(key, seed)

    def upto(hash_col: str, key_col: str):
        return (h < F.col(hash_col)) | ((h == F.col(hash_col)) & (col(key) <= F.col(key_col)))

    split = F.when(upto("h_test", "k_test"), "test").when(upto("h_lab", "k_lab"), "labeled")
    # one row per class, at most max_classes
    return rows.join(F.broadcast(ends), "__y").select(
        *[col(c) for c in df.columns], split.otherwise("pool").alias("split")
    )


# --- query --------------------------------------------------------------------

def query(
    pool: DataFrame, strategy: str, n: int, key: str, proba_col: str = "proba",
    seed: int = SEED, candidate_sample: int | None = None,
) -> DataFrame:
    """The ``n`` pool rows to label next.

    entropy and margin need a probability array column; random draws by a seed
    that moves with the pool. ``candidate_sample`` scores a random part only.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy: {strategy}")
    if strategy == "random":
        return sample_n(pool, n, key, seed + pool.count())
    if candidate_sample is not None:
        size = pool.count()
        if size > candidate_sample:
            pool = sample_n(pool, candidate_sample, key, seed + size)
    p = col(proba_col)
    order = F.desc(entropy(p)) if strategy == "entropy" else F.asc(margin(p))
    return pool.orderBy(order, col(key)).limit(n)


def pool_minus_batch(pool: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    return pool.join(batch.select(col(key)), key, "left_anti")


def append_batch(labeled: DataFrame, batch: DataFrame) -> DataFrame:
    return labeled.unionByName(batch)


# --- loop ---------------------------------------------------------------------

def prepare(
    df: DataFrame, key: str, label_col: str, text_col: str | None = None, embedding_col: str | None = None
) -> DataFrame:
    """What an experiment reads of a table, written once: key, label, and terms or vector.

    Texts are cut into terms here and never read again, by whatever strategy.
    """
    if text_col is not None:
        return stage(term_counts(df, key, text_col, [label_col]), "terms")
    return stage(df.select(col(key), col(label_col), col(embedding_col)), "vectors")


def _few(rows: int):
    return F.broadcast if rows <= BROADCAST_ROWS else lambda keys: keys


def _ask_candidates(
    runs: Sequence[str], models: Sequence[Classifier], rests: Sequence[DataFrame], sizes: Sequence[int], n: int,
    key: str, seed: int, candidate_sample: int,
) -> DataFrame:
    """``(__run, key)``: as ``_ask``, every strategy scoring its own random part of what is left."""
    found = []
    for run, strategy in enumerate(runs):
        rest = rests[run]
        if strategy != BASELINE:
            if sizes[run] > candidate_sample:
                rest = sample_n(rest, candidate_sample, key, seed + sizes[run])
            rest = models[run].predict(rest)
        found.append(query(rest, strategy, n, key, seed=seed).select(F.lit(run).alias("__run"), col(key)))
    return reduce(DataFrame.unionByName, found)


def _ask(
    runs: Sequence[str], models: Sequence[Classifier], pool: DataFrame, moved: DataFrame | None, sizes: Sequence[int],
    asked: int, n: int, key: str, seed: int,
) -> DataFrame:
    """``(__run, key)``: the ``n`` rows that each strategy asks for next, from one reading of the pool.

    Every row gets its place in the order of each strategy that has not moved it
    yet; per strategy only the first ``n`` rows of a slice are shuffled.
    """
    keep = []
    if moved is not None:
        taken = moved.groupBy(col(key)).agg(F.collect_set("__run").alias("__taken"))
        pool, keep = pool.join(_few(asked)(taken), key, "left"), ["__taken"]
    learned = [run for run, strategy in enumerate(runs) if strategy != BASELINE]
    if learned:
        scored = predict_all([models[run] for run in learned], pool, keep)
    else:
        scored = pool.select(col(key), *keep)
    places = []
    for run, strategy in enumerate(runs):
        score, drawn = F.lit(0.0), F.lit("")
        if strategy == BASELINE:
            drawn = seeded_hash(key, seed + sizes[run])
        else:
            p = F.col(f"proba_{learned.index(run)}")
            score = -entropy(p) if strategy == "entropy" else margin(p)
        place = F.struct(F.lit(run).alias("__run"), score.alias("__score"), drawn.alias("__drawn"))
        places.append(place if moved is None else F.when(
            ~F.array_contains(F.coalesce("__taken", F.array().cast("array<int>")), run), place
        ))
    rows = scored.select(col(key), F.explode(F.array(*places)).alias("p")).where("p is not null").select(col(key), "p.*")
    first = top_per_group(
        rows, ["__run"], [F.asc("__score"), F.asc("__drawn"), col(key).asc()], key, n, "__place", rows=sum(sizes)
    )
    return first.select("__run", col(key))


def _cycles(
    labeled: DataFrame, pool: DataFrame, test: DataFrame, strategies: Sequence[str], key: str, label_col: str,
    text_col: str | None = None, embedding_col: str | None = None, model: str = "logreg",
    iterations: int = ITERATIONS, batch_size: int = BATCH, seed: int = SEED,
    candidate_sample: int | None = None, **fit_options,
) -> DataFrame:
    """``compare_al_strategies`` on prepared tables: all strategies take one step, then all the next.

    The start is the same, so it is fitted once; later models are fitted side by
    side. An iteration reads the pool once to score it with all models and once
    to stage the rows of all batches.
    """
    runs = list(strategies)
    spark, kind = labeled.sparkSession, labeled.schema[key].dataType.simpleString()
    labeled_rows, pool_rows = labeled.count(), pool.count()
    n_labeled, n_pool = [labeled_rows] * len(runs), [pool_rows] * len(runs)
    history, moved, batches = [], None, None
    queried = spark.createDataFrame([], f"iteration int, __run int, k {kind}")
    truth = nan_to_null(test).withColumn("y", norm_label(col(label_col))).where("y is not null")

    def learn(known: DataFrame):
        fitted = fit(known, model, key, label_col, text_col, embedding_col, **fit_options)
        return fitted, evaluate(fitted.predict(truth, ["y"]), "y", "y_pred").first()

    for iteration in range(iterations + 1):
        if batches is None:
            steps = [learn(labeled)] * len(runs)
        else:
            known = [labeled.unionByName(batches.where(F.col("__run") == r).drop("__run")) for r in range(len(runs))]
            steps = side_by_side(spark, [partial(learn, rows) for rows in known])
        for run, (_, scores) in enumerate(steps):
            history.append((run, runs[run], iteration, n_labeled[run], scores["accuracy"], scores["f1"]))
        if iteration == iterations or not any(n_pool):
            continue
        models, asked = [fitted for fitted, _ in steps], (iteration + 1) * batch_size * len(runs)
        if candidate_sample is None:
            keys = _ask(runs, models, pool, moved, n_pool, asked, batch_size, key, seed)
        else:
            rests = [pool if moved is None else pool.join(
                _few(asked)(moved.where(F.col("__run") == r)), key, "left_anti"
            ) for r in range(len(runs))]
            keys = _ask_candidates(runs, models, rests, n_pool, batch_size, key, seed, candidate_sample)
        keys = stage(keys, "keys")
        # the batches are staged with their rows: later fits read them and never the pool
        batch = stage(pool.join(_few(asked)(keys.distinct()), key).select(*pool.columns, "__run"), "batch")
        batches = batch if batches is None else batches.unionByName(batch)
        moved = keys if moved is None else moved.unionByName(keys)
        queried = queried.union(keys.select(F.lit(iteration), "__run", col(key)))
        for row in batch.groupBy("__run").count().collect():
            n_labeled[row["__run"]] += row["count"]
            n_pool[row["__run"]] -= row["count"]
    lists = queried.groupBy("iteration", "__run").agg(F.array_sort(F.collect_list("k")).alias("queried_keys"))
    found = spark.createDataFrame(history, f"__run int, {HISTORY}").join(lists, ["iteration", "__run"], "left")
    none = F.array().cast(f"array<{kind}>")
    return found.select(
        "strategy", "iteration", "n_labeled", "accuracy", "f1", F.coalesce("queried_keys", none).alias("queried_keys")
    )


def run_cycle(
    labeled: DataFrame, pool: DataFrame, test: DataFrame, strategy: str, key: str,
    label_col: str, text_col: str | None = None, embedding_col: str | None = None, **cycle,
) -> DataFrame:
    """Fit, evaluate, query, move the batch; one history row per iteration.

    ``n_labeled`` is the size before the move, and the last iteration queries
    nothing. The three tables are prepared once. An iteration reads the pool to
    score it and to stage the rows of its batch; a fit reads the labeled rows and
    the staged batches alone. The keys of a batch stay in tables and appear in
    its history row. The pool is scored as a whole unless ``candidate_sample``
    limits that to a random part.
    """
    return compare_al_strategies(
        labeled, pool, test, [strategy], key=key, label_col=label_col, text_col=text_col,
        embedding_col=embedding_col, **cycle,
    )


def compare_al_strategies(
    labeled: DataFrame, pool: DataFrame, test: DataFrame,
    strategies: Sequence[str] = ("entropy", "random"), *, key: str, label_col: str,
    text_col: str | None = None, embedding_col: str | None = None, **cycle,
) -> DataFrame:
    """Histories of several strategies from the same start, over tables prepared once.

    The strategies advance in lockstep, so a comparison reads the pool no more
    often than one run does.
    """
    for strategy in strategies:
        if strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy: {strategy}")
    parts = [prepare(df, key, label_col, text_col, embedding_col) for df in (labeled, pool, test)]
    return _cycles(*parts, strategies, key, label_col, text_col, embedding_col, **cycle)


# --- learning curves ----------------------------------------------------------

def learning_curve(history: DataFrame) -> DataFrame:
    """Points of the curve, by strategy and labeled rows."""
    return history.select("strategy", "n_labeled", "accuracy", "f1").orderBy("strategy", "n_labeled")


def curve_pivot(history: DataFrame, strategies: Sequence[str]) -> DataFrame:
    """Mean accuracy and F1 per number of labeled rows, one column pair per strategy."""
    return history.groupBy("n_labeled").agg(*[
        F.round(F.avg(F.when(F.col("strategy") == s, F.col(m))), 4).alias(f"{m}_{s}")
        for m in ("accuracy", "f1") for s in strategies
    ])


def savings(history: DataFrame, baseline: str = BASELINE) -> DataFrame:
    """Labels each strategy saves on the way to the baseline's final F1.

    ``(strategy, target_f1, n_baseline, n_reached, saved, saved_pct, final_f1)``;
    never reached leaves the savings NULL, no baseline gives no rows.
    """
    last = history.where(F.col("strategy") == baseline).agg(
        F.max_by("f1", "iteration").alias("f1"), F.max_by("n_labeled", "iteration").alias("n")
    ).first()
    others = history.where(F.col("strategy") != baseline)
    if last["n"] is None:
        others = others.limit(0)
    good = F.col("f1") >= F.lit(last["f1"]).cast("double")
    n_base = F.lit(last["n"]).cast("bigint")
    reached = others.groupBy("strategy").agg(
        F.min_by("n_labeled", F.when(good, F.col("iteration"))).alias("n_reached"),
        F.max_by("f1", "iteration").alias("final_f1"),
    )
    saved = n_base - F.col("n_reached")
    return reached.select(
        "strategy", F.lit(last["f1"]).cast("double").alias("target_f1"), n_base.alias("n_baseline"),
        F.col("n_reached").cast("bigint").alias("n_reached"), saved.alias("saved"),
        F.round(saved / n_base * 100, 1).alias("saved_pct"), "final_f1",
    )


def strategy_summary(history: DataFrame, by: Sequence[str] = ("model", "strategy")) -> DataFrame:
    """Best F1 per model and strategy."""
    return history.groupBy(*by).agg(F.max("f1").alias("max_f1"))
