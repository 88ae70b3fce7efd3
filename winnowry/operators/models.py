"""Classifiers on Spark ML with one interface: fit, then scored rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnowry.functions.text import norm_label
from winnowry.jobs import side_by_side
from winnowry.operators.features import (
    BROADCAST_TERMS, COUNTS, ROW, TERMS, TfidfModel, fold_columns, numbered, term_counts, tfidf_fit, tfidf_transform,
)
from winnowry.operators.forest import fit_forest
from winnowry.operators.ranking import seeded_hash
from winnowry.operators.row_space import fit_calibrated_svm, fit_logreg, mean_shares
from winnowry.schema import col, nan_to_null
from winnowry.staging import DENSE, drop, stage

# --- fixed values -------------------------------------------------------------
MAX_ITERATIONS = 1000
SVM_ITERATIONS = 2000
SVM_TOLERANCE = 1e-3
INVERSE_PENALTY = 1.0
TREES = 100
FOLDS = 5
SEED = 42
# ------------------------------------------------------------------------------

MAX_DEPTH = 30
TOLERANCE = 1e-6
ROWS_PER_PARTITION = 5_000
FOREST_ROWS = 500  # rows of a forest's task: each descends all trees
MAX_MODEL_CLASSES = 1000
MODELS = ("logreg", "svm", "rf", "embedding")


def balanced_weights(counts: dict[str, int]) -> dict[str, float]:
    """n / (classes x class size): every class weighs the same in total."""
    total = sum(counts.values())
    return {c: total / (len(counts) * n) for c, n in counts.items()}


def lookup(value: Column, table: dict[str, float]) -> Column:
    """Small driver-side table as an expression, NULL for an unknown key."""
    return F.element_at(
        F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), value
    )


@dataclass
class Classifier:
    """A fitted model: ``predict`` adds ``proba`` (array) and ``y_pred`` (label)."""

    kind: str
    classes: list[str]
    key: str
    text_col: str | None
    embedding_col: str | None
    tfidf: TfidfModel | None = None
    score: Callable[[DataFrame], DataFrame] = field(default=lambda df: df)

    def features(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        if self.tfidf is not None:
            return tfidf_transform(df, self.tfidf, self.key, self.text_col, keep)
        return df.select(
            *[col(c) for c in (self.key, *keep)], array_to_vector(col(self.embedding_col)).alias("features")
        )

    def predict(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``(key, keep…, proba, y_pred)``, classes in the order of ``classes``."""
        scored = self.score(self.features(df, keep))
        best = F.array_position("proba", F.array_max("proba")).cast("int")
        names = F.array(*[F.lit(c) for c in self.classes])
        return scored.select(
            *[col(c) for c in (self.key, *keep)], "proba", F.element_at(names, best).alias("y_pred")
        )


def predict_all(models: Sequence[Classifier], df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``(key, keep…, proba_0, proba_1…)``: the probabilities of several models from one reading of ``df``.

    The models share key and input columns; text models read a frame that has its
    terms already (``term_counts``), which pass from model to model.
    """
    names, found = [col(c) for c in (models[0].key, *keep)], []
    inputs = [TERMS, COUNTS] if models[0].tfidf is not None else [models[0].embedding_col]
    carried = [f"__carried_{i}" for i in range(len(inputs))]
    for number, model in enumerate(models):
        given = df.withColumns({c: col(name) for c, name in zip(carried, inputs)})
        scored = model.score(model.features(given, [*keep, *found, *carried]))
        df = scored.select(
            *names, *found, F.col("proba").alias(f"proba_{number}"),
            *[F.col(c).alias(name) for c, name in zip(carried, inputs)],
        )
        found.append(f"proba_{number}")
    return df.select(*names, *found)


def fit(
    labeled: DataFrame, kind: str, key: str, label_col: str, text_col: str | None = None,
    embedding_col: str | None = None, trees: int = TREES, max_depth: int = MAX_DEPTH,
    max_terms: int | None = None, min_df: int = 1, max_classes: int = MAX_MODEL_CLASSES,
    rows_per_partition: int = ROWS_PER_PARTITION, tolerance: float = TOLERANCE, fold_terms: int = BROADCAST_TERMS,
) -> Classifier:
    """Train on the labeled rows; rows without a label take no part.

    The vocabulary has all terms in ``min_df`` texts or more, or the ``max_terms``
    most frequent of them. More than ``max_classes`` classes are an error.
    ``rows_per_partition`` sets how many rows a solver's task reads, ``tolerance``
    when a logistic regression has converged. A linear model of more than
    ``fold_terms`` terms has one feature for terms alike in all labeled rows, and is
    solved in the space of its rows, if they are fewer.
    """
    if kind not in MODELS:
        raise ValueError(f"unknown model: {kind}")
    rows = nan_to_null(labeled).withColumn("__y", norm_label(col(label_col))).where("__y is not null")
    sizes = rows.groupBy("__y").count().limit(max_classes + 1).collect()
    counts = {r["__y"]: r["count"] for r in sorted(sizes, key=lambda r: r["__y"])}
    if len(counts) < 2:
        raise ValueError("training needs at least two classes")
    if len(counts) > max_classes:
        raise ValueError("too many classes: is this a label column?")
    classes = list(counts)
    if kind != "embedding":
        # terms are counted once: for the vocabulary, for the features that terms share, and for the vectors
        rows = numbered(term_counts(rows, key, text_col, ["__y"]))
    linear = kind in ("logreg", "svm")
    tfidf = None if kind == "embedding" else tfidf_fit(rows, key, text_col, max_terms, min_df, linear)
    if linear and tfidf.size > fold_terms:
        tfidf = fold_columns(tfidf)
    model = Classifier(kind, classes, key, text_col, embedding_col, tfidf)
    weight = balanced_weights(counts)
    position = {c: float(i) for i, c in enumerate(classes)}
    # every solver iteration reads the features again: write them once
    train = stage(
        model.features(rows, ["__y"]).select(
            col(key).alias("k"), "features", lookup(F.col("__y"), position).alias("label"),
            lookup(F.col("__y"), weight).alias("weight"), F.monotonically_increasing_id().alias("row"),
        ),
        "train", DENSE,
    )
    if kind != "embedding" and ROW not in labeled.columns:
        drop(rows)  # the counted terms: many times what is kept of them
    n = sum(counts.values())
    # a few hundred labeled rows are not worth a task per core in each iteration
    if kind == "rf":
        rows_per_partition = min(rows_per_partition, FOREST_ROWS)
    penalty = 1.0 / (INVERSE_PENALTY * n)
    if linear and tfidf.columns is not None and n < tfidf.size:
        if kind == "logreg":
            model.score = fit_logreg(train, len(classes), penalty, tolerance, MAX_ITERATIONS)
        else:
            model.score = fit_calibrated_svm(_folds(train), len(classes), FOLDS, penalty, SVM_TOLERANCE, SVM_ITERATIONS)
        return model
    train = train.coalesce(max(1, n // rows_per_partition)).cache()
    try:
        if kind in ("logreg", "embedding"):
            model.score = _fit_logreg(train, n, tolerance)
        elif kind == "rf":
            model.score = fit_forest(train, tfidf.size, len(classes), trees, max_depth, SEED)
        else:
            model.score = _fit_calibrated_svm(train, n, len(classes))
    finally:
        train.unpersist()
    return model


def linear_classifier(
    classes: Sequence[str], coefficients: Sequence[Sequence[float]], intercepts: Sequence[float], key: str,
    embedding_col: str,
) -> Classifier:
    """A classifier from given coefficients, one row per class: probabilities by softmax of the margins."""
    weights = F.lit([list(map(float, row)) for row in coefficients])
    given = F.lit(list(map(float, intercepts)))

    def score(df: DataFrame) -> DataFrame:
        x = F.col("__x")
        margins = F.zip_with(weights, given, lambda row, b: b + F.aggregate(
            F.zip_with(row, x, lambda w, v: w * v), F.lit(0.0), lambda total, v: total + v
        ))
        scored = df.withColumn("__x", vector_to_array("features")).withColumn("__m", margins)
        shares = F.transform("__m", lambda m: F.exp(m - F.array_max("__m")))
        total = F.aggregate("__e", F.lit(0.0), lambda t, e: t + e)
        return scored.withColumn("__e", shares).withColumn("proba", F.transform("__e", lambda e: e / total))

    return Classifier("given", list(classes), key, None, embedding_col, score=score)


def _fit_logreg(train: DataFrame, n: int, tolerance: float) -> Callable[[DataFrame], DataFrame]:
    fitted = LogisticRegression(
        weightCol="weight", regParam=1.0 / (INVERSE_PENALTY * n), standardization=False,
        maxIter=MAX_ITERATIONS, tol=tolerance,
    ).fit(train)
    return lambda df: fitted.transform(df).withColumn("proba", vector_to_array("probability"))


def _folds(train: DataFrame) -> DataFrame:
    """``train`` with the fold of each row, by its key; rows without a key are one fold's."""
    digits = F.coalesce(F.substring(seeded_hash("k", SEED), 1, 8), F.lit("0"))
    return train.withColumn("fold", F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(FOLDS)))


def _fit_calibrated_svm(train: DataFrame, n: int, k: int) -> Callable[[DataFrame], DataFrame]:
    """Linear SVM per class and fold, its margin turned into a probability.

    Each fold's sigmoid is fitted on the rows its SVM has not seen; the folds'
    probabilities are averaged and, over more than two classes, normalised.
    """
    folds = _folds(train)

    def fit_fold(fold: int) -> list[tuple]:
        seen, held = folds.where(F.col("fold") != fold), folds.where(F.col("fold") == fold)
        per_class = []
        for c in ([1] if k == 2 else range(k)):
            is_c = F.when(F.col("label") == c, 1.0).otherwise(0.0)
            svm = LinearSVC(
                weightCol="weight", regParam=1.0 / (INVERSE_PENALTY * n), standardization=False,
                maxIter=SVM_ITERATIONS, tol=SVM_TOLERANCE,
            ).fit(seen.withColumn("label", is_c))
            per_class.append((svm, *_sigmoid(svm, held.withColumn("label", is_c))))
        return per_class

    # the folds do not depend on each other, so their jobs may overlap
    lines = side_by_side(train.sparkSession, [partial(fit_fold, f) for f in range(FOLDS)])

    def score(df: DataFrame) -> DataFrame:
        odds = []
        for number, per_class in enumerate(lines):
            odds.append([])
            for c, (svm, slope, offset) in enumerate(per_class):
                name = f"__raw_{number}_{c}"
                df = svm.transform(df).withColumn(
                    name, vector_to_array("rawPrediction")[1]
                ).drop("rawPrediction", "prediction")
                odds[-1].append(1.0 / (1.0 + F.exp(-(F.col(name) * slope + offset))))
        return df.withColumn("proba", mean_shares(odds))

    return score


def _sigmoid(svm, held: DataFrame) -> tuple[float, float]:
    """Slope and offset of the probability of a margin, with smoothed targets."""
    margins = svm.transform(held).select(
        "label", vector_to_array("rawPrediction")[1].alias("margin")
    )
    counts = {r["label"]: r["count"] for r in margins.groupBy("label").count().collect()}
    yes, no = counts.get(1.0, 0), counts.get(0.0, 0)
    high, low = (yes + 1.0) / (yes + 2.0), 1.0 / (no + 2.0)
    target = F.when(F.col("label") == 1.0, high).otherwise(low)
    soft = margins.select("margin", F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), target.alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (1.0 - target).alias("weight")),
    )).alias("t")).select(array_to_vector(F.array("margin")).alias("features"), "t.label", "t.weight")
    fitted = LogisticRegression(weightCol="weight", regParam=0.0, standardization=False).fit(soft)
    return float(fitted.coefficients[0]), float(fitted.intercept)
