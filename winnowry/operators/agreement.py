"""Agreement between annotators and between predictions and truth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnowry.functions.text import norm_label
from winnowry.schema import col, nan_to_null


def confusion(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts per pair of labels, ``(by…, a, b, count)``."""
    return df.groupBy(
        *[col(c) for c in by], col(a).alias("a"), col(b).alias("b")
    ).agg(F.count(F.lit(1)).alias("count"))


def class_marginals(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Per class: times given by ``a``, by ``b`` and by both, from one small table."""
    zero = F.lit(0).cast("bigint")
    both = F.when(F.col("a") == F.col("b"), F.col("count")).otherwise(zero)
    sides = F.explode(F.array(
        F.struct(F.col("a").alias("class"), F.col("count").alias("na"), zero.alias("nb"),
                 both.alias("nab")),
        F.struct(F.col("b").alias("class"), zero.alias("na"), F.col("count").alias("nb"),
                 zero.alias("nab")),
    ))
    return (
        confusion(df, a, b, by).select(*by, sides.alias("s"))
        .groupBy(*by, F.col("s.class").alias("class"))
        .agg(F.sum("s.na").alias("n_a"), F.sum("s.nb").alias("n_b"), F.sum("s.nab").alias("n_both"))
    )


def _labels_as_text(df: DataFrame, a: str, b: str, normalize: bool, by: Sequence[str] = ()) -> DataFrame:
    """Pairs with both labels; a side without a label (NULL or NaN) is no judgement to compare."""
    df = nan_to_null(df)
    df = df.where(col(a).isNotNull() & col(b).isNotNull())
    if not normalize:
        if df.schema[a].dataType == df.schema[b].dataType:
            return df
        # unlike types are compared as written: the number 1 is not the text " 1"
        return df.select(
            *[col(c) for c in by], col(a).cast("string").alias(a), col(b).cast("string").alias(b)
        )
    return df.select(
        *[col(c) for c in by], norm_label(col(a)).alias(a), norm_label(col(b)).alias(b)
    )


def _kappa(pairs: DataFrame, a: str, b: str, by: Sequence[str]) -> DataFrame:
    """``(by…, n, kappa, observed)`` with the share of equal pairs unrounded."""
    sums = class_marginals(pairs, a, b, by).groupBy(*by).agg(
        F.coalesce(F.sum("n_a"), F.lit(0)).cast("bigint").alias("n"),
        F.sum("n_both").alias("same"),
        F.sum(F.col("n_a").cast("double") * F.col("n_b").cast("double")).alias("cross"),
    )
    n = F.col("n").cast("double")
    expected = F.col("cross") / (n * n)
    observed = F.col("same") / n
    kappa = (
        F.when(F.col("n") == 0, F.lit(0.0))
        .when(F.col("cross") == n * n, F.lit(1.0))
        .otherwise(F.round((observed - expected) / (1 - expected), 4))
    )
    share = F.when(F.col("n") == 0, F.lit(0.0)).otherwise(observed)
    return sums.select(*by, "n", kappa.alias("kappa"), share.alias("observed"))


def cohens_kappa(
    df: DataFrame, a: str, b: str, by: Sequence[str] = (), normalize: bool = True
) -> DataFrame:
    """``(by…, n, kappa, agreement_pct)``; no rows give kappa 0, one shared class gives 1."""
    found = _kappa(_labels_as_text(df, a, b, normalize, by), a, b, by)
    return found.select(
        *by, "n", "kappa", F.round(F.col("observed") * 100, 1).alias("agreement_pct")
    )


def agreement(df: DataFrame, a: str, b: str, by: Sequence[str] = (), normalize: bool = True) -> DataFrame:
    """Share of equal pairs in percent; ``n`` counts the pairs with both labels."""
    pairs = _labels_as_text(df, a, b, normalize, by)
    same = F.avg(F.when(col(a) == col(b), 1.0).otherwise(0.0))
    return pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.round(same * 100, 1).alias("agreement_pct")
    )


# --- several labeling passes --------------------------------------------------

def pass_pairs(
    passes: DataFrame, key_col: str = "key", pass_col: str = "pass", label_col: str = "label"
) -> DataFrame:
    """Unordered pairs of passes per row, ``(key, pass_a, pass_b, label_a, label_b)``.

    A row has one label per pass, so the array per key is as short as the number
    of labeling passes; no self-join is needed.
    """
    given = passes.groupBy(col(key_col).alias("key")).agg(
        F.array_sort(F.collect_list(F.struct(
            col(pass_col).alias("pass"), norm_label(col(label_col), lower=True).alias("label")
        ))).alias("given")
    )
    later = given.select("key", "given", F.posexplode("given").alias("at", "first"))
    rest = F.explode(F.slice("given", F.col("at") + 2, F.size("given"))).alias("second")
    return later.select("key", "first", rest).select(
        "key", F.col("first.pass").alias("pass_a"), F.col("second.pass").alias("pass_b"),
        F.col("first.label").alias("label_a"), F.col("second.label").alias("label_b"),
    )


def kappa_by_pass(passes: DataFrame, **names: str) -> DataFrame:
    """Kappa and agreement of every pair of passes."""
    return cohens_kappa(
        pass_pairs(passes, **names), "label_a", "label_b", ["pass_a", "pass_b"], normalize=False
    )


def majority_share(
    passes: DataFrame, key_col: str = "key", label_col: str = "label"
) -> DataFrame:
    """Per row: share of passes that gave the most frequent label."""
    votes = passes.groupBy(
        col(key_col).alias("key"), norm_label(col(label_col), lower=True).alias("label")
    ).agg(F.count(F.lit(1)).alias("votes"))
    return votes.groupBy("key").agg(
        F.max("votes").alias("majority"), F.sum("votes").alias("passes")
    ).withColumn("share", F.col("majority") / F.col("passes"))


def row_agreement(passes: DataFrame, key_col: str = "key", label_col: str = "label") -> DataFrame:
    """Mean majority share and the rows on which all passes agree."""
    full = F.count_if(F.col("majority") == F.col("passes"))
    return majority_share(passes, key_col, label_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg("share") * 100, 1).alias("row_agreement"),
        full.alias("full_consensus"),
        F.round(full / F.count(F.lit(1)) * 100, 1).alias("full_consensus_pct"),
    )


def self_consistency(
    passes: DataFrame, key_col: str = "key", pass_col: str = "pass", label_col: str = "label"
) -> DataFrame:
    """One row: mean and spread of pairwise kappa, agreements, consensus, paradox flag."""
    pairs = pass_pairs(passes, key_col, pass_col, label_col)
    pairwise = _kappa(pairs, "label_a", "label_b", ["pass_a", "pass_b"]).agg(
        F.count(F.lit(1)).alias("pairs"),
        F.round(F.avg("kappa"), 4).alias("kappa"),
        F.round(F.stddev_pop("kappa"), 4).alias("kappa_std"),
        F.round(F.avg("observed") * 100, 1).alias("pairwise_agreement"),
    ).withColumn("one", F.lit(1))
    rows = row_agreement(passes, key_col, label_col).withColumn("one", F.lit(1))
    paradox = (F.col("kappa") == 0) & (F.col("row_agreement") > 50)
    return pairwise.join(rows, "one").drop("one").withColumn("paradox", paradox)


# --- predictions --------------------------------------------------------------

def _judged(df: DataFrame, y: str, y_pred: str) -> DataFrame:
    """Rows with both a true and a predicted class."""
    return nan_to_null(df).where(col(y).isNotNull() & col(y_pred).isNotNull())


def accuracy(df: DataFrame, y: str, y_pred: str) -> DataFrame:
    same = F.avg(F.when(col(y) == col(y_pred), 1.0).otherwise(0.0))
    return _judged(df, y, y_pred).agg(F.round(same, 4).alias("accuracy"))


def macro_f1(df: DataFrame, y: str, y_pred: str) -> DataFrame:
    """Unweighted mean F1 over all true and predicted classes."""
    f1 = 2 * F.col("n_both") / (F.col("n_a") + F.col("n_b"))
    return class_marginals(_judged(df, y, y_pred), y, y_pred).agg(F.round(F.avg(f1), 4).alias("f1"))


def evaluate(df: DataFrame, y: str, y_pred: str) -> DataFrame:
    """Accuracy and macro F1 from a single pass over the predictions."""
    f1 = 2 * F.col("n_both") / (F.col("n_a") + F.col("n_b"))
    return class_marginals(_judged(df, y, y_pred), y, y_pred).agg(
        F.round(F.sum("n_both") / F.sum("n_a"), 4).alias("accuracy"),
        F.round(F.avg(f1), 4).alias("f1"),
        F.sum("n_a").alias("n"),
    )
