"""Scores of probability arrays and agreement values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------
LOG_EPSILON = 1e-10
KAPPA_BANDS = (
    (0.0, "poor (worse than chance)"),
    (0.20, "slight"),
    (0.40, "fair"),
    (0.60, "moderate"),
    (0.80, "substantial"),
)
KAPPA_TOP_BAND = "almost perfect"
# ------------------------------------------------------------------------------


def entropy(p: Column) -> Column:
    """Shannon entropy of a probability array, natural logarithm."""
    terms = F.transform(p, lambda x: x * F.ln(x + F.lit(LOG_EPSILON)))
    return -F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)


def margin(p: Column) -> Column:
    """Distance between the two largest probabilities."""
    ranked = F.sort_array(p, asc=False)
    return ranked[0] - ranked[1]


def interpret_kappa(kappa: Column) -> Column:
    words = F.lit(KAPPA_TOP_BAND)
    for upper, word in reversed(KAPPA_BANDS):
        words = F.when(kappa < upper, word).otherwise(words)
    return words
