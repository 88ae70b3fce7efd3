"""Bins against numpy's rule."""

import numpy as np

from winnowry.operators import profile


def test_values_on_edges_begin_a_bin(spark):
    """As numpy counts: a value that is an edge, as printed, belongs to the bin that begins there."""
    for low, high in ((0.64, 603.74), (423.61, 457.41), (0.0, 94.0)):
        values = sorted({low, high, *(low + k * ((high - low) / 20) for k in range(20)), *(round(low + (high - low) * k / 20, 2) for k in range(20))})
        df = spark.createDataFrame([(v,) for v in values], "x double")
        found = {r["bin"]: r["count"] for r in profile.histogram(df, "x", 20).collect()}
        edges = [low + k * ((high - low) / 20) for k in range(20)]
        bins = [int(np.searchsorted(edges, v, "right")) for v in values]
        assert found == {b: bins.count(b) for b in bins}
