"""Repeated labeling: requests are moved once."""

import json

from winnowry.operators import annotate


def test_passes_move_the_requests_once(spark, monkeypatch):
    """All passes ask from one reading of the requests; every pass has its own answers."""
    runs, plain = [], annotate.run_passes
    monkeypatch.setattr(annotate, "run_passes", lambda *a, **b: (runs.append(list(a[2])), plain(*a, **b))[1])

    def labeler(request):
        return json.dumps([{"id": t["id"], "label": t["text"][:1]} for t in json.loads(request)["texts"]])

    rows = spark.createDataFrame([(i, f"{i % 3} text", str(i % 3)) for i in range(45)], "k int, text string, _label string")
    found = annotate.consistency_passes(rows, "k", labeler, "text", passes=4).collect()
    assert sorted((r["key"], r["pass"], r["label"]) for r in found) == [(i, p, str(i % 3)) for i in range(45) for p in range(1, 5)]
    assert runs == [[2, 3, 4]]
    assert annotate.consistency_passes(rows, "k", labeler, "text", passes=1).count() == 45
