import numpy as np
import pytest
from pyspark.sql import functions as F

from winnowry.functions.scores import entropy, interpret_kappa, margin
from winnowry.functions.text import norm_label
from winnowry.operators import agreement as agr
from winnowry.operators import annotate as ann


def brute_kappa(a, b):
    n = len(a)
    if n == 0:
        return 0.0
    po = sum(x == y for x, y in zip(a, b)) / n
    pe = sum((a.count(c) / n) * (b.count(c) / n) for c in set(a) | set(b))
    return 1.0 if pe == 1.0 else round((po - pe) / (1 - pe), 4)


def pairs(spark, a, b):
    return spark.createDataFrame(list(zip(a, b)), "a string, b string")


@pytest.mark.parametrize("a,b", [
    (["x"] * 5, ["x"] * 5),
    (["x", "y", "z", "x"], ["x", "y", "x", "z"]),
    (["0"] * 9 + ["1"], ["0"] * 10),
    (["0", "1"], ["1", "0"]),
])
def test_kappa_equals_brute_force(spark, a, b):
    assert agr.cohens_kappa(pairs(spark, a, b), "a", "b").first()["kappa"] == pytest.approx(brute_kappa(a, b))
    assert agr.cohens_kappa(pairs(spark, a, a), "a", "b").first()["kappa"] == 1.0


def test_kappa_of_nothing(spark):
    row = agr.cohens_kappa(pairs(spark, [], []), "a", "b").first()
    assert (row["n"], row["kappa"], row["agreement_pct"]) == (0, 0.0, 0.0)


def test_labels_meet_across_types(spark):
    df = spark.createDataFrame([("1", 1.0), (" 1 ", 1.0), ("1.0", 1.0), ("0", 0.0)], "a string, b double")
    assert agr.cohens_kappa(df, "a", "b").first()["agreement_pct"] == 100.0
    assert agr.agreement(df, "a", "b", normalize=False).first()["agreement_pct"] == 25.0
    assert [r[0] for r in df.select(norm_label(F.col("a"))).collect()] == ["1", "1", "1", "0"]


def test_self_consistency_paradox(spark):
    rows = [(k, p, "a") for k in range(9) for p in (1, 2, 3)] + [(9, 1, "b"), (9, 2, "a"), (9, 3, "A ")]
    row = agr.self_consistency(spark.createDataFrame(rows, "key int, pass int, label string")).first()
    kappas = [brute_kappa(["a"] * 9 + ["b"], ["a"] * 10)] * 2 + [1.0]
    assert row["kappa"] == round(float(np.mean(kappas)), 4)
    assert row["kappa_std"] == round(float(np.std(kappas)), 4)
    assert (row["rows"], row["full_consensus"], row["pairs"]) == (10, 9, 3)
    assert row["row_agreement"] == 96.7 and not row["paradox"]
    two = spark.createDataFrame([r for r in rows if r[1] < 3], "key int, pass int, label string")
    assert agr.self_consistency(two).first()["paradox"]


def test_macro_f1(spark):
    y = ["a", "a", "b", "b", "c"]
    p = ["a", "b", "b", "b", "d"]
    df = spark.createDataFrame(list(zip(y, p)), "y string, p string")
    f1 = np.mean([2 / 3, 4 / 5, 0.0, 0.0])
    row = agr.evaluate(df, "y", "p").first()
    assert row["f1"] == round(float(f1), 4) and row["accuracy"] == 0.6
    assert agr.macro_f1(df, "y", "p").first()["f1"] == row["f1"]


def test_scores(spark):
    df = spark.createDataFrame([([0.5, 0.5],), ([1.0, 0.0],), ([0.2, 0.7, 0.1],)], "p array<double>")
    got = df.select(entropy(F.col("p")).alias("e"), margin(F.col("p")).alias("m")).collect()
    for r, p in zip(got, ([0.5, 0.5], [1.0, 0.0], [0.2, 0.7, 0.1])):
        p = np.array(p)
        assert r["e"] == pytest.approx(-np.sum(p * np.log(p + 1e-10)))
        assert r["m"] == pytest.approx(sorted(p)[-1] - sorted(p)[-2])
    words = spark.createDataFrame([(-0.1,), (0.0,), (0.2,), (0.5,), (0.79,), (0.8,)], "k double")
    assert [r[0].split(" ")[0] for r in words.select(interpret_kappa(F.col("k"))).collect()] == [
        "poor", "slight", "fair", "moderate", "substantial", "almost"
    ]


def test_alignment_of_odd_responses(spark):
    batched = spark.createDataFrame(
        [(k, k // 3, k % 3, 3) for k in range(12)], "k int, batch_id bigint, id int, asked int"
    )
    responses = spark.createDataFrame([
        (0, '```json\n[{"id":2,"label":"a","confidence":0.1,"reason":"r"},{"label":1},{"id":0}]\n```'),
        (1, '[{"id":2,"label":"x"},{"id":2,"label":"y","confidence":1}]'),
        (2, '{"id":0,"label":"not a list"}'),
    ], "batch_id bigint, response string")
    out = {r["k"]: (r["_label"], r["_confidence"], r["_reason"])
           for r in ann.align_responses(batched, responses).collect()}
    nobody = ("unknown", 0.0, "")
    assert [out[k] for k in range(3)] == [("a", 0.1, "r"), ("1", 0.5, ""), ("unknown", 0.5, "")]
    assert [out[k] for k in range(3, 6)] == [nobody, nobody, ("y", 1.0, "")]
    assert all(out[k] == nobody for k in range(6, 12))
    limited = ann.align_responses(batched, responses, classes=["y"])
    assert {r["_label"] for r in limited.collect()} == {"unknown", "y"}


def test_a_failing_labeler_leaves_defaults(spark):
    df = spark.range(0, 45).select("id", F.lit("t").alias("text")).withColumnRenamed("id", "k")

    def labeler(request):
        if '"id":19' in request:
            raise RuntimeError("down")
        return "[]"

    out = ann.auto_label(df, "k", labeler, classes=["a"])
    assert {(r["_label"], r["_confidence"]) for r in out.collect()} == {("unknown", 0.0)}
    assert out.count() == 45 and out.columns == ["k", "text", "_label", "_confidence", "_reason"]


def test_confidence_without_a_column_and_all_zero(spark):
    df = spark.range(0, 4)
    row = ann.confidence_stats(df).first()
    assert (row["mean"], row["median"], row["low_0_6"]) == (0.5, 0.5, 4)
    zero = df.withColumn("_confidence", F.lit(0.0))
    assert ann.confidence_stats(zero).first()["all_zero"]


def test_distribution_counts_unlabeled_rows_in_the_total(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "_label string")
    assert [tuple(r) for r in ann.label_distribution(df).collect()] == [("a", 2, 50.0), ("b", 1, 25.0)]


def test_check_quality_without_human_or_consistency(spark):
    df = spark.createDataFrame([("a", 0.9), ("b", 0.3)], "_label string, _confidence double")
    row = ann.check_quality(df, label_maps=True).first()
    assert "label_distribution" not in ann.check_quality(df).columns
    assert row["kappa"] == 0.0 and row["kappa_interpretation"] == "slight"
    assert row["label_distribution"] == {"a": 1, "b": 1} and row["label_distribution_pct"]["a"] == 50.0


def test_unknown_labels_get_no_prediction(spark):
    import json

    df = spark.createDataFrame(
        [(1, "t", "unknown"), (2, "t", "nan"), (3, "t", ""), (4, "t", None), (5, "ab", "x")],
        "k int, text string, _label string",
    )
    tasks = {r["k"]: json.loads(r["task"]) for r in ann.to_labelstudio(df, "k").collect()}
    assert all(tasks[k]["predictions"] == [] for k in (1, 2, 3, 4))
    result = tasks[5]["predictions"][0]["result"][0]
    assert result["value"] == {"choices": ["x"]} and result["score"] == 0.5
    ner = json.loads(ann.to_labelstudio(df.where("k = 5"), "k", task_type="ner").first()["task"])
    assert ner["predictions"][0]["result"][0]["value"] == {"start": 0, "end": 2, "labels": ["x"]}


def test_the_last_batch_is_short(spark):
    rows = ann.assign_batches(spark.range(0, 45).withColumnRenamed("id", "k"), "k").collect()
    assert sorted({(r["batch_id"], r["asked"]) for r in rows}) == [(0, 20), (1, 20), (2, 5)]
    assert all(r["k"] == r["batch_id"] * 20 + r["id"] for r in rows)
