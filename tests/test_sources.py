import json
import os

import pytest
from pyspark.sql import functions as F

from winnowry.operators import catalog as cat
from winnowry.operators import columns as cols
from winnowry.plans import active_learning, annotation, collection, quality
from winnowry.sources import catalogs as src
from winnowry.sources import files


def pages(spark, *bodies):
    return spark.createDataFrame([(json.dumps(b) if not isinstance(b, str) else b,) for b in bodies], "value string")


def test_zenodo_record_without_anything(spark):
    row = src.zenodo_catalog(pages(spark, {"hits": {"hits": [{"id": 7}]}}, {"hits": {}}, "not json")).collect()
    assert len(row) == 1
    r = row[0]
    assert (r["id"], r["size_category"], r["license"], r["tags"], r["downloads"]) == ("zenodo:7", "0 MB", "unknown", [], 0)


def test_hub_sizes(spark):
    mib = 1024 * 1024
    df = src.hf_catalog(pages(
        spark, {"id": "a"}, {"id": "b", "siblings": [{"size": 3 * mib // 2}, {}], "tags": ["license:mit", "license:x"]},
        {"id": "c", "siblings": [{"size": 3 * 1024 * mib}], "tags": ["size_categories:1K<n<10K"]},
    ))
    got = {r["id"]: (r["size_category"], r["license"]) for r in df.collect()}
    assert got == {"a": ("unknown", "unknown"), "b": ("1.5 MB", "mit"), "c": ("3.00 GB | 1K<n<10K", "unknown")}


def test_kaggle_without_reference_is_dropped(spark):
    df = src.kaggle_catalog(pages(spark, [{"title": "t"}, {"ownerRef": "o"}, {"ref": "/a/b/", "totalDownloads": 3}]))
    assert sorted((r["id"], r["name"], r["downloads"]) for r in df.collect()) == [("a/b", "a/b", 3), ("o", "o", 0)]


def test_generic_paths(spark):
    listed = pages(spark, {"a": {"b": [{"x": 1, "t": "one"}, {"x": 0, "t": ""}]}})
    got = src.generic_catalog(listed, "a.b", {"id": "x", "name": "t"}, "My Api").orderBy("name").collect()
    assert [r["name"] for r in got] == [None, "one"] and got[1]["id"] == "1"
    assert got[0]["id"].startswith("my_api:") and got[0]["source"] == "my_api"
    assert src.generic_catalog(listed, "no.path", {"id": "x"}, "s").count() == 0
    assert src.generic_catalog(pages(spark, [{"x": 5}]), "", {"id": "x"}, "s").first()["id"] == "5"
    assert src.generic_catalog(pages(spark, {"x": 6}), "", {"id": "x"}, "s").first()["id"] == "6"


def test_search_with_copies_of_one_dataset(spark):
    rows = [("hot", "cats", 5)] * 50 + [("b", "cat dog", 9), ("c", "dog", 1)]
    df = spark.createDataFrame(rows, "id string, name string, downloads bigint")
    got = sorted((r["id"], r["term"]) for r in cat.search_catalog(df, ["cat", "dog"], 2).collect())
    assert got == [("b", "cat"), ("c", "dog"), ("hot", "cat")]
    assert [r["id"] for r in cat.search_catalog(df, ["cat"], 1).collect()] == ["b"]


def test_pick(spark):
    df = spark.createDataFrame([("a", 9.0), ("b", None), ("c", 5.0)], "id string, relevance_score double")
    ids = lambda choice: sorted(r["id"] for r in cat.pick(df, choice).collect())
    assert ids("1,2") == ["a", "c"] and ids("all") == ["a", "b", "c"] and ids("q") == ids("") == ids("x") == []
    for bad in ("9", "0"):
        with pytest.raises(ValueError):
            cat.pick(df, bad)


def test_summary_of_nothing(spark):
    df = spark.createDataFrame([], "id string, name string, source string, relevance_score double, ml_tasks array<string>")
    got = {(r["section"], r["item"]): r["value"] for r in cat.catalog_summary(df, ["zenodo"]).collect()}
    assert got == {("total", "datasets"): 0.0, ("avg_relevance_score", ""): 0.0, ("search_limits", "zenodo"): 0.0}


def test_scan_any_unites_columns(spark, folder):
    with open(f"{folder}/a.csv", "w") as f:
        f.write('text,label\n"hi, there",1\n')
    with open(f"{folder}/b.csv", "w") as f:
        f.write("label,text\n2,yo\n")
    with open(f"{folder}/c.jsonl", "w") as f:
        f.write('{"text":"j","extra":true}\n')
    got = files.scan_any(spark, [f"{folder}/a.csv", f"{folder}/b.csv", f"{folder}/c.jsonl"]).collect()
    assert sorted((r["text"], r["label"], r["extra"]) for r in got) == [
        ("hi, there", 1, None), ("j", None, True), ("yo", 2, None)
    ]
    with pytest.raises(ValueError):
        files.scan_any(spark, [f"{folder}/x.xlsx"])


def test_stage_inputs_in_order(spark, folder):
    with pytest.raises(FileNotFoundError):
        files.resolve_input(spark, folder, "annotation")
    one = spark.range(1)
    one.write.parquet(f"{folder}/data/raw/other.parquet")
    assert files.resolve_input(spark, folder, "quality").endswith("raw/other.parquet")
    one.write.parquet(f"{folder}/data/raw/combined.parquet")
    assert files.resolve_input(spark, folder, "annotation").endswith("raw/combined.parquet")
    one.write.parquet(f"{folder}/data/clean/combined_clean.parquet")
    assert files.resolve_input(spark, folder, "annotation").endswith("combined_clean.parquet")
    assert files.resolve_input(spark, folder, "quality").endswith("raw/combined.parquet")
    assert files.resolve_input(spark, folder, "quality", "x.parquet") == "x.parquet"


def test_staged_tables_are_dropped(spark):
    from winnowry import staging

    staging.drop_staged(spark)
    path = staging.stage(spark.range(3)).inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert os.path.isdir(path) and staging.drop_staged(spark) == 1 and not os.path.isdir(path)


def test_column_finders(spark):
    df = spark.createDataFrame([("aaaa", "b" * 9, 1), ("aaaaa", "b", 2)], "s string, t string, n int")
    assert cols.find_text_col(df) == "t"
    assert cols.find_text_col(df, "median") == "t"
    assert cols.find_text_col(df.withColumnRenamed("s", "comment")) == "comment"
    assert cols.find_text_col(df.select("n")) == "n"
    with pytest.raises(ValueError):
        cols.find_text_col(df.select("n"), "median")
    assert cols.find_label_col(df) == "s"
    many = spark.range(100)
    with pytest.raises(ValueError):
        cols.find_label_col(many)


def test_infer_classes_sorts_by_value(spark):
    df = spark.createDataFrame([("t", 10.0), ("u", 2.0), ("v", float("nan"))], "text string, label double")
    assert [r["class"] for r in cols.infer_classes(df, "text").collect()] == ["2", "10"]


def by_length():
    def label(request):
        texts = json.loads(request)["texts"]
        return json.dumps([{"id": t["id"], "label": str(len(t["text"]) % 2), "confidence": 0.8} for t in texts])

    return label


def test_the_four_stages(spark, folder):
    landed = f"{folder}/landed"
    os.makedirs(landed)
    df = spark.range(0, 60).select(
        F.concat(F.lit("w"), F.col("id") % 25, F.when(F.col("id") % 2 == 0, " even word").otherwise(" odd")).alias("body"),
        (F.col("id") % 2).alias("cls"), F.col("id").alias("k"),
    )
    df.where("k < 40").write.parquet(f"{landed}/a.parquet")
    df.where("k >= 40").write.option("header", True).csv(f"{landed}/b.csv")
    mapping = {"text": "body", "label": ("cls", "int"), "k": ("k", "bigint")}
    counts = collection.combine(spark, folder, [
        ("huggingface", "o/a", [f"{landed}/a.parquet"], mapping), ("kaggle", "o/b", [f"{landed}/b.csv"], mapping),
    ])
    assert {r["source"]: r["rows"] for r in counts.collect()} == {"huggingface": 40, "kaggle": 20}
    report = {(r["section"], r["metric"]): r["value"] for r in quality.report(spark, folder).collect()}
    assert report["duplicates", "duplicates"] == 0
    table = quality.clean(spark, folder, "medium", dedup_key="k", protected_cols=["k"])
    assert {r["metric"]: r["after"] for r in table.collect()}["Rows"] == 60
    metrics = annotation.annotate(spark, folder, "k", by_length(), passes=2, consistency_rows=10).first()
    assert metrics["total_labeled"] == 60 and metrics["kappa"] == 1.0
    tasks = spark.read.text(f"{folder}/{annotation.TASKS}")
    assert tasks.count() == 60
    found = active_learning.experiment(
        spark, folder, "k", n_start=10, strategies=["random", "entropy"], iterations=1, batch_size=5
    )
    history = found["history"].where("strategy = 'random'")
    assert found["curve"].count() == 4 and [r["strategy"] for r in found["savings"].collect()] == ["entropy"]
    assert [r["n_labeled"] for r in history.orderBy("iteration").collect()] == [10, 15]


def test_proposals(spark, folder):
    df = spark.range(0, 30).select("id", F.when(F.col("id") % 3 > 0, F.col("id") * 1.0).alias("x"), F.lit("a").alias("s"))
    df.write.parquet(f"{folder}/data/raw/combined.parquet")
    table = quality.proposals(spark, folder, order_col="id", key=["id"])
    after = {(r["strategy"], r["metric"]): r["after"] for r in table.collect()}
    assert after["strict", "Missing values"] == 0 and after["mild", "Rows"] == 30


def test_ranked_catalog(spark):
    one = spark.createDataFrame([("a", "Cats!"), ("b", "Dogs")], "id string, name string").withColumn("downloads", F.lit(1))
    two = spark.createDataFrame([("z", "cats")], "id string, name string").withColumn("downloads", F.lit(5))
    scores = spark.createDataFrame([("a", 8.0), ("z", 8.0), ("b", 3.0)], "id string, relevance_score double")
    assert [r["id"] for r in collection.ranked_catalog([one, two], scores).collect()] == ["z"]


def search_rows(spark):
    names = ["Cat pictures", "dogs, cats", None, "été 😀 set", "a", "", "aaaa", "CATALOG"]
    rows = [(f"id/{i % 40}", names[i % len(names)], i % 7) for i in range(80)] + [(None, "cat", 3), ("x", None, None)]
    return spark.createDataFrame(rows, "id string, name string, downloads long")


def test_indexed_search_finds_what_testing_every_text_finds(spark):
    df = search_rows(spark)
    terms = ["cat", "CAT", "cat", "a", "aa", "aaa", "aaaaa", "é", "😀", "😀 s", "dogs, c", "nothing", "id/3", "/1", " "]
    for limit in (1, 3, 100):
        inline = cat.search_catalog(df, terms, limit)
        indexed = cat.search_catalog(df, terms, limit, inline_terms=0)
        assert indexed.columns == inline.columns
        assert sorted(map(str, indexed.collect())) == sorted(map(str, inline.collect()))
    assert cat.search_catalog(df.limit(0), terms, 3, inline_terms=0).count() == 0
    with_empty = [cat.search_catalog(df, ["", "cat"], 5, n).collect() for n in (0, 9)]
    assert sorted(map(str, with_empty[0])) == sorted(map(str, with_empty[1]))


def test_a_common_text_and_a_hot_run_of_characters(spark, monkeypatch):
    """Copies of one text are looked up once; the plan does not grow with the terms."""
    from winnowry.operators import joins
    monkeypatch.setattr(joins, "HOT_KEYS", 10)
    df = spark.range(3000).selectExpr("'same' AS id", "'one name of all' AS name", "id AS downloads").unionByName(
        spark.range(300).selectExpr("'d' || id AS id", "'name ' || id AS name", "id AS downloads"))
    terms = ["name " + str(i) for i in range(200)] + ["one name"]
    found = cat.search_catalog(df, terms, 2)
    want = cat.search_catalog(df, terms, 2, inline_terms=1000)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    assert "name 137" not in found._jdf.queryExecution().analyzed().toString()
