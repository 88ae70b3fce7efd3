import numpy as np
import pytest
from pyspark.sql import functions as F

from winnowry.operators import features as feat
from winnowry.operators import learn, models


def points(spark, n=120, k=2, seed=0):
    """Noisy clusters: key, vector, label."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        c = i % k
        rows.append((i, [float(x) for x in rng.normal(c * 1.5, 1.0, 3)], f"c{c}"))
    return spark.createDataFrame(rows, "k int, v array<float>, label string")


def brute_logreg(x, y, w):
    """Newton steps on sum of weighted losses plus half the squared norm, free intercept."""
    z = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    b = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ b))
        grad = z.T @ (w * (p - y)) + penalty @ b
        hess = (z * (w * p * (1 - p))[:, None]).T @ z + penalty
        b = b - np.linalg.solve(hess, grad)
    return b


def test_logreg_solves_the_same_problem(spark):
    df = points(spark).where("k < 60 or label = 'c0'")
    rows = df.orderBy("k").collect()
    x = np.array([r["v"] for r in rows])
    y = np.array([r["label"] == "c1" for r in rows], dtype=float)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    b = brute_logreg(x, y, w)
    want = 1 / (1 + np.exp(-(x @ b[:-1] + b[-1])))
    model = models.fit(df, "embedding", "k", "label", embedding_col="v")
    got = [r["proba"][1] for r in model.predict(df).orderBy("k").collect()]
    assert np.allclose(got, want, atol=1e-4)


@pytest.mark.parametrize("k", [2, 3])
def test_calibrated_svm(spark, k, monkeypatch):
    monkeypatch.setattr(models, "FOLDS", 2)
    df = points(spark, 60, k)
    train = df.select(
        F.col("k"), models.array_to_vector("v").alias("features"),
        F.substring("label", 2, 1).cast("double").alias("label"), F.lit(1.0).alias("weight"),
    ).coalesce(1).cache()
    score = models._fit_calibrated_svm(train, 60, k)
    out = score(train).select("label", "proba").collect()
    assert all(abs(sum(r["proba"]) - 1) < 1e-9 and len(r["proba"]) == k for r in out)
    right = np.mean([int(np.argmax(r["proba"])) == r["label"] for r in out])
    assert right > 0.6


def test_forest(spark):
    rows = [(i, "good nice" if i % 2 else "bad awful", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, text string, label int")
    model = models.fit(df, "rf", "k", "label", "text", trees=5, max_depth=3)
    out = model.predict(df, ["label"]).collect()
    assert all(int(r["y_pred"]) == r["label"] for r in out)


def test_one_class_cannot_be_trained(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", None)], "k int, text string, label string")
    with pytest.raises(ValueError):
        models.fit(df, "logreg", "k", "label", "text")
    with pytest.raises(ValueError):
        models.fit(df, "magic", "k", "label", "text")


def test_tfidf_vectors(spark):
    rows = [(1, "Red red cat"), (2, "cat dog"), (3, None), (4, "x ? dog")]
    df = spark.createDataFrame(rows, "k int, text string")
    model = feat.tfidf_fit(df, "k", "text")
    terms = {r["term"]: r for r in model.vocabulary.collect()}
    assert sorted(terms) == ["cat", "cat dog", "dog", "red", "red cat", "red red"]
    assert [terms[t]["idx"] for t in sorted(terms)] == list(range(6))
    idf = {t: np.log(5 / (1 + r["df"])) + 1 for t, r in terms.items()}
    vectors = {r["k"]: r["features"].toArray() for r in feat.tfidf_transform(df, model, "k", "text").collect()}
    want = np.zeros(6)
    for t, tf in (("red", 2), ("cat", 1), ("red red", 1), ("red cat", 1)):
        want[terms[t]["idx"]] = (1 + np.log(tf)) * idf[t]
    assert np.allclose(vectors[1], want / np.linalg.norm(want))
    assert not vectors[3].any() and np.count_nonzero(vectors[4]) == 1
    top = feat.tfidf_fit(df, "k", "text", max_terms=2)
    assert sorted(r["term"] for r in top.vocabulary.collect()) == ["cat", "dog"]


def test_joined_vocabularies_give_the_same_vectors(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(1, 12) if i % j == 0)) for i in range(60)] + [(99, None), (100, "new words")]
    df = spark.createDataFrame(rows, "k int, text string")
    model = feat.tfidf_fit(df.where("k < 60"), "k", "text", min_df=2)
    vectors = lambda most: {r["k"]: r["features"] for r in feat.tfidf_transform(df, model, "k", "text", [], most).collect()}
    sent, joined = vectors(10_000), vectors(0)
    assert set(sent) == set(joined) == {r[0] for r in rows} and not sent[99].toArray().any()
    assert all(np.allclose(sent[k].toArray(), joined[k].toArray()) for k in sent)


@pytest.mark.parametrize("alike", [False, True])
def test_terms_meet_a_joined_vocabulary_in_slices(spark, monkeypatch, alike):
    """Many slices and buckets, also with one first fingerprint for all: no cell is a row of an exchange."""
    monkeypatch.setattr(feat, "SLICE", 30)
    monkeypatch.setattr(feat, "BUCKET_TERMS", 7)
    if alike:
        monkeypatch.setattr(feat, "_short_print", lambda t: (F.lit(5).cast("bigint"), F.shiftright(F.xxhash64(t), 32).cast("int")))
    rng = np.random.default_rng(2)
    rows = [(i % 50, i, " ".join(f"w{j}" for j in rng.integers(0, 30, i % 9))) for i in range(90)] + [(None, 90, None), (7, 91, "w1 w1 new")]
    df = spark.createDataFrame(rows, "k int, n int, text string").repartition(3)
    model = feat.tfidf_fit(df.where("n < 80"), "k", "text")
    vocabulary = model.vocabulary.orderBy("idx").collect()
    assert [r["term"] for r in vocabulary] == sorted(r["term"] for r in vocabulary) and model.size == len(vocabulary)
    assert [r["idx"] for r in vocabulary] == list(range(model.size))
    found = [feat.tfidf_weights(df, model, "k", "text", ["n"], most) for most in (10_000, 0)]
    sent, joined = [{(r["k"], r["n"], r["idx"], r["term"]): r["weight"] for r in f.collect()} for f in found]
    assert sent.keys() == joined.keys() and all(abs(sent[c] - joined[c]) < 1e-12 for c in sent)
    assert found[1].count() == len(sent)
    vectors = feat.tfidf_transform(df, model, "k", "text", ["n"], 0)
    plan = vectors._jdf.queryExecution().toString()
    assert "explode" not in plan and "collect_list" not in plan and vectors.count() == 92
    assert feat.tfidf_transform(df.limit(0), model, "k", "text", [], 0).count() == 0


@pytest.mark.parametrize("kind", ["logreg", "svm"])
def test_alike_terms_share_a_feature(spark, kind, monkeypatch):
    """One feature for terms with the same weights in all labeled rows: fewer features, the same probabilities."""
    monkeypatch.setattr(models, "FOLDS", 2)
    rng = np.random.default_rng(1)
    rows = [(i, " ".join([*(f"w{j}" for j in rng.integers(0, 12, 8)), f"own{i} mine{i}", "good fine" if i % 3 else "bad poor"]), i % 2)
            for i in range(60)]
    rows += [(60 + i, *rows[i][1:]) for i in range(5)] + [(70, None, 1), (0, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "k int, text string, label int")
    asked = df.unionByName(spark.createDataFrame([(90, "own1 own2 good w3 unseen", 0), (91, None, 1), (92, "mine3 w1 w1", 0)], df.schema))
    how = {"key": "k", "label_col": "label", "text_col": "text", "tolerance": 1e-9}
    plain, folded = models.fit(df, kind, **how), models.fit(df, kind, fold_terms=0, **how)
    assert folded.tfidf.size < 0.75 * plain.tfidf.size
    assert folded.features(df).first()["features"].size == folded.tfidf.size
    found = [sorted((r["k"], *r["proba"]) for r in m.predict(asked).collect()) for m in (plain, folded)]
    # the hinge has a kink, at which its solver stops early: its probabilities are near each other only
    assert np.allclose(*found, atol=1e-3 if kind == "logreg" else 0.1) and len(found[1]) == len(rows) + 3
    x = lambda m, d: np.array([r["features"].toArray() for r in sorted(m.features(d).collect(), key=lambda r: r["k"])])
    assert np.allclose(*[x(m, df) @ x(m, asked).T for m in (plain, folded)], atol=1e-12)


def test_terms_are_counted_in_slices(monkeypatch):
    """What is Python objects at a time has a bound, however many rows a batch holds."""
    lists = [["a"] * n for n in (3, 0, 9, 1, 1, 1)] + [None, ["a"]]
    batch = feat.pa.RecordBatch.from_arrays([feat.pa.array(range(8)), feat.pa.array(lists)], names=["k", "w"])
    for given in (batch, batch.slice(2)):
        parts = list(feat._in_slices(given, 1, 3))
        assert feat.pa.Table.from_batches(parts).to_pylist() == given.to_pylist()
        assert all(p.num_rows == 1 or sum(len(w or []) for w in p.column(1).to_pylist()) <= 3 for p in parts)
    assert not list(feat._in_slices(batch.slice(0, 0), 1, 3))


def test_prediction_shuffles_no_texts(spark):
    df = spark.createDataFrame([(i, f"good {i}" if i % 2 else f"bad {i}", i % 2) for i in range(40)], "k int, text string, label int")
    model = models.fit(df, "logreg", "k", "label", "text")
    plan = model.predict(df)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "from_json" not in plan


def test_a_fit_reads_no_pool(spark, monkeypatch):
    """From the second iteration on the labeled rows come from staged tables alone, by iterations few jobs."""
    seen = []
    plain = learn.fit
    monkeypatch.setattr(learn, "fit", lambda known, *a, **b: (seen.append(known.inputFiles()), plain(known, *a, **b))[1])
    staged = []
    prepared = learn.prepare
    monkeypatch.setattr(learn, "prepare", lambda *a, **b: (staged.append(prepared(*a, **b)), staged[-1])[1])
    df = points(spark, 60)
    learn.run_cycle(
        df.where("k < 10"), df.where("k >= 10 and k < 40"), df.where("k >= 40"), "entropy", "k", "label",
        embedding_col="v", model="embedding", iterations=2, batch_size=5,
    ).collect()
    pool = set(staged[1].inputFiles())
    assert len(seen) == 3 and all(not pool & set(files) for files in seen)


def test_predictions_are_those_of_every_model(spark, folder, monkeypatch):
    """Each kind of model gives labels and probabilities for its whole test part; terms are counted once."""
    import __spark_entry__ as entry

    rows = [(i, f"{'good fine' if i % 3 else 'bad poor'} other{i % 7} own{i}") for i in range(140)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, i % 2, int(i % 3 > 0)) for i in range(140)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    points(spark, 140).select(
        F.col("k").cast("bigint").alias("vec_id"), F.col("v").alias("embedding"), F.substring("label", 2, 1).cast("int").alias("label")
    ).write.parquet(f"{folder}/embeddings.parquet")
    counted = []
    plain = feat.numbered
    monkeypatch.setattr(feat, "numbered", lambda counts: counted.append(1) or plain(counts))
    monkeypatch.setattr(models, "FOLDS", 2)
    out = entry.queries()["predictions"](spark, folder).collect()
    sizes = {kind: sum(r["model"] == kind for r in out) for kind in models.MODELS}
    assert sizes == dict.fromkeys(models.MODELS, 28) and len(out) == 4 * 28 and len(counted) == 2
    assert all(abs(sum(r["proba"]) - 1) < 1e-3 for r in out)
    assert all(r["y"] == r["y_pred"] for r in out if r["model"] in ("logreg", "svm"))


def test_encoder_sees_each_text_once(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else f"t{i}") for i in range(30)] + [(99, None)], "k int, text string")

    def encoder(texts):
        assert len(set(texts)) == len(texts)
        return np.array([[len(t)] for t in texts])

    out = {r["k"]: r["embedding"] for r in feat.encode_distinct(df, "text", encoder).collect()}
    assert out[1] == [3.0] and out[0] == [2.0] and out[99] is None and len(out) == 31


def test_split_is_disjoint_complete_and_proportional(spark):
    df = spark.range(0, 1000).withColumn("label", F.when(F.col("id") < 700, "1.0").when(F.col("id") < 999, "0"))
    parts = learn.stratified_split(df, "label", "id", n_start=90).collect()
    assert sorted(r["id"] for r in parts) == list(range(999))
    count = lambda s, c: sum(r["split"] == s and r["label"] == c for r in parts)
    assert sum(r["split"] == "test" for r in parts) == 200
    assert sum(r["split"] == "labeled" for r in parts) == 90
    assert abs(count("test", "1.0") - 140) <= 1 and abs(count("labeled", "1.0") - 63) <= 1


def test_nan_labels_are_no_class(spark):
    df = spark.createDataFrame([(i, float(i % 2) if i < 20 else float("nan")) for i in range(30)], "k int, label double")
    assert learn.stratified_split(df, "label", "k", n_start=4).count() == 20


def test_split_with_a_class_of_one_row(spark):
    df = spark.createDataFrame([(i, "a") for i in range(20)] + [(20, "b")], "k int, label string")
    parts = learn.stratified_split(df, "label", "k", n_start=5).collect()
    assert len(parts) == 21 and sum(r["split"] == "test" for r in parts) == 5


def test_queries(spark):
    pool = spark.createDataFrame(
        [(1, [0.5, 0.5]), (2, [0.9, 0.1]), (3, [0.6, 0.4]), (4, [1.0, 0.0])], "k int, proba array<double>"
    )
    keys = lambda s, n: [r["k"] for r in learn.query(pool, s, n, "k").collect()]
    assert keys("entropy", 2) == [1, 3] and keys("margin", 3) == [1, 3, 2]
    assert len(keys("random", 99)) == 4 and keys("random", 2) == keys("random", 2)
    with pytest.raises(ValueError):
        keys("best", 1)


@pytest.mark.parametrize("strategy", ["entropy", "random"])
def test_cycle_moves_rows_from_pool_to_labeled(spark, strategy):
    df = points(spark, 90)
    labeled, pool, test = df.where("k < 10"), df.where("k >= 10 and k < 35"), df.where("k >= 35")
    history = learn.run_cycle(
        labeled, pool, test, strategy, "k", "label", embedding_col="v", model="embedding",
        iterations=3, batch_size=10,
    ).orderBy("iteration").collect()
    assert [r["n_labeled"] for r in history] == [10, 20, 30, 35]
    assert [len(r["queried_keys"]) for r in history] == [10, 10, 5, 0]
    asked = [k for r in history for k in r["queried_keys"]]
    assert len(set(asked)) == 25 and set(asked) == set(range(10, 35))
    assert all(r["accuracy"] > 0.6 for r in history)


def plain_cycle(labeled, pool, strategy, n, iterations, **how):
    """One strategy by itself, a query on the frames at a time."""
    keys = []
    for _ in range(iterations):
        scored = models.fit(labeled, key="k", label_col="label", **how).predict(pool)
        keys.append(sorted(r["k"] for r in learn.query(scored, strategy, n, "k").collect()))
        batch = pool.where(F.col("k").isin(keys[-1]))
        pool, labeled = pool.where(~F.col("k").isin(keys[-1])), learn.append_batch(labeled, batch)
    return keys


@pytest.mark.parametrize("how", [
    {"embedding_col": "v", "kind": "embedding"}, {"text_col": "text", "kind": "logreg"},
])
def test_strategies_in_lockstep_ask_as_each_would_alone(spark, how, monkeypatch):
    scans = []
    plain = learn.predict_all
    monkeypatch.setattr(learn, "predict_all", lambda *a: scans.append(len(a[0])) or plain(*a))
    df = points(spark, 60).withColumn("text", F.concat_ws(" ", F.transform("v", lambda x: F.round(x).cast("string")), "label"))
    labeled, pool, test = df.where("k < 8"), df.where("k >= 8 and k < 40"), df.where("k >= 40")
    strategies = ["entropy", "margin", "random"]
    history = learn.compare_al_strategies(
        labeled, pool, test, strategies, key="k", label_col="label", iterations=2, batch_size=5,
        **{k: v for k, v in how.items() if k != "kind"}, model=how["kind"],
    ).collect()
    assert scans == [2, 2] and len(history) == 9
    for s in strategies:
        got = sorted((r["iteration"], r["queried_keys"]) for r in history if r["strategy"] == s)
        assert [k for _, k in got] == [*plain_cycle(labeled, pool, s, 5, 2, **how), []]
    assert len({(r["accuracy"], r["f1"]) for r in history if r["iteration"] == 0}) == 1


def test_lockstep_with_repeated_and_missing_keys(spark):
    df = points(spark, 40)
    pool = df.where("k >= 10 and k < 20").unionByName(df.where("k = 15")).unionByName(df.where("k = 16").withColumn("k", F.lit(None).cast("int")))
    history = learn.compare_al_strategies(
        df.where("k < 10"), pool, df.where("k >= 20"), ["margin", "random"], key="k", label_col="label",
        embedding_col="v", model="embedding", iterations=3, batch_size=6,
    ).collect()
    for s in ("margin", "random"):
        runs = sorted((r["iteration"], r["n_labeled"]) for r in history if r["strategy"] == s)
        assert [n for _, n in runs] == sorted(n for _, n in runs) and runs[-1][1] <= 21


HISTORY = "strategy string, iteration int, n_labeled bigint, accuracy double, f1 double"


def test_savings(spark):
    rows = [
        ("random", 0, 50, 0.5, 0.9), ("random", 1, 70, 0.5, 0.6),
        ("entropy", 0, 50, 0.5, 0.5), ("entropy", 1, 70, 0.5, 0.6), ("margin", 0, 50, 0.5, 0.1),
    ]
    out = {r["strategy"]: r for r in learn.savings(spark.createDataFrame(rows, HISTORY)).collect()}
    assert out["entropy"]["n_reached"] == 70 and out["entropy"]["saved"] == 0 and out["entropy"]["saved_pct"] == 0.0
    assert out["margin"]["saved"] is None and out["margin"]["final_f1"] == 0.1
    lonely = spark.createDataFrame(rows[2:], HISTORY)
    assert learn.savings(lonely).count() == 0
