"""The additive classifier: features by hand, held-out accuracy, edge rows."""

import zlib

import numpy as np
import pytest

from winnowry.llm import queries, quality_gam as gam


def features(*texts):
    raw = [t.encode() for t in texts]
    return gam.text_features(
        np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    )


def test_features_by_hand():
    x = features("", "Ab cd. EF!\nab cd.\nAb cd. EF!", "x", " \n ")
    at = gam.FEATURES.index
    assert (x[0] == 0).all()
    row = x[1]
    assert np.isclose(row[at("log_words")], np.log1p(8)) and np.isclose(row[at("log_lines")], np.log1p(3))
    assert np.isclose(row[at("distinct_words")], 4 / 8) and np.isclose(row[at("distinct_lines")], 2 / 3)
    assert np.isclose(row[at("exclaim_ends")], 2 / 8) and np.isclose(row[at("sentence_ends")], 3 / 8)
    assert np.isclose(row[at("upper_words")], 2 / 8) and np.isclose(row[at("capital_words")], 4 / 8)
    assert np.isclose(row[at("longest_word")], np.log1p(3)) and x[3][at("log_words")] == 0
    assert (features("a b", "Ab cd. EF!\nab cd.\nAb cd. EF!", "q")[1] == row).all()


def test_fit_finds_single_effects_and_interactions():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (4000, 4))
    y = (np.sign(x[:, 1] * x[:, 2]) + 2 * x[:, 0] > 0).astype(float)
    model = gam.fit(x[:3000], y[:3000])
    alone = gam.fit(x[:3000], y[:3000], pairs=0)
    correct = lambda m: ((m.score(x[3000:]) >= 0.5) == y[3000:]).mean()
    assert model.pairs[0] == (1, 2) and correct(model) > correct(alone) + 0.1
    assert (gam.fit(x, y).score(x) == gam.fit(x, y).score(x)).all()


@pytest.mark.parametrize("y", [np.zeros(0), np.ones(5), np.zeros(5)])
def test_one_class_is_constant(y):
    score = gam.fit(np.zeros((len(y), 3)), y).score(np.ones((2, 3)))
    assert score[0] == score[1] and 0 <= score[0] <= 1


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in queries.op7_quality_gam(spark, sf).collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows.values())
    held = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if rows[r["doc_id"]]["held_out"]]
    majority = sum(r["quality"] for r in held) / len(held)
    assert sum(rows[r["doc_id"]]["predicted"] == r["quality"] for r in held) / len(held) > max(majority, 0.93)


def test_edge_rows(spark):
    rows = [(1, None, 1, "p"), (2, "", 2, "q"), (None, "word", 3, None), (3, "a " * 500_000, 4, "r"), (3, "b", 5, "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score int, quality string")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (3, None, 1), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = gam.fit_quality(docs, labels)
    found = gam.score_quality(docs, model).collect()
    assert len(found) == 5 and all(0 <= r["score"] <= 1 for r in found)
    assert found[0]["score"] == found[1]["score"]
    kept = gam.accepted(docs, model, 0.0)
    assert kept.schema == docs.schema and sorted(kept.collect(), key=str) == sorted(docs.collect(), key=str)
    assert gam.accepted(docs, model, 1.1).count() == 0
    assert gam.score_quality(docs.limit(0), gam.fit_quality(docs.limit(0), labels.limit(0))).count() == 0


def test_rows_without_an_id_are_not_held_out(spark, folder):
    docs = spark.createDataFrame([(None, "some words"), (4, "more words here"), (5, None)], "doc_id bigint, text string")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(4, 1, 0), (5, 0, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    found = {r["doc_id"]: r["held_out"] for r in queries.op7_quality_gam(spark, folder).collect()}
    assert found == {None: False, 4: zlib.crc32(b"4") % 3 == 1, 5: zlib.crc32(b"5") % 3 == 1}


def test_score_equals_a_loop_over_the_tables():
    """Scores by hand: table entries of bins and of pairs of coarse bins, added up."""
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (400, 3))
    model = gam.fit(x[:300], (x[:300, 0] > x[:300, 1]).astype(float))
    again = np.array([model.score(row[None])[0] for row in x])
    assert np.allclose(model.score(x), again) and (model.score(x) >= 0).all() and (model.score(x) <= 1).all()
