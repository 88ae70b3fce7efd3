"""The pipeline's stages one after another, each against what it was given."""

import hashlib
from collections import Counter

import public_tokenizers as vocabularies
import pytest
import tiktoken

import corpus_pipeline
from winnowry.llm import byte_bpe, mixing, quality_gam
from winnowry.staging import stage
from tests.llm.test_simhash_dedup import shingle_set
from tests.llm.test_substring_dedup import brute

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, step in corpus_pipeline.STAGES:
        docs.append(stage(step(spark, docs[-1], SF), name))
    return [(d, {r["doc_id"]: r for r in d.collect()}) for d in docs]


def test_columns(steps):
    assert all(d.schema == steps[0][0].schema for d, _ in steps[:-1])


def test_quality_drops_what_it_rejects(spark, steps):
    (docs, given), (_, kept) = steps[0], steps[1]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality_gam.fit_quality(docs, labels.where(quality_gam.fold() != 1))
    good = {r["doc_id"] for r in quality_gam.score_quality(docs, model).collect() if r["score"] >= 0.5}
    assert set(kept) == good and all(kept[i] == given[i] for i in kept)
    marked = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert sum(i in kept for i, q in marked.items() if q == 1) >= 0.98 * sum(marked.values())


def test_near_dedup_keeps_one_of_each(steps):
    (_, given), (_, kept) = steps[1], steps[2]
    sets = {i: shingle_set(r["text"]) for i, r in given.items()}
    like = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    assert set(kept) < set(given) and all(kept[i] == given[i] for i in kept)
    ids = sorted(kept)
    close = [(i, j) for n, j in enumerate(ids) for i in ids[:n] if like(i, j)]
    assert len(close) <= 0.02 * (len(given) - len(kept))
    gone = set(given) - set(kept)
    assert all(any(like(i, j) for j in given if j != i) for i in gone)


def test_substring_dedup_cuts_passages(steps):
    (_, given), (_, kept) = steps[2], steps[3]
    expected = brute([(i, r["text"]) for i, r in given.items()], 50)
    assert set(kept) == set(given)
    for i, (_, _, digest) in expected.items():
        assert hashlib.sha256(b" ".join((kept[i]["text"] or "").encode().split())).hexdigest() == digest
        assert kept[i]["n_chars"] == len(kept[i]["text"] or "")


def test_mix_repeats_documents(steps):
    (docs, given), (mixed, _) = steps[3], steps[4]
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(docs).collect()}
    rows = mixed.collect()
    assert Counter(r["doc_id"] for r in rows) == {i: c for i, c in copies.items() if c}
    assert all(r == given[r["doc_id"]] for r in rows)


def test_tokens_round_trip(steps):
    (mixed, given), (tokens, found) = steps[4], steps[5]
    ranks = byte_bpe.read_ranks(vocabularies.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert tokens.count() == mixed.count() and set(found) == set(given)
    for i, r in found.items():
        text = given[i]["text"] or ""
        assert r["n_tokens"] == len(library.encode_ordinary(text))
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_run_equals_the_stages(spark, steps):
    assert sorted(corpus_pipeline.run(spark, SF).collect()) == sorted(steps[5][0].collect())


def test_edge_tables(spark, folder):
    rows = [
        (1, None, None, None, None, 1), (2, "", "en", "a", 0, 2), (None, "x y z", None, "b", 5, 3), (3, "q " * 300_000, "en", None, 1, 4),
        (4, "same text here.", "en", "a", 1, 5), (4, "same text here.", "en", "a", 1, 5),
    ]
    docs = spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score int"
    )
    spark.createDataFrame([(1, 1, 0), (3, 0, 0), (None, 1, 1)], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    for given in (docs, docs.limit(0)):
        for name, step in corpus_pipeline.STAGES:
            given = stage(step(spark, given, folder), name)
            if name != "tokenize":
                assert given.columns == docs.columns
    assert given.count() == 0
