"""Substring dedup against a dictionary of all windows."""

import hashlib
import random

import numpy as np
import pytest

from winnowry.llm import queries, substring_dedup as sd


def brute(texts, length):
    """texts: (doc_id, text) with unique ids."""
    words = {i: (t or "").encode().split() for i, t in texts}
    owner = {}
    for i in sorted(words):
        for p in range(len(words[i]) - length + 1):
            owner.setdefault(tuple(words[i][p : p + length]), i)
    found = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if owner[tuple(w[p : p + length])] < i:
                gone[p : p + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        found[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return found


def result(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()}


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert result(queries.op10_substring_dedup(spark, sf)) == brute(texts, sd.LENGTH)


@pytest.mark.parametrize("length,first", [(8, 8), (8, 4), (8, 2), (6, 3)])
def test_planted_passages(spark, length, first):
    drawn = random.Random(length * 10 + first)
    pool = [[str(drawn.randrange(30)) for _ in range(drawn.randint(2, 25))] for _ in range(12)]
    texts = []
    for i in range(120):
        parts = [drawn.choice(pool) if drawn.random() < 0.5 else [str(drawn.randrange(40)) for _ in range(9)]
                 for _ in range(drawn.randint(0, 6))]
        texts.append((i, drawn.choice([" ", "\n"]).join(w for p in parts for w in p)))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(5)
    assert result(sd.removed_words(docs, length, first)) == brute(texts, length)
    kept = {r["doc_id"]: r["text"] for r in sd.without_repeats(docs, length, first).collect()}
    for i, (n, removed, digest) in brute(texts, length).items():
        assert hashlib.sha256(b" ".join(kept[i].encode().split())).hexdigest() == digest
        assert removed or kept[i] == dict(texts)[i]


def test_shuffled_lists_give_the_same(spark):
    texts = [(i, " ".join(str((i // 2 * 7 + j) % 90) for j in range(60))) for i in range(30)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    lists = lambda rows: {r["id"]: (r["copy"], set(r["listed"])) for r in sd.repeated_windows(docs, 8, 4, rows).collect()}
    assert lists(0) == lists(1_000_000) != {}


def test_kernels():
    h = np.random.default_rng(0).integers(0, 2**64, 40, dtype=np.uint64)
    for n in (1, 2, 3, 7, 25):
        runs = sd.run_hashes(h, n)
        assert len(runs) == 41 - n
        assert (sd.run_hashes(h[5:], n) == runs[5:]).all()
        assert (sd.sliding_min(h, n) == [h[i : i + n].min() for i in range(41 - n)]).all()
    assert len(sd.run_hashes(h[:3], 5)) == 0
    with pytest.raises(ValueError):
        sd.levels(50, 20)


def test_edge_rows(spark):
    same = " ".join(str(i) for i in range(70))
    rows = [
        (5, None, "x", 1, 0), (3, "", None, 2, 0), (4, same, "y", 3, len(same)), (2, same + "\n", "z", 4, 0),
        (None, same, "n", 5, 1), (9, "one " * 300_000, "l", 6, None), (7, same + " é", "r", 7, 3), (7, same + " é", "r", 7, 3),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, listed string, copy int, n_chars bigint")
    found = [(r["doc_id"], r["n_words"], r["n_removed"]) for r in sd.removed_words(docs).collect()]
    assert sorted(found, key=str) == sorted(
        [(5, 0, 0), (3, 0, 0), (4, 70, 70), (2, 70, 0), (None, 70, 0), (9, 300_000, 0), (7, 71, 70), (7, 71, 70)], key=str
    )
    kept = sd.without_repeats(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    out = {r["doc_id"]: r for r in kept.collect()}
    assert out[4]["text"] == "" and out[4]["n_chars"] == 0 and out[7]["text"] == "é" and out[7]["n_chars"] == 1
    assert out[5]["text"] is None and out[2]["text"] == same + "\n" and out[None]["text"] == same
    assert sd.removed_words(docs.limit(0)).count() == 0 and sd.without_repeats(docs.limit(0)).count() == 0
