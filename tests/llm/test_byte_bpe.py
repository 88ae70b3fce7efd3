"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers as vocabularies
import pytest
import tiktoken

from winnowry.llm import byte_bpe, queries

PATH = vocabularies.path("byte_bpe_multi_50k.tiktoken")
PATTERN = vocabularies.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def drawn_texts():
    rnd = random.Random(1)
    letter = lambda: chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(0x250), rnd.randrange(0xD7FF),
                                     0x1F600 + rnd.randrange(60), 97, 97, 32, 10, 0x1C, 0x85]))
    syllables = ["the", "ing", "er", "tion", "a", "b", "c", "aa", "ab", " ", "\n\n", "'s", "12"]
    texts = ["".join(letter() for _ in range(rnd.randrange(50))) for _ in range(1500)]
    texts += ["".join(rnd.choice(syllables) for _ in range(30)) for _ in range(1500)]
    return texts + ["a" * n for n in range(120)] + ["ab" * n for n in range(40)] + ["." * n for n in range(70)]


def test_ids_equal_the_library(ranks, reference):
    codec, texts = byte_bpe.ByteBpe(ranks, PATTERN), drawn_texts()
    for _ in range(2):  # the second time from memory
        ids, begins = codec.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == [reference.encode_ordinary(t) for t in texts]
        assert codec.decode(ids, begins) == [t.encode() for t in texts]


def test_long_piece_and_forgetting(ranks, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED_PIECES", 10)
    monkeypatch.setattr(byte_bpe, "CACHED_PAIRS", 10)
    codec = byte_bpe.ByteBpe(ranks, PATTERN)
    rnd = random.Random(3)
    for _ in range(3):
        text = "".join(rnd.choice("abcdetion") for _ in range(50_000))
        ids, begins = codec.encode([text, "x y z"])
        assert ids[: begins[1]].tolist() == reference.encode_ordinary(text)


def test_small_vocabulary_by_naive_merges():
    """Every string of up to 7 letters, merged pair by pair."""
    from itertools import product

    tokens = [b"a", b"b", b"c", b"ab", b"bc", b"aa", b"abc", b"aab", b"bcbc", b"aaaa", b"cab"]
    ranks = {t: i for i, t in enumerate(tokens)}
    ranks |= {bytes([x]): 1000 + x for x in range(256) if bytes([x]) not in ranks}

    def merge(piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        if piece in ranks:
            return [ranks[piece]]
        while True:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not found:
                return [ranks[p] for p in parts]
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    texts = ["".join(x) for n in range(1, 8) for x in product("abc", repeat=n)]
    ids, begins = byte_bpe.ByteBpe(ranks, r"\w+").encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == [merge(t.encode()) for t in texts]


def test_query_equals_the_library(spark, reference):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    rows = queries.op9_byte_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = reference.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha(",".join(map(str, ids)).encode())
        assert r["decoded_sha256"] == sha(texts[r["doc_id"]].encode())


def test_frames_and_edge_rows(spark, reference):
    rows = [(1, None, "a"), (2, "", "b"), (None, "solo é\n", None), (3, "x" * 300_000 + " word" * 1000, "c"), (3, "twice", "d")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    encoded = byte_bpe.encode_texts(docs, PATH, PATTERN)
    assert [r["ids"] for r in encoded.collect()] == [reference.encode_ordinary(t or "") for _, t, _ in rows]
    decoded = byte_bpe.decode_ids(encoded, PATH, PATTERN).collect()
    assert [bytes(r["decoded"]).decode() for r in decoded] == [t or "" for _, t, _ in rows]
    assert [r["n_tokens"] for r in byte_bpe.round_trip(docs, PATH, PATTERN).collect()] == [
        len(reference.encode_ordinary(t or "")) for _, t, _ in rows
    ]
    assert byte_bpe.round_trip(docs.limit(0), PATH, PATTERN).count() == 0
    assert np.array_equal(byte_bpe.ByteBpe(byte_bpe.read_ranks(PATH), PATTERN).encode([])[1], [0])
