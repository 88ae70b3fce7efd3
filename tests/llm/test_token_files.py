"""Simple-8b shards: round trips, a by-hand packing, and ids of the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers as vocabularies
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from winnowry.llm import queries, token_files as tf

PATH = vocabularies.path("word_bpe_49k.json")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=700))
def test_round_trip(values):
    assert tf.unpack(tf.pack(np.array(values, np.uint64))).tolist() == values


def test_words_are_greedy():
    """Words of each block as a plain loop packs them."""
    rnd = random.Random(5)
    values = [rnd.choice([0, 1, rnd.randrange(16), rnd.randrange(2**11), rnd.randrange(2**61)]) for _ in range(1000)]
    expected = []
    for first in range(0, 1000, tf.BLOCK):
        block, at = values[first : first + tf.BLOCK], 0
        while at < len(block):
            for k in range(1, 15):
                if max(block[at : at + int(tf.COUNTS[k])]) < 1 << int(tf.WIDTHS[k]):
                    break
            else:
                k = 0
            expected.append(k)
            at += int(tf.COUNTS[k])
    shard = tf.pack(np.array(values, np.uint64))
    _, _, blocks, words, escaped = np.frombuffer(shard, "<u8", 5, 8).tolist()
    found = np.frombuffer(shard, "<u8", words, 48 + 4 * blocks) >> np.uint64(60)
    assert found.tolist() == expected and escaped == expected.count(0) > 0


def test_size_of_small_ids():
    # 46 blocks of 128 ids in 3 words each, one of 112 ids in 2
    assert len(tf.pack(np.ones(6000, np.uint64))) == 48 + 4 * 47 + 8 * (46 * 3 + 2)
    with pytest.raises(ValueError):
        tf.unpack(b"something else")


def test_words_alone_give_the_ids_of_whole_texts(monkeypatch):
    monkeypatch.setattr(tf, "CACHED_WORDS", 300)
    library = Tokenizer.from_file(PATH)
    rnd = random.Random(2)
    letter = lambda: chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(0x400), rnd.randrange(0xD7FF),
                                     0x301, 0x3A3, 0x1C, 0x85, 0xA0, 32, 32, 10, 0x1F600]))
    texts = ["".join(letter() for _ in range(rnd.randrange(60))) for _ in range(1500)]
    texts += ["A<|ENDOFTEXT|>B ABC Abc", "ABC Def.", "J\u030c j\u030c", "a<|endoftext|>b <|startoftext|>", "it's DON'T 123", "ΌΣΟΣ Σ ΣΑΣ.", "é ́e", ""]
    signs = "abcXYZ019.,;!?|#$%&*()-_+=@'<>/\\ \n~"
    texts += ["".join(rnd.choice(signs) for _ in range(rnd.randrange(40))) for _ in range(1500)]
    words = tf.WordTokenizer(open(PATH, encoding="utf-8").read())
    assert words.by_parts
    for part in (texts[:800], texts[800:], texts[:10]):
        ids, begins = words.encode([t.encode() for t in part])
        assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == [
            library.encode(t, add_special_tokens=False).ids for t in part
        ]


def test_other_tokenizers_take_the_whole_way():
    path = vocabularies.path("byte_bpe_50k.json")
    words = tf.WordTokenizer(open(path, encoding="utf-8").read())
    library = Tokenizer.from_file(path)
    ids, begins = words.encode([b"Word", b"12,34!", "é".encode()])
    assert not words.by_parts
    assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == [library.encode(t).ids for t in ("Word", "12,34!", "é")]


def expected_rows(texts, end=2):
    library, start, rows = Tokenizer.from_file(PATH), 0, []
    for i, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [end]
        rows.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return rows


def test_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    texts = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert sorted(tuple(r) for r in queries.op8_token_files(spark, sf).collect()) == expected_rows(texts)


def test_frames_and_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(tf, "GROUP_CHARS", 50)
    rows = [(7, "The end.", "x"), (3, None, "y"), (5, "", "z"), (9, "word " * 100_000, None), (None, "no id", "a"),
            (8, "twice", "b"), (8, "twice", "b"), (-4, "before", "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shard string").repartition(3)
    shards = tf.write_ids(docs, PATH, 2)
    ordered = sorted(((i, t) for i, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    found = sorted((tuple(r) for r in tf.id_digests(shards).collect()), key=lambda r: r[1])
    assert found == expected_rows(ordered)
    library = Tokenizer.from_file(PATH)
    ids = {r["doc_id"]: r["ids"] for r in tf.read_ids(shards).collect()}
    assert ids == {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t in ordered}
    assert tf.id_digests(tf.write_ids(docs.limit(0), PATH, 2)).count() == 0


def test_encoding_is_not_interrupted_by_the_collector():
    import gc

    with open(vocabularies.path("word_bpe_49k.json"), encoding="utf-8") as definition:
        tokenizer = tf.WordTokenizer(definition.read())
    texts = [" ".join(f"w{i}x{j}" for j in range(200)).encode() for i in range(200)]
    seen = []
    gc.callbacks.append(lambda phase, info: seen.append(phase))
    try:
        tokenizer.encode(texts)
    finally:
        gc.callbacks.pop()
    assert not seen and gc.isenabled()


def test_words_with_latin_letters_take_the_short_way():
    """Words with accents are plain, and have the ids that the library gives them, as a whole text has."""
    import random

    import public_tokenizers
    from winnowry.llm import token_files

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as definition:
        tokenizer = token_files.WordTokenizer(definition.read())
    drawn = random.Random(1)
    signs = [*"abzABZ019.,-_\"(", *token_files.LATIN]
    words = ["".join(drawn.choices(signs, k=drawn.randint(1, 9))) for _ in range(4000)]
    words += ["étréoi", "ÜBER-groß", "señ1or", "Þing", "ÿ", "cœur", "éte", "2×3÷4", "l'été", "<s>é", "naïve²"]
    plain = [token_files.PLAIN.fullmatch(w.encode()) is not None for w in words]
    assert tokenizer.by_parts and all(plain[:4005]) and not any(plain[4005:])
    expected = [e.ids for e in tokenizer.tokenizer.encode_batch(words, add_special_tokens=False)]
    ids, begins = tokenizer.encode([w.encode() for w in words])
    assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == expected
