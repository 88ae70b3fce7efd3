"""Fingerprints against a plain loop over words, and block tables against all pairs."""

import hashlib
import random

import pytest
import xxhash

from winnowry.llm import fingerprints as fp
from winnowry.llm import queries


def brute(text):
    ones, total = [0] * 64, 0
    for word in (text or "").lower().encode().split():
        size = min(len(word.decode()), 16)
        w = max(1, size * size // 16)
        h, total = xxhash.xxh64_intdigest(word, 42), total + w
        for i in range(64):
            ones[i] += w * (h >> i & 1)
    return sum(1 << i for i in range(64) if 2 * ones[i] > total)


def expected(texts):
    """(doc_id, text) in order -> rows."""
    prints = [brute(t) for _, t in texts]
    like = lambda a, b: 1 - (a ^ b).bit_count() / 64
    rows = []
    for k, (i, text) in enumerate(texts):
        text, following = text or "", texts[(k + 1) % len(texts)][1] or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        e, n = brute(edited), prints[(k + 1) % len(texts)]
        rows.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{prints[k]:016x}", f"{e:016x}",
                     like(prints[k], e), like(prints[k], n)))
    return rows


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def test_query_equals_plain_loop(spark):
    sf = "/root/testdata/sf0.001"
    texts = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    found = queries.op6_simhash_fingerprints(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for df in (found, fp.edited_fingerprints(docs), fp.near_counts(fp.fingerprints(docs))):
        assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
    rows = found.collect()
    assert sorted(tuple(r[c] for c in COLUMNS) for r in rows) == expected(texts)
    prints = {r["doc_id"]: int(r["fingerprint"], 16) for r in rows}
    near = {i: sum((p ^ q).bit_count() <= 3 for q in prints.values()) - 1 for i, p in prints.items()}
    assert {r["doc_id"]: r["n_near"] for r in rows} == near


def test_edited_texts_are_nearer_than_others(spark):
    rows = queries.op6_simhash_fingerprints(spark, "/root/testdata/sf0.01").where("n_chars > 200").collect()
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.98 * len(rows)


@pytest.mark.parametrize("rows_per_bucket", [1, 3, 100])
def test_followers_across_buckets(spark, rows_per_bucket):
    rnd = random.Random(3)
    ids = rnd.sample(range(-500, 500), 40)
    texts = [(i, rnd.choice([None, "", "é" * rnd.randrange(9), "word " * rnd.randrange(30)])) for i in ids]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    found = fp.edited_fingerprints(docs, rows_per_bucket).collect()
    rows = expected(sorted(texts))
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found) == [r[:3] for r in rows]
    assert sorted((r["doc_id"], f"{r['next_fp'] & (1 << 64) - 1:016x}") for r in found) == sorted(
        (r[0], n[3]) for r, n in zip(rows, rows[1:] + rows[:1])
    )


def test_edge_rows(spark):
    rows = [(5, None, "x", 1), (3, "", None, 2), (7, "two\twords", "z", 3), (7, "two\twords", "z", 3), (None, "no id", "n", 4),
            (9, "longer " * 200_000, "l", 5), (11, "ab", "s", 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, bucket string, fp int")
    ordered = sorted(((i, t) for i, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    found = fp.edited_fingerprints(docs, 2).collect()
    wanted = expected(ordered)
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found), key=str) == sorted((r[:3] for r in wanted), key=str)
    alone = fp.edited_fingerprints(docs.where("doc_id = 9")).collect()
    assert alone[0]["fp"] == alone[0]["next_fp"]
    assert fp.edited_fingerprints(docs.limit(0)).count() == 0
    assert {r["doc_id"]: r["fp"] & (1 << 64) - 1 for r in fp.fingerprints(docs).collect()} == {i: brute(t) for i, t in ordered}


@pytest.mark.parametrize("radius,blocks", [(0, 1), (2, 4), (3, 6), (5, 8)])
def test_block_tables_find_all_pairs(spark, radius, blocks):
    rnd, prints = random.Random(radius), []
    for i in range(150):
        p = rnd.getrandbits(64) if i % 5 == 0 else rnd.choice(prints)
        for _ in range(rnd.randint(0, radius + 2)):
            p ^= 1 << rnd.randrange(64)
        prints.append(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = fp.near_fingerprints(spark.createDataFrame([(p,) for p in signed + [None]], "fp bigint"), radius, blocks)
    mask = (1 << 64) - 1
    pairs = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= radius}
    assert sorted(tuple(r) for r in found.collect()) == sorted(pairs)


@pytest.mark.parametrize("radius,blocks,crowd", [(0, 1, 1000), (2, 4, 4), (3, 6, 1), (3, 6, 1000)])
def test_near_rows_are_counted_once(spark, radius, blocks, crowd):
    """Equal rows, pairs that meet in many tables, and crowded keys of far fingerprints."""
    rnd, prints = random.Random(radius), [1 << i for i in range(20)]
    for i in range(120):
        p = rnd.getrandbits(64) if i % 5 == 0 else rnd.choice(prints)
        for _ in range(rnd.randint(0, radius + 2)):
            p ^= 1 << rnd.randrange(64)
        prints.append(p)
    prints += [prints[-1]] * 5 + [rnd.getrandbits(20) for _ in range(40)]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    docs = spark.createDataFrame([(i, p) for i, p in enumerate(signed + [None])], "doc_id bigint, fp bigint")
    found = {r["doc_id"]: r["n_near"] for r in fp.with_near_counts(docs, radius, blocks).collect()} if blocks == 6 else None
    counts = {r["fp"]: (r["copies"], r["n_near"]) for r in fp.near_counts(docs, radius, blocks, crowd).collect()}
    near = [sum((p ^ q).bit_count() <= radius for q in prints) - 1 for p in prints]
    assert counts == {p: (signed.count(p), n) for p, n in zip(signed, near)}
    assert found is None or found == dict(enumerate(near)) | {len(prints): None}
    assert fp.near_counts(docs.limit(0), radius, blocks).count() == 0
