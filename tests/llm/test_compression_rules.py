"""Quality rules: counts against a plain loop, bands by hand, edge rows."""

import base64
import random
import re
from collections import Counter

import numpy as np
import pytest
import zstandard

from winnowry.llm import compression_rules as rules
from winnowry.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """The columns by the letter, without hashes or arrays."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    raw, z = text.encode(), zstandard.ZstdCompressor(level=3)

    def outside(part):
        if len(part) < 128:
            return False
        low, high = (np.interp(np.log2(len(part)), np.log2([p[0] for p in rules.BANDS]), [p[k] for p in rules.BANDS]) for k in (1, 2))
        return not low <= len(z.compress(part)) / len(part) <= high

    cuts = list(range(0, len(raw), 4096)) or [0]
    if len(cuts) > 1 and len(raw) - cuts[-1] < 1024:
        cuts.pop()
    parts = [raw[a:b] for a, b in zip(cuts, [*cuts[1:], len(raw)])]
    bad = sum(len(p) for p in parts if outside(p)) > 0.3 * len(raw)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": copies, "n_repeat_words": len(covered), "base_failed": failed,
        "kept": not (failed or outside(raw) or bad),
    }


def test_query_equals_a_plain_loop(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op13_quality_rules(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = plain(texts[r["doc_id"]])
        assert {k: r[k] for k in expected} == expected, r["doc_id"]


def test_good_texts_stay_and_bad_labels_go(spark):
    sf = "/root/testdata/sf0.1"
    found = queries.op13_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good = [r for r in found if r["quality"] == 1 and not r["base_failed"]]
    repetitive = [r for r in found if r["quality"] == 0 and r["compressed_share"] < 0.2]
    assert sum(r["kept"] for r in good) == len(good)
    assert repetitive and not any(r["kept"] for r in repetitive)


def made(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [r for r in sorted(rules.quality_rules(docs).collect(), key=lambda r: r["doc_id"])]


def prose(n, seed=1):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choices("etaoinshrdlu", k=rnd.randint(2, 9))) for _ in range(3000)]
    return " ".join(rnd.choices(vocabulary, k=n))


def test_what_each_rule_rejects(spark):
    noise = base64.b64encode(random.Random(2).randbytes(6000)).decode()
    blocks = " ".join(noise[i : i + 20] for i in range(0, len(noise), 20))
    numbered = "\n".join(f"item {i} of the list" for i in range(2000))
    fine, half = prose(3000), prose(900) + " " + blocks
    rows = made(spark, fine, "too few words here", " ".join(["again"] * 50), blocks, numbered, half, prose(3000, 2) + " " + blocks[:2000])
    assert [r["kept"] for r in rows] == [True, False, False, False, False, False, True]
    assert [r["base_failed"] for r in rows] == [False, True, True, False, False, False, False]


def test_bands_join_their_points():
    bands = rules.Bands(((100, 0.2, 0.8), (400, 0.4, 0.6)))
    size = np.array([99, 100, 100, 200, 200, 200, 400, 10**9, 10**9])
    ratio = np.array([9.0, 0.2, 0.19, 0.3, 0.29, 0.71, 0.6, 0.4, 0.61])
    assert bands.inside(size, ratio).tolist() == [True, True, False, True, False, False, True, True, False]


@pytest.mark.parametrize("size, expected", [
    (0, [(0, 0)]), (4096, [(0, 4096)]), (5119, [(0, 5119)]), (5120, [(0, 4096), (4096, 5120)]),
    (9000, [(0, 4096), (4096, 9000)]), (9300, [(0, 4096), (4096, 8192), (8192, 9300)]),
])
def test_chunks(size, expected):
    assert rules.chunks_of(size) == expected


def test_edge_rows(spark):
    long = prose(200_000)
    rows = [
        (1, None, "p", 1), (2, "", None, 2), (None, "word " * 30, "q", 3), (3, long, "r", 4), (3, long, "r", 5),
        (4, " \n\t\n ", "s", 6), (5, "a\nb\na\n\nb \nb", "t", None), (6, "é| #\n" * 9, "u", 7),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kept string, n_words int")
    found = rules.quality_rules(docs).collect()
    for r, given in zip(sorted(found, key=lambda r: (r["doc_id"] is None, r["doc_id"])), sorted(rows, key=lambda r: (r[0] is None, r[0]))):
        expected = plain(given[1])
        assert {k: r[k] for k in expected} == expected
    kept = rules.accepted(docs)
    assert kept.schema == docs.schema and [tuple(r) for r in kept.collect()] == rows[3:5]
    assert rules.quality_rules(docs.limit(0)).count() == 0 and rules.accepted(docs.limit(0)).count() == 0
