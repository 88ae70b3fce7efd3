"""The byte model against a plain dictionary of contexts; token scores against a counter."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from winnowry.llm import ppm, queries


class Plain:
    """Prediction by partial matching, method C with exclusion, one byte at a time."""

    def __init__(self, texts, order):
        self.order, self.seen = order, defaultdict(Counter)
        for t in texts:
            t = bytes([ppm.BEFORE]) * order + t.lower() + bytes([ppm.END])
            for i in range(order, len(t)):
                for k in range(order + 1):
                    self.seen[t[i - k : i]][t[i]] += 1

    def byte(self, context, symbol):
        total, ruled = 0.0, set()
        for k in range(self.order, -1, -1):
            counts = {s: n for s, n in self.seen.get(context[len(context) - k :], {}).items() if s not in ruled}
            if not counts:
                continue
            whole = sum(counts.values()) + len(counts)
            if symbol in counts:
                return total + math.log10(counts[symbol] / whole)
            total += math.log10(len(counts) / whole)
            ruled |= set(counts)
        return total - math.log10(max(256 - len(ruled), 1))

    def text(self, t):
        t = bytes([ppm.BEFORE]) * self.order + t.lower() + bytes([ppm.END])
        return sum(self.byte(t[i - self.order : i], t[i]) for i in range(self.order, len(t)))


def buffers(texts):
    sizes = np.array([0] + [len(t) for t in texts])
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes)


def trie(texts, order):
    cells, n = np.unique(ppm.cells_at(*ppm.framed(*buffers(texts), order), order)[0], return_counts=True)
    low = ppm._summed(cells & np.uint64(ppm.low_bytes(min(3, order))), n)
    return ppm.Trie(cells, n, *low, order)


def drawn(seed, n, letters="abAB \n"):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(letters) for _ in range(rnd.randrange(25))).encode() for _ in range(n)]


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_scores_equal_the_plain_model(order):
    learned = drawn(order, 30) + [b"", "été".encode()]
    texts = drawn(order + 50, 30, "abcéA z") + [b""] + learned[:5]
    cells, rows = ppm.cells_at(*ppm.framed(*buffers(texts), order), order)
    found = np.bincount(rows, trie(learned, order).score(cells), len(texts))
    plain = Plain(learned, order)
    assert np.allclose(found, [plain.text(t) for t in texts], rtol=1e-6)


def test_probabilities_of_a_context_sum_to_one():
    model = trie(drawn(9, 40), 3)
    for context in (0x616261, 0x7A7A61, 0x7A7A7A, 0xFEFEFE):
        cells = np.uint64(context << 8) + np.arange(256, dtype=np.uint64)
        assert math.isclose((10 ** model.score(cells)).sum(), 1, rel_tol=1e-6)


def test_nothing_learned_is_uniform():
    cells, _ = ppm.cells_at(*ppm.framed(*buffers([b"abc"]), 4), 4)
    assert np.allclose(trie([], 4).score(cells), -math.log10(256))


def test_hash_table():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**56, 5000, dtype=np.uint64))
    table = ppm.HashTable(keys, np.arange(len(keys)))
    assert (table.get(keys) == np.arange(len(keys))).all() and np.isnan(table.get(keys + np.uint64(1 << 60))).all()


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_query_against_counters_and_the_plain_model(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    counts = Counter()
    for i in set(texts) - held:
        counts.update(texts[i].lower().split() + ["end"])
    total, kinds = sum(counts.values()), len(counts)
    plain = Plain([texts[i] for i in texts if i not in held], ppm.ORDER)
    found = rows_of(queries.op3_ppm_scores(spark, sf))
    assert set(found) == set(texts)
    for i, r in found.items():
        tokens = texts[i].lower().split() + ["end"]
        assert r["held_out"] == (i in held) and r["n_tokens"] == len(tokens) and r["train_tokens"] == total
        assert r["n_known"] == sum(counts[t] > 0 for t in tokens)
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in tokens)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
    for i in sorted(texts, key=lambda i: len(texts[i]))[:40]:
        assert math.isclose(found[i]["score"], plain.text(texts[i]), rel_tol=1e-6)


def test_held_out_texts_score_above_shuffled_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars > 200")
    rnd, rows = random.Random(4), []
    for r in docs.collect():
        rows.append((r["doc_id"], r["text"], zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2))
    mixed = [(i + 10**6, "".join(rnd.sample(t, len(t))), True) for i, t, h in rows if h]
    both = spark.createDataFrame(rows + mixed, "doc_id bigint, text string, h boolean")
    found = rows_of(ppm.language_scores(both, "h"))
    assert all(found[i]["score"] > found[i + 10**6]["score"] for i, _, h in rows if h)


@pytest.mark.parametrize("parts", [7, 300])
def test_a_trie_that_stays_in_the_cluster_gives_the_same(spark, parts, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    foreign = [(10**6 + i, "щё ~ новый " * 40, True) for i in range(30)]  # often held out, never learned
    docs = docs.selectExpr("doc_id", "text", "doc_id % 5 = 0 AS h").unionByName(
        spark.createDataFrame(foreign, "doc_id bigint, text string, h boolean"))
    whole = rows_of(ppm.language_scores(docs, "h"))
    size = ppm.Model(docs.where("NOT h").select(ppm.text_bytes())).size
    collected = []
    real = ppm._collected
    monkeypatch.setattr(ppm, "_collected", lambda *a: collected.append(real(*a)) or collected[-1])
    cut = rows_of(ppm.language_scores(docs, "h", part_cells=-(-size // parts), common_tokens=50))
    assert set(whole) == set(cut)
    for i, r in whole.items():
        assert all(r[c] == cut[i][c] for c in ("held_out", "n_tokens", "n_known", "train_tokens"))
        assert math.isclose(r["score"], cut[i]["score"], rel_tol=1e-6)
        assert math.isclose(r["base_score"], cut[i]["base_score"], rel_tol=1e-9)
    low, common = (len(cells) for cells, _ in collected)  # nothing else of the trie comes to the driver
    assert common <= -(-size // parts) and low < size


@pytest.mark.parametrize("part_cells", [3_000_000, 5])
def test_edge_rows(spark, part_cells):
    rows = [(1, None, "x", 1.0), (2, "", "y", 2.0), (None, "One two", "z", None), (3, "one " * 100_000, None, 1.0),
            (4, "one é", "k", 3.0), (4, "one é", "k", 3.0), (5, "\t\n", "q", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, key string, score double")
    found = ppm.language_scores(docs, "doc_id = 4", 3, part_cells).collect()
    assert len(found) == len(rows) and {r["train_tokens"] for r in found} == {5 + 2 + 100_000}
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[4]["n_known"] == 2 and by_id[4]["held_out"] and not by_id[None]["held_out"]
    assert by_id[1]["n_tokens"] == 1 and math.isclose(by_id[1]["score"], by_id[2]["score"])
    assert ppm.language_scores(docs.limit(0), "doc_id = 4").count() == 0
    unseen = ppm.language_scores(docs, "true").collect()
    assert {r["n_known"] for r in unseen} == {0} and {r["train_tokens"] for r in unseen} == {0}
