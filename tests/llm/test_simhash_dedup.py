"""SimHash near-dedup against every pair of fingerprints."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from winnowry.llm import queries, simhash_dedup


def brute_fingerprint(text, words):
    found = (text or "").encode().lower().split()
    runs = [found[i : i + words] for i in range(len(found) - words + 1)] if len(found) >= words else [found] * bool(found)
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = queries.op1_simhash_dedup(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    prints = {i: brute_fingerprint(t, 3) for i, t in texts.items()}
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute_components(prints, 2)


@pytest.mark.parametrize("radius", [2, 4])
def test_links_of_random_fingerprints(spark, radius):
    drawn = random.Random(radius)
    prints = {}
    for i in range(60):
        p = drawn.getrandbits(64) if i % 6 == 0 else prints[drawn.randrange(i)]
        for _ in range(drawn.randint(0, radius + 1)):
            p ^= 1 << drawn.randrange(64)
        prints[i] = p
    signed = {i: p - (1 << 64) if p >> 63 else p for i, p in prints.items()}
    classes = spark.createDataFrame([(p, i) for i, p in signed.items()], "fp bigint, first bigint")
    classes = classes.groupBy("fp").agg(F.min("first").alias("first"))
    links = simhash_dedup.fingerprint_links(classes, radius).collect()
    assert all((prints[r["a"]] ^ prints[r["b"]]).bit_count() <= radius for r in links)
    docs = spark.createDataFrame([(i, p) for i, p in signed.items()], "doc_id bigint, fp bigint")
    named = simhash_dedup.connected_components(links and spark.createDataFrame(links) or docs.limit(0))
    named = {r["id"]: r["component_id"] for r in named.collect()}
    firsts = {p: min(i for i in prints if prints[i] == p) for p in prints.values()}
    assert {i: named.get(firsts[p], firsts[p]) for i, p in prints.items()} == brute_components(prints, radius)


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        simhash_dedup.fingerprint_links(spark.createDataFrame([(1, 1)], "fp bigint, first bigint"), 3)


def test_edge_rows(spark):
    rows = [
        (5, None, "a", 1), (3, "", "b", 1), (4, " \t\n", "c", 1), (9, "One", "d", 1), (8, "one ", None, 1),
        (7, "one two", "e", 1), (7, "one two", "e", 1), (None, "solo", "f", 1), (6, "word " * 200_000, "g", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string, component_id int")
    found = simhash_dedup.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    groups = {r["doc_id"]: (r["fp"], r["component_id"]) for r in found}
    assert groups[5] == groups[3] == groups[4] == (0, 3)
    assert groups[9] == groups[8] and groups[9][1] == 8
    assert groups[7][1] == 7 and groups[None][1] is None and groups[6][1] == 6
    assert simhash_dedup.near_duplicates(docs.limit(0)).count() == 0


def shingle_set(text, words=5):
    found = (text or "").encode().lower().split()
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def test_near_copies_against_all_pairs(spark):
    """Links may be missed only by the fingerprints, which is rare; none is made up."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets = {r["doc_id"]: shingle_set(r["text"]) for r in docs.collect()}
    places = {}
    for i, s in sets.items():
        for x in s or {None}:
            places.setdefault(x, []).append(i)
    shared = {}
    for ids in places.values():
        for n, j in enumerate(ids):
            for i in ids[:n]:
                shared[i, j] = shared.get((i, j), 0) + 1
    links = [p for p, n in shared.items() if n >= 0.8 * len(sets[p[0]] | sets[p[1]])]
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in links:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    exact = {i: find(i) for i in sets}
    found = {r["id"]: r["component_id"] for r in simhash_dedup.near_copies(docs).collect()}
    assert set(found) == set(exact) and len(links) > 20
    assert all(exact[i] == exact[c] for i, c in found.items())
    grouped = [i for i in exact if exact[i] != i]
    assert sum(found[i] == exact[i] for i in grouped) >= 0.98 * len(grouped)
    kept = {r["doc_id"] for r in simhash_dedup.one_of_each(docs).collect()}
    assert kept == {i for i, c in found.items() if i == c}


def test_one_of_each_edge_rows(spark):
    base = [f"w{i}" for i in range(300)]
    changed = " ".join(base[:150] + ["x"] + base[151:])
    far = " ".join(base[:150] + [f"y{i}" for i in range(150)])
    rows = [
        (9, " ".join(base), "a", 1), (4, changed.upper(), "b", 2), (5, far, None, 3), (6, None, "c", 4), (7, "", "d", 5),
        (8, "two words", "e", 6), (8, "two words", "e", 6), (10, "two  WORDS", "f", None), (None, changed, "g", 7),
        (11, "long " * 200_000, "h", 8),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id string, component_id int")
    kept = simhash_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([4, 5, 6, 8, 8, None, 11], key=str)
    assert simhash_dedup.one_of_each(docs.limit(0)).count() == 0


def test_near_copies_of_every_kind_of_edit(spark):
    """No pair of Jaccard similarity 0.8 or more is missed, however the copy was made."""
    drawn = random.Random(5)
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text IS NOT NULL").orderBy("doc_id")
    texts = [w for w in (r["text"].split() for r in given.collect()) if len(w) >= 60][:240]
    foreign = [f"f{i}" for i in range(100_000)]

    def edited(words, kind):
        words, n = list(words), len(words)
        if kind == "replace":
            for i in drawn.sample(range(n), max(1, n // 60)):
                words[i] = f"r{i}"
        elif kind == "append":
            words += drawn.sample(foreign, drawn.randint(1, n // 4))
        elif kind == "truncate":
            words = words[: n - drawn.randint(1, n // 5)]
        else:
            cut = drawn.randint(n // 4, 3 * n // 4)
            words = words[cut:] + words[:cut]
        return " ".join(words)

    rows, pairs = [], []
    for n, words in enumerate(texts):
        kind = ("replace", "append", "truncate", "reorder")[n % 4]
        made = " ".join(f"{w}_{n}" for w in words), edited([f"{w}_{n}" for w in words], kind)
        rows += [(2 * n, made[0]), (2 * n + 1, made[1])]
        x, y = map(shingle_set, made)
        pairs.append((n, kind, len(x & y) >= 0.8 * len(x | y)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["id"]: r["component_id"] for r in simhash_dedup.near_copies(docs).collect()}
    similar = {kind: [n for n, k, close in pairs if k == kind and close] for _, kind, _ in pairs}
    assert all(len(ns) >= 20 for ns in similar.values())
    assert {k: sum(found[2 * n + 1] == 2 * n for n in ns) / len(ns) for k, ns in similar.items()} == dict.fromkeys(similar, 1.0)
    assert all(found[2 * n + 1] == 2 * n + 1 for n, _, close in pairs if not close)


def test_similar_texts_behind_an_unlike_first(spark):
    """Texts of the same distinct words, of which the smallest id is unlike the others."""
    drawn = random.Random(7)
    words = [f"w{i}" for i in range(200)]
    base = words + words[:6]
    rows = [(1, drawn.sample(words, 200)), (2, base), (3, words), (4, drawn.sample(words, 200))]
    rows += [(i, drawn.sample(base, len(base))) for i in range(5, 30)] + [(30, rows[3][1] + words[:5])]
    # and a crowd around two texts that share a quarter with the first of all
    first, second = ([f"{c}{i}" for i in range(90)] for c in "ab")
    rows += [(100, words[:30] + first), (101, words[:30] + second)]
    rows += [(110 + 2 * i + n, words[:30] + t + [f"x{i}"]) for i in range(40) for n, t in enumerate((first, second))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")
    found = {r["id"]: r["component_id"] for r in simhash_dedup.near_copies(docs).collect()}
    expected = {i: i for i in found} | {3: 2, 30: 4} | {110 + 2 * i + n: 100 + n for i in range(40) for n in range(2)}
    assert found == expected


def test_links_among_all_on_one_key(spark):
    """Every text meets every other on one key; all similar pairs are joined, whichever is the smallest."""
    drawn = random.Random(11)
    sets = {}
    for i in range(120):
        near = sets[drawn.randrange(i)] if i % 5 else None
        sets[i] = {0, *drawn.sample(range(1, 100_000), 40)} if near is None else set(near)
        if near is not None:
            for x in drawn.sample(sorted(near - {0}), drawn.randint(1, 6)):
                sets[i] ^= {x, drawn.randrange(100_000, 200_000)}
    shared = spark.createDataFrame([(7, i, len(s), 0) for i, s in sets.items()], "key bigint, id bigint, size bigint, at int")
    packed = [(i, np.array(sorted(s), np.uint32).tobytes()) for i, s in sets.items()]
    links = simhash_dedup.shingle_links(shared, spark.createDataFrame(packed, "id bigint, shingles binary"), 0.8)
    found = {r["id"]: r["component_id"] for r in simhash_dedup.connected_components(links).collect()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert {i: found.get(i, i) for i in sets} == {i: find(i) for i in sets}
    assert len({find(i) for i in sets}) > 24


@pytest.fixture
def verified(monkeypatch):
    """Nothing is known of common shingles beforehand; counts the pairs that are verified."""
    counts, similar = [], simhash_dedup._similar

    def counted(pairs, sets, similarity):
        counts.append(pairs.count())
        return similar(pairs, sets, similarity)

    monkeypatch.setattr(simhash_dedup, "_common_shingles", lambda docs: (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    monkeypatch.setattr(simhash_dedup, "_similar", counted)
    return counts


def all_pairs_components(texts, similarity=0.8):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and both >= similarity * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_a_passage_in_thousands_of_unlike_texts(spark, verified):
    """Unlike texts that meet on a shared passage are not verified pair by pair; near copies among them are found."""
    drawn = random.Random(3)
    passage = [f"p{i}" for i in range(12)]
    words = {i: passage + [f"u{drawn.randrange(10**9)}" for _ in range(30)] for i in range(3000)}
    for i in range(0, 3000, 30):
        words[3000 + i] = [*words[i], "tail"]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in words.items()], "doc_id bigint, text string")
    found = {r["id"]: r["component_id"] for r in simhash_dedup.near_copies(docs).collect()}
    assert found == {i: i - 3000 if i >= 3000 else i for i in words}
    assert sum(verified) < 100_000


def test_texts_made_of_crowded_shingles(spark, verified, monkeypatch):
    """Texts whose prefixes stay crowded meet on two shingles; no similar pair is missed, none is made up."""
    monkeypatch.setattr(simhash_dedup, "CROWD", 3)
    monkeypatch.setattr(simhash_dedup, "LEVELS", 2)
    paired = []
    with_second = simhash_dedup.Order.paired
    monkeypatch.setattr(simhash_dedup.Order, "paired", lambda *a: paired.append(with_second(*a)) or paired[-1])
    drawn = random.Random(4)
    lines = [[f"l{n}_{i}" for i in range(40)] for n in range(24)]
    texts = {}
    for i in range(240):
        chosen = drawn.sample(lines, 6)
        if i % 8 == 7:
            texts[i] = " ".join([*texts[i - drawn.randint(1, 7)].split(), *(f"e{i}_{k}" for k in range(drawn.randint(1, 70)))])
        else:
            texts[i] = " ".join(w for line in chosen for w in line)
    texts |= {300 + i: "one short line of five"[: 22 - i % 2] for i in range(6)} | {400: "one short line of five words"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r["id"]: r["component_id"] for r in simhash_dedup.near_copies(docs).collect()}
    exact = all_pairs_components(texts)
    assert found == exact and sum(i != c for i, c in exact.items()) > 15
    assert paired and paired[0].count() > 0


def test_near_copies_are_linked_by_fingerprints_first(spark, monkeypatch):
    """Texts within two bits and similar are one component before any shingle is compared; the others stay apart."""
    texts = {i: " ".join(f"w{i}_{k}" for k in range(3000)) for i in range(6)}
    texts |= {10 + i: texts[i].replace(f"w{i}_299", "x") for i in range(6)} | {20: "a b c d e f", 21: "a b c d e f", 22: ""}
    prints = {i: brute_fingerprint(t, 5) for i, t in texts.items()}
    close = {i: (prints[i] ^ prints[10 + i]).bit_count() <= 2 for i in range(6)}
    assert sum(close.values()) >= 2
    monkeypatch.setattr(simhash_dedup, "shingle_links", lambda shared, sets, similarity, order, grouped: simhash_dedup._stars(grouped))
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r["id"]: r["component_id"] for r in simhash_dedup.near_copies(docs).collect()}
    assert found == {i: 20 if i == 21 else i - 10 if 10 <= i < 16 and close[i - 10] else i for i in texts}
    pairs = spark.createDataFrame([(1, 7), (2, 7), (3, 6), (4, -1)], "first bigint, fp bigint")
    assert sorted(map(tuple, simhash_dedup.fingerprint_pairs(pairs).distinct().collect())) in ([(2, 1), (3, 1)], [(1, 3), (2, 1)], [(2, 1), (1, 3)])


def test_shingle_sets_leave_in_small_batches():
    """What a task holds of shingle sets is that of some texts, not of a whole batch of rows."""
    import pyarrow as pa

    class Rows:
        def mapInArrow(self, per_batch, schema):  # noqa: N802
            return per_batch

    texts = [b" ".join(b"w%d" % (i * 7 + j) for j in range(2_000)) for i in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(texts, pa.binary())], names=["id", "text"])
    found = list(simhash_dedup._shingle_sets(Rows())(iter([batch])))
    assert len(found) > 2 and max(b.nbytes for b in found) < 2 << 20
    assert [i for b in found for i in b.column(0).to_pylist()] == list(range(400))
    assert all(len(v.as_buffer()) == 4 * 1_996 for b in found for v in b.column(1))


def edited_copies(n, seed=9):
    """Copies of one text, of which each has up to a seventh of its words marked."""
    drawn = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    share = [drawn.random() / 7 for _ in range(n)]
    return {i: " ".join(f"{w}x" if drawn.random() < share[i] else w for w in base) for i in range(n)}


def test_a_crowd_of_edited_copies_is_compared_in_blocks(spark, verified, monkeypatch):
    """Copies of one text whose edits put many of them apart are not verified pair by pair; none is missed."""
    monkeypatch.setattr(simhash_dedup, "BLOCK_TEXTS", 64, raising=False)
    monkeypatch.setattr(simhash_dedup, "CROWD", 4)
    texts = edited_copies(500)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r["id"]: r["component_id"] for r in simhash_dedup.near_copies(docs).collect()}
    exact = all_pairs_components(texts)
    assert found == exact and 50 < sum(i != c for i, c in exact.items()) < 450
    assert sum(verified) < 15_000


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_blocks_of_a_crowd_join_all_similar_texts(spark, monkeypatch, block):
    """Links of two crowds, whatever the size of blocks and of matrices; texts of different crowds stay apart."""
    monkeypatch.setattr(simhash_dedup, "BLOCK_TEXTS", block)
    monkeypatch.setattr(simhash_dedup, "COLUMNS", 16)
    texts = edited_copies(40)
    sets = {i: shingle_set(t) for i, t in texts.items()}
    number = {s: n for n, s in enumerate(sorted(set().union(*sets.values())))}
    packed = [(i, np.array(sorted(number[s] for s in v), np.uint32).tobytes()) for i, v in sets.items()]
    packed += [(1000 + i, v) for i, v in packed] + [(2000, b"")]
    packed = spark.createDataFrame(packed, "id bigint, shingles binary")
    crowds = spark.createDataFrame([(i, i // 1000) for i in [*texts, *(1000 + i for i in texts)]], "id bigint, crowd bigint")
    links = simhash_dedup._all_similar(crowds, packed, 0.8)
    found = {r["id"]: r["component_id"] for r in simhash_dedup.connected_components(links).collect()}
    exact = all_pairs_components(texts)
    assert {i: found.get(i, i) for i in texts} == exact
    assert {i: found.get(1000 + i, 1000 + i) for i in texts} == {i: 1000 + c for i, c in exact.items()}


def test_rows_meet_the_heads_of_their_keys(spark, monkeypatch):
    """Keys with many rows and with few: each row has its head, once."""
    monkeypatch.setattr(simhash_dedup, "HOT_ROWS", 3)
    rows = [(k, i, 5, 0) for k in range(1, 7) for i in range(k)]
    shared = simhash_dedup._shared(spark.createDataFrame(rows, "key bigint, id bigint, size bigint, at int"))
    heads = shared.groupBy("key").agg(F.min("id").alias("head"), F.max("n").alias("n"))
    found = simhash_dedup._with_heads(shared, heads).collect()
    assert sorted((r["key"], r["id"], r["n"], r["head"]) for r in found) == [(k, i, k, 0) for k in range(2, 7) for i in range(k)]
