"""Systematic mixing: targets by hand, counts by rule."""

import math

from winnowry.llm import mixing


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, size string, part int")


def words(n):
    return " ".join(["w"] * n)


def test_targets_are_capped_and_reshared(spark):
    sizes = spark.createDataFrame(
        [("a", 10), ("b", 1000), ("c", 1000), ("d", 90), (None, 400)], "source string, size bigint"
    )
    found = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    # weights a 5, b 2, c 1, d 5, null 2: a and d stop at three times their size
    rest = 2500 - 30 - 270
    assert found["a"] == 30 and found["d"] == 270
    assert math.isclose(found["b"], rest * 2 / 5) and math.isclose(found["c"], rest * 1 / 5)
    assert math.isclose(found[None], rest * 2 / 5) and math.isclose(sum(found.values()), 2500)


def test_taken_words_come_near_targets(spark):
    rows = [(i, words(1 + i * 7 % 50), "ab"[i % 3 == 0], "x", i) for i in range(3000)]
    found = mixing.mix_sources(frame(spark, rows)).collect()
    assert len(found) == 3000
    for target in {r["target"] for r in found}:
        same = [r for r in found if r["target"] == target]
        assert abs(sum(r["taken"] for r in same) - target) <= 200
        assert all(r["taken"] in (r["size"] * c for c in range(4)) for r in same)


def test_reruns_and_partitionings_agree(spark):
    rows = [(i, words(i % 13), "abc"[i % 3], "x", i) for i in range(500)]
    a = mixing.mix_sources(frame(spark, rows)).collect()
    b = mixing.mix_sources(frame(spark, rows[::-1]).repartition(7)).collect()
    assert sorted(a) == sorted(b)


def test_edge_rows(spark):
    rows = [
        (1, None, "a", None, None), (2, "", "a", None, 1), (3, words(5), None, "9", 1), (3, words(5), None, "9", 1),
        (None, words(4), "b", "1", 1), (4, words(300_000), "c", "1", 2), (5, " \t", "empty", "", 0),
    ]
    docs = frame(spark, rows)
    found = mixing.mix_sources(docs).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: r["size"] for r in found} == {1: 0, 2: 0, 3: 5, None: 4, 4: 300_000, 5: 0}
    assert all(r["taken"] <= 3 * r["size"] for r in found)
    emitted = mixing.emit_mix(docs)
    assert emitted.columns == docs.columns
    assert mixing.mix_sources(docs.limit(0)).count() == 0 and mixing.emit_mix(docs.limit(0)).count() == 0


def test_emitted_rows_are_the_copies(spark):
    rows = [(i, words(i % 40), "abcd"[i % 4 if i % 8 else 0], "x", i) for i in range(800)]
    docs = frame(spark, rows)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(docs).collect()}
    emitted = {r["doc_id"]: r["count"] for r in mixing.emit_mix(docs).groupBy("doc_id").count().collect()}
    assert emitted == {i: c for i, c in copies.items() if c}


def test_rows_without_or_with_repeated_ids_keep_their_own_copies(spark):
    """Each row is emitted as the mix decided for it, so the emitted words are the taken ones."""
    rows = [(None, words(1 + i % 40) + f" n{i}", "abc"[i % 3], "x", i) for i in range(300)]
    rows += [(i % 9, words(1 + i % 30), "ab"[i % 2], None, i) for i in range(300)]
    rows += [(5, words(12), "a", "same", 1)] * 50 + [(None, words(7), None, "same", 1)] * 50 + [(None, None, "a", "", 2)] * 20
    docs = frame(spark, rows)
    decided = mixing.mix_sources(docs).collect()
    emitted = mixing.emit_mix(docs).collect()

    def by_size(pairs):
        found = {}
        for k, n in pairs:
            found[k] = found.get(k, 0) + n
        return {k: n for k, n in found.items() if n}

    assert by_size(((r["doc_id"], r["size"]), r["copies"]) for r in decided) == by_size(
        ((r["doc_id"], len((r["text"] or "").split())), 1) for r in emitted
    )
    assert set(emitted) <= set(docs.collect())
    assert any(r["copies"] == 0 for r in decided if r["doc_id"] is None)
    assert sum(len((r["text"] or "").split()) for r in emitted) == sum(r["taken"] for r in decided)
    counts = by_size((r, 1) for r in emitted if r["doc_id"] is None and r["source"] == "c")
    copies = sorted(r["copies"] for r in decided if r["doc_id"] is None and r["copies"])
    assert max(counts.values()) <= 3 and len(copies) >= len(counts)


def test_numbers_of_alike_rows_are_read_from_a_written_table(spark):
    """Rows alike in id, source and text but not in another column: each decided number of copies is given once."""
    docs = spark.range(60).selectExpr("1L AS doc_id", "'a' AS source", "'one two' AS text", "id AS other").unionByName(
        spark.range(200).selectExpr("id + 10 AS doc_id", "'b' AS source", "'three' AS text", "id AS other"))
    emitted = mixing.emit_mix(docs)
    decided = [("a" if r["doc_id"] == 1 else "b", r["taken"] // r["size"]) for r in mixing.mix_sources(docs).collect()]
    counts = lambda s: sorted(n for source, n in decided if source == s and n)
    found = {}
    for r in emitted.collect():
        found[r["source"], r["other"]] = found.get((r["source"], r["other"]), 0) + 1
    for s in "ab":
        assert sorted(n for (source, _), n in found.items() if source == s) == counts(s)
    assert any("numbered" in f for f in emitted.inputFiles())
