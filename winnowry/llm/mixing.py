"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected the same number of times, its source's
target divided by its source's size. In order of size, a running sum of these
numbers plus one random offset per source crosses integers; a document is
emitted once per integer it crosses. Because neighbours in that order are about
equally long, the words taken differ from the target by about one document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnowry.llm.common import checked_broadcast
from winnowry.operators.ranking import global_rank
from winnowry.staging import stage

WEIGHTS = (5, 2, 1)
CAP = 3
OFFSET_DIGITS = 5


def word_count(text: str = "text") -> Column:
    """Words of a text; a null text has none."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``(source, source_size, target)``: shares of all sizes by weight, at most ``cap`` times the size.

    Sources in code point order, null last, take the weights in turn. What a cap
    cuts off is shared anew by weight until no target is above its cap: each
    round is one sum over the sources.
    """
    totals = stage(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    named = totals.where("source IS NOT NULL")
    place = global_rank(named, ["source"], "place").union(
        totals.where("source IS NULL").withColumn("place", F.lit(named.count() + 1).cast("bigint"))
    )
    in_turn = F.get(F.lit(list(weights)), F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int"))
    shared = stage(
        place.select("source", "source_size", in_turn.cast("bigint").alias("weight")), "weights"
    )
    most = F.col("source_size") * cap
    whole = shared.agg(F.sum("source_size")).first()[0] or 0
    left, free = whole, None
    while True:
        capped = F.lit(False) if free is None else most * free < F.col("weight") * left
        used, weight = shared.agg(
            F.sum(F.when(capped, most)), F.sum(F.when(~capped, F.col("weight")))
        ).first()
        step = whole - (used or 0), weight or 0
        if step == (left, free):
            break
        left, free = step
        if not free:
            break
    if not free:
        target = most.cast("double")
    else:
        share = (F.col("weight") * left).cast("double") / F.lit(float(free))
        target = F.when(most * free < F.col("weight") * left, most.cast("double")).otherwise(share)
    return shared.select("source", "source_size", target.alias("target"))


def source_offset(source: str = "source", seed: int = 42) -> Column:
    """A fixed random number from 0 to 1 for a source; null has its own."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("null")))
    digits = F.substring(F.md5(text), 1, OFFSET_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / float(16**OFFSET_DIGITS)


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: int = 42
) -> DataFrame:
    """``(doc_id, size, source_size, target, copies, taken)`` per row of ``docs``.

    The order within a source is (size, doc_id). It is cut into ranges that are
    written with their number, so that a source of any size is numbered by many
    tasks: place in the range plus the rows of the ranges before. Empty texts
    have size 0 and take places like any other; a source of size 0 has target 0
    and no copies; rows repeating a ``doc_id`` count and are placed one by one.
    """
    return _placed(docs, weights, cap, seed).select("doc_id", "size", "source_size", "target", "copies", "taken")


def _placed(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: int = 42, more: Sequence[Column] = ()
) -> DataFrame:
    """The rows of ``mix_sources`` with their source and the columns ``more``."""
    sizes = docs.select("doc_id", "source", word_count().alias("size"), *more)
    ranged = sizes.repartitionByRange("source", "size", "doc_id")
    cut = stage(ranged.withColumn("part", F.spark_partition_id()), "sizes")
    targets = source_targets(cut, weights, cap)
    parts = cut.groupBy("source", "part").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        F.col("source").alias("s"), F.col("part").alias("p"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"),
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    starts = stage(
        starts.join(targets, F.col("s").eqNullSafe(F.col("source")))
        .select("s", "p", "start", "source_size", "target", rate.alias("rate")), "starts",
    )
    place = F.row_number().over(Window.partitionBy("part", "source").orderBy("size", "doc_id"))
    # one row per range and source: as few as ranges plus sources
    placed = cut.withColumn("place", place).join(
        checked_broadcast(starts), F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))
    )
    number = F.col("start") + F.col("place")
    crossed = F.floor(source_offset(seed=seed) + number * F.col("rate")) - F.floor(
        source_offset(seed=seed) + (number - 1) * F.col("rate")
    )
    copies = F.least(crossed, F.lit(cap))
    return placed.withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies"))


def emit_mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with the same columns.

    A row is known by ``doc_id``, source and a hash of its text. Rows that agree in
    all three are equally long; if the mix takes them differently often, they are
    numbered, and as many of them as the mix has decided get each number of copies.
    """
    names, row = docs.columns, ["__id", "__source", "__h"]
    given = docs.withColumns({"__id": F.col("doc_id"), "__source": F.col("source"), "__h": F.xxhash64("text")})
    key = [F.col("doc_id").alias("__id"), F.col("source").alias("__source"), "__h"]
    counted = _placed(docs, **options, more=[F.xxhash64("text").alias("__h")]).groupBy(
        *key, F.col("copies").cast("int").alias("__copies")
    ).agg(F.count("*").alias("__rows"))
    alike = Window.partitionBy(*row)
    upto = F.sum("__rows").over(alike.orderBy("__copies"))
    decided = stage(
        counted.withColumns({"__kinds": F.count("*").over(alike), "__last": upto})
        .where("__copies > 0").select(*row, "__copies", "__kinds", "__rows", "__last"), "copies",
    )

    def taken(rows: DataFrame, copies: DataFrame, *conditions: Column) -> DataFrame:
        copies = copies.withColumnsRenamed({c: f"{c}_taken" for c in row})
        same = [rows[c].eqNullSafe(copies[f"{c}_taken"]) for c in row]
        joined = rows.join(checked_broadcast(copies), [*same, *conditions])
        return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*names)

    emitted = taken(given, decided.where("__kinds = 1"))
    several = decided.where("__kinds > 1")
    if several.isEmpty():
        return emitted
    keys = several.select(*(F.col(c).alias(f"{c}_several") for c in row)).distinct()
    same = [given[c].eqNullSafe(keys[f"{c}_several"]) for c in row]
    # alike rows have no order of their own: their numbers are written, so that a lost executor renumbers none
    numbered = stage(given.join(checked_broadcast(keys), same, "left_semi").withColumn(
        "__number", F.row_number().over(alike.orderBy(F.lit(0)))
    ), "numbered")
    between = (F.col("__number") <= F.col("__last")) & (F.col("__number") > F.col("__last") - F.col("__rows"))
    return emitted.union(taken(numbered, several, between))


SQL = rf"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM d GROUP BY source
), w AS (
  SELECT *, sum(source_size) OVER () AS whole,
         coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM s
), c AS (
  SELECT *, 3 * source_size * free < weight * (whole - used) AS capped FROM w
), t AS (
  SELECT source, source_size, CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE) ELSE
    CAST(weight * (whole - coalesce(sum(3 * source_size) FILTER (WHERE capped) OVER (), 0)) AS DOUBLE)
      / CAST(sum(weight) FILTER (WHERE NOT capped) OVER () AS DOUBLE) END AS target,
    CAST(('0x' || substr(md5('42:' || coalesce('s' || source, 'null')), 1, 5)) AS BIGINT) / 1048576.0::DOUBLE AS u
  FROM c
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM t
), p AS (
  SELECT doc_id, source, size, row_number() OVER (PARTITION BY source ORDER BY size, doc_id) AS i FROM d
)
SELECT doc_id, size, source_size, target,
       CAST(size * least(floor(u + i * rate) - floor(u + (i - 1) * rate), 3) AS BIGINT) AS taken
FROM p JOIN r ON p.source IS NOT DISTINCT FROM r.source
"""
