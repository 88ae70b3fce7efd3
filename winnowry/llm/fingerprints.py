"""Document fingerprints by SimHash, with DataFrame operations alone.

Every word of a text votes on 64 signed bits with the bits of its hash, weighted by
the square of its length: long words tell texts apart, short ones hardly. Votes
are summed two bits to a number, a 32-bit lane each. A word's weight is at most its
length in bytes and a text has under 2**31 bytes, so no lane can overflow.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnowry.operators.joins import left_join_hot
from winnowry.operators.ranking import BUCKET, order_bucket
from winnowry.staging import stage

BITS = 64
LANES = 32
LANE = (1 << 32) - 1
BOTH = 1 | 1 << 32  # one bit in each lane
LONGEST = 16  # longer words weigh no more than this many characters
ROWS_PER_BUCKET = 2_000
HOT_ROWS = 256  # a key of more fingerprints is sent to them, not they to its task
CROWD = 1_000  # fingerprints on one key, above which the bits outside the key are cut into blocks too
SPACE = r"[\x20\x09-\x0D]+"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def words(text: Column) -> Column:
    """Lower-cased words; an empty one, which weighs nothing, stands for missing ones."""
    return F.split(F.lower(text), SPACE, -1)


def weight(word: Column) -> Column:
    size = F.least(F.char_length(word), F.lit(LONGEST))
    weighed = F.greatest(F.lit(1), F.shiftright(size * size, 4))
    return F.when(size == 0, 0).otherwise(weighed).cast("bigint")


def votes(exploded: DataFrame, keys: list[str], word: str = "word") -> DataFrame:
    """Per key the signed-bit majority ``fp`` of its words' hashes; a tie is a zero bit.

    Words of a key lie in one partition, so sums are made before, and here
    without, a shuffle.
    """
    weighed = exploded.select(*keys, F.xxhash64(word).alias("h"), weight(F.col(word)).alias("w"))
    lanes = [
        F.sum(F.shiftrightunsigned("h", i).bitwiseAND(F.lit(BOTH)) * F.col("w")).alias(f"v{i}") for i in range(LANES)
    ]
    summed = weighed.groupBy(*keys).agg(F.sum("w").alias("w"), *lanes)
    fp = F.lit(0).cast("bigint")
    for i in range(LANES):
        for lane, bit in ((F.col(f"v{i}").bitwiseAND(F.lit(LANE)), i), (F.shiftrightunsigned(f"v{i}", 32), i + LANES)):
            fp = fp.bitwiseOR(F.when(lane * 2 > F.col("w"), F.lit(_signed(1 << bit))).otherwise(F.lit(0)))
    return summed.select(*keys, fp.alias("fp"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)`` per distinct ``doc_id`` and text; a null or empty text has fingerprint 0."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64(text).alias("h1"), F.explode(words(text)).alias("word"))
    return votes(keyed, ["doc_id", "h1"]).select("doc_id", "fp")


def with_next(docs: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``(bucket, place, ghost, doc_id, text, next_text)``: each row with the text that follows.

    Rows are ordered by (doc_id, text), a null id first; the last is followed by the
    first. The order is cut into buckets; the rows that begin a bucket also end
    the bucket before it, as ghosts, so that every row finds its follower in its
    own bucket. Buckets are bounded up to 100,000 of them; beyond, the window of a
    task sorts and spills more rows.
    """
    narrow = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    bucketed, _ = order_bucket(narrow, ["doc_id"], rows_per_bucket)
    given = F.struct(F.col("doc_id").isNotNull().alias("named"), F.col("doc_id").alias("id"))
    heads = [(r[BUCKET], r["head"]["id"]) for r in bucketed.groupBy(BUCKET).agg(F.min(given).alias("head")).collect()]
    heads.sort()  # one per bucket
    before = [heads[i - 1][0] for i in range(len(heads))]
    targets = docs.sparkSession.createDataFrame(
        [(head, bucket) for (_, head), bucket in zip(heads, before)], "head bigint, target int"
    )
    places = F.filter(
        F.array(
            F.struct(F.col(BUCKET).alias("bucket"), F.lit(False).alias("ghost")),
            F.struct(F.col("target").alias("bucket"), F.lit(True).alias("ghost")),
        ),
        lambda p: p["bucket"].isNotNull(),
    )
    placed = bucketed.join(F.broadcast(targets), F.col("doc_id").eqNullSafe(F.col("head")), "left").select(
        "doc_id", "text", F.explode(places).alias("p")
    )
    order = Window.partitionBy("bucket").orderBy("ghost", "doc_id", "text")
    return placed.select("p.bucket", "p.ghost", "doc_id", "text").select(
        "bucket", F.row_number().over(order).alias("place"), "ghost", "doc_id", "text",
        F.lead("text").over(order).alias("next_text"),
    )


def edited_fingerprints(docs: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next document's text.

    The edited text ends, instead of in its last quarter, with as many characters from
    the start of the next document, or all it has. Returns ``doc_id, n_chars,
    edited_sha256, fp, edited_fp, next_fp`` per row. Texts cross the network once,
    to their bucket; words, votes and followers stay there.
    """
    followed = with_next(docs, rows_per_bucket)
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - quarter), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), quarter)
    )
    keys = ["bucket", "place", "ghost", "doc_id", "n_chars", "edited_sha256", "is_edited"]
    both = followed.select(
        "bucket", "place", "ghost", "doc_id", n.cast("bigint").alias("n_chars"), "text", edited.alias("edited")
    ).withColumn("edited_sha256", F.sha2("edited", 256))
    texts = F.explode(F.array(
        F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("t")),
        F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("t")),
    ))
    exploded = both.withColumn("x", texts).select(
        *keys[:-1], F.col("x.is_edited").alias("is_edited"), F.explode(words(F.col("x.t"))).alias("word")
    )
    voted = votes(exploded, keys)
    pairs = voted.groupBy(*keys[:-1]).agg(
        F.max(F.when(~F.col("is_edited"), F.col("fp"))).alias("fp"), F.max(F.when(F.col("is_edited"), F.col("fp"))).alias("edited_fp")
    )
    following = F.lead("fp").over(Window.partitionBy("bucket").orderBy("place"))
    return pairs.withColumn("next_fp", following).where(~F.col("ghost")).drop("bucket", "place", "ghost")


def likeness(a: str, b: str) -> Column:
    """Share of equal bits of two fingerprints."""
    return 1 - F.bit_count(F.col(a).bitwiseXOR(F.col(b))) / float(BITS)


def hex_digits(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def block_masks(radius: int, blocks: int) -> list[int]:
    """Masks of the permuted tables: each keeps ``blocks - radius`` of the blocks of bits."""
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("there must be more blocks than bits that may differ")
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    kept = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]
    return [_signed(sum(c)) for c in combinations(kept, blocks - radius)]


def near_fingerprints(prints: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """``(a, b)``: all pairs of different fingerprints ``fp`` within ``radius`` bits, ``a < b``.

    Fingerprints that differ in ``radius`` bits agree on all other blocks, hence on
    the whole key of one table at least. Equal fingerprints are one, so copies
    cost nothing; keys are joined, and adaptive execution may split frequent ones.
    """
    masks = F.lit(block_masks(radius, blocks))
    keyed = prints.where("fp IS NOT NULL").select("fp").distinct().select("fp", F.posexplode(masks).alias("table", "mask"))
    keyed = keyed.select("fp", "table", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    left, right = keyed.withColumnRenamed("fp", "a"), keyed.withColumnRenamed("fp", "b")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    return left.join(right, ["table", "key"]).where(F.col("a") < F.col("b")).where(close).select("a", "b").distinct()


def _blocks_outside(mask: int, radius: int, blocks: int) -> list[int]:
    """Masks of further tables for fingerprints that agree on ``mask``, over the bits outside it."""
    outside = [i for i in range(BITS) if not mask >> i & 1]
    if len(outside) < blocks:
        return [0]
    edges = [round(i * len(outside) / blocks) for i in range(blocks + 1)]
    kept = [sum(1 << i for i in outside[low:high]) for low, high in zip(edges, edges[1:])]
    return [_signed(sum(c)) for c in combinations(kept, blocks - radius)]


def near_counts(prints: DataFrame, radius: int = 3, blocks: int = 6, crowd: int = CROWD) -> DataFrame:
    """``(fp, copies, n_near)`` per distinct ``fp``: its rows, and the other rows within ``radius`` bits.

    Fingerprints meet in the permuted block tables. A pair counts in the first
    table it meets in, so no list of pairs is kept: sums are made where pairs
    are found. A key of more than ``crowd`` different fingerprints is met by the blocks
    of its other bits as well. Equal fingerprints are one with a count; null ones take no part.
    """
    masks = block_masks(radius, blocks)
    counted = stage(prints.where("fp IS NOT NULL").groupBy("fp").agg(F.count("*").alias("copies")), "fingerprints")
    keyed = counted.select("fp", "copies", F.posexplode(F.lit(masks)).alias("table", "mask"))
    keyed = keyed.select("fp", "copies", "table", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    shared = stage(keyed.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1"), "keys")
    met = stage(left_join_hot(keyed, shared, ["table", "key"], "n", HOT_ROWS).where("n > 1"), "met")

    outside = [_blocks_outside(m & (1 << BITS) - 1, radius, blocks) for m in masks]
    finer = F.element_at(F.array(*map(F.lit, outside)), F.col("table") + 1)
    many = met.where(F.col("n") > crowd).select("fp", "copies", "table", "key", F.posexplode(finer).alias("part", "mask"))
    many = many.select("fp", "copies", "table", "part", F.col("key").bitwiseOR(F.col("fp").bitwiseAND(F.col("mask"))).alias("key"))

    differ = F.col("a").bitwiseXOR(F.col("b"))
    first = F.coalesce(*(F.when(differ.bitwiseAND(F.lit(m)) == 0, i) for i, m in enumerate(masks))) == F.col("table")
    first_part = F.array_position(F.transform(finer, lambda m: differ.bitwiseAND(m) == 0), True) == F.col("part") + 1

    def near(rows: DataFrame, keys: list[str], once: Column) -> DataFrame:
        left, right = rows.select(*keys, F.col("fp").alias("a")), rows.select(*keys, F.col("fp").alias("b"), "copies")
        close = (F.col("a") != F.col("b")) & (F.bit_count(differ) <= radius)
        return left.join(right, keys).where(close).where(once).select("a", "copies")

    pairs = near(met.where(F.col("n") <= crowd), ["table", "key"], first).union(
        near(many, ["table", "part", "key"], first & first_part)
    )
    others = pairs.groupBy(F.col("a").alias("fp")).agg(F.sum("copies").alias("others"))
    return counted.join(others, "fp", "left").select(
        "fp", "copies", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_near")
    )


def with_near_counts(rows: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """``rows`` with ``n_near``: how many other rows have a fingerprint ``fp`` within ``radius`` bits."""
    counts = stage(near_counts(rows, radius, blocks), "near")
    return left_join_hot(rows, counts, ["fp"], "copies").drop("copies")
