"""Ranking, searching and summing up dataset catalogs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnowry.operators.joins import left_join_hot
from winnowry.operators.ranking import take_ranked, top_per_group
from winnowry.staging import stage

# --- fixed values -------------------------------------------------------------
MIN_SCORE = 4
SEARCH_LIMIT = 50
TOP_TASKS = 5
TOP_DATASETS = 3
# ------------------------------------------------------------------------------

INLINE_TERMS = 64  # so few terms are tested on every text
GRAM = 3
BROADCAST_TERMS = 100_000


def score() -> Column:
    return F.coalesce(F.col("relevance_score"), F.lit(0))


def rank_order() -> list[Column]:
    return [F.desc(score()), F.asc("id")]


def rank(df: DataFrame) -> DataFrame:
    """Best score first, a missing score counts as 0."""
    return df.orderBy(*rank_order())


def filter_relevant(df: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    return df.where(score() >= min_score)


def relevance_counts(df: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    kept = F.count_if(score() >= min_score)
    return df.agg(kept.alias("kept"), (F.count(F.lit(1)) - kept).alias("dropped"))


def pick(df: DataFrame, choice: str) -> DataFrame:
    """Rows of a ranked catalog by 1-based place: ``"1,3,5"``, ``"all"``, ``"q"``.

    Tokens that are not numbers are ignored; a place that does not exist is an error.
    """
    choice = choice.strip().lower()
    if choice == "all":
        return df
    if choice in ("", "q"):
        return df.limit(0)
    places = sorted({int(t) for t in choice.split(",") if t.strip().isdigit()})
    if not places:
        return df.limit(0)
    if places[0] < 1:
        raise ValueError("places start at 1")
    top = take_ranked(df, rank_order(), places[-1], "__place")
    if top.count() < places[-1]:
        raise ValueError(f"no dataset at place {places[-1]}")
    return top.where(F.col("__place").isin(places)).drop("__place")


def _inline_hits(catalog: DataFrame, terms: Sequence[str]) -> DataFrame:
    """``catalog`` and ``__hits``: every text is tested for every term."""
    text = searched_text()
    hits = F.filter(
        F.array(*[
            F.when(
                F.contains(text, F.lit(t.lower())),
                F.struct(F.lit(i).alias("term_no"), F.lit(t).alias("term")),
            )
            for i, t in enumerate(terms)
        ]),
        lambda h: h.isNotNull(),
    )
    return catalog.withColumn("__hits", hits)


def searched_text() -> Column:
    return F.lower(F.concat_ws(" ", "id", "name"))


def _grams(text: Column, sizes: Sequence[int]) -> Column:
    """The distinct runs of so many characters in a text."""
    chars = F.regexp_extract_all(text, F.lit("(?s)(.)"), F.lit(1))

    def runs(n: int) -> Column:
        joined = F.transform(chars, lambda _, i: F.array_join(F.slice(chars, i + 1, F.lit(n)), ""))
        return F.slice(joined, F.lit(1), F.greatest(F.size(chars) - (n - 1), F.lit(0)))

    return F.array_distinct(F.concat(*[runs(n) for n in sizes]))


def _indexed_hits(catalog: DataFrame, terms: Sequence[str]) -> DataFrame:
    """``catalog`` and ``__hits``, through an inverted index of runs of three characters.

    A term is looked up by one of its runs, the one in the fewest texts (terms of
    one or two characters are such a run themselves), and tested on the texts that
    have it. Runs of a text that no term is looked up by go nowhere.
    """
    rows = [(i, t, t.lower(), min(len(t.lower()), GRAM)) for i, t in enumerate(terms)]
    asked = catalog.sparkSession.createDataFrame(rows, "term_no int, term string, lowered string, size int")
    few = F.broadcast if len(terms) <= BROADCAST_TERMS else lambda df: df
    texts = stage(
        catalog.groupBy(searched_text().alias("__text")).agg(F.count(F.lit(1)).alias("__copies")), "searched"
    )
    sizes = sorted({size for *_, size in rows})
    posted = texts.select("__text", F.explode(_grams(F.col("__text"), sizes)).alias("gram"))
    runs = F.when(F.col("size") == 1, _grams(F.col("lowered"), [1])).when(
        F.col("size") == 2, _grams(F.col("lowered"), [2])
    ).otherwise(_grams(F.col("lowered"), [GRAM]))
    candidates = asked.select("term_no", F.explode(runs).alias("gram"))
    counted = posted.join(few(candidates.select("gram").distinct()), "gram").groupBy("gram").count()
    rarest = candidates.join(counted, "gram", "left").groupBy("term_no").agg(
        F.min_by("gram", F.struct(F.coalesce("count", F.lit(0)), F.col("gram"))).alias("gram")
    )
    index = stage(asked.join(rarest, "term_no"), "lookups")
    found = posted.join(few(index), "gram").where(F.contains("__text", F.col("lowered")))
    hits = texts.join(
        found.groupBy("__text").agg(F.array_sort(F.collect_list(F.struct("term_no", "term"))).alias("__hits")), "__text"
    )
    joined = left_join_hot(catalog.withColumn("__text", searched_text()), stage(hits, "hits"), ["__text"], "__copies")
    return joined.select(*catalog.columns, "__hits")


def search_catalog(
    catalog: DataFrame, terms: Sequence[str], limit: int = SEARCH_LIMIT, inline_terms: int = INLINE_TERMS
) -> DataFrame:
    """Per term the most downloaded matches, each dataset under the first term that found it.

    More than ``inline_terms`` terms are looked up in an inverted index of the
    catalog, so a text is tested only for terms that share a rare run of
    characters with it. A repeated term finds nothing new, an empty one finds all.
    """
    indexed = len(terms) > inline_terms and all(terms)
    # a dataset landed many times is one dataset: its copies meet before the shuffle
    matched = (_indexed_hits if indexed else _inline_hits)(catalog, terms).where(F.size("__hits") > 0)
    order = ["downloads"] + [c for c in matched.columns if c not in ("downloads", "id")]
    once = matched.groupBy("id").agg(F.max(F.struct(*order)).alias("r")).select("id", "r.*")
    found = once.select(*catalog.columns, F.explode("__hits").alias("hit")).select(
        *catalog.columns, "hit.*"
    )
    listed = top_per_group(
        found, ["term_no"], [F.desc("downloads"), F.asc("id")], "id", limit, "place"
    )
    # at most terms x limit rows are left
    first = Window.partitionBy("id").orderBy("term_no", "place")
    return (
        listed.withColumn("__first", F.row_number().over(first)).where("__first = 1")
        .drop("__first", "term_no", "place")
    )


def normalized_name(name: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(name, r"[^\p{L}\p{N}]+", " ")))


def dedup_catalog(df: DataFrame) -> DataFrame:
    """One row per dataset across sources: best score, then downloads, then largest id."""
    name = F.coalesce(
        F.nullif(normalized_name(F.col("name")), F.lit("")), F.lower(F.col("id"))
    )
    best = F.struct(score().cast("double"), F.coalesce("downloads", F.lit(0)), F.col("id"))
    kept = df.groupBy(name.alias("__name")).agg(
        F.max_by(F.struct(*df.columns), best).alias("row")
    )
    return kept.select("row.*")


def top_tasks(ranked: DataFrame, k: int = TOP_TASKS) -> DataFrame:
    tasks = ranked.select(F.explode("ml_tasks").alias("task"))
    return tasks.groupBy("task").agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.desc("count"), F.asc("task")
    ).limit(k)


def catalog_summary(ranked: DataFrame, sources: Sequence[str] = ()) -> DataFrame:
    """``(section, item, value)``: totals, sources, limits, tasks, mean score, top three.

    A source asked for in ``sources`` that found nothing gets the limit 0. The
    few columns read are written once; everything is counted on that table.
    """
    ranked = stage(ranked.select("id", "name", "source", "relevance_score", "ml_tasks"), "catalog")

    def rows(df: DataFrame, section: str, item: Column, value: Column) -> DataFrame:
        return df.select(
            F.lit(section).alias("section"), item.alias("item"), value.cast("double").alias("value")
        )

    by_source = ranked.groupBy(F.coalesce("source", F.lit("unknown")).alias("source")).agg(
        F.count(F.lit(1)).alias("count")
    )
    by_source = stage(by_source, "sources")
    totals = ranked.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.coalesce(F.avg(score()), F.lit(0.0)), 1).alias("mean")
    )
    best = take_ranked(ranked, rank_order(), TOP_DATASETS)
    parts = [
        rows(totals, "total", F.lit("datasets"), F.col("n")),
        rows(totals, "avg_relevance_score", F.lit(""), F.col("mean")),
        rows(by_source, "sources", F.col("source"), F.col("count")),
        rows(top_tasks(ranked), "top_ml_tasks", F.col("task"), F.col("count")),
        rows(best, "top_datasets", F.concat_ws(". ", F.col("rank"), F.col("name")), score()),
    ]
    limits = by_source
    if sources:
        asked = ranked.sparkSession.createDataFrame([(s,) for s in sources], "source string")
        limits = asked.join(by_source, "source", "full")
    parts.append(rows(
        limits, "search_limits", F.col("source"), F.coalesce(F.col("count"), F.lit(0))
    ))
    return reduce(DataFrame.unionByName, parts)


def preferred_sources(ranked: DataFrame) -> DataFrame:
    """Sources with results, most results first."""
    return ranked.groupBy("source").agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.desc("count"), "source"
    )
