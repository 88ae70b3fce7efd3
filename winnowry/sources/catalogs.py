"""Landed catalog pages (JSON text) as one CATALOG table.

Each reader takes a frame with one landed page or record per row and needs no
pass over the data to learn a schema.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnowry.functions.text import json_path, size_in_megabytes, size_on_disk, tag_value, truncate
from winnowry.schema import CATALOG

# --- fixed values: addresses, defaults, page shapes -----------------------------
UNKNOWN = "unknown"
UCI_URL = "https://archive.ics.uci.edu/dataset/"
HUB_URL = "https://huggingface.co/datasets/"
KAGGLE_URL = "https://www.kaggle.com/datasets/"

ZENODO_PAGE = """
    hits struct<hits: array<struct<
        id: string,
        links: struct<html: string>,
        stats: struct<downloads: bigint, views: bigint>,
        files: array<struct<size: bigint>>,
        metadata: struct<title: string, description: string,
                         license: struct<id: string>, keywords: array<string>>>>>
"""
UCI_ITEMS = """
    array<struct<id: string, ucimlId: string, name: string, abstract: string, numHits: bigint,
                 numInstances: string, license: string, tasks: array<string>>>
"""
HUB_RECORD = """
    id string, downloads bigint, likes bigint, tags array<string>,
    siblings array<struct<size: bigint>>
"""
KAGGLE_ITEMS = """
    array<struct<ref: string, ownerRef: string, datasetSlug: string, title: string,
                 downloadCount: bigint, totalDownloads: bigint, voteCount: bigint,
                 totalVotes: bigint, totalBytes: bigint, licenseName: string,
                 tags: array<struct<name: string>>>>
"""
FALSY_JSON = ("", "0", "0.0", "false", "[]", "{}", "null")
# ---------------------------------------------------------------------------------



def no_tags() -> Column:
    return F.array().cast("array<string>")


def _catalog(df: DataFrame, **fields: Column) -> DataFrame:
    """The CATALOG columns in order, NULL where a source has nothing to say."""
    return df.select([
        fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CATALOG.fields
    ])


def _total_size(files: Column) -> Column:
    return F.aggregate(
        F.coalesce(files, F.array()), F.lit(0).cast("bigint"),
        lambda acc, f: acc + F.coalesce(f["size"], F.lit(0).cast("bigint")),
    )


def zenodo_catalog(
    pages: DataFrame, json_col: str = "value", description_chars: int | None = None
) -> DataFrame:
    """Search pages ``hits.hits[]``; views count as likes, size is the sum of the files."""
    page = F.from_json(json_col, ZENODO_PAGE)
    records = pages.select(F.explode(page["hits"]["hits"]).alias("r")).select("r.*")
    meta = F.col("metadata")
    return _catalog(
        records,
        id=F.concat(F.lit("zenodo:"), F.coalesce(F.col("id"), F.lit("None"))),
        name=F.coalesce(meta["title"], F.lit("")),
        source=F.lit("zenodo"),
        url=F.coalesce(F.col("links.html"), F.lit("")),
        downloads=F.coalesce(F.col("stats.downloads"), F.lit(0)),
        likes=F.coalesce(F.col("stats.views"), F.lit(0)),
        size_category=size_in_megabytes(_total_size(F.col("files"))),
        license=F.coalesce(meta["license"]["id"], F.lit(UNKNOWN)),
        description_raw=truncate(F.coalesce(meta["description"], F.lit("")), description_chars),
        tags=F.coalesce(meta["keywords"], no_tags()),
    )


def uci_catalog(
    pages: DataFrame, json_col: str = "value", description_chars: int | None = None
) -> DataFrame:
    """Pages that are a list of datasets, or an object holding one under ``datasets``."""
    items = F.coalesce(
        F.from_json(F.get_json_object(json_col, "$.datasets"), UCI_ITEMS),
        F.when(F.startswith(F.ltrim(json_col), F.lit("[")), F.from_json(json_col, UCI_ITEMS)),
    )
    number = F.coalesce(F.col("id"), F.col("ucimlId"), F.lit(""))
    return _catalog(
        pages.select(F.explode(items).alias("r")).select("r.*"),
        id=F.concat(F.lit("uci:"), number),
        name=F.coalesce(F.col("name"), F.lit("")),
        source=F.lit("uci"),
        url=F.concat(F.lit(UCI_URL), number),
        downloads=F.coalesce(F.col("numHits"), F.lit(0)),
        likes=F.lit(0),
        size_category=F.concat(F.coalesce(F.col("numInstances"), F.lit("?")), F.lit(" rows")),
        license=F.coalesce(F.col("license"), F.lit(UNKNOWN)),
        description_raw=truncate(F.coalesce(F.col("abstract"), F.lit("")), description_chars),
        tags=F.coalesce(F.col("tasks"), no_tags()),
    )


def hf_catalog(records: DataFrame, json_col: str = "value") -> DataFrame:
    """One hub record per row; size and license come from files and tags."""
    rows = records.select(F.from_json(json_col, HUB_RECORD).alias("r")).select("r.*")
    tags = F.coalesce(F.col("tags"), no_tags())
    size = F.concat_ws(
        " | ", size_on_disk(_total_size(F.col("siblings"))),
        F.nullif(tag_value(tags, "size_categories:", anywhere=True), F.lit("")),
    )
    return _catalog(
        rows.where("id is not null"),
        id=F.col("id"),
        source=F.lit("huggingface"),
        url=F.concat(F.lit(HUB_URL), F.col("id")),
        downloads=F.coalesce(F.col("downloads"), F.lit(0)),
        likes=F.coalesce(F.col("likes"), F.lit(0)),
        size_category=F.when(size == "", F.lit(UNKNOWN)).otherwise(size),
        license=F.coalesce(tag_value(tags, "license:"), F.lit(UNKNOWN)),
        tags=tags,
    )


def kaggle_catalog(pages: DataFrame, json_col: str = "value") -> DataFrame:
    """Pages that are a list of datasets; one without any reference is dropped."""
    rows = pages.select(F.explode(F.from_json(json_col, KAGGLE_ITEMS)).alias("r")).select("r.*")
    joined = F.concat(
        F.coalesce("ownerRef", F.lit("")), F.lit("/"), F.coalesce("datasetSlug", F.lit(""))
    )
    ref = F.btrim(F.coalesce(F.nullif("ref", F.lit("")), joined), F.lit("/"))
    rows = rows.withColumn("ref", ref).where("ref <> ''")
    return _catalog(
        rows,
        id=F.col("ref"),
        name=F.coalesce("title", "ref"),
        source=F.lit("kaggle"),
        url=F.concat(F.lit(KAGGLE_URL), F.col("ref")),
        downloads=F.coalesce("downloadCount", "totalDownloads", F.lit(0)),
        likes=F.coalesce("voteCount", "totalVotes", F.lit(0)),
        size_category=size_in_megabytes(F.coalesce("totalBytes", F.lit(0))),
        license=F.coalesce("licenseName", F.lit(UNKNOWN)),
        tags=F.coalesce(F.transform("tags", lambda t: t["name"]), no_tags()),
    )


def generic_catalog(
    pages: DataFrame, result_path: str, field_map: Mapping[str, str], source: str,
    json_col: str = "value",
) -> DataFrame:
    """Any JSON page: the items under a dot path, fields renamed by ``field_map``.

    An item without a mapped id gets a stable synthetic one.
    """
    body = json_path(F.col(json_col), result_path)
    items = F.when(
        F.startswith(F.ltrim(body), F.lit("{")), F.array(body)
    ).otherwise(F.from_json(body, "array<string>"))
    rows = pages.select(F.explode(items).alias("item"))
    name = source.lower().replace(" ", "_")
    mapped = {
        ours: F.get_json_object("item", f"$['{theirs}']") for ours, theirs in field_map.items()
    }
    mapped = {k: F.when(~v.isin(*FALSY_JSON), v) for k, v in mapped.items()}
    if "tags" in mapped:
        mapped["tags"] = F.when(mapped["tags"].isNotNull(), F.array(mapped["tags"]))
    for counter in ("downloads", "likes"):
        if counter in mapped:
            mapped[counter] = mapped[counter].try_cast("bigint")
    synthetic = F.concat(F.lit(f"{name}:"), F.md5("item"))  # 128 bits: different items stay apart
    defaults = {
        "id": synthetic, "source": F.lit(name), "downloads": F.lit(0), "likes": F.lit(0),
        "size_category": F.lit(UNKNOWN), "license": F.lit(UNKNOWN), "tags": no_tags(),
    }
    fields = {
        f.name: F.coalesce(*[s[f.name] for s in (mapped, defaults) if f.name in s])
        for f in CATALOG.fields if f.name in mapped or f.name in defaults
    }
    return _catalog(rows, **fields)
