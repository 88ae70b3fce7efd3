"""Catalog, source and sink queries. Landed pages are made from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from registry.base import DOCS, Book, docs, table
from winnowry.functions import text as tx
from winnowry.operators import catalog as cat
from winnowry.schema import drop_agent_columns as drop_agent
from winnowry.session import shared_folder
from winnowry.sources import catalogs as src
from winnowry.sources import files

BOOK = Book()

CATALOG_COLUMNS = "id, name, source, url, downloads, likes, size_category, license, description_raw, tags"


def fresh(spark, name):
    """A path that no other call or session writes to."""
    return f"{shared_folder(spark)}/winnowry/{name}-{uuid.uuid4().hex}"


def flat(df):
    """Tags as one text, so that both engines print them alike."""
    return df.withColumn("tags", F.array_join("tags", "|"))


# --- landed pages -> catalogs ------------------------------------------------------

def zenodo_pages(spark, d):
    n = F.col("n_chars")
    hit = F.struct(
        F.col("doc_id").alias("id"),
        F.struct(F.concat(F.lit("https://zenodo.example/"), "doc_id").alias("html")).alias("links"),
        F.struct(n.alias("downloads"), (n * 2).alias("views")).alias("stats"),
        F.array(
            F.struct((n * 1000).alias("size")), F.struct(F.lit(500000).alias("size"))
        ).alias("files"),
        F.struct(
            F.concat("lang", F.lit(" corpus "), "doc_id").alias("title"),
            F.col("text").alias("description"),
            F.when(F.col("lang") != "fr", F.struct(F.concat(F.lit("cc-"), "lang").alias("id"))).alias("license"),
            F.when(F.col("lang") != "de", F.array("lang", "source")).alias("keywords"),
        ).alias("metadata"),
    )
    page = F.struct(F.struct(F.array(hit).alias("hits")).alias("hits"))
    return table(spark, d, "documents").select(F.to_json(page).alias("value"))


ZENODO = """
zenodo AS (SELECT 'zenodo:' || doc_id AS id, lang || ' corpus ' || doc_id AS name, 'zenodo' AS source,
  'https://zenodo.example/' || doc_id AS url, n_chars AS downloads, n_chars * 2 AS likes,
  ((n_chars * 1000 + 500000) // 1000000) || ' MB' AS size_category,
  CASE WHEN lang = 'fr' THEN 'unknown' ELSE 'cc-' || lang END AS license,
  text AS description_raw,
  CASE WHEN lang = 'de' THEN '' ELSE lang || '|' || source END AS tags FROM documents)"""


@BOOK.add(f"WITH {ZENODO} SELECT {CATALOG_COLUMNS} FROM zenodo")
def zenodo_catalog(spark, d):
    return flat(src.zenodo_catalog(zenodo_pages(spark, d)))


@BOOK.add(f"WITH {ZENODO} SELECT id, substring(description_raw, 1, 200) AS description_raw FROM zenodo")
def zenodo_catalog_200(spark, d):
    """Descriptions of 200 characters, as a caller may ask."""
    return src.zenodo_catalog(zenodo_pages(spark, d), description_chars=200).select("id", "description_raw")


def uci_pages(spark, d):
    """Small parts come as a bare list with the second id field, the rest as an object."""
    size = F.col("p_size")
    old = size > 25
    item = F.struct(
        F.when(~old, F.col("p_partkey")).alias("id"), F.when(old, F.col("p_partkey")).alias("ucimlId"),
        F.col("p_name").alias("name"), F.col("p_type").alias("abstract"), size.alias("numHits"),
        F.when(size != 10, size * 100).alias("numInstances"),
        F.when(size > 40, F.lit("CC0")).alias("license"), F.array("p_type", "p_brand").alias("tasks"),
    )
    page = F.when(old, F.to_json(F.array(item))).otherwise(
        F.to_json(F.struct(F.array(item).alias("datasets")))
    )
    return table(spark, d, "part").select(page.alias("value"))


@BOOK.add("""SELECT 'uci:' || p_partkey AS id, p_name AS name, 'uci' AS source,
  'https://archive.ics.uci.edu/dataset/' || p_partkey AS url, CAST(p_size AS BIGINT) AS downloads,
  CAST(0 AS BIGINT) AS likes, CASE WHEN p_size = 10 THEN '?' ELSE CAST(p_size * 100 AS VARCHAR) END || ' rows' AS size_category,
  CASE WHEN p_size > 40 THEN 'CC0' ELSE 'unknown' END AS license, p_type AS description_raw,
  p_type || '|' || p_brand AS tags FROM part""")
def uci_catalog(spark, d):
    return flat(src.uci_catalog(uci_pages(spark, d)))


def hub_records(spark, d):
    n = F.col("n_chars")
    record = F.struct(
        F.concat("source", F.lit("/"), "lang", F.lit("-"), "doc_id").alias("id"),
        n.alias("downloads"), F.when(n > 100, F.floor(n / 10)).alias("likes"),
        F.when(F.col("lang") != "es", F.array(
            F.concat(F.lit("language:"), "lang"),
            F.concat(F.lit("license:"), "lang", F.lit("-by")),
            F.when(n > 1000, F.lit("size_categories:n>1K")).otherwise(F.lit("region:us")),
        )).alias("tags"),
        F.when(n > 50, F.array(
            F.struct((n * 100000).alias("size")), F.struct(F.lit(None).cast("bigint").alias("size"))
        )).alias("siblings"),
    )
    return table(spark, d, "documents").select(F.to_json(record).alias("value"))


HUB = """
hubraw AS (SELECT *, n_chars * 100000 / 1048576.0::DOUBLE AS mb FROM documents),
hub AS (SELECT source || '/' || lang || '-' || doc_id AS id, CAST(NULL AS VARCHAR) AS name, 'huggingface' AS source,
  'https://huggingface.co/datasets/' || source || '/' || lang || '-' || doc_id AS url, n_chars AS downloads,
  CASE WHEN n_chars > 100 THEN CAST(n_chars // 10 AS BIGINT) ELSE 0 END AS likes,
  coalesce(nullif(concat_ws(' | ', CASE WHEN n_chars > 50 THEN CASE WHEN mb < 1024 THEN printf('%.1f MB', mb) ELSE printf('%.2f GB', mb / 1024) END END,
    CASE WHEN lang <> 'es' AND n_chars > 1000 THEN 'n>1K' END), ''), 'unknown') AS size_category,
  CASE WHEN lang = 'es' THEN 'unknown' ELSE lang || '-by' END AS license, CAST(NULL AS VARCHAR) AS description_raw,
  CASE WHEN lang = 'es' THEN '' ELSE 'language:' || lang || '|license:' || lang || '-by|' ||
    CASE WHEN n_chars > 1000 THEN 'size_categories:n>1K' ELSE 'region:us' END END AS tags FROM hubraw)"""


@BOOK.add(f"WITH {HUB} SELECT {CATALOG_COLUMNS} FROM hub")
def hf_catalog(spark, d):
    return flat(src.hf_catalog(hub_records(spark, d)))


def kaggle_pages(spark, d):
    """Rich customers have a reference, others owner and slug; poor ones have nothing."""
    bal = F.col("c_acctbal")
    item = F.struct(
        F.when(bal > 5000, F.concat(F.lit("/"), "c_mktsegment", F.lit("/"), "c_custkey", F.lit("/"))).alias("ref"),
        F.when(bal > 0, F.col("c_mktsegment")).alias("ownerRef"),
        F.when(bal > 0, F.concat(F.lit("set-"), "c_custkey")).alias("datasetSlug"),
        F.when(F.col("c_nationkey") > 5, F.col("c_name")).alias("title"),
        F.when(bal > 2000, F.col("c_custkey")).alias("downloadCount"),
        (F.col("c_custkey") + 7).alias("totalDownloads"), F.col("c_nationkey").alias("totalVotes"),
        F.floor(F.abs(bal) * 10000).alias("totalBytes"),
        F.array(F.struct(F.col("c_mktsegment").alias("name"))).alias("tags"),
    )
    return table(spark, d, "customer").select(F.to_json(F.array(item)).alias("value"))


KAGGLE = """
kraw AS (SELECT *, CASE WHEN c_acctbal > 5000 THEN c_mktsegment || '/' || c_custkey
  WHEN c_acctbal > 0 THEN c_mktsegment || '/set-' || c_custkey ELSE '' END AS ref FROM customer),
kaggle AS (SELECT ref AS id, CASE WHEN c_nationkey > 5 THEN c_name ELSE ref END AS name, 'kaggle' AS source,
  'https://www.kaggle.com/datasets/' || ref AS url,
  CASE WHEN c_acctbal > 2000 THEN c_custkey ELSE c_custkey + 7 END AS downloads, CAST(c_nationkey AS BIGINT) AS likes,
  (CAST(floor(abs(c_acctbal) * 10000) AS BIGINT) // 1000000) || ' MB' AS size_category, 'unknown' AS license,
  CAST(NULL AS VARCHAR) AS description_raw, c_mktsegment AS tags FROM kraw WHERE ref <> '')"""


@BOOK.add(f"WITH {KAGGLE} SELECT {CATALOG_COLUMNS} FROM kaggle")
def kaggle_catalog(spark, d):
    return flat(src.kaggle_catalog(kaggle_pages(spark, d)))


def supplier_pages(spark, d):
    """Debtors are landed as a single object instead of a list."""
    item = F.struct(
        F.col("s_suppkey").alias("code"), F.col("s_name").alias("title"),
        F.col("s_nationkey").alias("hits"),
    )
    listed = F.to_json(F.struct(F.struct(F.array(item).alias("items")).alias("data")))
    single = F.to_json(F.struct(F.struct(item.alias("items")).alias("data")))
    return table(spark, d, "supplier").select(
        F.when(F.col("s_acctbal") > 0, listed).otherwise(single).alias("value")
    )


@BOOK.add("""SELECT coalesce(nullif(CAST(s_suppkey AS VARCHAR), '0'), 'synthetic') AS id, s_name AS name, 'data_gov' AS source,
  CAST(NULL AS VARCHAR) AS url, CAST(s_nationkey AS BIGINT) AS downloads, CAST(0 AS BIGINT) AS likes, 'unknown' AS size_category,
  'unknown' AS license, CAST(NULL AS VARCHAR) AS description_raw, '' AS tags FROM supplier""")
def generic_catalog(spark, d):
    found = src.generic_catalog(
        supplier_pages(spark, d), "data.items", {"id": "code", "name": "title", "downloads": "hits"},
        "Data Gov",
    )
    synthetic = F.startswith("id", F.lit("data_gov:"))
    return flat(found).withColumn("id", F.when(synthetic, F.lit("synthetic")).otherwise(F.col("id")))


@BOOK.add(f"""WITH {ZENODO}, {HUB}, {KAGGLE} SELECT {CATALOG_COLUMNS} FROM zenodo
UNION ALL SELECT {CATALOG_COLUMNS} FROM hub UNION ALL SELECT {CATALOG_COLUMNS} FROM kaggle""")
def merge_sources(spark, d):
    return flat(files.merge([
        src.zenodo_catalog(zenodo_pages(spark, d)), src.hf_catalog(hub_records(spark, d)).drop("name", "description_raw"),
        src.kaggle_catalog(kaggle_pages(spark, d)), None,
    ]))


# --- search, rank, pick --------------------------------------------------------------

TERMS = ("en", "src1", "fr-1", "nothing")


@BOOK.add(f"""WITH {HUB},
hits AS (SELECT h.*, t.no, t.term, row_number() OVER (PARTITION BY t.no ORDER BY downloads DESC, id) AS place
  FROM hub h JOIN (VALUES (0, 'en'), (1, 'src1'), (2, 'fr-1'), (3, 'nothing')) AS t(no, term) ON contains(lower(h.id), t.term)),
firsts AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY no) AS seen FROM hits WHERE place <= 30)
SELECT id, downloads, term FROM firsts WHERE seen = 1""")
def search_catalog(spark, d):
    found = cat.search_catalog(src.hf_catalog(hub_records(spark, d)), TERMS, 30)
    return found.select("id", "downloads", "term")


@BOOK.add(f"""WITH {HUB}, terms AS (SELECT CAST(range AS BIGINT) AS no, CASE WHEN range < 3 THEN substring('eafrz', CAST(range AS INT) + 1, 2)
    ELSE '-' || range END AS term FROM range(1000)),
hits AS (SELECT h.*, t.no, t.term, row_number() OVER (PARTITION BY t.no ORDER BY downloads DESC, id) AS place
  FROM hub h JOIN terms t ON contains(lower(h.id), t.term)),
firsts AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY no) AS seen FROM hits WHERE place <= 5)
SELECT id, downloads, term FROM firsts WHERE seen = 1""")
def search_catalog_many(spark, d):
    """A thousand terms, looked up in an inverted index."""
    terms = ["eafrz"[i:i + 2] if i < 3 else f"-{i}" for i in range(1000)]
    found = cat.search_catalog(src.hf_catalog(hub_records(spark, d)), terms, 5)
    return found.select("id", "downloads", "term")


def ranked(spark, d):
    """Documents as scored datasets: few names, many copies of each."""
    df = docs(spark, d)
    return df.select(
        F.concat(F.lit("ds:"), "doc_id").alias("id"),
        F.concat(F.upper("lang"), F.lit("--"), "_source", F.lit("!")).alias("name"),
        F.col("_source").alias("source"), F.col("n_chars").alias("downloads"),
        (F.col("quality") * 5 + F.col("toxic") * 3).cast("double").alias("relevance_score"),
        F.array("lang", "_source").alias("ml_tasks"),
    )


RANKED = DOCS + """,
ranked AS (SELECT 'ds:' || doc_id AS id, upper(lang) || '--' || _source || '!' AS name, _source AS source,
  n_chars AS downloads, CAST(quality * 5 + toxic * 3 AS DOUBLE) AS relevance_score, lang AS t1, _source AS t2 FROM docs)"""


@BOOK.add(f"""WITH {RANKED} SELECT id, relevance_score FROM ranked ORDER BY coalesce(relevance_score, 0) DESC, id""")
def rank(spark, d):
    return cat.rank(ranked(spark, d)).select("id", "relevance_score")


@BOOK.add(f"""WITH {RANKED} SELECT id, name, relevance_score FROM ranked WHERE coalesce(relevance_score, 0) >= 4""")
def filter_relevant(spark, d):
    return cat.filter_relevant(ranked(spark, d)).select("id", "name", "relevance_score")


@BOOK.add(f"""WITH {RANKED} SELECT count(*) FILTER (WHERE coalesce(relevance_score, 0) >= 4) AS kept,
count(*) FILTER (WHERE coalesce(relevance_score, 0) < 4) AS dropped FROM ranked""")
def relevance_counts(spark, d):
    return cat.relevance_counts(ranked(spark, d))


@BOOK.add(f"""WITH {RANKED} SELECT id, name FROM (SELECT *, row_number() OVER (ORDER BY coalesce(relevance_score, 0) DESC, id) AS place
FROM ranked) WHERE place IN (1, 3, 5)""")
def pick(spark, d):
    return cat.pick(ranked(spark, d), "1, 3,x,5").select("id", "name")


@BOOK.add(f"""WITH {RANKED} SELECT id, name, relevance_score, downloads FROM (SELECT *, row_number() OVER
(PARTITION BY trim(lower(regexp_replace(name, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')))
 ORDER BY coalesce(relevance_score, 0) DESC, downloads DESC, id DESC) AS rn FROM ranked) WHERE rn = 1""")
def dedup_catalog(spark, d):
    return cat.dedup_catalog(ranked(spark, d)).select("id", "name", "relevance_score", "downloads")


TASK_COUNTS = """tasks AS (SELECT t AS task, count(*) AS n FROM (SELECT t1 AS t FROM ranked UNION ALL SELECT t2 FROM ranked) GROUP BY t),
top AS (SELECT * FROM tasks ORDER BY n DESC, task LIMIT 5)"""


@BOOK.add(f"""WITH {RANKED}, {TASK_COUNTS} SELECT task, n AS "count" FROM top""")
def top_tasks(spark, d):
    return cat.top_tasks(ranked(spark, d))


@BOOK.add(f"""WITH {RANKED}, {TASK_COUNTS},
best AS (SELECT *, row_number() OVER (ORDER BY coalesce(relevance_score, 0) DESC, id) AS place FROM ranked),
per AS (SELECT source, CAST(count(*) AS DOUBLE) AS n FROM ranked GROUP BY source)
SELECT 'total' AS section, 'datasets' AS item, CAST(count(*) AS DOUBLE) AS value FROM ranked
UNION ALL SELECT 'avg_relevance_score', '', round(avg(coalesce(relevance_score, 0)), 1) FROM ranked
UNION ALL SELECT 'sources', source, n FROM per
UNION ALL SELECT 'top_ml_tasks', task, CAST(n AS DOUBLE) FROM top
UNION ALL SELECT 'top_datasets', place || '. ' || name, coalesce(relevance_score, 0) FROM best WHERE place <= 3
UNION ALL SELECT 'search_limits', source, n FROM per UNION ALL SELECT 'search_limits', 'kaggle', 0""")
def catalog_summary(spark, d):
    asked = ["kaggle", "src1"]
    return cat.catalog_summary(ranked(spark, d), asked)


@BOOK.add("""SELECT source, count(*) AS "count" FROM documents GROUP BY source ORDER BY 2 DESC, 1""")
def preferred_sources(spark, d):
    return cat.preferred_sources(ranked(spark, d))


# --- dataset files -------------------------------------------------------------------

@BOOK.add("SELECT * FROM conversations")
def scan(spark, d):
    return files.scan(spark, f"{d}/conversations.parquet")


@BOOK.add("""SELECT CAST(item_id AS VARCHAR) AS item_id, text, CAST(NULL AS VARCHAR) AS c_mktsegment, CAST(NULL AS VARCHAR) AS region FROM benchmark
UNION ALL SELECT CAST(c_custkey AS VARCHAR), NULL, c_mktsegment, NULL FROM customer
UNION ALL SELECT CAST(r_regionkey AS VARCHAR), NULL, NULL, r_name FROM region""")
def scan_any(spark, d):
    """The same tables written as three formats, read back as one dataset."""
    base = fresh(spark, "landed")
    key = lambda c: F.col(c).cast("string").alias("item_id")
    table(spark, d, "benchmark").select(key("item_id"), "text").write.mode("overwrite").parquet(f"{base}/a.parquet")
    table(spark, d, "customer").select(key("c_custkey"), "c_mktsegment").write.mode("overwrite").option("header", True).csv(f"{base}/b.csv")
    table(spark, d, "region").select(key("r_regionkey"), F.col("r_name").alias("region")).write.mode("overwrite").json(f"{base}/c.json")
    found = files.scan_any(spark, [f"{base}/a.parquet", f"{base}/b.csv", f"{base}/c.json"])
    return found.withColumn("item_id", F.col("item_id").cast("string"))


@BOOK.add("SELECT doc_id, text, lang, source, n_chars, 'kaggle' AS _source, 'demo/docs' AS _dataset_id FROM documents")
def tag_provenance(spark, d):
    return files.tag(table(spark, d, "documents"), "kaggle", "demo/docs")


@BOOK.add("""SELECT text, CAST(n_chars AS DOUBLE) AS label, 'hub' AS _source, 'a/b' AS _dataset_id FROM documents
UNION ALL SELECT text, CAST(turn AS DOUBLE), 'kaggle', 'c/d' FROM conversations""")
def unify(spark, d):
    parts = [
        files.unify(files.tag(table(spark, d, name), source, set_id), {"text": "text", "label": (label, "double")})
        for name, source, set_id, label in (
            ("documents", "hub", "a/b", "n_chars"), ("conversations", "kaggle", "c/d", "turn"),
        )
    ]
    return files.merge(parts)


@BOOK.add(f"WITH {DOCS} SELECT doc_id, text, lang, n_chars, quality, toxic FROM docs")
def drop_agent_columns(spark, d):
    return drop_agent(docs(spark, d))


@BOOK.add("SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def preview(spark, d):
    return files.preview(table(spark, d, "orders"), 5, ["o_orderkey"])


@BOOK.add("SELECT * FROM events")
def write_stage(spark, d):
    path = fresh(spark, "stage") + ".parquet"
    files.write_stage(table(spark, d, "events"), path)
    return files.scan(spark, path)


@BOOK.add("""SELECT 'combined_clean.parquet' AS annotation, 'combined.parquet' AS quality, count(*) AS rows FROM conversations""")
def resolve_stage_input(spark, d):
    """Raw and clean stages written, then found again in the order of each stage."""
    base = fresh(spark, "topic")
    df = table(spark, d, "conversations")
    files.write_stage(df, f"{base}/{files.RAW}")
    files.write_stage(df, f"{base}/{files.CLEAN}")
    found = {s: files.resolve_input(spark, base, s) for s in ("annotation", "quality")}
    last = {s: F.lit(p.rsplit("/", 1)[1]).alias(s) for s, p in found.items()}
    return files.scan(spark, found["annotation"]).agg(F.count(F.lit(1)).alias("rows")).select(*last.values(), "rows")


@BOOK.add(f"WITH {RANKED} SELECT id, name, source, downloads, relevance_score, t1 || '|' || t2 AS ml_tasks FROM ranked")
def catalog_json_io(spark, d):
    path = fresh(spark, "found") + ".json"
    files.write_catalog(ranked(spark, d), path)
    back = files.read_catalog(spark, path)
    return back.select(
        "id", "name", "source", "downloads", "relevance_score", F.array_join("ml_tasks", "|").alias("ml_tasks")
    )


@BOOK.add("""SELECT 'labels' AS chosen, count(DISTINCT toxic) AS classes FROM labels""")
def first_multiclass(spark, d):
    """A table whose label is constant is passed over."""
    single = table(spark, d, "documents").select("text", F.lit("1.0").alias("label"))
    none = table(spark, d, "benchmark").select("text")
    labels = table(spark, d, "labels")
    name, _ = files.first_multiclass({"single": single, "none": none, "labels": labels}, None)
    return spark.createDataFrame([(name, files.class_count(labels))], "chosen string, classes bigint")


# --- text functions --------------------------------------------------------------------

@BOOK.add("""SELECT page_id, replace(replace(replace(lower(trim(url)), ' ', '_'), '/', '_'), ':', '_') AS slug FROM pages""")
def slug(spark, d):
    return table(spark, d, "pages").select("page_id", tx.slug(F.col("url")).alias("slug"))


@BOOK.add("""SELECT doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS body,
  '[' || n_chars || ', "]"]' AS array_text FROM documents""")
def strip_fences(spark, d):
    text = F.col("text")
    fenced = (
        F.when(F.col("lang") == "en", F.concat(F.lit("Sure:\n```json\n"), "text", F.lit("\n``` done")))
        .when(F.col("lang") == "fr", F.concat(F.lit("```python\n"), "text"))
        .otherwise(F.regexp_replace(text, r"^\s+|\s+$", ""))
    )
    answer = F.concat(F.lit("The array: ["), F.col("n_chars").cast("string"), F.lit(', "]"] thanks'))
    return table(spark, d, "documents").select(
        "doc_id", tx.strip_fences(fenced).alias("body"), tx.json_array_slice(answer).alias("array_text")
    )


@BOOK.add("""SELECT doc_id, CASE WHEN n_chars > 50 THEN lang || '|' || source END AS classes FROM documents""")
def spec_classes(spark, d):
    bold = lambda c: F.concat(F.lit("**"), c, F.lit("**: as defined\n"))
    spec = F.concat(
        F.lit("# Spec\n**not a class**\n"),
        F.when(F.col("n_chars") > 50, F.concat(F.lit("## classes\n"), bold("lang"), bold("source"))).otherwise(F.lit("")),
        F.lit("## Examples\n**neither**\n"),
    )
    names = tx.spec_classes(spec)
    return table(spark, d, "documents").select("doc_id", F.array_join(names, "|").alias("classes"))


@BOOK.add("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_path(spark, d):
    return table(spark, d, "events").select(
        "event_id", tx.json_path(F.col("props"), "k").cast("bigint").alias("k")
    )


@BOOK.add("""SELECT doc_id, array_to_string(list_slice(t, 1, 3), ' ') AS first_tokens, len(t) AS n_tokens,
  CAST(len(t) + greatest(len(t) - 1, 0) AS BIGINT) AS n_grams
FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') AS t FROM documents)""")
def tokenize_ngrams(spark, d):
    words = table(spark, d, "documents").select("doc_id", tx.tokens(F.col("text")).alias("t"))
    t = F.col("t")
    return words.select(
        "doc_id", F.array_join(F.slice(t, 1, 3), " ").alias("first_tokens"),
        F.size(t).cast("bigint").alias("n_tokens"), F.size(tx.ngrams(t)).cast("bigint").alias("n_grams"),
    )
