"""Active-learning queries."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registry.base import HISTORY, PROBA, Book, history, proba, table
from winnowry.functions import scores as sc
from winnowry.operators import agreement as agr
from winnowry.operators import features as feat
from winnowry.operators import learn, models, ranking
from winnowry.operators.joins import left_join_hot
from winnowry.staging import stage

BOOK = Book()


def labeled_docs(spark, d):
    return table(spark, d, "labels").join(
        table(spark, d, "documents").select("doc_id", "text"), "doc_id"
    ).select("doc_id", "text", "quality", "toxic")


# --- sampling and splitting -----------------------------------------------------------

@BOOK.add("SELECT doc_id, text FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 30")
def sample_n(spark, d):
    return ranking.sample_n(table(spark, d, "documents").select("doc_id", "text"), 30, "doc_id")


@BOOK.add("""SELECT event_id, value FROM events ORDER BY md5('7:' || event_id), event_id
LIMIT (SELECT CAST(count(*) / 2 AS BIGINT) FROM events)""")
def sample_half(spark, d):
    """A large sample, cut at a counted hash instead of being sorted."""
    events = table(spark, d, "events").select("event_id", "value")
    return ranking.sample_n(events, events.count() // 2, "event_id", seed=7, take_rows=100)


SPLIT = """
y AS (SELECT doc_id, CAST(toxic AS VARCHAR) AS y FROM labels WHERE toxic IS NOT NULL),
cls AS (SELECT y, count(*) AS n FROM y GROUP BY y),
tot AS (SELECT CAST(sum(n) AS BIGINT) AS n, CAST(sum(n) AS BIGINT) - CAST(ceil(0.2 * sum(n)) AS BIGINT) AS n_train FROM cls),
tr0 AS (SELECT y, cls.n, cls.n * n_train // tot.n AS share, cls.n * n_train % tot.n AS rest, n_train FROM cls, tot),
tr AS (SELECT y, n, share + CASE WHEN row_number() OVER (ORDER BY rest DESC, y) <= n_train - sum(share) OVER () THEN 1 ELSE 0 END AS train, n_train FROM tr0),
lb0 AS (SELECT *, train * 50 // n_train AS share, train * 50 % n_train AS rest FROM tr),
lb AS (SELECT *, share + CASE WHEN row_number() OVER (ORDER BY rest DESC, y) <= 50 - sum(share) OVER () THEN 1 ELSE 0 END AS start FROM lb0),
rk AS (SELECT doc_id, y, row_number() OVER (PARTITION BY y ORDER BY md5('42:' || doc_id), doc_id) AS place FROM y),
split AS (SELECT doc_id, y, CASE WHEN place <= n - train THEN 'test' WHEN place <= n - train + start THEN 'labeled' ELSE 'pool' END AS split
  FROM rk JOIN lb USING (y))"""


@BOOK.add(f"WITH {SPLIT} SELECT doc_id, split FROM split")
def stratified_split(spark, d):
    labels = table(spark, d, "labels")
    return learn.stratified_split(labels, "toxic", "doc_id", n_start=50).select("doc_id", "split")


# --- queries ----------------------------------------------------------------------------

ENTROPY = "-(p1 * ln(p1 + 1e-10) + p2 * ln(p2 + 1e-10) + p3 * ln(p3 + 1e-10))"
MARGIN = "greatest(p1, p2, p3) - (p1 + p2 + p3 - greatest(p1, p2, p3) - least(p1, p2, p3))"


@BOOK.add(f"WITH {PROBA} SELECT vec_id, round({ENTROPY}, 6) AS entropy, round({MARGIN}, 6) AS margin FROM proba")
def entropy_margin(spark, d):
    p = F.col("proba")
    return proba(spark, d).select(
        "vec_id", F.round(sc.entropy(p), 6).alias("entropy"), F.round(sc.margin(p), 6).alias("margin")
    )


@BOOK.add(f"WITH {PROBA} SELECT vec_id FROM proba ORDER BY {ENTROPY} DESC, vec_id LIMIT 20")
def query_entropy(spark, d):
    return learn.query(proba(spark, d), "entropy", 20, "vec_id").select("vec_id")


@BOOK.add(f"WITH {PROBA} SELECT vec_id FROM proba ORDER BY {MARGIN}, vec_id LIMIT 20")
def query_margin(spark, d):
    return learn.query(proba(spark, d), "margin", 20, "vec_id").select("vec_id")


RANDOM = """SELECT vec_id FROM embeddings ORDER BY md5((42 + (SELECT count(*) FROM embeddings)) || ':' || vec_id), vec_id LIMIT {n}"""


@BOOK.add(RANDOM.format(n=20))
def query_random(spark, d):
    return learn.query(proba(spark, d), "random", 20, "vec_id").select("vec_id")


@BOOK.add(f"""WITH {PROBA} SELECT vec_id FROM proba WHERE vec_id IN ({RANDOM.format(n=100)})
ORDER BY {ENTROPY} DESC, vec_id LIMIT 20""")
def query_candidates(spark, d):
    """Entropy among a random part of the pool."""
    return learn.query(proba(spark, d), "entropy", 20, "vec_id", candidate_sample=100).select("vec_id")


@BOOK.add(f"WITH {PROBA} SELECT vec_id FROM proba WHERE vec_id NOT IN (SELECT vec_id FROM proba ORDER BY {ENTROPY} DESC, vec_id LIMIT 20)")
def pool_minus_batch(spark, d):
    pool = proba(spark, d)
    return learn.pool_minus_batch(pool, learn.query(pool, "entropy", 20, "vec_id"), "vec_id").select("vec_id")


@BOOK.add(f"WITH {SPLIT} SELECT doc_id FROM split WHERE split = 'labeled' UNION ALL (SELECT doc_id FROM split WHERE split = 'pool' ORDER BY doc_id LIMIT 20)")
def append_batch(spark, d):
    parts = learn.stratified_split(table(spark, d, "labels"), "toxic", "doc_id", n_start=50)
    pool = parts.where("split = 'pool'").select("doc_id")
    batch = pool.orderBy("doc_id").limit(20)
    return learn.append_batch(parts.where("split = 'labeled'").select("doc_id"), batch)


# --- features -----------------------------------------------------------------------------

def terms_sql(least: int = 1, limit: int | None = None) -> str:
    """Vocabulary of the labeled texts: terms in ``least`` texts, the ``limit`` most frequent."""
    cut = f"ORDER BY cf DESC, term LIMIT {limit}" if limit else ""
    return f"""
t0 AS (SELECT l.doc_id, regexp_extract_all(lower(d.text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
grams AS (SELECT doc_id, unnest(t) AS term FROM t0 UNION ALL
  SELECT doc_id, t[i] || ' ' || t[i + 1] FROM (SELECT doc_id, t, unnest(range(1, len(t))) AS i FROM t0)),
tf AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY doc_id, term),
nrows AS (SELECT count(*) AS n FROM t0),
voc0 AS (SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df, n FROM tf, nrows GROUP BY term, n HAVING count(*) >= {least}),
voc AS (SELECT *, row_number() OVER (ORDER BY term) - 1 AS idx, ln((1 + n) / (1 + df)) + 1 AS idf
  FROM (SELECT * FROM voc0 {cut}))"""


TERMS = terms_sql()


@BOOK.add(f"WITH {TERMS} SELECT term, CAST(idx AS INTEGER) AS idx, cf, df, round(idf, 6) AS idf FROM voc")
def tfidf_terms(spark, d):
    model = feat.tfidf_fit(labeled_docs(spark, d), "doc_id", "text")
    return model.vocabulary.withColumn("idf", F.round("idf", 6))


@BOOK.add(f"WITH {terms_sql(2, 50_000)} SELECT term, CAST(idx AS INTEGER) AS idx, cf, df, round(idf, 6) AS idf FROM voc")
def tfidf_terms_50000(spark, d):
    """Limits a caller may set: terms of two texts or more, and 50,000 of them."""
    model = feat.tfidf_fit(labeled_docs(spark, d), "doc_id", "text", max_terms=50_000, min_df=2)
    return model.vocabulary.withColumn("idf", F.round("idf", 6))


WEIGHTS = f"""WITH {TERMS}, w AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM tf JOIN voc USING (term)),
norm AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id)
SELECT doc_id, term, round(w / norm, 6) AS weight FROM w JOIN norm USING (doc_id)"""


@BOOK.add(WEIGHTS)
def tfidf_weights_joined(spark, d):
    """A vocabulary too large to be sent is joined."""
    rows = feat.numbered(feat.term_counts(labeled_docs(spark, d), "doc_id", "text"))
    model = feat.tfidf_fit(rows, "doc_id", "text")
    weights = feat.tfidf_weights(rows, model, "doc_id", "text", broadcast_terms=0)
    return weights.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@BOOK.add(f"""WITH {TERMS}, w AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM tf JOIN voc USING (term)),
norm AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id)
SELECT doc_id, term, round(w / norm, 6) AS weight FROM w JOIN norm USING (doc_id)""")
def tfidf_weights(spark, d):
    rows = feat.numbered(feat.term_counts(labeled_docs(spark, d), "doc_id", "text"))
    model = feat.tfidf_fit(rows, "doc_id", "text")
    weights = feat.tfidf_weights(rows, model, "doc_id", "text")
    return weights.select("doc_id", "term", F.round("weight", 6).alias("weight"))


def shape_encoder():
    """A stand-in encoder: characters and spaces of a text."""
    def encode(texts: list[str]) -> np.ndarray:
        return np.array([[len(t), t.count(" ")] for t in texts], dtype="float32")

    return encode  # a closure, so that executors need not import this module


@BOOK.add("""SELECT doc_id, CAST(length(text) AS FLOAT) AS chars, CAST(length(text) - length(replace(text, ' ', '')) AS FLOAT) AS spaces FROM documents""")
def encode_distinct(spark, d):
    done = feat.encode_distinct(table(spark, d, "documents").select("doc_id", "text"), "text", shape_encoder())
    return done.select("doc_id", F.col("embedding")[0].alias("chars"), F.col("embedding")[1].alias("spaces"))


# --- model metrics --------------------------------------------------------------------------

@BOOK.add("SELECT round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 4) AS accuracy FROM labels")
def accuracy(spark, d):
    return agr.accuracy(table(spark, d, "labels"), "quality", "toxic")


F1 = """
sides AS (SELECT quality AS c, 1 AS na, 0 AS nb, CASE WHEN quality = toxic THEN 1 ELSE 0 END AS nab FROM labels
  UNION ALL SELECT toxic, 0, 1, 0 FROM labels),
per AS (SELECT c, 2 * sum(nab) / (sum(na) + sum(nb)) AS f1 FROM sides GROUP BY c)"""


@BOOK.add(f"WITH {F1} SELECT round(avg(f1), 4) AS f1 FROM per")
def macro_f1(spark, d):
    return agr.macro_f1(table(spark, d, "labels"), "quality", "toxic")


@BOOK.add(f"""WITH {F1} SELECT round(avg(f1), 4) AS f1, (SELECT count(*) FROM labels) AS n,
(SELECT round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 4) FROM labels) AS accuracy FROM per""")
def evaluate(spark, d):
    return agr.evaluate(table(spark, d, "labels"), "quality", "toxic")


# --- learning curves --------------------------------------------------------------------------

@BOOK.add(f"WITH {HISTORY} SELECT strategy, n_labeled, accuracy, f1 FROM history ORDER BY 1, 2")
def learning_curve(spark, d):
    return learn.learning_curve(history(spark, d))


PIVOT = ", ".join(
    f"round(avg({m}) FILTER (WHERE strategy = '{s}'), 4) AS {m}_{s}"
    for m in ("accuracy", "f1") for s in ("view", "random")
)


@BOOK.add(f"WITH {HISTORY} SELECT n_labeled, {PIVOT} FROM history GROUP BY n_labeled")
def curve_pivot(spark, d):
    return learn.curve_pivot(history(spark, d), ["view", "random"])


@BOOK.add(f"""WITH {HISTORY}, base AS (SELECT f1 AS target_f1, n_labeled AS n_baseline FROM history WHERE strategy = 'random' ORDER BY iteration DESC LIMIT 1),
r AS (SELECT strategy, min(iteration) FILTER (WHERE f1 >= target_f1) AS it, arg_max(f1, iteration) AS final_f1, target_f1, n_baseline
  FROM history, base WHERE strategy <> 'random' GROUP BY strategy, target_f1, n_baseline)
SELECT r.strategy, target_f1, n_baseline, h.n_labeled AS n_reached, n_baseline - h.n_labeled AS saved,
  round((n_baseline - h.n_labeled) / n_baseline * 100, 1) AS saved_pct, final_f1
FROM r LEFT JOIN history h ON h.strategy = r.strategy AND h.iteration = r.it""")
def savings(spark, d):
    return learn.savings(history(spark, d))


@BOOK.add(f"WITH {HISTORY} SELECT strategy, max(f1) AS max_f1 FROM history GROUP BY strategy")
def strategy_summary(spark, d):
    return learn.strategy_summary(history(spark, d), by=["strategy"])


# --- ways of large tables, with small limits ----------------------------------------------------

@BOOK.add("SELECT event_id, row_number() OVER (ORDER BY user_id NULLS FIRST, event_id) AS rank FROM "
          "(SELECT event_id, CASE WHEN event_id % 4 > 0 THEN user_id % 5 END AS user_id FROM events)")
def rank_small_buckets(spark, d):
    """Ranks over many buckets, where few values of the leading key, one of them NULL, hold all rows."""
    user = F.when(F.col("event_id") % 4 > 0, F.col("user_id") % 5)
    events = table(spark, d, "events").select("event_id", user.alias("user_id"))
    return ranking.global_rank(events, ["user_id", "event_id"], rows_per_bucket=100).select("event_id", "rank")


@BOOK.add("""SELECT event_id, user_id % 3 AS k, n FROM events LEFT JOIN
(SELECT user_id % 3 AS k, count(*) AS n FROM events WHERE user_id % 3 > 0 GROUP BY 1) g ON user_id % 3 = g.k""")
def join_hot_keys(spark, d):
    """Three keys hold all rows; two of them are in the other table."""
    events = table(spark, d, "events").select("event_id", (F.col("user_id") % 3).alias("k"))
    sizes = events.where("k > 0").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return left_join_hot(events, sizes, ["k"], "n", hot_rows=100).select("event_id", "k", "n")


@BOOK.add("""WITH r AS (SELECT event_id, row_number() OVER (ORDER BY md5('7:' || event_id), event_id) AS rank FROM events)
SELECT rank, event_id FROM r WHERE rank IN (1, 50, 700)""")
def cutoffs_one_group(spark, d):
    """Places in one group that holds all rows, found in slices of about 30 rows."""
    events = table(spark, d, "events").withColumn("g", F.lit("all"))
    found = ranking.hash_cutoffs(events, "g", "event_id", 7, {"all": [1, 50, 700]}, prefix_rows=30)
    return found.select(F.col("rank").cast("bigint").alias("rank"), F.col("k").alias("event_id"))


# --- training: what SQL can say of it -----------------------------------------------------------

CYCLE = """WITH n AS (SELECT count(*) AS total, count(*) - CAST(ceil(0.2 * count(*)) AS BIGINT) - {start} AS pool FROM {rows})
SELECT s AS strategy, CAST(it AS INTEGER) AS iteration, {start} + least(20 * it, pool) AS n_labeled,
  CASE WHEN it < 2 THEN least(20, pool - least(20 * it, pool)) ELSE 0 END AS n_queried, TRUE AS apart, TRUE AS scored
FROM n, (VALUES (0), (1), (2)) AS v(it), (VALUES {strategies}) AS w(s)"""


def cycle_sql(rows: str, start: int, *strategies: str) -> str:
    return CYCLE.format(rows=rows, start=start, strategies=", ".join(f"('{s}')" for s in strategies))


def cycle_facts(history):
    """Sizes; whether the batches of a strategy share no key; whether its scores are scores."""
    every = F.flatten(F.collect_list("queried_keys").over(Window.partitionBy("strategy")))
    good = F.col("accuracy").between(0, 1) & F.col("f1").between(0, 1)
    return history.select(
        "strategy", "iteration", "n_labeled", F.size("queried_keys").cast("bigint").alias("n_queried"),
        (F.size(every) == F.size(F.array_distinct(every))).alias("apart"), good.alias("scored"),
    )


def split_vectors(spark, d, n_start):
    parts = stage(learn.stratified_split(table(spark, d, "embeddings"), "label", "vec_id", n_start=n_start), "split")
    return [parts.where(F.col("split") == s).drop("split") for s in ("labeled", "pool", "test")]


def split_docs(spark, d, n_start=100):
    parts = stage(learn.stratified_split(labeled_docs(spark, d), "toxic", "doc_id", n_start=n_start), "split")
    return [parts.where(F.col("split") == s).drop("split") for s in ("labeled", "pool", "test")]


def vector_cycle(spark, d, strategy, **how):
    return cycle_facts(learn.run_cycle(
        *split_vectors(spark, d, 100), strategy, "vec_id", "label", embedding_col="embedding",
        model="embedding", iterations=2, batch_size=20, **how,
    ))


@BOOK.add(cycle_sql("embeddings", 100, "random"))
def run_cycle_sizes(spark, d):
    return vector_cycle(spark, d, "random")


@BOOK.add(cycle_sql("embeddings", 100, "entropy"))
def run_cycle_entropy(spark, d):
    return vector_cycle(spark, d, "entropy")


@BOOK.add(cycle_sql("embeddings", 100, "entropy"))
def run_cycle_candidates(spark, d):
    """A caller's limit: only so many random rows of the pool are scored."""
    return vector_cycle(spark, d, "entropy", candidate_sample=60)


@BOOK.add(cycle_sql("labels WHERE toxic IS NOT NULL", 100, "entropy"))
def run_cycle(spark, d):
    """A cycle over texts."""
    return cycle_facts(learn.run_cycle(
        *split_docs(spark, d), "entropy", "doc_id", "toxic", "text", iterations=2, batch_size=20
    ))


@BOOK.add(cycle_sql("embeddings", 100, "entropy", "margin", "random"))
def compare_al_strategies(spark, d):
    return cycle_facts(learn.compare_al_strategies(
        *split_vectors(spark, d, 100), ["entropy", "margin", "random"], key="vec_id", label_col="label",
        embedding_col="embedding", model="embedding", iterations=2, batch_size=20,
    ))


def split_sql(labels: str, start: int) -> str:
    """The test keys of a split, with what holds of every prediction."""
    test = SPLIT.replace("* 50 ", f"* {start} ").replace("<= 50 -", f"<= {start} -")
    test = test.replace("SELECT doc_id, CAST(toxic AS VARCHAR) AS y FROM labels WHERE toxic IS NOT NULL", labels)
    return f"WITH {test} SELECT doc_id, TRUE AS one, TRUE AS best, TRUE AS known FROM split WHERE split = 'test'"


def prediction_facts(predicted, model):
    """Per test key: probabilities sum to 1, the label is the most probable one, and a class."""
    place = F.array_position("proba", F.array_max("proba")).cast("int")
    classes = F.array(*[F.lit(c) for c in model.classes])
    return predicted.select(
        "doc_id", (F.round(F.aggregate("proba", F.lit(0.0), lambda t, p: t + p), 6) == 1).alias("one"),
        (F.element_at(classes, place) == F.col("y_pred")).alias("best"), F.col("y_pred").isin(*model.classes).alias("known"),
    )


TOXIC = "SELECT doc_id, CAST(toxic AS VARCHAR) AS y FROM labels WHERE toxic IS NOT NULL"
VECTORS = "SELECT vec_id AS doc_id, CAST(label AS VARCHAR) AS y FROM embeddings WHERE label IS NOT NULL"


def predict_texts(spark, d, kind, **options):
    """Predictions for the test part from a model of all other rows."""
    labeled, pool, test = split_docs(spark, d)
    model = models.fit(labeled.unionByName(pool), kind, "doc_id", "toxic", "text", **options)
    return model.predict(test, ["toxic"]), model


def predict_vectors(spark, d):
    """The same for ten classes from precomputed vectors."""
    labeled, pool, test = split_vectors(spark, d, 100)
    model = models.fit(labeled.unionByName(pool), "embedding", "vec_id", "label", embedding_col="embedding")
    return model.predict(test, ["label"]).withColumnRenamed("vec_id", "doc_id"), model


@BOOK.add(split_sql(TOXIC, 100))
def predict_logreg(spark, d):
    return prediction_facts(*predict_texts(spark, d, "logreg"))


@BOOK.add(split_sql(TOXIC, 100))
def predict_svm(spark, d):
    return prediction_facts(*predict_texts(spark, d, "svm"))


@BOOK.add(split_sql(TOXIC, 100))
def predict_rf(spark, d):
    return prediction_facts(*predict_texts(spark, d, "rf"))


@BOOK.add(split_sql(VECTORS, 100))
def predict_embedding(spark, d):
    return prediction_facts(*predict_vectors(spark, d))


def _rows(predicted, kind: str, truth: str):
    return predicted.select(
        F.lit(kind).alias("model"), "doc_id", F.col(truth).cast("string").alias("y"), "y_pred",
        F.transform("proba", lambda p: F.round(p, 4)).alias("proba"),
    )


@BOOK.add()
def predictions(spark, d):
    """Labels and probabilities of every model for its test part: they depend on the solver, so no SQL says them."""
    labeled, pool, test = split_docs(spark, d)
    # terms are counted once for all models of texts
    train, test = [feat.numbered(feat.term_counts(df, "doc_id", "text", ["toxic"])) for df in (labeled.unionByName(pool), test)]
    parts = [
        _rows(models.fit(train, kind, "doc_id", "toxic", "text").predict(test, ["toxic"]), kind, "toxic")
        for kind in models.MODELS if kind != "embedding"
    ]
    return reduce(DataFrame.unionByName, [*parts, _rows(predict_vectors(spark, d)[0], "embedding", "label")])


@BOOK.add()
def cycle_scores(spark, d):
    """Accuracy and macro-F1 per iteration of a whole run."""
    history = learn.run_cycle(
        *split_vectors(spark, d, 100), "margin", "vec_id", "label", embedding_col="embedding", model="embedding",
        iterations=2, batch_size=20,
    )
    return history.select("strategy", "iteration", "n_labeled", F.round("accuracy", 4).alias("accuracy"), F.round("f1", 4).alias("f1"))


@BOOK.add("SELECT count(*) > 0 AS better FROM labels")
def fit_beats_majority(spark, d):
    """A model of a few measures of the text is more often right on test rows than the largest class is."""
    size = F.char_length("text") + 1
    shares = [F.regexp_count("text", F.lit(p)) / size for p in (r"[#$%&*]", r"\|", "!", "[A-Z]", r"\s")]
    rows = labeled_docs(spark, d).select("doc_id", "quality", F.transform(F.array(*shares), lambda v: v * 20).alias("x"))
    parts = stage(learn.stratified_split(rows, "quality", "doc_id", n_start=100), "split")
    model = models.fit(parts.where("split <> 'test'"), "embedding", "doc_id", "quality", embedding_col="x")
    test = model.predict(parts.where("split = 'test'"), ["quality"])
    right = F.avg((F.col("quality").cast("string") == F.col("y_pred")).cast("int"))
    return test.agg((right > F.greatest(F.avg("quality"), 1 - F.avg("quality"))).alias("better"))


@BOOK.add("""WITH RECURSIVE d AS (SELECT CAST(embedding[1] AS DOUBLE) AS x, CASE WHEN label < 5 THEN 1.0 ELSE 0.0 END::DOUBLE AS y FROM embeddings),
s AS (SELECT count(*)::DOUBLE AS n, sum(y) AS yes FROM d),
r AS (SELECT x, y, CASE WHEN y = 1 THEN n / (2 * yes) ELSE n / (2 * (n - yes)) END AS w, n FROM d, s),
fit AS (
  SELECT 0 AS it, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b
  UNION ALL
  SELECT it + 1, a - (haa_inv * ga + hab_inv * gb), b - (hab_inv * ga + hbb_inv * gb) FROM (
    SELECT it, a, b, ga, gb, hbb / (haa * hbb - hab * hab) AS haa_inv, haa / (haa * hbb - hab * hab) AS hbb_inv, -hab / (haa * hbb - hab * hab) AS hab_inv
    FROM (SELECT it, a, b, sum(w * (p - y)) AS ga, sum(w * (p - y) * x) + b AS gb,
                 sum(w * p * (1 - p)) AS haa, sum(w * p * (1 - p) * x) AS hab, sum(w * p * (1 - p) * x * x) + 1 AS hbb
          FROM (SELECT fit.*, r.*, 1 / (1 + exp(-(a + b * x))) AS p FROM fit, r WHERE it < 12) GROUP BY it, a, b)))
SELECT place, round(1 / (1 + exp(-(a + b * place))), 4) AS p FROM fit, (VALUES (-1.0::DOUBLE), (0.0), (1.0)) AS v(place) WHERE it = 12""")
def logreg_one_feature(spark, d):
    """A balanced logistic regression of one feature against Newton's steps in SQL."""
    rows = table(spark, d, "embeddings").select(
        "vec_id", F.array(F.col("embedding")[0].cast("double")).alias("x"), F.when(F.col("label") < 5, 1).otherwise(0).alias("y")
    )
    model = models.fit(rows, "embedding", "vec_id", "y", embedding_col="x", tolerance=1e-12)
    asked = rows.groupBy().agg(F.max("vec_id").alias("vec_id")).select(
        "vec_id", F.explode(F.array(F.lit(-1.0), F.lit(0.0), F.lit(1.0))).alias("place")
    ).withColumn("x", F.array("place"))
    return model.predict(asked, ["place"]).select("place", F.round(F.col("proba")[1], 4).alias("p"))


GIVEN = ([[1.0, -2.0, 0.5], [0.0, 1.0, 3.0], [-1.5, 0.25, -0.5]], [0.1, -0.2, 0.3])


@BOOK.add("""WITH e AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings),
m AS (SELECT vec_id, exp(x - 2 * y + 0.5 * z + 0.1) AS a, exp(y + 3 * z - 0.2) AS b, exp(-1.5 * x + 0.25 * y - 0.5 * z + 0.3) AS c FROM e)
SELECT vec_id, round(a / (a + b + c), 6) AS p_a, round(b / (a + b + c), 6) AS p_b,
  CASE WHEN a >= b AND a >= c THEN 'a' WHEN b >= c THEN 'b' ELSE 'c' END AS y_pred FROM m""")
def predict_given(spark, d):
    """Probabilities and labels from given coefficients."""
    rows = table(spark, d, "embeddings").select(
        "vec_id", F.transform(F.slice("embedding", 1, 3), lambda v: v.cast("double")).alias("x")
    )
    found = models.linear_classifier(["a", "b", "c"], *GIVEN, "vec_id", "x").predict(rows)
    return found.select(
        "vec_id", F.round(F.col("proba")[0], 6).alias("p_a"), F.round(F.col("proba")[1], 6).alias("p_b"), "y_pred"
    )
