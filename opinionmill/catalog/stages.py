"""Extractive summaries, artifacts and files written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinionmill.catalog.dashboard import LENGTH_SQL, THEMES_SQL
from opinionmill.catalog.evaluation import predictions
from opinionmill.catalog.features import STOP_SQL
from opinionmill.catalog.registry import (
    CLUSTERED, REVIEWS_TEXT, SENTIMENT_ROWS, SOURCE_ROWS, clean_sql, label_sql, query,
)
from opinionmill.operators import articles, metrics
from opinionmill.plans import dashboard
from opinionmill.session import scratch_path
from opinionmill.sources import adapters, artifact, documents, sinks
from opinionmill.sources import reviews as readers

SENTENCES_SQL = rf"""
WITH parts AS (
  SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)),
                             lambda x: NOT regexp_full_match(x, '\s*')) AS p FROM documents),
listed AS (SELECT doc_id, unnest(p) AS sentence, unnest(range(len(p))) AS position FROM parts),
occ AS (SELECT doc_id, position, unnest(list_filter(regexp_extract_all(lower(sentence), '[\pL\pM\pN_]{{2,}}'),
                                                   lambda w: w NOT IN {STOP_SQL})) AS term FROM listed),
counts AS (SELECT doc_id, position, term, count(*) AS tf FROM occ GROUP BY ALL),
vocab AS (SELECT term, count(*) AS df FROM counts GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 5000),
sums AS (SELECT doc_id, position, sum(tf * (ln(((SELECT count(*) FROM listed) + 1.0) / (df + 1.0)) + 1.0)) AS s
         FROM counts c JOIN vocab v ON v.term = c.term GROUP BY ALL),
weighted AS (
  SELECT l.doc_id, l.position, sentence,
         round(COALESCE(s, 0) / sqrt(greatest(len(regexp_extract_all(sentence, '\S+')), 1)), 6) AS weight
  FROM listed l LEFT JOIN sums u ON u.doc_id = l.doc_id AND u.position = l.position)"""


@query("extractive_summary", f"""{SENTENCES_SQL},
best AS (SELECT * FROM weighted QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, position) <= 2)
SELECT doc_id AS row_id, string_agg(sentence, ' ' ORDER BY position) AS summary FROM best GROUP BY doc_id""")
def extractive_summary(spark, sf_dir):
    docs = adapters.documents(spark, sf_dir).select(F.col("doc_id").alias("row_id"), "text")
    return articles.extractive_summaries(docs, "row_id", "text")


@query("csv_roundtrip", f"""
WITH {REVIEWS_TEXT}, named AS (
  SELECT row_id, rating, {clean_sql('raw_text')} AS review_text, {label_sql('rating')} AS sentiment,
         trim(regexp_replace(product_name, '\\s+', ' ', 'g'), ' ,') AS product_name, categories FROM reviews_text)
SELECT row_id, review_text, product_name, categories, rating, sentiment FROM named
WHERE rating IS NOT NULL AND review_text <> ''""")
def csv_roundtrip(spark, sf_dir):
    """The documents written as a review CSV, line breaks and quotes included, and loaded again."""
    path = scratch_path(spark, "reviews-csv")
    raw = adapters.reviews_text(spark, sf_dir).select(
        F.col("row_id").cast("string").alias("id"), F.col("raw_text").alias("reviews.text"),
        F.col("rating").cast("string").alias("reviews.rating"), F.col("product_name").alias("name"), "categories",
    )
    sinks.write_csv(raw, path)
    loaded = readers.load_reviews(readers.read_reviews_csv(spark, path, row_id="id"))
    return loaded.withColumn("row_id", F.col("row_id").cast("long"))


def saved_artifact(spark, sf_dir):
    path = scratch_path(spark, "dashboard")
    dashboard.build_dashboard(adapters.clustered_reviews(spark, sf_dir), path, themes=adapters.CORPUS_THEMES)
    return artifact.read(spark, path)


@query("artifact_category_sentiment", f"""
WITH {CLUSTERED},
both_sources AS (
  SELECT cluster_name AS category, 'model' AS source, model_sentiment AS sentiment FROM clustered
  UNION ALL SELECT cluster_name, 'rating', sentiment FROM clustered)
SELECT c.category, o.source, s.sentiment, count(b.category) AS count
FROM (SELECT DISTINCT category FROM both_sources) c CROSS JOIN {SOURCE_ROWS} CROSS JOIN {SENTIMENT_ROWS}
LEFT JOIN both_sources b ON b.category = c.category AND b.source = o.source AND b.sentiment = s.sentiment
GROUP BY ALL""")
def artifact_category_sentiment(spark, sf_dir):
    return saved_artifact(spark, sf_dir)["category_sentiment"]


@query("artifact_record", f"""
WITH {CLUSTERED},
both_sources AS (
  SELECT cluster_name AS category, 'model' AS source, model_sentiment AS sentiment FROM clustered
  UNION ALL SELECT cluster_name, 'rating', sentiment FROM clustered)
SELECT c.category, o.source, s.sentiment, count(b.category) AS count
FROM (SELECT DISTINCT category FROM both_sources) c CROSS JOIN {SOURCE_ROWS} CROSS JOIN {SENTIMENT_ROWS}
LEFT JOIN both_sources b ON b.category = c.category AND b.source = o.source AND b.sentiment = s.sentiment
GROUP BY ALL""")
def artifact_record(spark, sf_dir):
    """The artifact as one JSON record in one file, read back."""
    path = scratch_path(spark, "dashboard")
    record = f"{path}-record/dashboard.json"
    dashboard.build_dashboard(adapters.clustered_reviews(spark, sf_dir), path, themes=adapters.CORPUS_THEMES, record=record)
    return artifact.read_nested(spark, record)["category_sentiment"]


@query("csv_projected", f"""
WITH {REVIEWS_TEXT}
SELECT row_id, md5(raw_text) AS text_digest, rating FROM reviews_text WHERE rating IS NOT NULL AND raw_text IS NOT NULL""")
def csv_projected(spark, sf_dir):
    """Two columns of a review CSV, rows without either dropped, texts as they were written."""
    path = scratch_path(spark, "reviews-csv")
    raw = adapters.reviews_text(spark, sf_dir).select(
        F.col("row_id").cast("string").alias("id"), F.col("raw_text").alias("reviews.text"),
        F.col("rating").cast("string").alias("reviews.rating"), F.col("product_name").alias("name"), "categories",
    )
    sinks.write_csv(raw, path)
    loaded = readers.read_reviews_csv(spark, path, ("reviews.text", "reviews.rating"), row_id="id").toDF("row_id", "text", "rating")
    return loaded.na.drop().select(
        F.col("row_id").cast("long").alias("row_id"), F.md5(F.col("text").cast("binary")).alias("text_digest"),
        F.col("rating").cast("double").alias("rating"))


@query("csv_single_file", f"""
WITH {REVIEWS_TEXT}, named AS (
  SELECT row_id, rating, {clean_sql('raw_text')} AS review_text, {label_sql('rating')} AS sentiment,
         trim(regexp_replace(product_name, '\\s+', ' ', 'g'), ' ,') AS product_name, categories FROM reviews_text)
SELECT row_id, review_text, product_name, categories, rating, sentiment FROM named
WHERE rating IS NOT NULL AND review_text <> ''""")
def csv_single_file(spark, sf_dir):
    """The documents as one CSV file with a byte-order mark, read again by ranges."""
    path = scratch_path(spark, "reviews-file") + "/reviews.csv"
    raw = adapters.reviews_text(spark, sf_dir).select(
        F.col("row_id").cast("string").alias("id"), F.col("raw_text").alias("reviews.text"),
        F.col("rating").cast("string").alias("reviews.rating"), F.col("product_name").alias("name"), "categories",
    )
    documents.write_csv_file(raw, path, ["id"])
    loaded = readers.load_reviews(readers.read_reviews_csv(spark, path, row_id="id"))
    return loaded.withColumn("row_id", F.col("row_id").cast("long"))


@query("artifact_theme_counts", f"{THEMES_SQL} SELECT * FROM theme_counts")
def artifact_theme_counts(spark, sf_dir):
    return saved_artifact(spark, sf_dir)["complaint_theme_counts"]


@query("artifact_length_sentiment", f"{LENGTH_SQL} SELECT * FROM lengths")
def artifact_length_sentiment(spark, sf_dir):
    return saved_artifact(spark, sf_dir)["review_length_sentiment"]


@query("dashboard_ranked_export", f"""
WITH {CLUSTERED}
SELECT cluster_name AS category, product_name, count(*) AS review_count, round(avg(rating), 6) AS mean_rating,
       round(avg((sentiment = 'negative')::INT), 6) AS negative_share,
       round(avg((sentiment = 'positive')::INT), 6) AS positive_share
FROM clustered GROUP BY ALL HAVING count(*) >= 10
ORDER BY avg((sentiment = 'negative')::INT) DESC, review_count DESC, product_name LIMIT 10""")
def dashboard_ranked_export(spark, sf_dir):
    views = dashboard.dashboard_views(saved_artifact(spark, sf_dir), source="rating", min_support=10)
    path = scratch_path(spark, "ranked-export")
    sinks.write_csv(views["ranked_export"], path)
    back = sinks.read_csv(spark, path, "category string, product_name string, review_count bigint, "
                          "mean_rating double, negative_share double, positive_share double")
    return back.withColumns({c: F.round(c, 6) for c in ("mean_rating", "negative_share", "positive_share")})


@query("confusion_csv", """
SELECT 'Actual ' || s.sentiment AS actual,
       count(*) FILTER (l_returnflag = 'R') AS "Predicted negative",
       count(*) FILTER (l_returnflag = 'A') AS "Predicted neutral",
       count(*) FILTER (l_returnflag = 'N') AS "Predicted positive"
FROM (VALUES ('negative', 1), ('neutral', 2), ('positive', 3)) AS s(sentiment, level)
JOIN lineitem ON level = CASE WHEN 1 + l_quantity % 5 <= 2 THEN 1 WHEN 1 + l_quantity % 5 = 3 THEN 2 ELSE 3 END
GROUP BY 1""")
def confusion_csv(spark, sf_dir):
    path = scratch_path(spark, "confusion")
    sinks.write_confusion_csv(metrics.confusion_matrix(predictions(spark, sf_dir)), path)
    return sinks.read_csv(
        spark, path, "actual string, `Predicted negative` bigint, `Predicted neutral` bigint, `Predicted positive` bigint"
    )
