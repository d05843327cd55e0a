"""Streaming forms, run to the end of the files at hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinionmill.catalog.dashboard import CATEGORY_COUNTS_SQL, METRICS_COLUMNS_SQL
from opinionmill.catalog.models import balanced_model
from opinionmill.catalog.registry import USABLE, query
from opinionmill.functions.labels import SENTIMENTS
from opinionmill.operators import aggregates
from opinionmill.operators.contracts import split_requests
from opinionmill.session import scratch_path
from opinionmill.sources import adapters
from opinionmill.sources.adapters import table
from opinionmill.streaming import counts, scoring


def document_stream(spark, sf_dir):
    """The document table as a file stream, be it one file or a folder of part files.

    A stream refuses the path of a single file, but not a pattern; this one matches the table's name alone.
    """
    schema = table(spark, sf_dir, "documents").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/documents.parque[t]")


@query("stream_scored_reviews")
def stream_scored_reviews(spark, sf_dir):
    model = balanced_model(spark, sf_dir)
    requests = document_stream(spark, sf_dir).select(F.col("doc_id").alias("row_id"), F.col("text").alias("review_text"))
    scored, _ = scoring.score_stream(requests, model, "review_text")
    path = scratch_path(spark, "stream-scored")
    scoring.append_table(scored, path, scratch_path(spark, "stream-scored-log")).awaitTermination()
    result = scoring.read_table(spark, path, scored.schema)
    return result.select("row_id", "sentiment", *[F.col("class_scores")[s].alias(s) for s in SENTIMENTS])


@query("stream_rejected_requests", r"""
SELECT doc_id AS row_id, CASE WHEN text = '' THEN 'empty' WHEN length(text) > 5000 THEN 'too_long' ELSE 'blank' END AS reason
FROM documents WHERE length(text) > 5000 OR regexp_full_match(text, '\s*')""")
def stream_rejected_requests(spark, sf_dir):
    requests = document_stream(spark, sf_dir).select(F.col("doc_id").alias("row_id"), F.col("text").alias("review"))
    _, rejected = split_requests(requests, "review")
    reasons = rejected.select("row_id", "reason")
    path = scratch_path(spark, "stream-rejected")
    scoring.append_table(reasons, path, scratch_path(spark, "stream-rejected-log")).awaitTermination()
    return scoring.read_table(spark, path, reasons.schema)


@query("stream_sentiment_counts", CATEGORY_COUNTS_SQL)
def stream_sentiment_counts(spark, sf_dir):
    """The batch aggregate, unchanged, on a stream joined with the label table."""
    reviews = adapters.usable_reviews(spark, sf_dir, document_stream(spark, sf_dir))
    refreshed = aggregates.category_sentiment(reviews, "categories")
    path = scratch_path(spark, "stream-counts")
    keys = ["category", "source", "sentiment"]
    counts.refresh_counts(refreshed, path, scratch_path(spark, "stream-counts-log"), keys).awaitTermination()
    return counts.latest_counts(spark, path)


@query("stream_product_metrics", f"""
WITH {USABLE}
SELECT categories AS category, product_name, count(*) AS review_count, round(avg(rating), 6) AS mean_rating,
       {METRICS_COLUMNS_SQL} FROM usable GROUP BY ALL""")
def stream_product_metrics(spark, sf_dir):
    reviews = adapters.usable_reviews(spark, sf_dir, document_stream(spark, sf_dir))
    refreshed = aggregates.product_metrics(reviews, "categories")
    path = scratch_path(spark, "stream-products")
    keys = ["category", "product_name"]
    counts.refresh_counts(refreshed, path, scratch_path(spark, "stream-products-log"), keys).awaitTermination()
    return counts.latest_counts(spark, path).withColumn("mean_rating", F.round("mean_rating", 6))
