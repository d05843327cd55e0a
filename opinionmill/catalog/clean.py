"""Cleaning, labels and contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinionmill.catalog.registry import CLUSTERED, REVIEWS_TEXT, USABLE, clean_sql, query
from opinionmill.functions import labels, text
from opinionmill.operators import aggregates, contracts, joins, reshape
from opinionmill.sources import adapters
from opinionmill.sources.adapters import table


@query("clean_text", f"SELECT doc_id AS row_id, {clean_sql('text')} AS review_text FROM documents")
def clean_text(spark, sf_dir):
    docs = adapters.documents(spark, sf_dir)
    return docs.select(F.col("doc_id").alias("row_id"), text.clean_text(F.col("text")).alias("review_text"))


@query("clean_product_name", r"""
WITH named AS (
  SELECT doc_id AS row_id,
         trim(regexp_replace(split_part(replace(text, chr(13), chr(10)), chr(10), 1), '\s+', ' ', 'g'), ' ,') AS name
  FROM documents)
SELECT row_id, CASE WHEN name = '' OR lower(name) IN ('unknown', 'nan', 'none')
                    THEN 'Unknown product' ELSE name END AS product_name
FROM named""")
def clean_product_name(spark, sf_dir):
    docs = adapters.documents(spark, sf_dir)
    return docs.select(
        F.col("doc_id").alias("row_id"), text.clean_product_name(F.col("text")).alias("product_name")
    )


@query("review_ingest", f"""
WITH {USABLE}
SELECT row_id, product_name, categories, rating, sentiment, review_text FROM usable""")
def review_ingest(spark, sf_dir):
    return adapters.usable_reviews(spark, sf_dir).select(
        "row_id", "product_name", "categories", "rating", "sentiment", "review_text"
    )


@query("sentiment_open", """
SELECT l_quantity / 10 AS rating,
       CASE WHEN l_quantity / 10 <= 2 THEN 'negative' WHEN l_quantity / 10 = 3 THEN 'neutral'
            ELSE 'positive' END AS sentiment,
       count(*) AS n
FROM lineitem GROUP BY ALL""")
def sentiment_open(spark, sf_dir):
    rating = F.col("l_quantity") / 10
    return (
        table(spark, sf_dir, "lineitem").select(rating.alias("rating"), labels.sentiment(rating).alias("sentiment"))
        .groupBy("rating", "sentiment").agg(F.count(F.lit(1)).alias("n"))
    )


@query("sentiment_strict", """
WITH labelled AS (
  SELECT l_quantity / 10 AS rating,
         CASE WHEN l_quantity / 10 <= 2 THEN 'negative' WHEN l_quantity / 10 = 3 THEN 'neutral'
              WHEN l_quantity / 10 BETWEEN 4 AND 5 THEN 'positive' ELSE 'invalid' END AS sentiment
  FROM lineitem)
SELECT rating, sentiment, count(*) AS n FROM labelled WHERE sentiment <> 'invalid' GROUP BY ALL""")
def sentiment_strict(spark, sf_dir):
    rating = F.col("l_quantity") / 10
    return (
        table(spark, sf_dir, "lineitem")
        .select(rating.alias("rating"), labels.sentiment(rating, strict=True).alias("sentiment"))
        .where(F.col("sentiment").isin(*labels.SENTIMENTS))
        .groupBy("rating", "sentiment").agg(F.count(F.lit(1)).alias("n"))
    )


RAW_RATING_SQL = """CASE event_type WHEN 'error' THEN 'NaN' WHEN 'view' THEN event_type
                    ELSE json_extract_string(props, '$.k') END"""


@query("numeric_coercion", f"""
SELECT event_id AS row_id,
       CASE WHEN isnan(TRY_CAST({RAW_RATING_SQL} AS DOUBLE)) THEN NULL
            ELSE TRY_CAST({RAW_RATING_SQL} AS DOUBLE) END AS rating
FROM events""")
def numeric_coercion(spark, sf_dir):
    raw = (
        F.when(F.col("event_type") == "error", "NaN").when(F.col("event_type") == "view", F.col("event_type"))
        .otherwise(F.get_json_object("props", "$.k"))
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"), labels.to_number(raw).alias("rating")
    )


@query("length_buckets", """
SELECT CASE WHEN length(text) <= 49 THEN '0–49' WHEN length(text) <= 99 THEN '50–99'
            WHEN length(text) <= 199 THEN '100–199' WHEN length(text) <= 399 THEN '200–399' ELSE '400+' END AS length_bucket,
       count(*) AS n, min(length(text)) AS shortest, max(length(text)) AS longest
FROM documents GROUP BY 1""")
def length_buckets(spark, sf_dir):
    length = F.length("text")
    return adapters.documents(spark, sf_dir).groupBy(text.length_bucket(length).alias("length_bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.min(length).cast("long").alias("shortest"),
        F.max(length).cast("long").alias("longest"),
    )


@query("word_band_filter", r"""
SELECT doc_id AS row_id, len(regexp_extract_all(text, '\S+'))::BIGINT AS words
FROM documents WHERE len(regexp_extract_all(text, '\S+')) BETWEEN 4 AND 120""")
def word_band_filter(spark, sf_dir):
    words = text.word_count(F.col("text")).cast("long")
    return (
        adapters.documents(spark, sf_dir).select(F.col("doc_id").alias("row_id"), words.alias("words"))
        .where(F.col("words").between(4, 120))
    )


@query("request_split", r"""
SELECT doc_id AS row_id,
       CASE WHEN text = '' THEN 'empty' WHEN length(text) > 5000 THEN 'too_long'
            WHEN regexp_full_match(text, '\s*') THEN 'blank' ELSE 'accepted' END AS outcome,
       CASE WHEN length(text) BETWEEN 1 AND 5000 AND NOT regexp_full_match(text, '\s*')
            THEN regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '') END AS review
FROM documents""")
def request_split(spark, sf_dir):
    requests = adapters.documents(spark, sf_dir).select(F.col("doc_id").alias("row_id"), F.col("text").alias("review"))
    accepted, rejected = contracts.split_requests(requests, "review")
    return accepted.select("row_id", F.lit("accepted").alias("outcome"), "review").unionByName(
        rejected.select("row_id", F.col("reason").alias("outcome"), F.lit(None).cast("string").alias("review"))
    )


@query("contract_unique_key", """
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def contract_unique_key(spark, sf_dir):
    return contracts.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("contract_orphans", """
SELECT user_id, count(*) AS rows FROM events
WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY user_id""")
def contract_orphans(spark, sf_dir):
    return contracts.orphans(
        table(spark, sf_dir, "events"), table(spark, sf_dir, "supplier"), "user_id", "s_suppkey"
    )


@query("contract_id_sets", """
SELECT COALESCE(a.doc_id, b.doc_id) AS doc_id,
       CASE WHEN b.doc_id IS NULL THEN 'left_only' ELSE 'right_only' END AS side
FROM (SELECT DISTINCT doc_id FROM documents) a FULL JOIN (SELECT DISTINCT doc_id FROM labels) b ON a.doc_id = b.doc_id
WHERE a.doc_id IS NULL OR b.doc_id IS NULL""")
def contract_id_sets(spark, sf_dir):
    return contracts.id_set_differences(
        adapters.documents(spark, sf_dir), table(spark, sf_dir, "labels"), "doc_id"
    )


@query("null_profile", f"""
WITH {REVIEWS_TEXT}
SELECT 'rows' AS item, '' AS "column", '' AS type, count(*) AS value FROM reviews_text
UNION ALL SELECT 'missing', 'row_id', 'bigint', count(*) FILTER (row_id IS NULL) FROM reviews_text
UNION ALL SELECT 'missing', 'raw_text', 'string', count(*) FILTER (raw_text IS NULL) FROM reviews_text
UNION ALL SELECT 'missing', 'product_name', 'string', count(*) FILTER (product_name IS NULL) FROM reviews_text
UNION ALL SELECT 'missing', 'categories', 'string', count(*) FILTER (categories IS NULL) FROM reviews_text
UNION ALL SELECT 'missing', 'rating', 'double', count(*) FILTER (rating IS NULL) FROM reviews_text
UNION ALL SELECT 'duplicate_rows', '', '', (SELECT count(*) FROM reviews_text)
                 - (SELECT count(*) FROM (SELECT DISTINCT * FROM reviews_text))""")
def null_profile(spark, sf_dir):
    return aggregates.table_profile(adapters.reviews_text(spark, sf_dir))


@query("missing_columns", f"""
WITH {REVIEWS_TEXT}
SELECT 'rating' AS "column", count(*) AS missing FROM reviews_text WHERE rating IS NULL HAVING count(*) > 0""")
def missing_columns(spark, sf_dir):
    return aggregates.missing_columns_report(aggregates.table_profile(adapters.reviews_text(spark, sf_dir)))


@query("numeric_describe", """
SELECT count(r) AS count, round(avg(r), 6) AS mean, round(stddev_samp(r), 6) AS std, min(r) AS min,
       quantile_cont(r, 0.25) AS q1, quantile_cont(r, 0.5) AS median, quantile_cont(r, 0.75) AS q3, max(r) AS max
FROM (SELECT (1 + l_quantity % 5)::DOUBLE AS r FROM lineitem)""")
def numeric_describe(spark, sf_dir):
    out = aggregates.describe_numeric(adapters.reviews_bulk(spark, sf_dir), "rating")
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query("numeric_describe_continuous", """
SELECT count(r) AS count, round(avg(r), 4) AS mean, round(stddev_samp(r), 4) AS std, min(r) AS min,
       quantile_cont(r, 0.25) AS q1, quantile_cont(r, 0.5) AS median, quantile_cont(r, 0.75) AS q3, max(r) AS max
FROM (SELECT (l_extendedprice * (1 - l_discount) * (1 + l_tax))::DOUBLE AS r FROM lineitem)""")
def numeric_describe_continuous(spark, sf_dir):
    """A column with nearly as many values as rows."""
    charge = F.expr("CAST(l_extendedprice * (1 - l_discount) * (1 + l_tax) AS DOUBLE)").alias("charge")
    out = aggregates.describe_numeric(adapters.table(spark, sf_dir, "lineitem").select(charge), "charge")
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "std")})


@query("class_balance", f"""
WITH {USABLE}
SELECT s.sentiment, count(u.row_id) AS count, round(count(u.row_id) / (SELECT count(*) FROM usable), 6) AS share
FROM (VALUES ('negative'), ('neutral'), ('positive')) AS s(sentiment)
LEFT JOIN usable u ON u.sentiment = s.sentiment GROUP BY s.sentiment""")
def class_balance(spark, sf_dir):
    out = aggregates.class_balance(adapters.usable_reviews(spark, sf_dir))
    return out.withColumn("share", F.round("share", 6))


@query("cluster_join_default", f"""
WITH {CLUSTERED} SELECT row_id, product_name, rating, sentiment, cluster_id, cluster_name FROM clustered""")
def cluster_join_default(spark, sf_dir):
    dim = adapters.product_dim(spark, sf_dir)
    contracts.require_unique(dim, "product_name", what="Product table")
    return joins.assign_categories(adapters.usable_reviews(spark, sf_dir), dim).select(
        "row_id", "product_name", "rating", "sentiment", "cluster_id", "cluster_name"
    )


@query("unpivot_sources", f"""
WITH {USABLE}
SELECT row_id, 'model' AS source, model_sentiment AS sentiment FROM usable
UNION ALL SELECT row_id, 'rating', sentiment FROM usable""")
def unpivot_sources(spark, sf_dir):
    reviews = adapters.usable_reviews(spark, sf_dir)
    return reshape.unpivot_sources(reviews, aggregates.SENTIMENT_SOURCES, ["row_id"])


@query("picker_values", "SELECT DISTINCT p_name AS product_name FROM lineitem JOIN part ON l_partkey = p_partkey")
def picker_values(spark, sf_dir):
    return reshape.picker_values(adapters.reviews_bulk(spark, sf_dir), "product_name")
