"""Product, category and dashboard aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinionmill.catalog.registry import (
    BULK, CLUSTERED, SENTIMENT_ROWS, SOURCE_ROWS, USABLE, query,
)
from opinionmill.functions.text import LENGTH_BUCKETS
from opinionmill.operators import aggregates, contracts, joins, ranking, reshape, sketches
from opinionmill.operators.aggregates import SENTIMENT_SOURCES
from opinionmill.session import materialized
from opinionmill.sources import adapters
from opinionmill.sources.adapters import CORPUS_THEMES

SIX = ("mean_rating", "negative_share", "neutral_share", "positive_share")


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns or SIX if c in df.columns})


CATEGORY_COUNTS_SQL = f"""
WITH {USABLE},
both_sources AS (
  SELECT categories AS category, 'model' AS source, model_sentiment AS sentiment FROM usable
  UNION ALL SELECT categories, 'rating', sentiment FROM usable)
SELECT c.category, o.source, s.sentiment, count(b.category) AS count
FROM (SELECT DISTINCT category FROM both_sources) c CROSS JOIN {SOURCE_ROWS} CROSS JOIN {SENTIMENT_ROWS}
LEFT JOIN both_sources b ON b.category = c.category AND b.source = o.source AND b.sentiment = s.sentiment
GROUP BY ALL"""


@query("category_sentiment_counts", CATEGORY_COUNTS_SQL)
def category_sentiment_counts(spark, sf_dir):
    return aggregates.category_sentiment(adapters.usable_reviews(spark, sf_dir), "categories")


@query("product_profile", f"""
WITH {USABLE},
first20 AS (
  SELECT product_name, row_id, review_text FROM usable
  QUALIFY row_number() OVER (PARTITION BY product_name ORDER BY row_id) <= 20),
docs AS (SELECT product_name, string_agg(review_text, ' ' ORDER BY row_id) AS review_document FROM first20 GROUP BY 1),
cats AS (SELECT product_name, string_agg(c, ' ' ORDER BY c) AS categories_text
         FROM (SELECT DISTINCT product_name, trim(categories) AS c FROM usable WHERE trim(categories) <> '') GROUP BY 1)
SELECT u.product_name, count(*) AS review_count, round(avg(rating), 6) AS mean_rating,
       round(avg((sentiment = 'negative')::INT), 6) AS negative_share,
       round(avg((sentiment = 'neutral')::INT), 6) AS neutral_share,
       round(avg((sentiment = 'positive')::INT), 6) AS positive_share,
       any_value(categories_text) AS categories_text, any_value(review_document) AS review_document
FROM usable u LEFT JOIN docs USING (product_name) LEFT JOIN cats USING (product_name) GROUP BY u.product_name""")
def product_profile(spark, sf_dir):
    return rounded(aggregates.product_profiles(adapters.usable_reviews(spark, sf_dir)))


CLUSTER_PRODUCTS_SQL = f"""
WITH {BULK},
products AS (
  SELECT cluster_name, product_name, count(*) AS review_count, avg(rating) AS mean_rating,
         avg((sentiment = 'negative')::INT) AS negative_share, avg((sentiment = 'positive')::INT) AS positive_share,
         count(*) FILTER (sentiment = 'negative') AS negative_review_count
  FROM bulk GROUP BY ALL)"""


def bulk_products(spark, sf_dir):
    reviews = adapters.reviews_bulk(spark, sf_dir)
    return reviews.groupBy("cluster_name", "product_name").agg(
        F.count(F.lit(1)).alias("review_count"), F.avg("rating").alias("mean_rating"),
        aggregates.share_of("sentiment", "negative").alias("negative_share"),
        aggregates.share_of("sentiment", "positive").alias("positive_share"),
    )


@query("category_profile_unweighted", f"""{CLUSTER_PRODUCTS_SQL},
top5 AS (SELECT cluster_name, string_agg(product_name, ' | ' ORDER BY review_count DESC, product_name) AS top_products
  FROM (SELECT * FROM products
        QUALIFY row_number() OVER (PARTITION BY cluster_name ORDER BY review_count DESC, product_name) <= 5) GROUP BY 1)
SELECT p.cluster_name, count(*) AS product_count, sum(review_count)::BIGINT AS total_reviews,
       round(avg(mean_rating), 6) AS mean_rating, round(avg(negative_share), 6) AS negative_share,
       round(avg(positive_share), 6) AS positive_share, any_value(top_products) AS top_products
FROM products p JOIN top5 USING (cluster_name) GROUP BY 1""")
def category_profile_unweighted(spark, sf_dir):
    products = bulk_products(spark, sf_dir)
    profiles = aggregates.cluster_profiles(products, "cluster_name")
    return rounded(profiles.join(ranking.largest_joined(products, "cluster_name"), "cluster_name"))


@query("category_summary_weighted", f"""
WITH {CLUSTERED}
SELECT cluster_id, cluster_name, count(*) AS review_count, count(DISTINCT product_name) AS product_count,
       round(avg(rating), 6) AS mean_rating, round(avg((sentiment = 'negative')::INT), 6) AS negative_share,
       round(avg((sentiment = 'positive')::INT), 6) AS positive_share
FROM clustered WHERE cluster_id >= 0 GROUP BY ALL""")
def category_summary_weighted(spark, sf_dir):
    reviews = adapters.clustered_reviews(spark, sf_dir).where("cluster_id >= 0")
    return rounded(aggregates.category_summary(reviews, "cluster_id", "cluster_name"))


METRICS_COLUMNS_SQL = ", ".join(
    f"count(*) FILTER ({column} = '{label}') AS {source}_{label}"
    for source, column in SENTIMENT_SOURCES.items() for label in ("negative", "neutral", "positive")
)
METRICS_SQL = f"""
WITH {BULK},
metrics AS (SELECT cluster_name AS category, product_name, count(*) AS review_count, avg(rating) AS mean_rating,
                   {METRICS_COLUMNS_SQL} FROM bulk GROUP BY ALL)"""


@query("product_metrics_wide", f"{METRICS_SQL} SELECT * REPLACE (round(mean_rating, 6) AS mean_rating) FROM metrics")
def product_metrics_wide(spark, sf_dir):
    return rounded(aggregates.product_metrics(adapters.reviews_bulk(spark, sf_dir)))


LENGTH_SQL = f"""
WITH {USABLE},
bucketed AS (
  SELECT CASE WHEN length(review_text) <= 49 THEN '0–49' WHEN length(review_text) <= 99 THEN '50–99'
              WHEN length(review_text) <= 199 THEN '100–199' WHEN length(review_text) <= 399 THEN '200–399'
              ELSE '400+' END AS length_bucket, sentiment, model_sentiment FROM usable),
lengths AS (
  SELECT length_bucket, model_sentiment AS sentiment, 'model' AS source, count(*) AS count FROM bucketed GROUP BY ALL
  UNION ALL SELECT length_bucket, sentiment, 'rating', count(*) FROM bucketed GROUP BY ALL)"""


@query("length_sentiment", f"{LENGTH_SQL} SELECT * FROM lengths")
def length_sentiment(spark, sf_dir):
    return aggregates.length_sentiment(adapters.usable_reviews(spark, sf_dir))


THEMES_SQL = f"""
WITH {CLUSTERED},
negatives AS (
  SELECT cluster_name AS category, 'model' AS source, review_text FROM clustered WHERE model_sentiment = 'negative'
  UNION ALL SELECT cluster_name, 'rating', review_text FROM clustered WHERE sentiment = 'negative'),
themes(theme, pattern) AS (VALUES {", ".join(f"('{t}', '{p}')" for t, p in CORPUS_THEMES.items())}),
theme_counts AS (
  SELECT category, source, theme, count(*) FILTER (regexp_matches(review_text, pattern, 'i')) AS count
  FROM negatives CROSS JOIN themes GROUP BY ALL)"""


@query("theme_counts", f"{THEMES_SQL} SELECT * FROM theme_counts")
def theme_counts(spark, sf_dir):
    return aggregates.theme_counts(adapters.clustered_reviews(spark, sf_dir), themes=CORPUS_THEMES)


@query("theme_rollup", f"""{THEMES_SQL}
SELECT theme, sum(count)::BIGINT AS count FROM theme_counts WHERE source = 'rating' GROUP BY theme""")
def theme_rollup(spark, sf_dir):
    return aggregates.theme_rollup(theme_counts(spark, sf_dir), "rating")


@query("kpi_row", f"""{METRICS_SQL},
rows_ AS (
  SELECT category, sum(model_negative + model_neutral + model_positive) AS review_count,
         sum(model_negative) AS negatives, count(DISTINCT product_name) AS product_count,
         sum(mean_rating * review_count) / sum(review_count) AS average_rating
  FROM metrics GROUP BY category
  UNION ALL
  SELECT 'All categories', sum(model_negative + model_neutral + model_positive), sum(model_negative),
         count(DISTINCT product_name), sum(mean_rating * review_count) / sum(review_count) FROM metrics)
SELECT category, review_count::BIGINT AS review_count, product_count, round(average_rating, 6) AS average_rating,
       round(negatives / review_count, 6) AS negative_share FROM rows_""")
def kpi_row(spark, sf_dir):
    reviews = adapters.reviews_bulk(spark, sf_dir)
    out = aggregates.kpi_rows(aggregates.category_sentiment(reviews), aggregates.product_metrics(reviews), "model")
    return rounded(out, "average_rating", "negative_share")


@query("sentiment_totals", f"""
WITH {USABLE}
SELECT s.sentiment, count(u.row_id) AS count FROM {SENTIMENT_ROWS}
LEFT JOIN usable u ON u.model_sentiment = s.sentiment AND u.categories = 'en' GROUP BY 1""")
def sentiment_totals(spark, sf_dir):
    counts = aggregates.category_sentiment(adapters.usable_reviews(spark, sf_dir), "categories")
    return aggregates.sentiment_totals(counts, "model", "en")


@query("sentiment_pivot_share", f"""
WITH {CLUSTERED}
SELECT cluster_name AS category, round(avg((model_sentiment = 'negative')::INT), 6) AS negative,
       round(avg((model_sentiment = 'neutral')::INT), 6) AS neutral,
       round(avg((model_sentiment = 'positive')::INT), 6) AS positive
FROM clustered WHERE cluster_name <> 'Unclassified / missing product name' GROUP BY 1""")
def sentiment_pivot_share(spark, sf_dir):
    counts = aggregates.category_sentiment(adapters.clustered_reviews(spark, sf_dir))
    shown = counts.where((F.col("source") == "model") & (F.col("category") != joins.UNASSIGNED_NAME))
    return rounded(reshape.row_shares(reshape.pivot_counts(shown, "category")), "negative", "neutral", "positive")


@query("length_mix", f"""{LENGTH_SQL},
spine(position, length_bucket) AS (VALUES (0, '0–49'), (1, '50–99'), (2, '100–199'), (3, '200–399'), (4, '400+')),
wide AS (
  SELECT position, s.length_bucket, COALESCE(sum(count) FILTER (sentiment = 'negative'), 0) AS neg,
         COALESCE(sum(count) FILTER (sentiment = 'neutral'), 0) AS neu,
         COALESCE(sum(count) FILTER (sentiment = 'positive'), 0) AS pos
  FROM spine s LEFT JOIN lengths l ON l.length_bucket = s.length_bucket AND l.source = 'rating' GROUP BY ALL)
SELECT position, length_bucket, COALESCE(round(neg / NULLIF(neg + neu + pos, 0), 6), 0) AS negative,
       COALESCE(round(neu / NULLIF(neg + neu + pos, 0), 6), 0) AS neutral,
       COALESCE(round(pos / NULLIF(neg + neu + pos, 0), 6), 0) AS positive FROM wide""")
def length_mix(spark, sf_dir):
    counts = aggregates.length_sentiment(adapters.usable_reviews(spark, sf_dir)).where("source = 'rating'")
    table = reshape.in_order(reshape.pivot_counts(counts, "length_bucket"), "length_bucket",
                             [label for _, label in LENGTH_BUCKETS])
    return rounded(reshape.row_shares(table), "negative", "neutral", "positive").orderBy("position")


@query("category_review_counts", f"""
WITH {CLUSTERED} SELECT cluster_name, count(*) AS review_count FROM clustered WHERE cluster_id >= 0 GROUP BY 1""")
def category_review_counts(spark, sf_dir):
    return aggregates.review_counts(adapters.clustered_reviews(spark, sf_dir))


@query("distinct_texts", f"""
WITH {CLUSTERED} SELECT cluster_id, count(DISTINCT review_text) AS distinct_texts FROM clustered GROUP BY 1""")
def distinct_texts(spark, sf_dir):
    return aggregates.distinct_texts(adapters.clustered_reviews(spark, sf_dir), "cluster_id")


@query("distinct_texts_sketch", f"""
WITH {CLUSTERED} SELECT cluster_id, count(DISTINCT review_text) AS distinct_texts, TRUE AS estimate_within_error FROM clustered GROUP BY 1""")
def distinct_texts_sketch(spark, sf_dir):
    """Sketches stored by language and merged per cluster, their estimate held against the exact number."""
    reviews = adapters.clustered_reviews(spark, sf_dir)
    stored = materialized(spark, sketches.text_sketches(reviews, "cluster_id", "categories"), "text-sketches")
    parts = [stored.where("categories = 'en'"), stored.where("categories <> 'en' OR categories IS NULL")]
    estimated = sketches.estimated_texts(sketches.merged_sketches(parts, "cluster_id"), "cluster_id")
    exact = aggregates.distinct_texts(reviews, "cluster_id")
    joined = exact.join(estimated.withColumnRenamed("distinct_texts", "estimate"), "cluster_id")
    return joined.select("cluster_id", "distinct_texts", sketches.within_error(F.col("estimate"), F.col("distinct_texts")).alias("estimate_within_error"))


@query("product_drilldown", f"""{METRICS_SQL},
chosen AS (SELECT * FROM metrics WHERE product_name = 'red widget' ORDER BY category LIMIT 1)
SELECT product_name, 'negative' AS sentiment, rating_negative AS count FROM chosen
UNION ALL SELECT product_name, 'neutral', rating_neutral FROM chosen
UNION ALL SELECT product_name, 'positive', rating_positive FROM chosen""")
def product_drilldown(spark, sf_dir):
    metrics = aggregates.product_metrics(adapters.reviews_bulk(spark, sf_dir))
    return aggregates.product_drilldown(metrics, "red widget", "rating")


@query("selection_filter", f"""{METRICS_SQL}
SELECT product_name, review_count, rating_negative FROM metrics WHERE category = 'PROMO'""")
def selection_filter(spark, sf_dir):
    metrics = aggregates.product_metrics(adapters.reviews_bulk(spark, sf_dir))
    return reshape.select_category(metrics, "PROMO").select("product_name", "review_count", "rating_negative")


@query("assigned_reviews", f"""
WITH {CLUSTERED} SELECT row_id, cluster_id, product_name FROM clustered
WHERE cluster_id >= 0 AND product_name <> 'Unknown product'""")
def assigned_reviews(spark, sf_dir):
    reviews = adapters.clustered_reviews(spark, sf_dir)
    contracts.require_known(
        reviews, adapters.product_dim(spark, sf_dir), "cluster_id", unassigned=joins.UNASSIGNED_ID, what="Reviews"
    )
    return reviews.where("cluster_id >= 0 AND product_name <> 'Unknown product'").select(
        "row_id", "cluster_id", "product_name"
    )
