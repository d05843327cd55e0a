"""Ranked picks, copies, samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinionmill.catalog.dashboard import CLUSTER_PRODUCTS_SQL, METRICS_SQL, bulk_products, rounded
from opinionmill.catalog.registry import BULK, CLUSTERED, query
from opinionmill.functions.text import word_count
from opinionmill.operators import aggregates, joins, ranking, sampling
from opinionmill.sources import adapters


@query("first_n_reviews", f"""
WITH {BULK} SELECT product_name, row_id, rating FROM bulk
QUALIFY row_number() OVER (PARTITION BY product_name ORDER BY row_id) <= 20""")
def first_n_reviews(spark, sf_dir):
    reviews = adapters.reviews_bulk(spark, sf_dir).select("product_name", "row_id", "rating")
    return ranking.first_rows(reviews, ["product_name"], [F.col("row_id")], 20)


# The support floor of 60 leaves some categories without an established product at sf0.01.
POOL_SQL = f"""{CLUSTER_PRODUCTS_SQL},
pool AS (SELECT * FROM products
         QUALIFY review_count >= 60 OR NOT bool_or(review_count >= 60) OVER (PARTITION BY cluster_name))"""


@query("top3_products", f"""{POOL_SQL}
SELECT cluster_name, product_name, review_count, round(mean_rating, 6) AS mean_rating, negative_review_count,
       row_number() OVER (PARTITION BY cluster_name
                          ORDER BY mean_rating DESC, review_count DESC, product_name)::INTEGER AS rank
FROM pool QUALIFY rank <= 3""")
def top3_products(spark, sf_dir):
    products = aggregates.product_evidence(adapters.reviews_bulk(spark, sf_dir), "cluster_name")
    top = ranking.top_products(products, "cluster_name", minimum=60)
    return rounded(top.drop("negative_share"))


@query("lowest_product", f"""{POOL_SQL}
SELECT cluster_name, product_name, review_count, round(mean_rating, 6) AS mean_rating FROM pool
QUALIFY row_number() OVER (PARTITION BY cluster_name ORDER BY mean_rating, review_count DESC, product_name) = 1""")
def lowest_product(spark, sf_dir):
    products = aggregates.product_evidence(adapters.reviews_bulk(spark, sf_dir), "cluster_name")
    low = ranking.lowest_product(products, "cluster_name", minimum=60)
    return rounded(low.select("cluster_name", "product_name", "review_count", "mean_rating"))


@query("lowest_not_in_top", f"""{POOL_SQL},
top3 AS (SELECT cluster_name, product_name FROM pool QUALIFY row_number() OVER (
           PARTITION BY cluster_name ORDER BY mean_rating DESC, review_count DESC, product_name) <= 3),
low AS (SELECT cluster_name, product_name FROM pool QUALIFY row_number() OVER (
           PARTITION BY cluster_name ORDER BY mean_rating, review_count DESC, product_name) = 1)
SELECT cluster_name, product_name FROM low EXCEPT SELECT cluster_name, product_name FROM top3""")
def lowest_not_in_top(spark, sf_dir):
    products = aggregates.product_evidence(adapters.reviews_bulk(spark, sf_dir), "cluster_name")
    low = ranking.lowest_product(products, "cluster_name", minimum=60).select("cluster_name", "product_name")
    top = ranking.top_products(products, "cluster_name", minimum=60)
    return joins.drop_members(low, top, "cluster_name", "product_name")


@query("top5_joined", f"""{CLUSTER_PRODUCTS_SQL}
SELECT cluster_name, string_agg(product_name, ' | ' ORDER BY review_count DESC, product_name) AS top_products
FROM (SELECT * FROM products
      QUALIFY row_number() OVER (PARTITION BY cluster_name ORDER BY review_count DESC, product_name) <= 5)
GROUP BY cluster_name""")
def top5_joined(spark, sf_dir):
    return ranking.largest_joined(bulk_products(spark, sf_dir), "cluster_name")


@query("top10_negative_share", f"""{METRICS_SQL}
SELECT category, product_name, review_count, round(mean_rating, 6) AS mean_rating,
       round(model_negative / review_count, 6) AS negative_share, round(model_positive / review_count, 6) AS positive_share
FROM metrics WHERE review_count >= 20
ORDER BY model_negative / review_count DESC, review_count DESC, product_name, category LIMIT 10""")
def top10_negative_share(spark, sf_dir):
    metrics = aggregates.product_metrics(adapters.reviews_bulk(spark, sf_dir))
    worst = ranking.worst_by_share(metrics, "model", 20)
    return rounded(worst).select(
        "category", "product_name", "review_count", "mean_rating", "negative_share", "positive_share"
    )


@query("dedupe_first", f"""
WITH {CLUSTERED} SELECT cluster_id, sentiment, row_id, rating FROM clustered
QUALIFY row_number() OVER (PARTITION BY cluster_id, sentiment, review_text ORDER BY row_id) = 1""")
def dedupe_first(spark, sf_dir):
    reviews = adapters.clustered_reviews(spark, sf_dir)
    return ranking.drop_copies(reviews, ["cluster_id", "sentiment"]).select(
        "cluster_id", "sentiment", "row_id", "rating"
    )


@query("dedupe_product_negatives", f"""
WITH {CLUSTERED} SELECT cluster_id, product_name, row_id FROM clustered WHERE sentiment = 'negative'
QUALIFY row_number() OVER (PARTITION BY cluster_id, product_name, review_text ORDER BY row_id) = 1""")
def dedupe_product_negatives(spark, sf_dir):
    negatives = adapters.clustered_reviews(spark, sf_dir).where("sentiment = 'negative'")
    return ranking.drop_copies(negatives, ["cluster_id", "product_name"]).select(
        "cluster_id", "product_name", "row_id"
    )


@query("dedupe_table", """
SELECT doc_id AS row_id, text FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""")
def dedupe_table(spark, sf_dir):
    docs = adapters.documents(spark, sf_dir).select(F.col("doc_id").alias("row_id"), "text")
    return ranking.drop_copies(docs, [], text="text")


@query("lowest_rated_examples", f"""
WITH {CLUSTERED},
products AS (SELECT cluster_id, product_name, avg(rating) AS m, count(*) AS n FROM clustered GROUP BY ALL),
low AS (SELECT cluster_id, product_name FROM products
        QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY m, n DESC, product_name) <= 2),
negatives AS (
  SELECT cluster_id, product_name, row_id, rating, review_text FROM clustered
  SEMI JOIN low USING (cluster_id, product_name) WHERE rating <= 2),
firsts AS (SELECT * FROM negatives QUALIFY row_number() OVER (PARTITION BY cluster_id, review_text ORDER BY row_id) = 1)
SELECT cluster_id, product_name, row_id, rating FROM firsts
QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY row_id) <= 3""")
def lowest_rated_examples(spark, sf_dir):
    reviews = adapters.clustered_reviews(spark, sf_dir)
    products = aggregates.product_evidence(reviews)
    order = [F.asc("mean_rating"), F.desc("review_count"), F.asc("product_name")]
    low = ranking.first_rows(products, ["cluster_id"], order, 2)
    negatives = joins.keep_members(reviews.where("rating <= 2"), low, "cluster_id", "product_name")
    distinct = ranking.drop_copies(negatives, ["cluster_id"])
    return ranking.first_rows(distinct, ["cluster_id"], [F.col("row_id")], 3).select(
        "cluster_id", "product_name", "row_id", "rating"
    )


@query("sample_per_class", f"""
WITH {BULK} SELECT sentiment, row_id, rating FROM bulk
QUALIFY row_number() OVER (PARTITION BY sentiment ORDER BY md5(row_id || ':42'), row_id) <= 10""")
def sample_per_class(spark, sf_dir):
    reviews = adapters.reviews_bulk(spark, sf_dir).select("sentiment", "row_id", "rating")
    return sampling.sample_per_group(reviews, ["sentiment"], 10).orderBy("row_id")


@query("evaluation_sample", r"""
WITH rated AS (
  SELECT d.doc_id AS row_id, text AS original,
         CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 0 THEN 'neutral' ELSE 'positive' END AS sentiment
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id
  WHERE len(regexp_extract_all(text, '\S+')) BETWEEN 4 AND 120),
firsts AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY original ORDER BY row_id) = 1)
SELECT sentiment, row_id, original FROM firsts
QUALIFY row_number() OVER (PARTITION BY sentiment ORDER BY md5(row_id || ':42'), row_id) <= 10""")
def evaluation_sample(spark, sf_dir):
    from opinionmill.plans.translation_evaluation import evaluation_sample as sample

    raw = adapters.reviews_text(spark, sf_dir).select("row_id", F.col("raw_text").alias("original"), "rating")
    return sample(raw).select("sentiment", "row_id", "original")


SPLIT_SQL = f"""
WITH {BULK},
quota_base AS (SELECT sentiment, count(*) AS n FROM bulk GROUP BY 1),
t0 AS (SELECT *, sum(n) OVER () AS total, ceil(round(sum(n) OVER () * 0.2, 6)) AS wanted FROM quota_base),
t1 AS (SELECT *, n * wanted / total - floor(n * wanted / total) AS rest, floor(n * wanted / total) AS base FROM t0),
t2 AS (SELECT *, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, sentiment)
                                  <= wanted - sum(base) OVER () THEN 1 ELSE 0 END AS test_rows FROM t1),
v0 AS (SELECT sentiment, n - test_rows AS m, test_rows, sum(n - test_rows) OVER () AS total,
              ceil(round(sum(n - test_rows) OVER () * 0.25, 6)) AS wanted FROM t2),
v1 AS (SELECT *, m * wanted / total - floor(m * wanted / total) AS rest, floor(m * wanted / total) AS base FROM v0),
v2 AS (SELECT *, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, sentiment)
                                  <= wanted - sum(base) OVER () THEN 1 ELSE 0 END AS validation_rows FROM v1),
ranked AS (SELECT row_id, sentiment,
                  row_number() OVER (PARTITION BY sentiment ORDER BY md5(row_id || ':42'), row_id) AS place FROM bulk)
SELECT row_id, r.sentiment, CASE WHEN place <= test_rows THEN 'test'
       WHEN place <= test_rows + validation_rows THEN 'validation' ELSE 'train' END AS split
FROM ranked r JOIN v2 ON v2.sentiment = r.sentiment"""


@query("stratified_split", SPLIT_SQL)
def stratified_split(spark, sf_dir):
    reviews = adapters.reviews_bulk(spark, sf_dir).select("row_id", "sentiment")
    return sampling.stratified_split(reviews)


@query("split_parts_union", f"""
SELECT split, sentiment, count(*) AS n FROM ({SPLIT_SQL}) WHERE split <> 'test' GROUP BY ALL""")
def split_parts_union(spark, sf_dir):
    split = stratified_split(spark, sf_dir)
    joined = sampling.union_all([split.where("split = 'train'"), split.where("split = 'validation'")])
    return joined.groupBy("split", "sentiment").agg(F.count(F.lit(1)).alias("n"))


@query("words_per_review", r"""
SELECT source AS product_name, max(len(regexp_extract_all(text, '\S+')))::BIGINT AS most_words
FROM documents GROUP BY 1""")
def words_per_review(spark, sf_dir):
    return adapters.documents(spark, sf_dir).groupBy(F.col("source").alias("product_name")).agg(
        F.max(word_count(F.col("text"))).cast("long").alias("most_words")
    )
