"""The whole batch: load, train, cluster, map reviews, write the guides."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionmill.functions.text import UNKNOWN_PRODUCT
from opinionmill.operators import aggregates, articles, classify, clusters, contracts, evidence, features, joins
from opinionmill.operators import metrics, ranking, sampling
from opinionmill.operators.text_stage import TextFunction
from opinionmill.session import materialized
from opinionmill.sources import reviews as readers
from opinionmill.sources import sinks
from opinionmill.sources.documents import write_text_file

GUIDE_HEADING = (
    "> Product rankings and statistics are calculated from the review data; quoted themes are "
    "summaries of sampled reviews. These are drafts and should be checked against the evidence."
)


def train_and_save(reviews: DataFrame, out: str, max_iter: int = 100,
                   max_features: int = features.SENTIMENT_FEATURES) -> classify.SentimentModel:
    """Compare the candidates, keep the best, and write its tables and model."""
    spark = reviews.sparkSession
    split = sampling.stratified_split(reviews.select("row_id", "review_text", "sentiment"))
    split = materialized(spark, split, "split")
    comparison, model, predictions = classify.train_sentiment_model(split, max_features=max_features, max_iter=max_iter)
    predictions = materialized(spark, predictions, "test-predictions")
    name = F.lit(model.name).alias("model")
    sinks.write_csv(comparison.drop("position"), f"{out}/model_comparison")
    sinks.write_csv(metrics.per_class_metrics(predictions).select(name, "*"), f"{out}/per_class_metrics")
    sinks.write_csv(metrics.summary_metrics(predictions).select(name, "*"), f"{out}/test_metrics")
    sinks.write_confusion_csv(metrics.confusion_matrix(predictions), f"{out}/confusion_matrix")
    sinks.save_model(model, f"{out}/model")
    return model


def cluster_products(reviews: DataFrame, out: str, names: Mapping[int, str], restarts: int = clusters.RESTARTS) -> DataFrame:
    """Product clusters and profiles; returns the product table with ids and names."""
    spark = reviews.sparkSession
    named = reviews.where(F.col("product_name") != UNKNOWN_PRODUCT)
    products = materialized(spark, aggregates.product_profiles(named), "products")
    contracts.require_rows(products, clusters.MIN_PRODUCTS, "Product clustering")
    blocks = materialized(spark, features.product_blocks(products), "blocks")
    vectors = features.block_vectors(blocks, products)
    solutions, models = clusters.compare_solutions(vectors, restarts=restarts)
    sinks.write_csv(solutions, f"{out}/cluster_solution_comparison")
    found = clusters.assign_clusters(models[len(names)], vectors, products)
    found = materialized(spark, clusters.name_clusters(found, names), "product-clusters")
    profiles = (
        aggregates.cluster_profiles(found)
        .join(ranking.largest_joined(found), "cluster_id")
        .join(features.top_terms(features.cluster_terms(found)), "cluster_id", "left")
        .join(found.select("cluster_id", "cluster_name").distinct(), "cluster_id")
    )
    profiles.orderBy("cluster_id").write.mode("overwrite").parquet(f"{out}/cluster_profiles")
    kept = found.select(
        "product_name", "cluster_id", "cluster_name", "review_count", "mean_rating", "negative_share",
        "positive_share", "categories_text",
    )
    kept.write.mode("overwrite").parquet(f"{out}/product_clusters")
    return spark.read.parquet(f"{out}/product_clusters")


def map_reviews(reviews: DataFrame, products: DataFrame, out: str) -> DataFrame:
    """Reviews with their product's cluster, written for the later steps."""
    contracts.require_unique(products, "product_name", what="Product clusters")
    mapped = joins.assign_categories(reviews, products)
    mapped.write.mode("overwrite").parquet(f"{out}/review_clusters")
    return reviews.sparkSession.read.parquet(f"{out}/review_clusters")


def write_guides(profiles: DataFrame, mapped: DataFrame, out: str, make_function: Callable[[], TextFunction],
                 model_name: str, batch_size: int = 2) -> DataFrame:
    """Evidence, summaries, articles and draft table for every category."""
    spark = mapped.sparkSession
    briefs = materialized(spark, evidence.evidence_briefs(profiles, mapped), "briefs")
    summaries = articles.summarize_tasks(articles.summary_tasks(briefs), make_function, batch_size)
    drafts = materialized(spark, articles.drafts(briefs, articles.articles(briefs, summaries), model_name), "drafts")
    contracts.require_articles(drafts, profiles, inference="local")
    sinks.write_markdown(drafts, f"{out}/category_articles", GUIDE_HEADING)
    guide = drafts.withColumn("text", F.concat("article", F.lit("\n")))
    write_text_file(guide, f"{out}/category_articles.md", "text", ["cluster_id"], f"{GUIDE_HEADING}\n\n")
    sinks.write_csv(drafts, f"{out}/article_drafts")
    return drafts


def guides_only(spark: SparkSession, csv_path: str, out: str, make_function: Callable[[], TextFunction],
                model_name: str) -> DataFrame:
    """Write the guides again from saved clusters; their contracts are checked first."""
    hint = "Run the full flow once before rewriting only the guides."
    profiles = readers.read_table(spark, f"{out}/cluster_profiles", hint)
    products = readers.read_table(spark, f"{out}/product_clusters", hint)
    contracts.require_columns(profiles, ["cluster_id", "cluster_name"], "Cluster profiles")
    contracts.require_columns(products, ["product_name", "cluster_id"], "Product clusters")
    contracts.require_known(products, profiles, "cluster_id", what="Product clusters")
    named = joins.lookup(products.drop("cluster_name"), profiles.select("cluster_id", "cluster_name"), "cluster_id")
    reviews = readers.load_reviews(readers.read_reviews_csv(spark, csv_path))
    return write_guides(profiles, map_reviews(reviews, named, out), out, make_function, model_name)


def run_all(spark: SparkSession, csv_path: str, out: str, names: Mapping[int, str],
            make_function: Callable[[], TextFunction], model_name: str, restarts: int = clusters.RESTARTS,
            max_iter: int = 100, max_features: int = features.SENTIMENT_FEATURES) -> DataFrame:
    """Every step in order over one review file."""
    reviews = materialized(spark, readers.load_reviews(readers.read_reviews_csv(spark, csv_path)), "reviews")
    train_and_save(reviews, out, max_iter, max_features)
    products = cluster_products(reviews, out, names, restarts)
    mapped = map_reviews(reviews, products, out)
    profiles = spark.read.parquet(f"{out}/cluster_profiles")
    return write_guides(profiles, mapped, out, make_function, model_name)
