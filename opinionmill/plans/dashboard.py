"""From scored reviews to the dashboard artifact and its views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionmill.functions.formats import percent, two_decimals
from opinionmill.functions.labels import COMPLAINT_THEMES, SENTIMENTS, to_number
from opinionmill.functions.text import LENGTH_BUCKETS
from opinionmill.operators import aggregates, contracts, ranking, reshape
from opinionmill.operators.classify import predict_sentiment
from opinionmill.operators.joins import UNASSIGNED_NAME
from opinionmill.session import materialized
from opinionmill.sources import artifact, sinks

REQUIRED = ("review_text", "product_name", "rating", "sentiment", "cluster_name")


def dashboard_reviews(reviews: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Contract, coercion and filters of the dashboard input, then batch scoring.

    A table that already has ``model_sentiment`` is taken as scored.
    """
    contracts.require_columns(reviews, REQUIRED, "Review-cluster data")
    usable = (
        reviews.withColumn("review_text", F.coalesce(F.col("review_text").cast("string"), F.lit("")))
        .withColumn("rating", to_number(F.col("rating")))
        .withColumn("sentiment", F.lower(F.col("sentiment")))
        .where(F.col("rating").isNotNull() & F.col("sentiment").isin(*SENTIMENTS))
    )
    if "model_sentiment" in usable.columns:
        return usable
    if model is None:
        raise ValueError("Unscored reviews need a sentiment model.")
    return predict_sentiment(model, usable)


def dashboard_tables(scored: DataFrame, themes: Mapping[str, str] = COMPLAINT_THEMES) -> dict[str, DataFrame]:
    """The four count tables. Write ``scored`` first: each table reads it once."""
    return {
        "category_sentiment": aggregates.category_sentiment(scored),
        "product_metrics": aggregates.product_metrics(scored),
        "review_length_sentiment": aggregates.length_sentiment(scored),
        "complaint_theme_counts": aggregates.theme_counts(scored, themes=themes),
    }


def build_dashboard(reviews: DataFrame, path: str, model: PipelineModel | None = None,
                    themes: Mapping[str, str] = COMPLAINT_THEMES, record: str | None = None) -> str:
    """Score, aggregate and write the artifact; returns its path. ``record`` names a file for the single-record form as well."""
    columns = list(dict.fromkeys([*REQUIRED, *(c for c in reviews.columns if c == "model_sentiment")]))
    contracts.require_columns(reviews, REQUIRED, "Review-cluster data")
    scored = materialized(reviews.sparkSession, dashboard_reviews(reviews.select(*columns), model), "scored")
    artifact.write(scored.agg(F.count(F.lit(1))), dashboard_tables(scored, themes), path)
    if record:
        artifact.write_nested(scored.agg(F.count(F.lit(1))), artifact.read(reviews.sparkSession, path), record)
    return path


def dashboard_views(tables: Mapping[str, DataFrame], category: str = reshape.ALL_CATEGORIES, source: str = "model",
                    min_support: int = 20) -> dict[str, DataFrame]:
    """Every table the dashboard shows for one selection, as queries over the saved tables."""
    counts, products = tables["category_sentiment"], tables["product_metrics"]
    themes, lengths = tables["complaint_theme_counts"], tables["review_length_sentiment"]
    named = counts.where((F.col("source") == source) & (F.col("category") != UNASSIGNED_NAME))
    by_length = reshape.pivot_counts(lengths.where(F.col("source") == source), "length_bucket")
    ordered = reshape.in_order(by_length, "length_bucket", [label for _, label in LENGTH_BUCKETS])
    ranked = ranking.worst_by_share(reshape.select_category(products, category), source, min_support)
    return {
        "categories": reshape.picker_values(counts, "category"),
        "kpis": aggregates.kpi_rows(counts, products, source).where(F.col("category") == category),
        "category_mix": reshape.row_shares(reshape.pivot_counts(named, "category")).orderBy("category"),
        "selection": aggregates.sentiment_totals(counts, source, category),
        "length_mix": reshape.row_shares(ordered).orderBy("position"),
        "ranked_products": ranked.select(
            "product_name", "review_count", two_decimals(F.col("mean_rating")).alias("mean_rating"),
            percent(F.col("negative_share")).alias("negative_share"),
            percent(F.col("positive_share")).alias("positive_share"),
        ),
        "ranked_export": sinks.ranked_export(ranked),
        "themes": aggregates.theme_rollup(themes, source, category),
        "products": reshape.picker_values(reshape.select_category(products, category), "product_name"),
    }
