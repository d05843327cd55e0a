"""Classifiers and clusters."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from opinionmill.catalog.features import PRODUCTS, block_sql
from opinionmill.catalog.registry import USABLE, query
from opinionmill.functions.labels import SENTIMENTS
from opinionmill.operators import aggregates, classify, clusters, contracts, features, metrics, newton, sampling
from opinionmill.operators.vector_blocks import vector_blocks
from opinionmill.session import materialized, scratch_path
from opinionmill.sources import adapters, sinks
from opinionmill.sources.adapters import table


def split_reviews(spark, sf_dir):
    reviews = adapters.usable_reviews(spark, sf_dir).select("row_id", "review_text", "sentiment")
    reviews = materialized(spark, reviews, "reviews")
    return materialized(spark, sampling.stratified_split(reviews), "split")


BALANCED_LOGISTIC = classify.CANDIDATES[1]


@query("model_comparison_fit")
def model_comparison_fit(spark, sf_dir):
    split = split_reviews(spark, sf_dir)
    out = classify.compare_candidates(split.where("split = 'train'"), split.where("split = 'validation'"))
    return out.select("model", *[F.round(c, 4).alias(c) for c in ("accuracy", "macro_f1", "weighted_f1")], "samples")


@query("test_metrics_fit")
def test_metrics_fit(spark, sf_dir):
    split = split_reviews(spark, sf_dir)
    pipeline = classify.fit_sentiment_model(split.where("split <> 'test'"), classify.CANDIDATES[3])
    scored = classify.predict_sentiment(pipeline, split.where("split = 'test'"))
    return metrics.per_class_metrics(scored.select(F.col("sentiment").alias("actual"), F.col("model_sentiment").alias("predicted")))


def balanced_model(spark, sf_dir):
    split = split_reviews(spark, sf_dir)
    return classify.fit_sentiment_model(split.where("split <> 'test'"), BALANCED_LOGISTIC)


@query("scored_reviews")
def scored_reviews(spark, sf_dir):
    """A saved and reloaded model scores every document."""
    path = scratch_path(spark, "model")
    sinks.save_model(classify.SentimentModel(balanced_model(spark, sf_dir), BALANCED_LOGISTIC.name), path)
    model = sinks.load_model(spark, path)
    documents = adapters.documents(spark, sf_dir).select(F.col("doc_id").alias("row_id"), F.col("text").alias("review_text"))
    scored = classify.score_reviews(model.pipeline, documents, "review_text")
    return scored.select("row_id", "sentiment", *[F.col("class_scores")[s].alias(s) for s in SENTIMENTS])


def vectors(spark, sf_dir):
    return clusters.as_vectors(table(spark, sf_dir, "embeddings"), "embedding")


@query("kmeans_assign")
def kmeans_assign(spark, sf_dir):
    rows = materialized(spark, vectors(spark, sf_dir).select("vec_id", "features"), "vectors")
    model = clusters.fit_kmeans(rows, clusters.CHOSEN_COUNT)
    return model.transform(rows).select("vec_id", F.col("prediction").alias("cluster_id"))


@query("kmeans_nearest", "SELECT vec_id, TRUE AS at_nearest_centre, TRUE AS centre_is_mean FROM embeddings")
def kmeans_nearest(spark, sf_dir):
    """Every vector lies with the centre nearest to it, and every centre is the mean of its vectors."""
    rows = materialized(spark, vectors(spark, sf_dir).select("vec_id", "features"), "vectors")
    model = clusters.fit_kmeans(rows, clusters.CHOSEN_COUNT)
    assigned = model.transform(rows).select("vec_id", F.col("prediction").alias("own"), vector_to_array("features").alias("v"))
    assigned = materialized(spark, assigned, "assigned")
    means = assigned.select("own", F.posexplode("v").alias("i", "x")).groupBy("own", "i").agg(F.avg("x").alias("mean")).collect()
    centers = np.array(model.clusterCenters())  # clusters * dimensions numbers, as the means are
    mean = centers.copy()
    for r in means:
        mean[r["own"], r["i"]] = r["mean"]
    off = ((centers - mean) ** 2).sum(axis=1)
    squares = F.array(*[_squared(F.col("v"), F.array(*[F.lit(float(x)) for x in c])) for c in centers])
    return assigned.select("vec_id", "own", squares.alias("squares")).select(
        "vec_id", (F.get("squares", F.col("own")) <= F.array_min("squares") + 1e-9).alias("at_nearest_centre"),
        (F.get(F.array(*[F.lit(float(x)) for x in off]), F.col("own")) < 1e-6).alias("centre_is_mean"))


def _squared(left, right):
    return F.aggregate(F.zip_with(left, right, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda total, x: total + x)


@query("svm_stationary", f"""
WITH {USABLE}
SELECT sentiment, count(*) AS rows, TRUE AS at_minimum FROM usable GROUP BY 1""")
def svm_stationary(spark, sf_dir):
    """The gradient of each class's squared-hinge objective vanishes at the fitted coefficients."""
    reviews = adapters.usable_reviews(spark, sf_dir).select("review_text", "sentiment")
    reviews = materialized(spark, reviews, "reviews")
    stages = features.fit_text_features(reviews)
    rows = classify.labelled_features(stages, reviews, "review_text", SENTIMENTS)
    counts = classify.class_counts(rows)
    weights = classify.class_weights(counts)
    costs = np.array([weights.get(s, 1.0) for s in SENTIMENTS])
    blocks = vector_blocks(rows, "features", "_label")
    size = blocks.agg(F.max("size").alias("size")).first()["size"]
    found = newton.fit_squared_hinge(blocks, size, costs)
    start = np.linalg.norm(newton.loss_and_gradient(blocks, np.zeros_like(found), costs)[1], axis=1)
    end = np.linalg.norm(newton.loss_and_gradient(blocks, found, costs)[1], axis=1)
    return spark.createDataFrame(
        [(s, counts[s], bool(end[i] <= 1e-4 * start[i])) for i, s in enumerate(SENTIMENTS) if s in counts],
        "sentiment string, rows long, at_minimum boolean")


@query("k_search")
def k_search(spark, sf_dir):
    found, _ = clusters.compare_solutions(vectors(spark, sf_dir).select("vec_id", "features"))
    return found


@query("batch_scores", """
SELECT doc_id AS row_id, 1.0::DOUBLE AS score_sum, TRUE AS label_has_best_score, 3::BIGINT AS labels FROM documents""")
def batch_scores(spark, sf_dir):
    """Every document has a label, three scores that add up to 1, and the label's score is the largest."""
    scores = F.map_values("class_scores")
    documents = adapters.documents(spark, sf_dir).select(F.col("doc_id").alias("row_id"), F.col("text").alias("review_text"))
    scored = classify.score_reviews(balanced_model(spark, sf_dir), documents, "review_text")
    return scored.select(
        "row_id", F.round(F.aggregate(scores, F.lit(0.0), lambda a, x: a + x), 2).alias("score_sum"),
        (F.element_at("class_scores", F.col("sentiment")) >= F.array_max(scores)).alias("label_has_best_score"),
        F.size(scores).cast("long").alias("labels"),
    )


@query("product_vectors", "WITH " + ",".join(
    [PRODUCTS, *[block_sql(b, *spec) for b, spec in features.PRODUCT_BLOCKS.items()]]
) + """, weights AS (SELECT * FROM title_block UNION ALL SELECT * FROM category_block UNION ALL SELECT * FROM review_block)
SELECT p.product_name, count(w.term) AS entries, round(coalesce(sum(w.weight * w.weight), 0), 1) AS squares
FROM products p LEFT JOIN weights w ON w.product_name = p.product_name GROUP BY 1""")
def product_vectors(spark, sf_dir):
    """A vector for every product, also for one without any kept term."""
    products = materialized(spark, aggregates.product_profiles(adapters.usable_reviews(spark, sf_dir)), "products")
    rows = features.block_vectors(materialized(spark, features.product_blocks(products), "blocks"), products)
    values = vector_to_array("features")
    squares = F.aggregate(values, F.lit(0.0), lambda a, x: a + x * x)
    return rows.select(
        "product_name", F.size(F.filter(values, lambda x: x != 0)).cast("long").alias("entries"),
        F.round(squares, 1).alias("squares"))


@query("product_clusters")
def product_clusters(spark, sf_dir):
    products = materialized(spark, aggregates.product_profiles(adapters.usable_reviews(spark, sf_dir)), "products")
    contracts.require_rows(products, clusters.MIN_PRODUCTS, "Product clustering")
    blocks = materialized(spark, features.product_blocks(products), "blocks")
    rows = features.block_vectors(blocks, products)
    model = clusters.fit_kmeans(rows, clusters.CHOSEN_COUNT)
    found = clusters.assign_clusters(model, rows, products)
    named = clusters.name_clusters(found, {i: f"Group {i}" for i in range(clusters.CHOSEN_COUNT)})
    return named.select("product_name", "cluster_id", "cluster_name", "review_count", "mean_rating")


@query("cosine_silhouette", """
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
pairs AS (
  SELECT a.vec_id, a.label AS own, b.label AS other, count(*) AS n, sum(1 - list_cosine_similarity(a.e, b.e)) AS d
  FROM v a JOIN v b ON a.vec_id <> b.vec_id GROUP BY ALL),
inside AS (SELECT vec_id, d / n AS a FROM pairs WHERE own = other),
outside AS (SELECT vec_id, min(d / n) AS b FROM pairs WHERE own <> other GROUP BY 1)
SELECT round(avg((b - a) / greatest(a, b)), 6) AS cosine_silhouette
FROM outside JOIN inside USING (vec_id)""")
def cosine_silhouette(spark, sf_dir):
    value = clusters.cosine_silhouette(vectors(spark, sf_dir).select("features", F.col("label").alias("cluster_id")))
    return spark.createDataFrame([(round(value, 6),)], "cosine_silhouette double")
