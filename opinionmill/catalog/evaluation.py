"""Classification metrics and relative scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinionmill.catalog.registry import BULK, query
from opinionmill.functions import scores
from opinionmill.operators import metrics, ranking, sampling
from opinionmill.session import scratch_path
from opinionmill.sources import adapters, sinks
from opinionmill.sources.adapters import table

PREDICTIONS = f"""
WITH {BULK},
pred AS (SELECT sentiment AS actual, model_sentiment AS predicted FROM bulk),
per AS (
  SELECT s.sentiment, count(*) FILTER (actual = s.sentiment AND predicted = s.sentiment) AS tp,
         count(*) FILTER (predicted = s.sentiment) AS pp, count(*) FILTER (actual = s.sentiment) AS support
  FROM pred CROSS JOIN (VALUES ('negative'), ('neutral'), ('positive')) AS s(sentiment) GROUP BY 1),
scored AS (
  SELECT sentiment, COALESCE(tp / NULLIF(pp, 0), 0) AS p, COALESCE(tp / NULLIF(support, 0), 0) AS r,
         COALESCE(2 * tp / NULLIF(pp + support, 0), 0) AS f1, support, tp FROM per)"""


def predictions(spark, sf_dir):
    return adapters.reviews_bulk(spark, sf_dir).select(
        F.col("sentiment").alias("actual"), F.col("model_sentiment").alias("predicted"), "row_id"
    )


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("confusion_matrix", f"""{PREDICTIONS}
SELECT s.sentiment AS actual, count(*) FILTER (predicted = 'negative') AS predicted_negative,
       count(*) FILTER (predicted = 'neutral') AS predicted_neutral,
       count(*) FILTER (predicted = 'positive') AS predicted_positive
FROM (VALUES ('negative'), ('neutral'), ('positive')) AS s(sentiment)
LEFT JOIN pred ON actual = s.sentiment GROUP BY 1""")
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(predictions(spark, sf_dir))


@query("per_class_metrics", f"""{PREDICTIONS}
SELECT sentiment, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, support FROM scored""")
def per_class_metrics(spark, sf_dir):
    return rounded(metrics.per_class_metrics(predictions(spark, sf_dir)), "precision", "recall", "f1")


@query("metrics_record", f"""{PREDICTIONS}
SELECT sentiment, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, support FROM scored""")
def metrics_record(spark, sf_dir):
    """The metrics written as JSON records and read back."""
    path = scratch_path(spark, "metrics")
    found = rounded(metrics.per_class_metrics(predictions(spark, sf_dir)), "precision", "recall", "f1")
    sinks.write_json_record(found, path)
    return spark.read.schema(found.schema).json(path)


SUMMARY = ("accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1", "negative_f1",
           "neutral_f1", "positive_f1")


@query("macro_weighted_metrics", f"""{PREDICTIONS}
SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(p), 6) AS macro_precision,
       round(avg(r), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1,
       round(sum(f1 * support) / sum(support), 6) AS weighted_f1,
       round(max(f1) FILTER (sentiment = 'negative'), 6) AS negative_f1,
       round(max(f1) FILTER (sentiment = 'neutral'), 6) AS neutral_f1,
       round(max(f1) FILTER (sentiment = 'positive'), 6) AS positive_f1, sum(support)::BIGINT AS samples
FROM scored""")
def macro_weighted_metrics(spark, sf_dir):
    return rounded(metrics.summary_metrics(predictions(spark, sf_dir)), *SUMMARY)


@query("classification_report", f"""{PREDICTIONS}
SELECT sentiment AS row, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, support FROM scored
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), sum(support)::BIGINT FROM scored
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM scored
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
                 round(sum(tp) / sum(support), 6), sum(support)::BIGINT FROM scored""")
def classification_report(spark, sf_dir):
    return rounded(metrics.classification_report(predictions(spark, sf_dir)), "precision", "recall", "f1")


CANDIDATES = f"""
WITH {BULK},
pred AS (
  SELECT 'return flag' AS model, 0 AS position, sentiment AS actual, model_sentiment AS predicted FROM bulk
  UNION ALL SELECT 'always positive', 1, sentiment, 'positive' FROM bulk
  UNION ALL SELECT 'own label', 2, sentiment, sentiment FROM bulk WHERE model_sentiment <> 'neutral'),
per AS (
  SELECT model, position, s.sentiment, count(*) FILTER (actual = s.sentiment AND predicted = s.sentiment) AS tp,
         count(*) FILTER (predicted = s.sentiment) AS pp, count(*) FILTER (actual = s.sentiment) AS support
  FROM pred CROSS JOIN (VALUES ('negative'), ('neutral'), ('positive')) AS s(sentiment) GROUP BY ALL),
scored AS (
  SELECT model, position, sentiment, COALESCE(tp / NULLIF(pp, 0), 0) AS p, COALESCE(tp / NULLIF(support, 0), 0) AS r,
         COALESCE(2 * tp / NULLIF(pp + support, 0), 0) AS f1, support, tp FROM per),
comparison AS (
  SELECT model, position, round(sum(tp) / sum(support), 6) AS accuracy, round(avg(p), 6) AS macro_precision,
       round(avg(r), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1,
       round(sum(f1 * support) / sum(support), 6) AS weighted_f1,
       round(max(f1) FILTER (sentiment = 'negative'), 6) AS negative_f1,
       round(max(f1) FILTER (sentiment = 'neutral'), 6) AS neutral_f1,
       round(max(f1) FILTER (sentiment = 'positive'), 6) AS positive_f1, sum(support)::BIGINT AS samples
  FROM scored GROUP BY ALL)"""


def candidate_predictions(spark, sf_dir):
    base = predictions(spark, sf_dir).drop("row_id")
    return sampling.union_all([
        base.withColumn("model", F.lit("return flag")),
        base.withColumn("predicted", F.lit("positive")).withColumn("model", F.lit("always positive")),
        base.where("predicted <> 'neutral'").withColumn("predicted", F.col("actual"))
        .withColumn("model", F.lit("own label")),
    ])


@query("model_comparison", f"{CANDIDATES} SELECT * EXCLUDE (position) FROM comparison")
def model_comparison(spark, sf_dir):
    return rounded(metrics.model_comparison(candidate_predictions(spark, sf_dir)), *SUMMARY)


@query("best_model", f"""{CANDIDATES}
SELECT model, macro_f1, accuracy FROM comparison ORDER BY macro_f1 DESC, accuracy DESC, position LIMIT 1""")
def best_model(spark, sf_dir):
    position = F.when(F.col("model") == "return flag", 0).when(F.col("model") == "always positive", 1).otherwise(2)
    table_ = metrics.summary_metrics(candidate_predictions(spark, sf_dir), ["model"]).withColumn("position", position)
    return rounded(ranking.best_model(table_).select("model", "macro_f1", "accuracy"), "macro_f1", "accuracy")


@query("softmax_scores", """
WITH m AS (SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b, embedding[3]::DOUBLE AS c FROM embeddings),
e AS (SELECT *, exp(a) AS ea, exp(b) AS eb, exp(c) AS ec FROM m)
SELECT vec_id AS row_id,
       CASE WHEN a >= b AND a >= c THEN 'Negative' WHEN b >= c THEN 'Neutral' ELSE 'Positive' END AS sentiment,
       round(ea / (ea + eb + ec), 6) AS negative, round(eb / (ea + eb + ec), 6) AS neutral,
       round(ec / (ea + eb + ec), 6) AS positive
FROM e""")
def softmax_scores(spark, sf_dir):
    margins = F.slice("embedding", 1, 3).cast("array<double>")
    scored = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.initcap(scores.best_label(margins)).alias("sentiment"),
        scores.class_scores(margins).alias("scores"),
    )
    return scored.select(
        "row_id", "sentiment", *[F.round(F.col("scores")[s], 6).alias(s) for s in ("negative", "neutral", "positive")]
    )


@query("uniform_scores", """
SELECT vec_id AS row_id, round(1 / 3, 6) AS negative, round(1 / 3, 6) AS neutral, round(1 / 3, 6) AS positive FROM embeddings""")
def uniform_scores(spark, sf_dir):
    scored = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_id"), scores.uniform_scores().alias("s"))
    return scored.select("row_id", *[F.round(F.col("s")[s], 6).alias(s) for s in ("negative", "neutral", "positive")])
