"""Evaluation of translation on a per-class sample."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionmill.functions.labels import sentiment
from opinionmill.functions.text import word_count
from opinionmill.operators.classify import predict_sentiment
from opinionmill.operators.language import detect_language
from opinionmill.operators.pairs import pair_metrics
from opinionmill.operators.ranking import drop_copies
from opinionmill.operators.sampling import sample_per_group
from opinionmill.operators.text_stage import TextFunction
from opinionmill.operators.translate import prepare, translate, translate_back
from opinionmill.session import materialized
from opinionmill.sources.documents import write_csv_file
from opinionmill.sources.sinks import write_json_record

# Word band of usable reviews and the sample size per class.
MIN_WORDS, MAX_WORDS = 4, 120
PER_CLASS = 10


def evaluation_sample(raw: DataFrame, per_class: int = PER_CLASS, seed: int = 42) -> DataFrame:
    """Rated texts of fitting length, copies removed, a few per class.

    ``raw`` has row_id, original and rating.
    """
    rated = (
        raw.na.drop(subset=["original", "rating"])
        .where(word_count(F.col("original")).between(MIN_WORDS, MAX_WORDS))
        .withColumn("sentiment", sentiment(F.col("rating")))
    )
    return sample_per_group(drop_copies(rated, [], text="original"), ["sentiment"], per_class, seed)


def evaluate(
    raw: DataFrame, model: PipelineModel, language_model: PipelineModel, make_german: Callable[[], TextFunction],
    make_english: Callable[[], TextFunction], per_class: int = PER_CLASS,
) -> tuple[DataFrame, DataFrame]:
    """Sample, translate there and back, label both sides, score: (samples, metrics)."""
    spark = raw.sparkSession
    sample = materialized(spark, evaluation_sample(raw, per_class), "evaluation-sample")
    spoken = detect_language(language_model, sample.withColumnRenamed("original", "text"))
    german = translate(prepare(spoken), make_german)
    back = translate_back(german, "translation", "back_translation", make_english)
    flat = back.select(
        "row_id", "sentiment", "rating", F.col("text").alias("original"), F.col("translation").alias("german"),
        "back_translation", "status",
    )
    labelled = _with_prediction(model, _with_prediction(model, flat, "original", "pred_original"),
                                "back_translation", "pred_back")
    samples = materialized(
        spark, labelled.withColumn("sentiment_preserved", F.col("pred_original") == F.col("pred_back")), "samples"
    )
    return samples, pair_metrics(samples)


def _with_prediction(model: PipelineModel, df: DataFrame, text: str, out: str) -> DataFrame:
    labelled = predict_sentiment(model, df.withColumn("review_text", F.col(text)))
    return labelled.drop("review_text").withColumnRenamed("model_sentiment", out)


def save(samples: DataFrame, scores: DataFrame, path: str) -> None:
    """Sample table for manual comparison, one file with a byte-order mark, and the metrics record."""
    columns = ["sentiment", "rating", "original", "german", "back_translation", "pred_original", "pred_back",
               "sentiment_preserved", "status"]
    write_csv_file(samples.orderBy("row_id").select(*columns), f"{path}/translation_samples.csv")
    write_json_record(scores, f"{path}/translation_metrics")
