"""Sentiment classifiers: candidates, selection, refit and scoring."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LinearSVCModel, LogisticRegression, NaiveBayes
from pyspark.ml.common import _py2java
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinionmill.functions import scores
from opinionmill.functions.labels import SENTIMENTS
from opinionmill.operators import contracts
from opinionmill.operators.features import SENTIMENT_FEATURES, fit_text_features, text_vocabulary
from opinionmill.operators.metrics import cell_counts, summary_metrics
from opinionmill.operators.newton import fit_squared_hinge
from opinionmill.operators.sampling import union_all
from opinionmill.operators.vector_blocks import vector_blocks
from opinionmill.session import materialized


@dataclass(frozen=True)
class Candidate:
    """One configuration to compare."""

    name: str
    learner: str
    balanced: bool = False
    tfidf: bool = True


# The five configurations in listing order, which decides ties.
CANDIDATES = (
    Candidate("TF-IDF + Logistic Regression", "logistic"),
    Candidate("TF-IDF + Logistic Regression (balanced)", "logistic", balanced=True),
    Candidate("TF-IDF + Multinomial Naive Bayes", "bayes"),
    Candidate("TF-IDF + LinearSVC (balanced)", "svc", balanced=True),
    Candidate("BoW + Logistic Regression (balanced)", "logistic", balanced=True, tfidf=False),
)


@dataclass(frozen=True)
class SentimentModel:
    """A fitted pipeline with the numbers that travel with it."""

    pipeline: PipelineModel
    name: str
    labels: tuple[str, ...] = SENTIMENTS
    selection_metric: str = "validation_macro_f1"
    validation_macro_f1: float | None = None
    test_accuracy: float | None = None
    test_weighted_f1: float | None = None


def label_index(column: Column, labels: Sequence[str] = SENTIMENTS) -> Column:
    names = F.array(*[F.lit(label) for label in labels])
    return (F.array_position(names, column) - 1).cast("double")


def class_counts(df: DataFrame, label: str = "sentiment") -> dict[str, int]:
    """Rows per class: one small row per label on the driver."""
    return {r[label]: r["count"] for r in df.groupBy(label).count().collect()}


def class_weights(counts: dict[str, int]) -> dict[str, float]:
    """Balanced weights n / (k * n_class)."""
    rows = sum(counts.values())
    return {label: rows / (len(counts) * count) for label, count in counts.items()}


def with_weights(df: DataFrame, balanced: bool, label: str = "sentiment", out: str = "_weight") -> DataFrame:
    """Row weights for balanced training, 1 otherwise (L2)."""
    chain = F.lit(1.0)
    for name, weight in (class_weights(class_counts(df, label)) if balanced else {}).items():
        chain = F.when(F.col(label) == name, F.lit(weight)).otherwise(chain)
    return df.withColumn(out, chain)


def _svc_model(features: DataFrame, position: int, weights: np.ndarray) -> LinearSVCModel:
    """Coefficients and intercept as a model of Spark's library, which can be saved."""
    context = features.sparkSession.sparkContext
    java = context._jvm.org.apache.spark.ml.classification.LinearSVCModel(
        f"svc_{position}_{uuid.uuid4().hex[:12]}", _py2java(context, Vectors.dense(weights[:-1])), float(weights[-1]))
    model = LinearSVCModel(java)
    return model._set(featuresCol="features", rawPredictionCol=f"_raw_{position}", predictionCol=f"_predicted_{position}")


def fit_one_vs_rest(features: DataFrame, balanced: bool, max_iter: int, labels: Sequence[str] = SENTIMENTS) -> list[Transformer]:
    """One linear SVM per class, its margins joined to one ``rawPrediction`` vector (L4).

    Squared hinge loss with a penalty constant of 1 and the intercept penalised as one more coefficient. Rows of
    the class carry its balanced weight, all others weigh 1. All classes are fitted in the same passes.
    """
    counts = class_counts(features)
    weights = class_weights(counts) if balanced else {}
    blocks = vector_blocks(features, "features", "_label")
    size = blocks.agg(F.max("size").alias("size")).first()["size"] or 0
    found = fit_squared_hinge(blocks, size, [weights.get(label, 1.0) for label in labels], max_iter)
    stages = [_svc_model(features, i, found[i]) for i in range(len(labels))]
    margins = [
        VectorSlicer(inputCol=f"_raw_{i}", outputCol=f"_margin_{i}", indices=[1]) for i in range(len(labels))
    ]
    joined = VectorAssembler(inputCols=[f"_margin_{i}" for i in range(len(labels))], outputCol="rawPrediction")
    return [*stages, *margins, joined]


def fit_learner(features: DataFrame, candidate: Candidate, rows: int, max_iter: int,
                labels: Sequence[str] = SENTIMENTS) -> list[Transformer]:
    """Stages from ``features`` to ``rawPrediction``, one margin per label in label order.

    A penalty constant of 1 on summed losses is 1 / rows on Spark's averaged loss; balanced
    weights average 1, so that also holds for balanced logistic regression.
    """
    if candidate.learner == "svc":
        return fit_one_vs_rest(features, candidate.balanced, max_iter, labels)
    common = {"featuresCol": "features", "labelCol": "_label", "weightCol": "_weight"}
    weighted = with_weights(features, candidate.balanced)
    if candidate.learner == "logistic":
        return [LogisticRegression(
            family="multinomial", standardization=False, regParam=1.0 / rows, maxIter=max_iter, **common
        ).fit(weighted)]
    if candidate.learner == "bayes":
        return [NaiveBayes(modelType="multinomial", smoothing=1.0, **common).fit(weighted)]
    raise ValueError(f"unknown learner {candidate.learner!r}")


def predicted_label(labels: Sequence[str] = SENTIMENTS) -> Column:
    """Label of the largest margin of a scored row."""
    return scores.best_label(vector_to_array("rawPrediction"), labels)


def labelled_features(stages: PipelineModel, rows: DataFrame, text: str, labels: Sequence[str]) -> DataFrame:
    """sentiment, its number and the features, written once for the passes of the learners."""
    named = stages.transform(rows.select(text, "sentiment")).select(
        "sentiment", label_index(F.col("sentiment"), labels).alias("_label"), "features")
    return materialized(rows.sparkSession, named, "labelled-features")


def compare_candidates(
    train: DataFrame, validation: DataFrame, text: str = "review_text", candidates: Sequence[Candidate] = CANDIDATES,
    max_features: int = SENTIMENT_FEATURES, max_iter: int = 100, labels: Sequence[str] = SENTIMENTS,
) -> DataFrame:
    """Fit every candidate on the training rows and score it on the validation rows.

    The terms are counted once for all kinds of features, and features are kept while the candidates train on them.
    """
    found = text_vocabulary(train, text, max_features)
    kinds = {}
    for tfidf in sorted({c.tfidf for c in candidates}, reverse=True):
        stages = fit_text_features(train, text, max_features, tfidf_weights=tfidf, found=found)
        fitting, judging = (labelled_features(stages, frame, text, labels) for frame in (train, validation))
        kinds[tfidf] = fitting, judging, fitting.count()

    def judge(entry: tuple[int, Candidate]) -> list[tuple]:
        position, candidate = entry
        fitting, judging, rows = kinds[candidate.tfidf]
        model = PipelineModel(fit_learner(fitting, candidate, rows, max_iter, labels))
        named = model.transform(judging).select(
            F.col("sentiment").alias("actual"), predicted_label(labels).alias("predicted"))
        return [(candidate.name, position, *cell) for cell in cell_counts(named).collect()]

    scored = []
    with ThreadPool(len(candidates)) as pool:  # the candidates share the features and train side by side
        for cells in pool.map(inheritable_thread_target(train.sparkSession)(judge), list(enumerate(candidates)), chunksize=1):
            scored += cells
    # Only labels x labels cell counts per candidate reach the driver.
    cells = train.sparkSession.createDataFrame(scored, "model string, position int, actual string, predicted string, n long")
    return summary_metrics(cells, ["model", "position"], labels).orderBy(
        F.desc("macro_f1"), F.desc("accuracy"), "position"
    )


def fit_sentiment_model(
    train: DataFrame, candidate: Candidate, text: str = "review_text", max_features: int = SENTIMENT_FEATURES,
    max_iter: int = 100, labels: Sequence[str] = SENTIMENTS,
) -> PipelineModel:
    """Text to class margins as one savable pipeline (L7), all of it JVM stages."""
    stages = fit_text_features(train, text, max_features, tfidf_weights=candidate.tfidf)
    features = labelled_features(stages, train, text, labels)
    fitted = fit_learner(features, candidate, features.count(), max_iter, labels)
    return PipelineModel([*stages.stages, *fitted])


def train_sentiment_model(
    split: DataFrame, text: str = "review_text", candidates: Sequence[Candidate] = CANDIDATES,
    max_features: int = SENTIMENT_FEATURES, max_iter: int = 100,
) -> tuple[DataFrame, SentimentModel, DataFrame]:
    """Compare, choose, refit on train + validation, evaluate once on test.

    ``split`` has the text, ``sentiment`` and ``split``. Returns the comparison table, the model
    and its test predictions.
    """
    contracts.require_columns(split, [text, "sentiment", "split"], "Training table")
    train, validation, test = (split.where(F.col("split") == part) for part in ("train", "validation", "test"))
    comparison = compare_candidates(train, validation, text, candidates, max_features, max_iter)
    best = comparison.first()
    chosen = next(c for c in candidates if c.name == best["model"])
    pipeline = fit_sentiment_model(union_all([train, validation]), chosen, text, max_features, max_iter)
    predictions = pipeline.transform(test).select(
        F.col("sentiment").alias("actual"), predicted_label().alias("predicted")
    )
    final = summary_metrics(predictions).first()
    model = SentimentModel(
        pipeline, chosen.name, validation_macro_f1=best["macro_f1"],
        test_accuracy=final["accuracy"], test_weighted_f1=final["weighted_f1"],
    )
    return comparison, model, predictions


def predict_sentiment(model: PipelineModel, reviews: DataFrame, text: str = "review_text",
                      labels: Sequence[str] = SENTIMENTS) -> DataFrame:
    """Batch scoring: adds ``model_sentiment`` and keeps the input columns."""
    scored = model.transform(reviews.withColumn(text, F.coalesce(F.col(text), F.lit(""))))
    return scored.select(*reviews.columns, predicted_label(labels).alias("model_sentiment"))


def model_kind(model: PipelineModel) -> str:
    """Name of the learner whose margins a pipeline gives."""
    kinds = {"LinearSVCModel": "LinearSVC", "LogisticRegressionModel": "logistic regression", "NaiveBayesModel": "naive Bayes"}
    return next((kinds[type(s).__name__] for s in model.stages if type(s).__name__ in kinds), "model")


def score_reviews(model: PipelineModel, requests: DataFrame, text: str = "review",
                  labels: Sequence[str] = SENTIMENTS) -> DataFrame:
    """Label and relative class scores of accepted requests (L9, F24); batch or stream."""
    keys = [c for c in requests.columns if c != text]
    margins = vector_to_array("rawPrediction")
    scored = model.transform(requests)
    return scored.select(
        *keys, scores.best_label(margins, labels).alias("sentiment"),
        scores.class_scores(margins, labels).alias("class_scores"),
        F.lit(scores.SCORE_NOTE.format(kind=model_kind(model))).alias("score_note"),
    )
