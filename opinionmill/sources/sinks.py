"""Tables, documents and models written and read back."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionmill.functions.labels import SENTIMENTS
from opinionmill.operators import contracts
from opinionmill.operators.classify import SentimentModel

SOURCE_COUNT_COLUMNS = tuple(f"{source}_{label}" for source in ("model", "rating") for label in SENTIMENTS)

MODEL_FIELDS = ("recommended_model", "labels", "selection_metric", "validation_macro_f1", "test_accuracy", "test_weighted_f1")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; quotes are doubled and line breaks stay inside quoted fields."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("encoding", "UTF-8").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return (
        spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    )


def write_confusion_csv(matrix: DataFrame, path: str) -> None:
    """Confusion matrix with the row label in the first column."""
    columns = [c for c in matrix.columns if c != "actual"]
    labelled = matrix.select(
        F.concat(F.lit("Actual "), "actual").alias("actual"),
        *[F.col(c).alias("Predicted " + c.removeprefix("predicted_")) for c in columns],
    )
    write_csv(labelled, path)


def write_json_record(df: DataFrame, path: str) -> None:
    """Nested records as JSON lines; nulls are written, text stays UTF-8."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_markdown(articles: DataFrame, path: str, heading: str) -> None:
    """One text part per category under a shared heading."""
    body = articles.select("cluster_id", F.concat(F.lit(heading), F.lit("\n\n"), "article").alias("value"))
    body.write.mode("overwrite").partitionBy("cluster_id").option("lineSep", "\n").text(path)


def ranked_export(products: DataFrame) -> DataFrame:
    """Ranked products without the per-source counts."""
    return products.drop(*SOURCE_COUNT_COLUMNS)


def save_model(model: SentimentModel, *paths: str) -> None:
    """Pipeline and a one-row metadata table, at every path given."""
    spark = SparkSession.getActiveSession()
    row = [(model.name, list(model.labels), model.selection_metric, model.validation_macro_f1,
            model.test_accuracy, model.test_weighted_f1)]
    schema = ("recommended_model string, labels array<string>, selection_metric string, "
              "validation_macro_f1 double, test_accuracy double, test_weighted_f1 double")
    for path in paths:
        model.pipeline.write().overwrite().save(f"{path}/pipeline")
        spark.createDataFrame(row, schema).write.mode("overwrite").parquet(f"{path}/metadata")


def load_model(spark: SparkSession, path: str) -> SentimentModel:
    """Read a saved model; its metadata must be complete."""
    from opinionmill.sources.reviews import read_table

    metadata = read_table(spark, f"{path}/metadata", "Train and save a sentiment model first.")
    contracts.require_columns(metadata, MODEL_FIELDS, "Sentiment model")
    row = metadata.first()
    return SentimentModel(
        PipelineModel.load(f"{path}/pipeline"), row["recommended_model"], tuple(row["labels"]), row["selection_metric"],
        row["validation_macro_f1"], row["test_accuracy"], row["test_weighted_f1"],
    )
