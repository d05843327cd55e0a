"""Review-shaped views over the driver's tables.

``row_id`` is the order every order-sensitive operator sorts by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionmill.functions.labels import sentiment
from opinionmill.functions.text import clean_text, has_words

# Words that mark a text as negative in the stand-in for model labels; they occur in the corpus.
HOSTILE_WORDS = ("trash", "scum", "clown", "idiot", "worthless", "moron", "pathetic")

# Themes over the same words, since the corpus holds none of the default keywords.
CORPUS_THEMES = {
    "Insults": r"\b(?:idiot|moron|clown)\b",
    "Contempt": r"\b(?:scum|trash|pathetic)\b",
    "Worth": r"\b(?:worthless|quality|value)\b",
    "Never mentioned": r"\b(?:battery|charger)\b",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document table."""
    return table(spark, sf_dir, "documents")


def reviews_text(spark: SparkSession, sf_dir: str, stream: DataFrame | None = None) -> DataFrame:
    """Documents as raw reviews; the label table supplies the stars.

    ``stream`` replaces the documents by a stream of the same table.
    """
    labels = table(spark, sf_dir, "labels")
    stars = F.when(F.col("toxic") == 1, 1.0).when(F.col("quality") == 0, 3.0).when(F.col("quality") == 1, 5.0)
    return (
        (documents(spark, sf_dir) if stream is None else stream).join(labels, "doc_id", "left")
        .select(
            F.col("doc_id").alias("row_id"), F.col("text").alias("raw_text"),
            F.col("source").alias("product_name"), F.col("lang").alias("categories"), stars.alias("rating"),
        )
    )


def usable_reviews(spark: SparkSession, sf_dir: str, stream: DataFrame | None = None) -> DataFrame:
    """Rated, non-empty reviews with cleaned text and both labels.

    Both filters look at the raw columns, so only rows that stay are cleaned, and only once.
    """
    hostile = F.col("review_text").rlike(rf"\b(?:{'|'.join(HOSTILE_WORDS)})\b")
    return (
        reviews_text(spark, sf_dir, stream).where("rating IS NOT NULL").where(has_words(F.col("raw_text")))
        .withColumn("review_text", clean_text(F.col("raw_text"))).drop("raw_text")
        .withColumn("sentiment", sentiment(F.col("rating")))
        .withColumn(
            "model_sentiment",
            F.when(hostile, "negative").when(F.length("review_text") < 400, "neutral").otherwise("positive"),
        )
    )


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product to cluster: five clusters by source number, the last two sources unassigned."""
    number = F.substring("source", 4, 9).cast("int")
    return (
        table(spark, sf_dir, "documents").select("source").distinct().where(number < 18)
        .select(
            F.col("source").alias("product_name"), (number % 5).cast("int").alias("cluster_id"),
            F.concat(F.lit("Category "), (number % 5).cast("string")).alias("cluster_name"),
        )
    )


def clustered_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opinionmill.operators.joins import assign_categories

    return assign_categories(usable_reviews(spark, sf_dir), product_dim(spark, sf_dir))


def reviews_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as rated reviews without text; the return flag plays the model label."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    rating = (F.lit(1) + F.col("l_quantity") % 5).cast("double")
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat_ws("-", *[F.lpad(F.col(c).cast("string"), 12, "0") for c in key]).alias("row_id"),
            F.col("p_name").alias("product_name"), F.col("p_type").alias("cluster_name"),
            rating.alias("rating"), sentiment(rating).alias("sentiment"),
            F.when(F.col("l_returnflag") == "R", "negative").when(F.col("l_returnflag") == "A", "neutral")
            .otherwise("positive").alias("model_sentiment"),
        )
    )


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn and the assistant turn after it, as a text pair."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where("role = 'user'").select(
        "conv_id", "turn", F.col("text").alias("reference"))
    answered = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("candidate"))
    pair_id = F.concat_ws(":", "conv_id", "turn").alias("pair_id")
    return asked.join(answered, ["conv_id", "turn"]).select(pair_id, "reference", "candidate")
