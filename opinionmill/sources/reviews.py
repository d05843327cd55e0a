"""Review readers with an explicit schema and a stable row order."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from opinionmill.functions.labels import sentiment, to_number
from opinionmill.functions.text import clean_product_name, clean_text, has_words
from opinionmill.operators import contracts
from opinionmill.sources import csv_ranges

# Source columns and what they are called here.
SOURCE_COLUMNS = {"reviews.text": "review_text", "reviews.rating": "rating", "name": "product_name"}


def read_table(spark: SparkSession, path: str, hint: str, schema: StructType | None = None) -> DataFrame:
    """Parquet stage table; a missing path is reported with what to run first."""
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{path} not found. {hint}") from error
        raise


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file; only the head of the file is read."""
    return spark.read.option("header", True).option("escape", '"').csv(path).columns


def _named(names: list[str], columns: tuple[str, ...] | None) -> list[Column]:
    return [F.col(f"`{c}`").alias(c) for c in (columns or tuple(names)) if c in names and c != "row_id"]


def read_reviews_csv(spark: SparkSession, path: str, columns: tuple[str, ...] | None = None,
                     row_id: str | None = None, whole_files: bool = False) -> DataFrame:
    """Raw reviews as strings, only the wanted columns, with ``row_id`` in file order.

    Files are read by byte ranges, also where quoted fields hold line breaks; quotes must pair up, as RFC 4180
    has it. ``whole_files`` reads each file in one task, for files that do not keep to that. All files must have
    the same header; another one is refused. ``row_id`` is a key column where there is one, else file path and
    position in the file, whatever task read it.
    """
    names = csv_header(spark, path)
    schema = StructType([StructField(name, StringType()) for name in names])
    if whole_files:
        return _read_whole_files(spark, path, schema, columns, row_id)
    records, heads = csv_ranges.csv_records(spark, path)
    if len(heads) > 1:
        raise contracts.ContractError(f"Review files have different headers: {sorted(heads)}")
    parsed = F.from_csv(
        F.regexp_replace("line", r"\r\z", ""), ", ".join(f"`{name}` string" for name in names), {"escape": '"'})
    # a generator, so that one parse gives all columns
    rows = records.where("record > 0").select("file", "record", F.inline(F.array(parsed)))
    place = F.concat_ws(":", "file", F.lpad((F.col("record") - 1).cast("string"), 12, "0"))
    return rows.select((F.col(f"`{row_id}`") if row_id else place).alias("row_id"), *_named(names, columns))


def _read_whole_files(spark: SparkSession, path: str, schema: StructType, columns: tuple[str, ...] | None,
                      row_id: str | None) -> DataFrame:
    raw = (
        spark.read.schema(schema).option("header", True).option("multiLine", True).option("enforceSchema", False)
        .option("escape", '"').option("encoding", "UTF-8").csv(path)
    )
    wanted = _named(schema.names, columns)
    if row_id:
        return raw.select(F.col(f"`{row_id}`").alias("row_id"), *wanted)
    # a file is read by one task from its first row on, so its rows are numbered without a gap
    numbered = raw.select(F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at"), *wanted)
    first = numbered.groupBy("_file").agg(F.min("_at").alias("_first"))
    place = F.lpad((F.col("_at") - F.col("_first")).cast("string"), 12, "0")
    return numbered.join(first, "_file").select(
        F.concat_ws(":", "_file", place).alias("row_id"), *[F.col(f"`{c}`") for c in numbered.columns[2:]])


def load_reviews(raw: DataFrame, strict_labels: bool = False) -> DataFrame:
    """Contract, renames, cleaning, numeric stars, filters and labels."""
    contracts.require_columns(raw, SOURCE_COLUMNS, "Review table")
    df = raw.select(*[F.col(f"`{c}`").alias(SOURCE_COLUMNS.get(c, c)) for c in raw.columns])
    categories = F.coalesce(F.col("categories").cast("string"), F.lit("")) if "categories" in df.columns else F.lit("")
    return (
        df.withColumn("rating", to_number(F.col("rating"))).na.drop(subset=["rating"])
        .where(has_words(F.col("review_text"))).withColumn("review_text", clean_text(F.col("review_text")))
        .withColumn("product_name", clean_product_name(F.col("product_name")))
        .withColumn("categories", categories)
        .withColumn("sentiment", sentiment(F.col("rating"), strict_labels))
        .where("sentiment <> 'invalid'")
        .select("row_id", "review_text", "product_name", "categories", "rating", "sentiment")
    )
