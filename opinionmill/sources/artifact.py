"""The dashboard artifact: four count tables under one manifest.

The tables are written as JSON-lines folders, so a table with millions of products is written
and read in parallel. A single record in one file can be written and read too.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionmill.functions.labels import SENTIMENTS
from opinionmill.operators import contracts
from opinionmill.sources import documents
from opinionmill.sources.sinks import write_json_record

# Version and schemas of the artifact's tables.
SCHEMA_VERSION = 1
SOURCE_NOTES = {
    "model": "Task 1 LinearSVC predictions",
    "rating": "Sentiment labels derived from star ratings",
}
_counts = ", ".join(f"{s}_{label} bigint" for s in ("model", "rating") for label in SENTIMENTS)
TABLES = {
    "category_sentiment": "category string, source string, sentiment string, count bigint",
    "product_metrics": f"category string, product_name string, review_count bigint, mean_rating double, {_counts}",
    "review_length_sentiment": "length_bucket string, sentiment string, count bigint, source string",
    "complaint_theme_counts": "category string, source string, theme string, count bigint",
}
MANIFEST = "schema_version int, sentiment_sources map<string,string>, review_count bigint"
NESTED = f"{MANIFEST}, " + ", ".join(f"{name} array<struct<{fields}>>" for name, fields in TABLES.items())


def _columns(name: str) -> list[str]:
    return [field.split()[0] for field in TABLES[name].split(", ")]


def manifest(review_count: DataFrame, notes: Mapping[str, str] = SOURCE_NOTES) -> DataFrame:
    """Version, source notes and review count; ``review_count`` is one row with one column."""
    named = F.create_map(*[F.lit(v) for item in notes.items() for v in item])
    return review_count.toDF("review_count").select(
        F.lit(SCHEMA_VERSION).alias("schema_version"), named.alias("sentiment_sources"), "review_count"
    )


def write(review_count: DataFrame, tables: Mapping[str, DataFrame], path: str, notes: Mapping[str, str] = SOURCE_NOTES) -> None:
    """The tables first, the manifest last: a reader never sees a half-written artifact."""
    for name in TABLES:
        write_json_record(tables[name].select(*_columns(name)), f"{path}/{name}")
    write_json_record(manifest(review_count, notes), f"{path}/manifest")


def write_nested(review_count: DataFrame, tables: Mapping[str, DataFrame], path: str, notes: Mapping[str, str] = SOURCE_NOTES) -> None:
    """The artifact as one JSON record in one file, as ``read_nested`` takes it; ``notes`` say what the sources are."""
    rows = review_count.toDF("review_count").first()["review_count"]
    head = {"schema_version": SCHEMA_VERSION, "sentiment_sources": dict(notes), "review_count": rows}
    fields = json.dumps(head, ensure_ascii=False, separators=(",", ":"))[1:-1]
    named = {name: tables[name].select(*_columns(name)) for name in TABLES}
    documents.write_json_document(review_count.sparkSession, fields, named, path)


def read(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The four tables of a saved artifact, after its contract was checked."""
    check_manifest(_json(spark, f"{path}/manifest", MANIFEST))
    return {name: _json(spark, f"{path}/{name}", schema) for name, schema in TABLES.items()}


def read_nested(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The four tables of a single-record JSON artifact."""
    record = _json(spark, path, NESTED)
    check_manifest(record, [name for name in TABLES])
    return {name: record.select(F.inline(name)) for name in TABLES}


def check_manifest(record: DataFrame, required: list[str] | None = None) -> None:
    fields = ["schema_version", "review_count", *(required or [])]
    head = record.select(
        "schema_version", "review_count", *[F.col(c).isNull().alias(f"no_{c}") for c in fields]
    ).first()
    if head is None:
        raise contracts.ContractError("Dashboard data is empty.")
    missing = sorted(c for c in fields if head[f"no_{c}"])
    if missing:
        raise contracts.ContractError(f"Dashboard data is missing required fields: {missing}")
    if head["schema_version"] != SCHEMA_VERSION:
        raise contracts.ContractError(f"Unsupported dashboard data schema: {head['schema_version']}")
    if not head["review_count"]:
        raise contracts.ContractError("Dashboard data contains no reviews.")


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).option("multiLine", False).json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{path} not found. Build the dashboard artifact first.") from error
        raise
