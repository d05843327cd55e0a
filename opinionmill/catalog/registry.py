"""The query registry and the SQL views its checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opinionmill.sources.adapters import HOSTILE_WORDS

QueryFunction = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFunction] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a query under ``name``, with the SQL that must give the same rows."""

    def register(function: QueryFunction) -> QueryFunction:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def clean_sql(column: str) -> str:
    spaced = rf"regexp_replace(lower({column}), '[^a-z0-9\s]', ' ', 'g')"
    return rf"trim(regexp_replace({spaced}, '\s+', ' ', 'g'))"


def label_sql(rating: str) -> str:
    return f"CASE WHEN {rating} <= 2 THEN 'negative' WHEN {rating} = 3 THEN 'neutral' ELSE 'positive' END"


REVIEWS_TEXT = """
reviews_text AS (
  SELECT d.doc_id AS row_id, d.text AS raw_text, d.source AS product_name, d.lang AS categories,
         CASE WHEN l.toxic = 1 THEN 1.0 WHEN l.quality = 0 THEN 3.0 WHEN l.quality = 1 THEN 5.0 END::DOUBLE AS rating
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

USABLE = f"""{REVIEWS_TEXT},
cleaned AS (SELECT row_id, product_name, categories, rating, {clean_sql('raw_text')} AS review_text FROM reviews_text),
usable AS (
  SELECT *, {label_sql('rating')} AS sentiment,
         CASE WHEN regexp_matches(review_text, '\\b(?:{'|'.join(HOSTILE_WORDS)})\\b') THEN 'negative'
              WHEN length(review_text) < 400 THEN 'neutral' ELSE 'positive' END AS model_sentiment
  FROM cleaned WHERE rating IS NOT NULL AND review_text <> '')"""

CLUSTERED = f"""{USABLE},
dim AS (
  SELECT DISTINCT source AS product_name, CAST(substr(source, 4) AS INTEGER) % 5 AS cluster_id
  FROM documents WHERE CAST(substr(source, 4) AS INTEGER) < 18),
clustered AS (
  SELECT u.*, COALESCE(d.cluster_id, -1)::INTEGER AS cluster_id,
         COALESCE('Category ' || d.cluster_id, 'Unclassified / missing product name') AS cluster_name
  FROM usable u LEFT JOIN dim d ON d.product_name = u.product_name)"""

BULK = f"""
bulk AS (
  SELECT lpad(l_orderkey::VARCHAR, 12, '0') || '-' || lpad(l_linenumber::VARCHAR, 12, '0') || '-'
         || lpad(l_partkey::VARCHAR, 12, '0') || '-' || lpad(l_suppkey::VARCHAR, 12, '0') AS row_id,
         p_name AS product_name, p_type AS cluster_name, (1 + l_quantity % 5)::DOUBLE AS rating,
         {label_sql('(1 + l_quantity % 5)')} AS sentiment,
         CASE l_returnflag WHEN 'R' THEN 'negative' WHEN 'A' THEN 'neutral' ELSE 'positive' END AS model_sentiment
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

SENTIMENT_ROWS = "(VALUES ('negative'), ('neutral'), ('positive')) AS s(sentiment)"
SOURCE_ROWS = "(VALUES ('model'), ('rating')) AS o(source)"
