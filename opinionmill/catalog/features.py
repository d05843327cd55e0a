"""Text features in long form."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinionmill.catalog.registry import CLUSTERED, clean_sql, query
from opinionmill.functions.text import clean_text
from opinionmill.functions.tokens import clean_tokens, default_stop_words, uni_and_bigrams, without_stop_words
from opinionmill.operators import aggregates, features
from opinionmill.session import materialized
from opinionmill.sources import adapters
from opinionmill.sources.adapters import table

STOP_SQL = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in default_stop_words()) + ")"


def terms_sql(name: str, source: str, key: str, text: str) -> str:
    """CTE with one row per occurrence of a uni- or bigram after stop words."""
    return rf"""
{name}_tokens AS (
  SELECT {key}, list_filter(regexp_extract_all({text}, '\w\w+'), lambda w: w NOT IN {STOP_SQL}) AS t FROM {source}),
{name} AS (
  SELECT {key}, unnest(list_concat(t, [t[i] || ' ' || t[i + 1] for i in range(1, len(t))])) AS term FROM {name}_tokens)"""


DOCS = f"docs AS (SELECT doc_id, {clean_sql('text')} AS cleaned FROM documents)"
DOC_TERMS = f"WITH {DOCS}, {terms_sql('occ', 'docs', 'doc_id', 'cleaned')}"
DOC_COUNTS = f"""{DOC_TERMS},
counts AS (SELECT doc_id, term, count(*) AS tf FROM occ GROUP BY ALL),
vocab AS (SELECT term, sum(tf)::BIGINT AS corpus_tf, count(*) AS df FROM counts GROUP BY term
          ORDER BY corpus_tf DESC, term LIMIT 5000)"""


def document_tokens():
    return uni_and_bigrams(without_stop_words(clean_tokens(clean_text(F.col("text")))))


def document_terms(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return features.term_counts(docs, ["doc_id"], document_tokens(), one_row_per_key=True)


@query("token_counts", f"""
WITH {DOCS},
occ AS (SELECT doc_id, unnest(list_filter(regexp_extract_all(cleaned, '\\w\\w+'), lambda w: w NOT IN {STOP_SQL})) AS term FROM docs)
SELECT doc_id, term, count(*) AS tf FROM occ GROUP BY ALL""")
def token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = without_stop_words(clean_tokens(clean_text(F.col("text"))))
    return features.term_counts(docs, ["doc_id"], tokens, one_row_per_key=True)


@query("bigram_counts", f"""{DOC_TERMS}
SELECT doc_id, term, count(*) AS tf FROM occ WHERE contains(term, ' ') GROUP BY ALL""")
def bigram_counts(spark, sf_dir):
    return document_terms(spark, sf_dir).where(F.col("term").contains(" "))


@query("bow_vocabulary", f"{DOC_COUNTS} SELECT term, corpus_tf, df FROM vocab")
def bow_vocabulary(spark, sf_dir):
    return features.vocabulary(table(spark, sf_dir, "documents"), document_tokens(), features.SENTIMENT_FEATURES)


@query("bow_vocabulary_sketch", f"{DOC_COUNTS} SELECT term, corpus_tf, df FROM vocab")
def bow_vocabulary_sketch(spark, sf_dir):
    """The same vocabulary from a sketch's candidates, counted exactly."""
    return features.vocabulary_by_sketch(table(spark, sf_dir, "documents"), document_tokens(), features.SENTIMENT_FEATURES)


@query("tfidf_long", f"""{DOC_COUNTS},
raw AS (SELECT doc_id, c.term, tf * (ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1.0)) + 1.0) AS w
        FROM counts c JOIN vocab v ON v.term = c.term)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw""")
def tfidf_long(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = features.tfidf(docs, ["doc_id"], document_tokens(), features.SENTIMENT_FEATURES)
    return out.withColumn("weight", F.round("weight", 6))


PRODUCTS = f"""{CLUSTERED},
first20 AS (SELECT product_name, row_id, review_text FROM usable
            QUALIFY row_number() OVER (PARTITION BY product_name ORDER BY row_id) <= 20),
products AS (
  SELECT product_name, string_agg(review_text, ' ' ORDER BY row_id) AS review_document,
         (SELECT string_agg(c, ' ' ORDER BY c) FROM (SELECT DISTINCT trim(categories) AS c FROM usable u
          WHERE u.product_name = f.product_name AND trim(categories) <> '')) AS categories_text
  FROM first20 f GROUP BY product_name)"""


def block_sql(block: str, column: str, limit: int, factor: float) -> str:
    return f"""
{terms_sql(block + '_occ', 'products', 'product_name', f'lower({column})')},
{block}_counts AS (SELECT product_name, term, count(*) AS tf FROM {block}_occ GROUP BY ALL),
{block}_vocab AS (SELECT term, sum(tf) AS corpus_tf, count(*) AS df FROM {block}_counts GROUP BY term
                  ORDER BY corpus_tf DESC, term LIMIT {limit}),
{block}_raw AS (
  SELECT product_name, c.term,
         (1 + ln(tf)) * (ln(((SELECT count(*) FROM products) + 1.0) / (df + 1.0)) + 1.0) AS w
  FROM {block}_counts c JOIN {block}_vocab v ON v.term = c.term),
{block}_block AS (
  SELECT product_name, '{block}' AS block, term,
         round({factor} * w / sqrt(sum(w * w) OVER (PARTITION BY product_name)), 6) AS weight FROM {block}_raw)"""


@query("tfidf_sublinear_blocks", "WITH " + ",".join(
    [PRODUCTS, *[block_sql(b, *spec) for b, spec in features.PRODUCT_BLOCKS.items()]]
) + " SELECT * FROM title_block UNION ALL SELECT * FROM category_block UNION ALL SELECT * FROM review_block")
def tfidf_sublinear_blocks(spark, sf_dir):
    products = materialized(spark, aggregates.product_profiles(adapters.usable_reviews(spark, sf_dir)), "products")
    return features.product_blocks(products).withColumn("weight", F.round("weight", 6))


CLUSTER_TERMS = f"""WITH {PRODUCTS},
named AS (SELECT d.cluster_id, p.review_document FROM products p JOIN dim d USING (product_name)),
{terms_sql('occ', 'named', 'cluster_id', 'review_document')},
counts AS (SELECT cluster_id, term, count(*) AS tf FROM occ GROUP BY ALL),
vocab AS (SELECT term FROM counts GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 2000),
kept AS (SELECT cluster_id, c.term, tf FROM counts c JOIN vocab USING (term))"""


def cluster_term_table(spark, sf_dir):
    products = aggregates.review_documents(adapters.usable_reviews(spark, sf_dir))
    named = products.join(adapters.product_dim(spark, sf_dir), "product_name")
    return features.cluster_terms(named)


@query("cluster_terms", f"{CLUSTER_TERMS} SELECT cluster_id, term, tf FROM kept")
def cluster_terms(spark, sf_dir):
    return cluster_term_table(spark, sf_dir)


@query("cluster_top_terms", f"""{CLUSTER_TERMS},
top AS (SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY tf DESC, term) <= 10)
SELECT cluster_id, string_agg(term, ', ' ORDER BY tf DESC, term) AS top_terms FROM top GROUP BY 1""")
def cluster_top_terms(spark, sf_dir):
    return features.top_terms(cluster_term_table(spark, sf_dir))
