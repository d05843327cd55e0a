"""Redaction, evidence briefs, request rows and articles."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinionmill.catalog.registry import CLUSTERED, ORACLES, query
from opinionmill.functions.redact import redact_excerpt
from opinionmill.operators import aggregates, articles, contracts, evidence, ranking
from opinionmill.session import materialized
from opinionmill.sources import adapters


def redact_sql(column: str) -> str:
    """Redaction without lookarounds: the borders are spelled with \\b and \\B."""
    text = f"substr({column}, 1, 500)"
    for pattern, to, flags in (
        (r"\bmy name is\s+[\w''-]+(?:\s+[\w''-]+){0,2}", "my name is [redacted]", "gi"),
        (r"\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b", "[redacted email]", "gi"),
        (r"https?://\S+|www\.\S+", "[redacted link]", "gi"),
        (r"(?:\B\+)?\b\d[\d().\-\s]{7,}\d\b", "[redacted phone]", "g"),
    ):
        text = f"regexp_replace({text}, '{pattern}', '{to}', '{flags}')"
    return text


def cut_sql(e: str) -> str:
    closing = r"\b(?:thank you|thanks|regards|sincerely)\b"
    head = f"substr({e}, 1, greatest(length({e}) - 100, 0))"
    tail = f"substr({e}, greatest(length({e}) - 100, 0) + 1)"
    return rf"""CASE WHEN regexp_matches({tail}, '(?i){closing}')
       THEN regexp_replace({head} || regexp_replace({tail}, '(?is){closing}.*$', ''), '\s+$', '') ELSE {e} END"""


@query("redact_excerpts", f"""
WITH r AS (SELECT doc_id, {redact_sql('text')} AS e FROM documents)
SELECT doc_id AS row_id, {cut_sql('e')} AS excerpt FROM r""")
def redact_excerpts(spark, sf_dir):
    return adapters.documents(spark, sf_dir).select(
        F.col("doc_id").alias("row_id"), redact_excerpt(F.col("text")).alias("excerpt")
    )


ASSIGNED = f"""WITH {CLUSTERED},
assigned AS (SELECT * FROM clustered WHERE cluster_id >= 0),
products AS (
  SELECT cluster_id, product_name, count(*) AS review_count, avg(rating) AS mean_rating,
         count(*) FILTER (sentiment = 'negative') AS negative_review_count,
         avg((sentiment = 'negative')::INT) AS negative_share
  FROM assigned GROUP BY ALL),
pool AS (SELECT * FROM products
         QUALIFY review_count >= 5 OR NOT bool_or(review_count >= 5) OVER (PARTITION BY cluster_id)),
top3 AS (SELECT *, row_number() OVER (PARTITION BY cluster_id
           ORDER BY mean_rating DESC, review_count DESC, product_name) AS rank FROM pool QUALIFY rank <= 3),
low AS (SELECT * FROM pool QUALIFY row_number() OVER (PARTITION BY cluster_id
           ORDER BY mean_rating, review_count DESC, product_name) = 1),
selected AS (SELECT cluster_id, product_name FROM top3 UNION SELECT cluster_id, product_name FROM low),
example_rows AS (
  SELECT * FROM (SELECT * FROM assigned WHERE sentiment <> 'neutral'
                 QUALIFY row_number() OVER (PARTITION BY cluster_id, sentiment, review_text ORDER BY row_id) = 1)
  QUALIFY row_number() OVER (PARTITION BY cluster_id, sentiment ORDER BY md5(row_id || ':42'), row_id)
          <= CASE sentiment WHEN 'negative' THEN 5 ELSE 3 END),
complaint_rows AS (
  SELECT * FROM (SELECT * FROM assigned SEMI JOIN selected USING (cluster_id, product_name) WHERE sentiment = 'negative'
                 QUALIFY row_number() OVER (PARTITION BY cluster_id, product_name, review_text ORDER BY row_id) = 1)
  QUALIFY row_number() OVER (PARTITION BY cluster_id, product_name ORDER BY md5(row_id || ':42'), row_id) <= 3)"""


def assigned_reviews(spark, sf_dir):
    return adapters.clustered_reviews(spark, sf_dir).where("cluster_id >= 0")


def categories(spark, sf_dir):
    return adapters.product_dim(spark, sf_dir).select("cluster_id", "cluster_name").distinct()


@query("evidence_stats", f"""{ASSIGNED}
SELECT cluster_id, product_name, review_count, round(mean_rating, 6) AS mean_rating, negative_review_count,
       round(negative_share, 6) AS negative_share FROM products""")
def evidence_stats(spark, sf_dir):
    out = aggregates.product_evidence(assigned_reviews(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("mean_rating", "negative_share")})



@query("evidence_examples", f"""{ASSIGNED},
shown AS (SELECT cluster_id, sentiment, row_id, product_name, rating, {redact_sql('review_text')} AS e FROM example_rows)
SELECT cluster_id, sentiment, row_id, product_name, rating, {cut_sql('e')} AS review FROM shown""")
def evidence_examples(spark, sf_dir):
    reviews = assigned_reviews(spark, sf_dir)
    ids = materialized(spark, evidence.category_example_ids(reviews), "category-examples")
    return evidence.with_excerpts(reviews, ids)


@query("product_complaints", f"""{ASSIGNED},
shown AS (SELECT cluster_id, row_id, product_name, rating, {redact_sql('review_text')} AS e FROM complaint_rows)
SELECT cluster_id, row_id, product_name, rating, {cut_sql('e')} AS review FROM shown""")
def product_complaints(spark, sf_dir):
    reviews = assigned_reviews(spark, sf_dir)
    products = aggregates.product_evidence(reviews)
    keys = ["cluster_id", "product_name"]
    chosen = ranking.top_products(products).select(*keys).union(ranking.lowest_product(products).select(*keys)).distinct()
    ids = materialized(spark, evidence.complaint_ids(reviews, chosen), "complaints")
    return evidence.with_excerpts(reviews, ids)


def briefs(spark, sf_dir):
    reviews = materialized(spark, adapters.clustered_reviews(spark, sf_dir), "review-clusters")
    return evidence.evidence_briefs(categories(spark, sf_dir), reviews)


@query("evidence_brief", f"""{ASSIGNED},
stats AS (SELECT cluster_id, cluster_name, count(*) AS review_count, count(DISTINCT product_name) AS product_count,
                 round(avg(rating), 2) AS mean_rating, round(avg((sentiment = 'negative')::INT), 4) AS negative_share,
                 round(avg((sentiment = 'positive')::INT), 4) AS positive_share FROM assigned GROUP BY ALL)
SELECT s.*, (SELECT string_agg(product_name, '|' ORDER BY rank) FROM top3 t WHERE t.cluster_id = s.cluster_id) AS top_names,
       (SELECT max(product_name) FROM low l WHERE l.cluster_id = s.cluster_id) AS lowest_name,
       (SELECT count(*) FROM example_rows e WHERE e.cluster_id = s.cluster_id AND sentiment = 'negative') AS negatives,
       (SELECT count(*) FROM example_rows e WHERE e.cluster_id = s.cluster_id AND sentiment = 'positive') AS positives,
       (SELECT count(*) FROM complaint_rows c JOIN top3 t ON t.cluster_id = c.cluster_id AND t.product_name = c.product_name
        WHERE c.cluster_id = s.cluster_id) AS complaints
FROM stats s""")
def evidence_brief(spark, sf_dir):
    top = F.col("highest_rated_products")
    per_product = F.transform(top, lambda p: F.size(p["negative_review_examples"]))
    return briefs(spark, sf_dir).select(
        "cluster_id", "cluster_name", "review_count", "product_count", "mean_rating", "negative_share", "positive_share",
        F.array_join(F.transform(top, lambda p: p["name"]), "|").alias("top_names"),
        F.col("lowest_rated_product")["name"].alias("lowest_name"),
        F.size("negative_review_examples").cast("long").alias("negatives"),
        F.size("positive_review_examples").cast("long").alias("positives"),
        F.aggregate(per_product, F.lit(0), lambda a, n: a + n).cast("long").alias("complaints"),
    )


BRIEF_JSON = f"""{ASSIGNED},
stats AS (SELECT cluster_id, cluster_name, count(*) AS review_count, count(DISTINCT product_name) AS product_count,
                 round(avg(rating), 2) AS mean_rating, round(avg((sentiment = 'negative')::INT), 4) AS negative_share,
                 round(avg((sentiment = 'positive')::INT), 4) AS positive_share FROM assigned GROUP BY ALL),
e1 AS (SELECT cluster_id, sentiment, row_id, product_name, rating, {redact_sql('review_text')} AS e FROM example_rows),
examples AS (
  SELECT cluster_id, sentiment, list({{product: product_name, rating: rating::VARCHAR, review: {cut_sql('e')}}} ORDER BY row_id) AS l
  FROM e1 GROUP BY ALL),
c1 AS (SELECT cluster_id, row_id, product_name, rating, {redact_sql('review_text')} AS e FROM complaint_rows),
complaints AS (
  SELECT cluster_id, product_name, list({{product: product_name, rating: rating::VARCHAR, review: {cut_sql('e')}}} ORDER BY row_id) AS l
  FROM c1 GROUP BY ALL),
chosen AS (
  SELECT p.cluster_id, rank, {{name: p.product_name, mean_rating: round(mean_rating, 2), review_count: review_count,
         negative_review_count: negative_review_count, negative_review_examples: COALESCE(c.l, [])}} AS record
  FROM (SELECT cluster_id, product_name, mean_rating, review_count, negative_review_count, rank FROM top3
        UNION ALL SELECT cluster_id, product_name, mean_rating, review_count, negative_review_count, 0 FROM low) p
  LEFT JOIN complaints c ON c.cluster_id = p.cluster_id AND c.product_name = p.product_name),
briefs AS (
  SELECT s.cluster_id, s.cluster_name, to_json({{cluster_name: s.cluster_name, review_count: s.review_count,
    product_count: s.product_count, mean_rating: s.mean_rating, negative_share: s.negative_share,
    positive_share: s.positive_share,
    highest_rated_products: (SELECT list(record ORDER BY rank) FROM chosen h WHERE h.cluster_id = s.cluster_id AND rank > 0),
    lowest_rated_product: (SELECT any_value(record) FROM chosen h WHERE h.cluster_id = s.cluster_id AND rank = 0),
    negative_review_examples: COALESCE((SELECT any_value(l) FROM examples x WHERE x.cluster_id = s.cluster_id AND sentiment = 'negative'), []),
    positive_review_examples: COALESCE((SELECT any_value(l) FROM examples x WHERE x.cluster_id = s.cluster_id AND sentiment = 'positive'), [])
  }})::VARCHAR AS evidence FROM stats s)"""


@query("evidence_json", f"{BRIEF_JSON} SELECT cluster_id, evidence FROM briefs")
def evidence_json(spark, sf_dir):
    rows = briefs(spark, sf_dir)
    return rows.select("cluster_id", evidence.evidence_json(rows).alias("evidence"))


DEFAULT_VARIANT = "structured_buyer_guide"


def sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query("prompt_rows", f"""{BRIEF_JSON}
SELECT cluster_id, cluster_name, {sql_text(evidence.REQUEST_OPENING)} || evidence AS user_text,
       '{DEFAULT_VARIANT}' AS prompt_variant, {sql_text(evidence.system_text(DEFAULT_VARIANT))} AS system_text FROM briefs""")
def prompt_rows(spark, sf_dir):
    return evidence.request_rows(briefs(spark, sf_dir), [DEFAULT_VARIANT])


@query("prompt_variants", f"""
WITH v(prompt_variant) AS (VALUES {", ".join(f"('{v}')" for v in evidence.PROMPT_VARIANTS)}),
c AS (SELECT DISTINCT CAST(substr(source, 4) AS INTEGER) % 5 AS cluster_id FROM documents
      WHERE CAST(substr(source, 4) AS INTEGER) < 18)
SELECT prompt_variant, count(*) AS requests FROM v CROSS JOIN c GROUP BY 1""")
def prompt_variants(spark, sf_dir):
    requests = evidence.request_rows(briefs(spark, sf_dir), list(evidence.PROMPT_VARIANTS))
    return requests.groupBy("prompt_variant").agg(F.count(F.lit(1)).alias("requests"))


def message_length():
    """Stand-in for a hosted model: how long the whole message is."""
    return lambda texts: [f"{len(text)} characters." for text in texts]


@query("request_drafts", f"""{BRIEF_JSON}
SELECT cluster_id, cluster_name, 'counter' AS model, '{DEFAULT_VARIANT}' AS prompt_variant, review_count,
       length({sql_text(evidence.system_text(DEFAULT_VARIANT))} || chr(10) || chr(10)
              || {sql_text(evidence.REQUEST_OPENING)} || evidence)::VARCHAR || ' characters.' AS article
FROM briefs JOIN (SELECT cluster_id, count(*) AS review_count FROM assigned GROUP BY 1) USING (cluster_id)""")
def request_drafts(spark, sf_dir):
    """Requests answered by a supplied function become drafts that meet the output contract."""
    rows = materialized(spark, briefs(spark, sf_dir), "briefs")
    requests = evidence.request_rows(rows, [DEFAULT_VARIANT])
    drafts = articles.response_drafts(requests, rows, message_length, "counter")
    contracts.require_columns(drafts, contracts.ARTICLE_COLUMNS, "Draft table")
    return drafts.select("cluster_id", "cluster_name", "model", "prompt_variant", "review_count", "article")


@query("evidence_empty_category", f"""{ASSIGNED},
wanted AS (SELECT DISTINCT cluster_id, cluster_name FROM dim_named
           UNION ALL SELECT 99, 'No such category')
SELECT cluster_id, cluster_name FROM wanted WHERE cluster_id NOT IN (SELECT cluster_id FROM assigned)""".replace(
    "dim_named", "(SELECT cluster_id, 'Category ' || cluster_id AS cluster_name FROM dim)"))
def evidence_empty_category(spark, sf_dir):
    """Categories that a brief would refuse; one without products is added to the table."""
    extra = spark.createDataFrame([(99, "No such category")], "cluster_id int, cluster_name string")
    wanted = categories(spark, sf_dir).unionByName(extra)
    return contracts.without_rows(wanted, assigned_reviews(spark, sf_dir), "cluster_id")


@query("summary_routing", f"""{ASSIGNED},
low_only AS (SELECT cluster_id, product_name FROM low EXCEPT SELECT cluster_id, product_name FROM top3),
shown AS (
  SELECT cluster_id, 'category_' || sentiment AS key, rating, {redact_sql('review_text')} AS e FROM example_rows
  UNION ALL
  SELECT c.cluster_id, 'product:' || c.product_name, rating, {redact_sql('review_text')} FROM complaint_rows c),
lines AS (SELECT cluster_id, key, 2 + len(regexp_extract_all({cut_sql('e')}, '\\S+')) AS words FROM shown)
SELECT cluster_id, key, sum(words)::BIGINT AS n_tokens,
       CASE WHEN sum(words) < 40 THEN 'quote' ELSE 'summarize' END AS route,
       greatest(20, least(90, floor(sum(words) * 0.7::DOUBLE)))::INTEGER AS max_tokens
FROM lines GROUP BY cluster_id, key""")
def summary_routing(spark, sf_dir):
    tasks = articles.summary_tasks(briefs(spark, sf_dir))
    budget = articles.output_budget(F.col("n_tokens"))
    return tasks.select(
        "cluster_id", "key", F.col("n_tokens").cast("long").alias("n_tokens"), "route",
        budget["max_tokens"].alias("max_tokens"),
    )


@query("article_table")
def article_table(spark, sf_dir):
    rows = materialized(spark, briefs(spark, sf_dir), "briefs")
    summaries = articles.summarize_tasks(articles.summary_tasks(rows))
    return articles.drafts(rows, articles.articles(rows, summaries), "heaviest sentences").drop("generated_at_utc")


def closed_when_even():
    """Stand-in text function: the whole text, unfinished where it has an odd number of words."""
    return lambda texts: [" ".join(w) + (" end." if len(w) % 2 == 0 else " and") for w in map(str.split, texts)]


@query("summary_stage", f"""{ASSIGNED},
shown AS (
  SELECT cluster_id, 'category_' || sentiment AS key, row_id, rating, {redact_sql('review_text')} AS e FROM example_rows
  UNION ALL
  SELECT c.cluster_id, 'product:' || c.product_name, row_id, rating, {redact_sql('review_text')} FROM complaint_rows c),
lines AS (SELECT cluster_id, key, row_id, 'Rating ' || rating::VARCHAR || ': '
              || trim(regexp_replace({cut_sql('e')}, '\\s+', ' ', 'g')) AS line FROM shown),
tasks AS (SELECT cluster_id, key, string_agg(line, ' | ' ORDER BY row_id) AS quoted,
                 regexp_extract_all(string_agg(line, ' ' ORDER BY row_id), '\\S+') AS words FROM lines GROUP BY ALL)
SELECT cluster_id, key,
       CASE WHEN len(words) < 40 THEN {sql_text(articles.SHORT_NOTE)} || quoted
            WHEN len(words) % 2 = 0 THEN 'Model summary: ' || array_to_string(words, ' ') || ' end.'
            ELSE {sql_text(articles.CUT_NOTE)} || quoted END AS summary
FROM tasks""")
def summary_stage(spark, sf_dir):
    tasks = articles.summary_tasks(briefs(spark, sf_dir))
    return articles.summarize_tasks(tasks, closed_when_even)


def within_budget():
    """Stand-in that uses its whole budget of words."""
    return lambda texts, max_tokens, min_tokens: [
        " ".join(text.split()[:max_tokens]) + f" {min_tokens} to {max_tokens}." for text in texts]


BUDGET_SQL = ORACLES["summary_stage"].replace(
    "WHEN len(words) % 2 = 0 THEN 'Model summary: ' || array_to_string(words, ' ') || ' end.'",
    "WHEN TRUE THEN 'Model summary: ' || array_to_string(words[1:longest], ' ') || ' ' || least(10, longest // 3) || ' to ' || longest || '.'",
).replace("FROM tasks", "FROM (SELECT *, greatest(20, least(90, floor(len(words) * 0.7::DOUBLE)))::INTEGER AS longest FROM tasks)")


@query("summary_budget", BUDGET_SQL)
def summary_budget(spark, sf_dir):
    """Each summary is as long as the budget that its input allows."""
    tasks = articles.summary_tasks(briefs(spark, sf_dir))
    return articles.summarize_tasks(tasks, within_budget, batch_size=1, budgeted=True)
