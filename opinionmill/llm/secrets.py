r"""Secret scans with corpus-wide ownership (operator 9), in DataFrame functions only.

Spans of a pattern come from two lists: the pieces between matches and the matches; their lengths add up
to code point positions. Besides the fixed kinds, long mixed tokens are candidates. The digest of every
candidate is counted over distinct owners and distinct repositories of the whole corpus: what many
owners hold is a copied example, what one owner holds looks live and becomes a span of its own. Owners
are counted after distinct (digest, owner, repository) rows, so a token in a third of all rows is merged
before it is shuffled.

Defined results: a null text is empty; a null owner or repository counts as an owner of its own; repeated
rows give equal rows and count once; rows are told apart by id and text; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionmill.llm.common import table, unwrapped, wrapped
from opinionmill.session import materialized

# Pattern, group whose length counts, and least length of each kind, in listed order.
BASE_KINDS = {
    "assign": (
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}
# The same matches of sufficient length, found faster: a run is only tried at its beginning.
FAST = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"(?<![0-9a-f])[0-9a-f]{16,}"}
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}"
TOKEN_PLAIN = r"[A-Za-z0-9+/_-]{24,}"

MAX_OWNERS = 2  # more owners than this make a copied example
MAX_REPOSITORIES = 3

SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string>"


def pattern_spans(text: Column, pattern: str, kind: str, rank: int, group: int, least: int) -> Column:
    """All matches as (start, rank, end, kind, value), leftmost and non-overlapping, short values dropped."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    rows = F.arrays_zip(between.alias("gap"), matches.alias("match"), values.alias("value"))
    nothing = F.array().cast(f"array<{SPAN}>")

    def step(state: Column, row: Column) -> Column:
        start = state["at"] + F.length(row["gap"])
        end = start + F.length(row["match"])
        span = F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"),
            row["value"].alias("value"))
        found = F.when(F.length(row["value"]) >= least, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    start = F.struct(F.lit(0).alias("at"), nothing.alias("found"))
    return F.when(text.rlike(pattern), F.aggregate(rows, start, step, lambda s: s["found"])).otherwise(nothing)


def base_spans(text: Column) -> Column:
    parts = [
        pattern_spans(text, FAST.get(kind, pattern), kind, rank, group, least)
        for rank, (kind, (pattern, group, least)) in enumerate(BASE_KINDS.items())
    ]
    return F.array_sort(F.concat(*parts))


def token_spans(text: Column, base: Column) -> Column:
    """Long tokens of letters and digits that no base span holds."""
    found = pattern_spans(text, TOKEN, "owned", len(BASE_KINDS), 0, 24)
    return F.filter(
        found, lambda t: t["value"].rlike("[0-9]") & t["value"].rlike("[A-Za-z]")
        & ~F.exists(base, lambda b: (b["start"] <= t["start"]) & (t["end"] <= b["end"])))


def ownership(candidates: DataFrame) -> DataFrame:
    """digest, owners, repositories and whether it looks live, from (digest, owner, repository) rows."""
    once = candidates.select("digest", "owner", "repository").distinct()
    by_owner = once.groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return (
        by_owner.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))
        .withColumn("live", (F.col("owners") <= MAX_OWNERS) & (F.col("repositories") <= MAX_REPOSITORIES))
    )


def scan(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """Per row: doc_id, text_key, base spans, owned spans, and how many candidates look live or copied.

    A candidate is the value of a base span or a long token; owned spans are the live long tokens.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", text.alias("text"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
    )
    rows = rows.withColumn("base", base_spans(F.col("text")))
    rows = rows.withColumn("tokens", token_spans(F.col("text"), F.col("base")))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_key"), "owner", "repository", "base", "tokens")
    held = rows.where((F.size("base") > 0) | (F.size("tokens") > 0))
    found = held.select(
        "doc_id", "text_key", "owner", "repository", F.explode(F.concat("base", "tokens")).alias("span"),
    ).withColumn("digest", F.sha2("span.value", 256))
    judged = found.select("doc_id", "text_key", "span", "digest").distinct().join(ownership(found), "digest")
    owned = F.array_sort(F.collect_list(F.when(F.col("live") & (F.col("span.kind") == "owned"), F.col("span"))))
    per_text = judged.groupBy("doc_id", "text_key").agg(
        owned.alias("owned"), F.sum(F.col("live").cast("long")).alias("n_live"),
        F.sum((~F.col("live")).cast("long")).alias("n_copied"),
    ).withColumnsRenamed({"doc_id": "of_id", "text_key": "of_key"})
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key"))
    return rows.join(per_text, same, "left").select(
        "doc_id", "text_key", "base",
        F.coalesce("owned", F.array().cast(f"array<{SPAN}>")).alias("owned"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
    )


def written(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones merged, replaced by a mark."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, span: Column) -> Column:
        gap = F.when(
            span["start"] >= s["at"],
            F.concat(F.substring(text, s["at"] + 1, span["start"] - s["at"]), F.lit(mark))).otherwise(F.lit(""))
        return F.struct(F.greatest(s["at"], span["end"]).alias("at"), F.concat(s["out"], gap).alias("out"))

    def rest(s: Column) -> Column:
        return F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(F.array_sort(spans), state, step, rest)).otherwise(text)


def redacted(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """``docs`` with every base span and every live long token replaced by a mark; other columns as they are."""
    found = scan(docs, owner, repository).withColumn("spans", F.concat("base", "owned"))
    held = found.where(F.size("spans") > 0).select(
        F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"), F.col("spans").alias("of_spans")).distinct()
    held = materialized(docs.sparkSession, held, "secret-spans")
    text = F.col("text")
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("of_key"))
    cleaned = F.when(F.col("of_spans").isNull(), text).otherwise(redact(text, F.col("of_spans")))
    return unwrapped(wrapped(docs).join(held, same, "left"), docs.columns, text=cleaned)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document; a source is an owner, its languages are its repositories."""
    docs = table(spark, sf_dir, "documents")
    spans = scan(docs, F.col("source"), F.concat_ws("/", "source", "lang"))

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans.select(
        "doc_id", *[number(k) for k in BASE_KINDS], F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.array_sort(F.concat("base", "owned"))).alias("spans"),
    )


def _spans_sql(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    pieces = f"string_split_regex(text, '{quoted}')"
    matches = f"regexp_extract_all(text, '{quoted}')"
    values = f"regexp_extract_all(text, '{quoted}', {group})"
    return f"""
  SELECT row_id, start, start + length(match) AS until, {rank} AS rank, '{kind}' AS kind, value FROM (
    SELECT row_id, matches[i] AS match, vals[i] AS value,
           (list_sum(list_transform(pieces[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(matches[1:i-1], lambda x: length(x))), 0))::INTEGER AS start
    FROM (SELECT row_id, pieces, matches, vals, unnest(range(1, len(matches) + 1)) AS i
          FROM (SELECT row_id, {pieces} AS pieces, {matches} AS matches, {values} AS vals FROM rows_
                WHERE regexp_matches(text, '{quoted}'))))
  WHERE length(value) >= {least}"""


def _op9_sql() -> str:
    base = " UNION ALL ".join(
        _spans_sql(kind, rank, pattern, group, least)
        for rank, (kind, (pattern, group, least)) in enumerate(BASE_KINDS.items()))
    token = _spans_sql("owned", len(BASE_KINDS), TOKEN_PLAIN, 0, 24)
    spell = "kind || ':' || start || ':' || until"
    return f"""
WITH rows_ AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner,
         concat_ws('/', source, lang) AS repository FROM documents),
base AS MATERIALIZED ({base}),
tokens AS MATERIALIZED (
  SELECT t.* FROM ({token}) t WHERE regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.row_id = t.row_id AND b.start <= t.start AND t.until <= b.until)),
live AS (
  SELECT value FROM (SELECT row_id, value FROM base UNION ALL SELECT row_id, value FROM tokens)
  JOIN rows_ USING (row_id) GROUP BY value
  HAVING count(DISTINCT owner) <= {MAX_OWNERS} AND count(DISTINCT owner || chr(0) || repository) <= {MAX_REPOSITORIES}),
kept AS (SELECT * FROM base UNION ALL SELECT * FROM tokens WHERE value IN (SELECT value FROM live)),
per_row AS (
  SELECT row_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg({spell}, ',' ORDER BY start, rank) FILTER (WHERE kind <> 'owned') AS base_text,
         string_agg({spell}, ',' ORDER BY start, rank) AS spans
  FROM kept GROUP BY row_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base_text, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM rows_ LEFT JOIN per_row USING (row_id)"""


OP9_SQL = _op9_sql()
