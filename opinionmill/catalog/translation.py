"""Rewriting, protection, status, language and text pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinionmill.catalog.registry import HOSTILE_WORDS, clean_sql, label_sql, query
from opinionmill.functions import rewrite
from opinionmill.functions.labels import contains_pattern
from opinionmill.functions.rewrite import ABBREVIATIONS, GREAT_EXCEPTIONS
from opinionmill.functions.text import sentences
from opinionmill.operators import language, metrics, pairs, translate
from opinionmill.sources import adapters


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def replaced(expression: str, pattern: str, replacement: str, flags: str = "g") -> str:
    return f"regexp_replace({expression}, {quoted(pattern)}, {quoted(replacement)}, '{flags}')"


def normalize_sql(column: str) -> list[str]:
    """CTE bodies that redo ``normalize_informal`` without lookarounds or backreferences.

    Long letter runs are shortened on the list of characters, exceptions to the "great" rule
    are marked first, and word borders are spelled out (each rule runs twice because a border
    character cannot serve two neighbouring matches).
    """
    squeezed = rf"trim(regexp_replace({column}, '\s+', ' ', 'g'))"
    marks = squeezed
    for mark in ("!", "?", "."):
        marks = replaced(marks, rf"\{mark}{{3,}}", mark)
    runs = r"""array_to_string(list_filter(c, lambda x, i: NOT (
        regexp_full_match(x, '[\pL\pM\pN_]') AND i > 2 AND c[i - 1] = x AND c[i - 2] = x
        AND ((i < len(c) AND c[i + 1] = x) OR (i > 3 AND c[i - 3] = x)))), '')"""
    exceptions = "|".join(GREAT_EXCEPTIONS)
    great = replaced("s", rf"(^|[.!?]\s+)(great) (({exceptions})([^\pL\pM\pN_]|$))", "\\1\\2\x01\\3", "gi")
    great = replaced(great, r"(^|[.!?]\s+)great ([\pL\pM\pN_])", r"\1An awesome \2", "gi")
    great = replaced(great, "\x01", " ")
    rules = "s"
    word = r"[\pL\pM\pN_]"
    for pattern, spelled in ABBREVIATIONS:
        core = pattern.removeprefix(r"\b").removesuffix(r"\b")
        if core.endswith("/"):
            for _ in range(2):
                rules = replaced(rules, rf"(^|[^\pL\pM\pN_]){core}({word})", rf"\1{spelled}\2", "gi")
            continue
        for _ in range(2):
            rules = replaced(rules, rf"(^|[^\pL\pM\pN_]){core}([^\pL\pM\pN_]|$)", rf"\1{spelled}\2", "gi")
    return [marks, runs, great, rules]


def normalized_ctes(source: str) -> str:
    """CTEs from ``source`` (doc_id, text) to ``normalized`` (doc_id, s)."""
    marks, runs, great, rules = normalize_sql("text")
    return f"""
n1 AS (SELECT doc_id, {marks} AS s FROM {source}),
n2 AS (SELECT doc_id, string_split(s, '') AS c FROM n1),
n3 AS (SELECT doc_id, {runs} AS s FROM n2),
n4 AS (SELECT doc_id, {great} AS s FROM n3),
normalized AS (SELECT doc_id, {rules} AS s FROM n4)"""


@query("normalize_informal", f"WITH {normalized_ctes('documents')} SELECT doc_id AS row_id, s AS normalized_text FROM normalized")
def normalize_informal(spark, sf_dir):
    return adapters.documents(spark, sf_dir).select(
        F.col("doc_id").alias("row_id"), rewrite.normalize_informal(F.col("text")).alias("normalized_text")
    )


@query("status_by_language", r"""
WITH s AS (SELECT doc_id, lang, regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '') AS t FROM documents)
SELECT doc_id AS row_id, lang AS language,
       CASE WHEN t = '' THEN 'empty' WHEN lang = 'de' THEN 'already_german'
            WHEN lang NOT IN ('en', 'unknown') THEN 'unsupported_language'
            WHEN length(t) > 2000 THEN 'translated_truncated' ELSE 'translated' END AS status,
       length(t) > 2000 AS truncated, substr(t, 1, 2000) AS clipped_text
FROM s""")
def status_by_language(spark, sf_dir):
    text = F.col("text")
    return adapters.documents(spark, sf_dir).select(
        F.col("doc_id").alias("row_id"), F.col("lang").alias("language"),
        rewrite.translation_status(text, F.col("lang")).alias("status"),
        rewrite.is_truncated(text).alias("truncated"), rewrite.clipped_input(text).alias("clipped_text"),
    )


# Names to protect that do occur in the corpus, with one inside another.
CORPUS_TERMS = ("the", "of the", "worthless", "idiot", "on")


def protected_documents(spark, sf_dir):
    docs = adapters.documents(spark, sf_dir).select(F.col("doc_id").alias("row_id"), "text")
    return rewrite.protect_terms(docs, "text", terms=CORPUS_TERMS)


@query("protect_restore_roundtrip", "SELECT doc_id AS row_id, text AS restored_text FROM documents")
def protect_restore_roundtrip(spark, sf_dir):
    protected = protected_documents(spark, sf_dir)
    return protected.select(
        "row_id", rewrite.restore_terms(F.col("protected_text"), F.col("protected_terms")).alias("restored_text")
    )


@query("protected_term_counts", r"""
WITH p1 AS (SELECT doc_id, regexp_extract_all(text, '(?i)(?:^|[^\pL\pM\pN_])worthless?s?(?:[^\pL\pM\pN_]|$)') AS w,
                   text FROM documents)
SELECT doc_id AS row_id, len(w)::BIGINT AS hits FROM p1""")
def protected_term_counts(spark, sf_dir):
    docs = adapters.documents(spark, sf_dir).select(F.col("doc_id").alias("row_id"), "text")
    protected = rewrite.protect_terms(docs, "text", terms=["worthless"])
    return protected.select("row_id", F.size("protected_terms").cast("long").alias("hits"))


@query("fix_german", r"""
WITH f AS (SELECT doc_id, regexp_replace(text, ' (der|die|das) ', ' \1 eine gute Tablette ', 'g') AS t
           FROM documents WHERE lang = 'de')
SELECT doc_id AS row_id, replace(t, ' eine gute Tablette ', ' ein gutes Tablet ') AS german_text FROM f""")
def fix_german(spark, sf_dir):
    # Phrases to correct are planted after the articles of every German text.
    german = adapters.documents(spark, sf_dir).where("lang = 'de'")
    planted = F.regexp_replace("text", " (der|die|das) ", " $1 eine gute Tablette ")
    return german.select(F.col("doc_id").alias("row_id"), rewrite.fix_german(planted).alias("german_text"))


# A phrase for each rule of the German corrections, and what must become of it.
GERMAN_CASES = (
    ("viele Tabletten hier", "viele Tablets hier"), ("die beste Tablette", "die bestes Tablet"),
    ("zwei Tablettes da", "zwei Tablets da"), ("Diese Tablette", "Dieses Tablet"), ("keine Tablette", "kein Tablet"),
    ("schnelle Tablette", "schnelles Tablet"), ("Eine gute Tablette", "Ein gutes Tablet"),
)


def _cases_sql(column: int) -> str:
    arms = " ".join(f"WHEN {i} THEN '{case[column]}'" for i, case in enumerate(GERMAN_CASES))
    return f"CASE doc_id % {len(GERMAN_CASES)} {arms} END"


@query("german_rules", f"SELECT doc_id AS row_id, text || ' ' || {_cases_sql(1)} AS german_text FROM documents")
def german_rules(spark, sf_dir):
    """Every text ends in a phrase that one of the seven rules must correct."""
    planted = F.concat_ws(" ", "text", F.expr(_cases_sql(0)))
    docs = adapters.documents(spark, sf_dir)
    return docs.select(F.col("doc_id").alias("row_id"), rewrite.fix_german(planted).alias("german_text"))


@query("protected_names", """
SELECT doc_id AS row_id, 'PRD0X and PRD1X by PRD2X. ' || text AS protected_text, 'Kindle Fire|Echo dots|Amazon' AS names
FROM documents""")
def protected_names(spark, sf_dir):
    """Names planted in front of every text are swapped for numbered tokens, the longest first."""
    planted = F.concat(F.lit("Kindle Fire and Echo dots by Amazon. "), "text").alias("text")
    docs = adapters.documents(spark, sf_dir).select(F.col("doc_id").alias("row_id"), planted)
    out = rewrite.protect_terms(docs, "text")
    return out.select("row_id", "protected_text", F.array_join("protected_terms", "|").alias("names"))


@query("sentence_split", r"""
WITH marked AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))) AS sentence
                FROM documents)
SELECT doc_id AS row_id, count(*) AS sentences, max(length(sentence))::BIGINT AS longest,
       md5(string_agg(sentence, '|' ORDER BY sentence)) AS digest
FROM marked WHERE NOT regexp_full_match(sentence, '\s*') GROUP BY doc_id""")
def sentence_split(spark, sf_dir):
    parts = sentences(F.col("text"))
    rows = adapters.documents(spark, sf_dir).select(F.col("doc_id").alias("row_id"), parts.alias("parts")).where("size(parts) > 0")
    return rows.select(
        "row_id", F.size("parts").cast("long").alias("sentences"),
        F.array_max(F.transform("parts", lambda p: F.length(p))).cast("long").alias("longest"),
        F.md5(F.array_join(F.sort_array("parts"), "|").cast("binary")).alias("digest"),
    )


@query("translation_preparation", rf"""
WITH stripped AS (
  SELECT doc_id, regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '') AS t FROM documents WHERE lang = 'en'),
clipped AS (SELECT doc_id, substr(t, 1, 2000) AS text, t FROM stripped),{normalized_ctes('clipped')}
SELECT c.doc_id AS row_id, CASE WHEN length(t) > 2000 THEN 'translated_truncated' ELSE 'translated' END AS status,
       s AS protected_text
FROM clipped c JOIN normalized n ON n.doc_id = c.doc_id WHERE t <> ''""")
def translation_preparation(spark, sf_dir):
    docs = adapters.documents(spark, sf_dir).select(
        F.col("doc_id").alias("row_id"), "text", F.col("lang").alias("language"))
    prepared = translate.prepare(docs)
    return prepared.where(F.col("status").startswith("translated")).select("row_id", "status", "protected_text")


def repeat_texts():
    return lambda texts: texts


@query("translation_stage", """
SELECT doc_id AS row_id, CASE WHEN trim(text) = '' THEN 'empty' WHEN lang = 'de' THEN 'already_german'
       WHEN lang IN ('fr', 'es') THEN 'unsupported_language' ELSE 'translated' END AS kind FROM documents""")
def translation_stage(spark, sf_dir):
    docs = adapters.documents(spark, sf_dir).select(
        F.col("doc_id").alias("row_id"), "text", F.col("lang").alias("language"))
    done = translate.translate(translate.prepare(docs), repeat_texts)
    kind = F.when(F.col("status").startswith("translated") & F.col("translation").isNotNull(), "translated").otherwise(F.col("status"))
    return done.select("row_id", kind.alias("kind"))


@query("language_id")
def language_id(spark, sf_dir):
    """Trained on four rows in five; the others show how well it does."""
    docs = adapters.documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language.fit_language_model(docs.where(language.in_training()))
    found = language.detect_language(model, docs.withColumn("held_out", ~language.in_training()))
    return found.select(F.col("doc_id").alias("row_id"), "lang", "language", "held_out")


@query("language_accuracy", f"""
WITH judged AS (SELECT lang, count(*) AS texts FROM documents
                WHERE len(regexp_extract_all(text, '[A-Za-zÄÖÜäöüß]')) >= 3 GROUP BY 1)
SELECT lang, texts, TRUE AS nine_in_ten_found FROM judged""")
def language_accuracy(spark, sf_dir):
    """Texts with enough letters per language, and whether nine in ten of the held-out ones are recognised."""
    found = language_id(spark, sf_dir).where("language <> 'unknown'")
    right = F.avg(F.when(F.col("held_out"), (F.col("lang") == F.col("language")).cast("double")))
    return found.groupBy("lang").agg(F.count(F.lit(1)).alias("texts"), (F.coalesce(right, F.lit(1.0)) >= 0.9).alias("nine_in_ten_found"))


def bleu_tokens_sql(column: str) -> str:
    line = f"' ' || {column} || ' '"
    for pattern, to in pairs.BLEU_TOKEN_RULES:
        line = replaced(f"({line})", pattern, to.replace("$1", "\\1").replace("$2", "\\2"))
    return rf"regexp_extract_all({line}, '\S+')"


PAIRS = """
turn_pairs AS (
  SELECT u.conv_id || ':' || u.turn AS pair_id, u.text AS reference, a.text AS candidate
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""
TOKENS = f"""{PAIRS},
tok AS (SELECT pair_id, {bleu_tokens_sql('reference')} AS r, {bleu_tokens_sql('candidate')} AS c FROM turn_pairs)"""
ORDERS = " UNION ALL ".join(
    f"SELECT pair_id, {n} AS n, unnest([array_to_string(r[i:i + {n - 1}], ' ') for i in range(1, len(r) - {n - 2})]) AS gram, 0 AS c, 1 AS r FROM tok"
    f" UNION ALL SELECT pair_id, {n}, unnest([array_to_string(c[i:i + {n - 1}], ' ') for i in range(1, len(c) - {n - 2})]), 1, 0 FROM tok"
    for n in range(1, 5)
)


@query("corpus_bleu", f"""
WITH {TOKENS}, grams AS ({ORDERS}),
merged AS (SELECT pair_id, n, gram, sum(c) AS c, sum(r) AS r FROM grams GROUP BY ALL),
stats AS (SELECT n, sum(least(c, r)) AS m, sum(c) AS t FROM merged GROUP BY n),
lens AS (SELECT sum(len(c)) AS cl, sum(len(r)) AS rl FROM tok),
smoothed AS (SELECT n, m, t, sum(CASE WHEN m = 0 THEN 1 ELSE 0 END) OVER (ORDER BY n) AS k FROM stats)
SELECT round(100 * CASE WHEN any_value(cl) >= any_value(rl) THEN 1 ELSE exp(1 - any_value(rl) / any_value(cl)) END
       * exp(sum(ln(CASE WHEN m > 0 THEN m ELSE 1 / pow(2, k) END / t)) / 4), 6) AS bleu,
       any_value(cl)::BIGINT AS candidate_length, any_value(rl)::BIGINT AS reference_length,
       max(m) FILTER (n = 1)::BIGINT AS matches_1, max(m) FILTER (n = 4)::BIGINT AS matches_4,
       max(t) FILTER (n = 4)::BIGINT AS total_4
FROM smoothed CROSS JOIN lens""")
def corpus_bleu(spark, sf_dir):
    return pairs.corpus_bleu(adapters.turn_pairs(spark, sf_dir)).select(
        F.round("bleu", 6).alias("bleu"), "candidate_length", "reference_length", "matches_1", "matches_4", "total_4"
    )


ROUGE_TOKENS = f"""{PAIRS},
tok AS (SELECT pair_id, list_filter(string_split({clean_sql('reference')}, ' '), lambda x: x <> '') AS r,
               list_filter(string_split({clean_sql('candidate')}, ' '), lambda x: x <> '') AS c FROM turn_pairs)"""


@query("rouge1", f"""
WITH {ROUGE_TOKENS},
grams AS (SELECT pair_id, unnest(r) AS g, 0 AS c, 1 AS r FROM tok UNION ALL SELECT pair_id, unnest(c), 1, 0 FROM tok),
merged AS (SELECT pair_id, g, sum(c) AS c, sum(r) AS r FROM grams GROUP BY ALL),
per_pair AS (SELECT pair_id, sum(least(c, r)) AS m FROM merged GROUP BY 1)
SELECT t.pair_id, COALESCE(round(2 * m / NULLIF(len(t.c) + len(t.r), 0), 6), 0) AS rouge1_f
FROM tok t LEFT JOIN per_pair USING (pair_id)""")
def rouge1(spark, sf_dir):
    out = pairs.rouge1(adapters.turn_pairs(spark, sf_dir))
    return out.select("pair_id", F.round("rouge1_f", 6).alias("rouge1_f"))


# The table of longest common subsequences, one reference word a step; a row of it is a running maximum.
ROUGE_L_SQL = f"""
WITH RECURSIVE {ROUGE_TOKENS},
steps AS (
  SELECT pair_id, r, c, 0 AS i, [0 FOR x IN c] AS row FROM tok
  UNION ALL
  SELECT pair_id, r, c, i + 1,
         [list_max([greatest(row[k], CASE WHEN c[k] = r[i + 1] THEN 1 + CASE WHEN k > 1 THEN row[k - 1] ELSE 0 END ELSE 0 END)
                    FOR k IN range(1, j + 1)]) FOR j IN range(1, len(c) + 1)]
  FROM steps WHERE i < len(r)),
done AS (SELECT pair_id, len(c) AS nc, len(r) AS nr, COALESCE(row[len(c)], 0) AS lcs FROM steps WHERE i = len(r))
SELECT pair_id, COALESCE(round(2 * lcs / NULLIF(nc + nr, 0), 6), 0) AS rougeL_f FROM done"""


@query("rougeL", ROUGE_L_SQL)
def rouge_l(spark, sf_dir):
    out = pairs.rouge_l(adapters.turn_pairs(spark, sf_dir))
    return out.select("pair_id", F.round("rougeL_f", 6).alias("rougeL_f"))


HOSTILE = "|".join(HOSTILE_WORDS)


# Words the stand-in for a back translation loses, anywhere in a text.
LOST_WORDS = "trash|clown|the"


def back_translated(text):
    """The whole text with some words changed, as a translation there and back would."""
    return F.regexp_replace(text, rf"\b(?:{LOST_WORDS})\b", "thing")


def both_predictions(spark, sf_dir):
    """Rated documents with a label from the raw and one from the stand-in for its back translation."""
    rated = adapters.reviews_text(spark, sf_dir).where("rating IS NOT NULL")
    word = rf"\b(?:{HOSTILE})\b"
    label = lambda text: F.when(contains_pattern(text, word), "negative").otherwise("positive")
    return rated.select(
        "row_id", F.when(F.col("rating") <= 2, "negative").when(F.col("rating") == 3, "neutral")
        .otherwise("positive").alias("sentiment"),
        label(F.col("raw_text")).alias("pred_original"),
        label(back_translated(F.col("raw_text"))).alias("pred_back"),
    ).withColumn("sentiment_preserved", F.col("pred_original") == F.col("pred_back"))


@query("preservation_rate", rf"""
WITH rated AS (
  SELECT text, CASE WHEN toxic = 1 THEN 1 WHEN quality = 0 THEN 3 ELSE 5 END AS rating
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
labelled AS (
  SELECT {label_sql('rating')} AS sentiment,
         regexp_matches(lower(text), '(^|[^\pL\pM\pN_])({HOSTILE})([^\pL\pM\pN_]|$)') AS a,
         regexp_matches(lower(regexp_replace(text, '(^|[^\pL\pM\pN_])({LOST_WORDS})([^\pL\pM\pN_]|$)', '\1thing\3', 'g')), '(^|[^\pL\pM\pN_])({HOSTILE})([^\pL\pM\pN_]|$)') AS b
  FROM rated)
SELECT sentiment, round(avg((a = b)::INT), 6) AS rate, count(*) AS n FROM labelled GROUP BY 1
UNION ALL SELECT 'all', round(avg((a = b)::INT), 6), count(*) FROM labelled""")
def preservation_rate(spark, sf_dir):
    rates = metrics.preservation_rates(both_predictions(spark, sf_dir))
    return rates.withColumn("rate", F.round("rate", 6))


@query("pair_metrics")
def pair_metrics(spark, sf_dir):
    docs = adapters.reviews_text(spark, sf_dir).select(
        "row_id", F.col("raw_text").alias("original"),
        F.coalesce(back_translated(F.col("raw_text")), F.lit("")).alias("back_translation"),
    )
    sample = both_predictions(spark, sf_dir).join(docs, "row_id").withColumn(
        "status", F.when(F.length("original") > rewrite.MAX_INPUT_CHARS, "translated_truncated").otherwise("translated"))
    return pairs.pair_metrics(sample).drop("note")
