"""Summary tasks, extractive summaries and category articles."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinionmill.functions.formats import joined_examples, percent, thousands, two_decimals
from opinionmill.functions.text import sentences, strip, word_count
from opinionmill.functions.tokens import without_stop_words, word_tokens
from opinionmill.operators.features import number_list, vocabulary
from opinionmill.operators.ranking import first_rows
from opinionmill.operators.text_stage import TextFunction, apply_to_texts
from opinionmill.operators.vector_blocks import stored_vectors

# Shortest input worth summarising and the bounds of the output length.
SHORT_INPUT_TOKENS = 40
MAX_OUTPUT, MIN_OUTPUT, OUTPUT_SHARE = 90, 20, 0.7

# Sentences of the article template.
SHORT_NOTE = "Representative review evidence (not model-summarized because the excerpt is short): "
CUT_NOTE = (
    "Representative review evidence (the model output ended mid-sentence, so the source is shown instead): "
)
MODEL_LABEL = "Model summary: "
NO_POSITIVE = "No positive examples were available."
NO_NEGATIVE = "No negative examples were available in the selected review sample."
NO_COMPLAINT = (
    "No negative review examples were available in the selected sample; "
    "this is not evidence that the product has no complaints."
)
NO_LOWEST_COMPLAINT = "No negative review examples were available in the selected sample."
UNUSABLE = "The model did not return a usable complaint summary."
ORDER_NOTE = (
    "\nProducts are ordered by mean rating (with review count as a tie-breaker); "
    "the differences reported here are limited to rating and review evidence.\n\n"
)
AVOID_NOTE = "A relative ranking alone is not enough evidence to recommend avoiding this product.\n\n"
TAKEAWAY = (
    "### Buying takeaway\n\n"
    "Use the category average and product-level review counts as context. "
    "Complaint summaries reflect only the sampled reviews processed by the "
    "local model; check the source reviews before making a purchase decision.\n\n"
)


# Label of sentences that no model has written.
EXTRACT_LABEL = "Sentences from the reviews: "


def output_budget(tokens: Column) -> Column:
    """Longest and shortest summary for an input of so many tokens."""
    longest = F.greatest(F.lit(MIN_OUTPUT), F.least(F.lit(MAX_OUTPUT), F.floor(tokens * F.lit(OUTPUT_SHARE)).cast("int")))
    shortest = F.least(F.lit(10), F.floor(longest / 3).cast("int"))
    return F.struct(longest.alias("max_tokens"), shortest.alias("min_tokens"))


def batch_budget(texts: list[str]) -> dict[str, int]:
    """The budget of a batch, which its shortest input decides."""
    tokens = min((len(text.split()) for text in texts), default=0)
    longest = max(MIN_OUTPUT, min(MAX_OUTPUT, int(tokens * OUTPUT_SHARE)))
    return {"max_tokens": longest, "min_tokens": min(10, longest // 3)}


def is_complete(summary: Column) -> Column:
    """Whether a summary ends with a sentence mark."""
    return F.coalesce(strip(summary).rlike(r"[.!?]\z"), F.lit(False))


def input_route(tokens: Column) -> Column:
    """Short evidence is quoted, longer evidence goes to the text function."""
    return F.when(tokens < SHORT_INPUT_TOKENS, "quote").otherwise("summarize")


def summary_tasks(briefs: DataFrame) -> DataFrame:
    """One row per text to summarise: category sides, top products, lowest product.

    The lowest product is left out when it is also a top product; empty evidence is skipped.
    """
    def task(key: Column, examples: Column) -> Column:
        return F.struct(key.alias("key"), examples.alias("examples"))

    def product_task(product: Column) -> Column:
        return task(F.concat(F.lit("product:"), product["name"]), product["negative_review_examples"])

    top = F.col("highest_rated_products")
    low = F.col("lowest_rated_product")
    is_top = F.exists(top, lambda p: p["name"] == low["name"])
    lowest = F.when(low.isNotNull() & ~F.coalesce(is_top, F.lit(False)), F.array(product_task(low)))
    no_tasks = F.array().cast("array<struct<key:string,examples:array<struct<product:string,rating:string,review:string>>>>")
    tasks = F.concat(
        F.array(
            task(F.lit("category_positive"), F.col("positive_review_examples")),
            task(F.lit("category_negative"), F.col("negative_review_examples")),
        ),
        F.coalesce(F.transform(top, product_task), no_tasks),
        F.coalesce(lowest, no_tasks),
    )
    text = joined_examples(F.col("examples"), "\n")
    return (
        briefs.select("cluster_id", F.inline(tasks)).where(F.size("examples") > 0)
        .withColumn("text", text)
        .withColumn("n_tokens", word_count(F.col("text")))
        .withColumn("route", input_route(F.col("n_tokens")))
    )


def summarize_tasks(tasks: DataFrame, make_function: Callable[[], TextFunction] | None = None, batch_size: int = 2,
                    label: str | None = None, budgeted: bool = False) -> DataFrame:
    """Text shown for each task: a quote, a labelled summary, or the source of a cut one.

    A ``budgeted`` function is called with ``max_tokens`` and ``min_tokens`` of its batch (F28). Without a
    text function the heaviest sentences of the evidence are the summary (G6), and the label says so.
    """
    label = label or (MODEL_LABEL if make_function else EXTRACT_LABEL)
    if make_function is None:
        done = _with_extracts(tasks)
    else:
        longer = tasks.withColumn("_inputs", F.when(F.col("route") == "summarize", F.array("text")))
        done = apply_to_texts(longer, "_inputs", "_outputs", make_function, batch_size, batch_budget if budgeted else None)
        done = done.withColumn("_summary", F.get("_outputs", F.lit(0)))
    summary = strip(F.col("_summary"))
    quoted = joined_examples(F.col("examples"))
    shown = (
        F.when(F.col("route") == "quote", F.concat(F.lit(SHORT_NOTE), quoted))
        .when(is_complete(summary), F.concat(F.lit(label), summary))
        .otherwise(F.concat(F.lit(CUT_NOTE), quoted))
    )
    return done.select("cluster_id", "key", shown.alias("summary"))


def _with_extracts(tasks: DataFrame) -> DataFrame:
    """Add ``_summary``: two sentences per task, every example line counting as one."""
    keyed = tasks.withColumn("_task", F.concat_ws("\u0001", F.col("cluster_id").cast("string"), "key"))
    closed = F.regexp_replace(F.concat("text", F.lit("\n")), r"([^.!?])\n", "$1.\n")
    longer = keyed.where("route = 'summarize'").select("_task", closed.alias("_closed"))
    extracts = extractive_summaries(longer, "_task", "_closed").withColumnRenamed("summary", "_summary")
    return keyed.join(extracts.withColumn("_summary", F.regexp_replace("_summary", r"\n+", " ")), "_task", "left")


def sentence_weights(df: DataFrame, key: str, text: str, stop_words: Sequence[str] | None = None,
                     max_features: int = 5000) -> DataFrame:
    """Every sentence with its weight: inverse document frequencies of its vocabulary terms,
    added up over the occurrences and divided by the root of the word count."""
    listed = df.select(key, F.posexplode(sentences(F.col(text))).alias("position", "sentence"))
    tokens = without_stop_words(word_tokens(F.col("sentence")), stop_words)
    found = vocabulary(listed, tokens, max_features).collect()
    total = listed.count()
    words = F.sqrt(F.greatest(word_count(F.col("sentence")), F.lit(1)).cast("double"))
    if not found:
        return listed.withColumn("weight", F.lit(0.0))
    # the counts of a sentence lie in its own row, as the vector of a fitted vocabulary stage
    stage = CountVectorizerModel.from_vocabulary([r["term"] for r in found], inputCol="_terms", outputCol="_counts")
    counted = stored_vectors(stage.transform(listed.withColumn("_terms", tokens)).drop("_terms"), "_counts")
    idf = number_list([math.log((total + 1.0) / (r["df"] + 1.0)) + 1.0 for r in found])
    parts = F.zip_with("_counts.indices", "_counts.values", lambda i, n: n * F.element_at(idf, i + 1))
    added = F.aggregate(parts, F.lit(0.0), lambda sum_, x: sum_ + x)
    return counted.select(key, "position", "sentence", F.round(added / words, 6).alias("weight"))


def extractive_summaries(df: DataFrame, key: str, text: str, sentences_kept: int = 2,
                         stop_words: Sequence[str] | None = None) -> DataFrame:
    """Our stand-in for a pretrained summariser: the heaviest sentences in text order."""
    weighted = sentence_weights(df, key, text, stop_words)
    best = first_rows(weighted, [key], [F.desc("weight"), F.asc("position")], sentences_kept)
    ordered = F.sort_array(F.collect_list(F.struct("position", "sentence")))
    return best.groupBy(key).agg(
        F.array_join(F.transform(ordered, lambda s: s["sentence"]), " ").alias("summary")
    )


def _product_line(summaries: Column) -> Callable[[Column, Column], Column]:
    def line(product: Column, position: Column) -> Column:
        found = F.element_at(summaries, F.concat(F.lit("product:"), product["name"]))
        evidence = F.when(found.isNotNull(), found).when(
            F.size(product["negative_review_examples"]) > 0, F.lit(UNUSABLE)
        ).otherwise(F.lit(NO_COMPLAINT))
        return F.concat(
            (position + 1).cast("string"), F.lit(". **"), product["name"], F.lit("** — "),
            two_decimals(product["mean_rating"]), F.lit("/5 from "), thousands(product["review_count"]),
            F.lit(" reviews, including "), thousands(product["negative_review_count"]),
            F.lit(" negative. Product-specific complaint evidence: "), evidence, F.lit("\n"),
        )

    return line


def articles(briefs: DataFrame, summaries: DataFrame) -> DataFrame:
    """One article per category from the fixed template (G7): cluster_id, article."""
    texts = summaries.groupBy("cluster_id").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "summary"))).alias("texts")
    )
    none = F.create_map().cast("map<string,string>")
    joined = briefs.join(texts, "cluster_id", "left").withColumn("texts", F.coalesce("texts", none))
    said = lambda key, otherwise: F.coalesce(F.element_at("texts", F.lit(key)), F.lit(otherwise))
    low = F.col("lowest_rated_product")
    low_said = F.element_at("texts", F.concat(F.lit("product:"), low["name"]))
    low_evidence = F.when(low_said.isNotNull(), low_said).when(
        F.size(low["negative_review_examples"]) > 0, F.lit(UNUSABLE)
    ).otherwise(F.lit(NO_LOWEST_COMPLAINT))
    overview = F.concat(
        F.lit("## "), F.col("cluster_name"), F.lit("\n\nThis category contains **"), F.col("product_count").cast("string"),
        F.lit(" products** and **"), thousands(F.col("review_count")), F.lit(" reviews**, with an average rating of **"),
        two_decimals(F.col("mean_rating")), F.lit("/5**. "), percent(F.col("positive_share")),
        F.lit(" of assigned reviews are positive and "), percent(F.col("negative_share")), F.lit(" are negative.\n\n"),
    )
    themes = F.concat(
        F.lit("### Review themes\n\n- **Positive examples:** "), said("category_positive", NO_POSITIVE),
        F.lit("\n- **Negative examples:** "), said("category_negative", NO_NEGATIVE), F.lit("\n\n"),
    )
    ranking = F.concat(
        F.lit("### Top 3 products and differences\n\n"),
        F.array_join(F.transform("highest_rated_products", _product_line(F.col("texts"))), ""),
        F.lit(ORDER_NOTE),
    )
    lowest = F.when(low.isNotNull(), F.concat(
        F.lit("### Lowest-rated product in this comparison\n\n**"), low["name"],
        F.lit("** has the lowest average rating among eligible products ("), two_decimals(low["mean_rating"]),
        F.lit("/5 from "), thousands(low["review_count"]), F.lit(" reviews, including "),
        thousands(low["negative_review_count"]), F.lit(" negative). Sampled negative-review evidence: "),
        low_evidence, F.lit("\n\n" + AVOID_NOTE),
    )).otherwise(F.lit(""))
    return joined.select(
        "cluster_id", F.concat(overview, themes, ranking, lowest, F.lit(TAKEAWAY)).alias("article")
    )


def drafts(briefs: DataFrame, written: DataFrame, model: str, inference: str = "local") -> DataFrame:
    """Articles with their provenance and the numbers they rest on."""
    return briefs.join(written, "cluster_id").select(
        "cluster_id", "cluster_name", F.lit(model).alias("model"), F.lit(inference).alias("inference"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("generated_at_utc"),
        "review_count", "product_count", "mean_rating", "negative_share", "positive_share", "article",
    ).orderBy("cluster_id")


def response_drafts(requests: DataFrame, briefs: DataFrame, make_function: Callable[[], TextFunction],
                    model: str) -> DataFrame:
    """Draft rows from request rows and a caller-supplied text function, with time and statistics.

    An empty answer fails the query instead of being saved.
    """
    message = F.concat_ws("\n\n", "system_text", "user_text")
    answered = apply_to_texts(
        requests.withColumn("_inputs", F.array(message)), "_inputs", "_outputs", make_function, batch_size=1
    )
    article = strip(F.get("_outputs", F.lit(0)))
    failed = F.raise_error(F.lit("The model returned an empty article.")).cast("string")
    numbers = ["review_count", "product_count", "mean_rating", "negative_share", "positive_share"]
    return answered.join(briefs.select("cluster_id", *numbers), "cluster_id").select(
        "cluster_id", "cluster_name", F.lit(model).alias("model"), "prompt_variant",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("generated_at_utc"),
        *numbers, F.when(article == "", failed).otherwise(article).alias("article"),
    )

