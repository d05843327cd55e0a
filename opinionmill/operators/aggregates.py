"""Product, category and dashboard aggregates.

Counts per label, source or theme are conditional sums inside one grouped pass and are
unfolded afterwards. That yields the zero rows without a join and without multiplying the
input rows, and partial aggregation keeps a hot key from reaching one task as raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinionmill.functions.labels import COMPLAINT_THEMES, SENTIMENTS, theme_flags
from opinionmill.functions.text import length_bucket
from opinionmill.operators.quantiles import exact_quantiles
from opinionmill.operators.ranking import first_rows
from opinionmill.operators.reshape import ALL_CATEGORIES, long_counts, select_category

# Label sources of the dashboard and the columns that hold them.
SENTIMENT_SOURCES = {"model": "model_sentiment", "rating": "sentiment"}

# Fixed value: name of the category for rows without one.
NO_CATEGORY = "Unclassified"


def share_of(column: str, label: str) -> Column:
    return F.avg(F.when(F.col(column) == label, 1.0).otherwise(0.0))


def count_of(condition: Column) -> Column:
    return F.count_if(condition)


def product_stats(reviews: DataFrame) -> DataFrame:
    """Review count, mean rating and label shares per product (A1)."""
    return reviews.groupBy("product_name").agg(
        F.count(F.lit(1)).alias("review_count"),
        F.avg("rating").alias("mean_rating"),
        *[share_of("sentiment", s).alias(f"{s}_share") for s in SENTIMENTS],
    )


def category_texts(reviews: DataFrame) -> DataFrame:
    """Sorted distinct category strings of a product, joined by a space (A4).

    Values are made distinct by a grouped pass first, so that what is collected per product
    is its list of different category strings and never its reviews.
    """
    value = F.btrim("categories")
    distinct = reviews.select("product_name", value.alias("category")).where("category <> ''").distinct()
    return distinct.groupBy("product_name").agg(
        F.array_join(F.sort_array(F.collect_list("category")), " ").alias("categories_text")
    )


def review_documents(reviews: DataFrame, per_product: int = 20) -> DataFrame:
    """The first texts of a product in row order, joined by a space (A5)."""
    first = first_rows(reviews.where(F.length("review_text") > 0), ["product_name"], [F.col("row_id")], per_product)
    ordered = F.sort_array(F.collect_list(F.struct("row_id", "review_text")))
    return first.groupBy("product_name").agg(
        F.array_join(F.transform(ordered, lambda r: r["review_text"]), " ").alias("review_document")
    )


def product_profiles(reviews: DataFrame, per_product: int = 20) -> DataFrame:
    """Product table for clustering: A1 with category text and review document."""
    return (
        product_stats(reviews)
        .join(category_texts(reviews), "product_name", "left")
        .join(review_documents(reviews, per_product), "product_name", "left")
        .withColumn("categories_text", F.coalesce("categories_text", F.lit("")))
        .withColumn("review_document", F.coalesce("review_document", F.lit("")))
    )


def cluster_profiles(products: DataFrame, key: str = "cluster_id") -> DataFrame:
    """Unweighted means over the products of a cluster (A2)."""
    return products.groupBy(key).agg(
        F.count(F.lit(1)).alias("product_count"),
        F.sum("review_count").alias("total_reviews"),
        F.avg("mean_rating").alias("mean_rating"),
        F.avg("negative_share").alias("negative_share"),
        F.avg("positive_share").alias("positive_share"),
    )


def category_summary(reviews: DataFrame, *keys: str) -> DataFrame:
    """Review-weighted category statistics (A3)."""
    return reviews.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("review_count"),
        F.count_distinct("product_name").alias("product_count"),
        F.avg("rating").alias("mean_rating"),
        share_of("sentiment", "negative").alias("negative_share"),
        share_of("sentiment", "positive").alias("positive_share"),
    )


def product_evidence(reviews: DataFrame, category: str = "cluster_id") -> DataFrame:
    """Product statistics inside a category."""
    return reviews.groupBy(category, "product_name").agg(
        F.count(F.lit(1)).alias("review_count"),
        F.avg("rating").alias("mean_rating"),
        count_of(F.col("sentiment") == "negative").alias("negative_review_count"),
        share_of("sentiment", "negative").alias("negative_share"),
    )


def _source_columns(sources: Mapping[str, str]) -> list[Column]:
    return [
        count_of(F.col(column) == label).alias(f"{source}_{label}")
        for source, column in sources.items()
        for label in SENTIMENTS
    ]


def category_sentiment(
    reviews: DataFrame, category: str = "cluster_name", sources: Mapping[str, str] = SENTIMENT_SOURCES
) -> DataFrame:
    """Count per category, source and label with zeros."""
    wide = reviews.groupBy(F.coalesce(F.col(category), F.lit(NO_CATEGORY)).alias("category")).agg(
        *_source_columns(sources)
    )
    records = [
        ({"source": source, "sentiment": label}, F.col(f"{source}_{label}"))
        for source in sources
        for label in SENTIMENTS
    ]
    return long_counts(wide, ["category"], records)


def product_metrics(
    reviews: DataFrame, category: str = "cluster_name", sources: Mapping[str, str] = SENTIMENT_SOURCES
) -> DataFrame:
    """One row per category and product with the counts of both sources."""
    return (
        reviews.groupBy(category, "product_name")
        .agg(
            F.count(F.lit(1)).alias("review_count"),
            F.avg("rating").alias("mean_rating"),
            *_source_columns(sources),
        )
        .withColumn("category", F.coalesce(F.col(category), F.lit(NO_CATEGORY)))
        .select(
            "category", "product_name", "review_count", "mean_rating",
            *[f"{source}_{label}" for source in sources for label in SENTIMENTS],
        )
    )


def length_sentiment(
    reviews: DataFrame, text: str = "review_text", sources: Mapping[str, str] = SENTIMENT_SOURCES
) -> DataFrame:
    """Count per length bucket, label and source, observed pairs only."""
    bucket = length_bucket(F.length(F.coalesce(F.col(text), F.lit(""))))
    observed = reviews.groupBy(bucket.alias("length_bucket"), *sources.values()).agg(
        F.count(F.lit(1)).alias("n")
    )
    pairs = F.array(*[
        F.struct(F.lit(source).alias("source"), F.col(column).alias("label"))
        for source, column in sources.items()
    ])
    return (
        observed.select("length_bucket", "n", F.inline(pairs))
        .where(F.col("label").isNotNull())
        .groupBy("length_bucket", F.col("label").alias("sentiment"), "source")
        .agg(F.sum("n").alias("count"))
    )


def theme_counts(
    reviews: DataFrame,
    category: str = "cluster_name",
    themes: Mapping[str, str] = COMPLAINT_THEMES,
    sources: Mapping[str, str] = SENTIMENT_SOURCES,
    text: str = "review_text",
) -> DataFrame:
    """Keyword matches among negative reviews, zeros kept (A10).

    Every pattern is tested once per row, for both sources together. A source has rows only
    for categories with at least one negative review in it.
    """
    is_negative = {s: F.coalesce(F.col(c) == "negative", F.lit(False)) for s, c in sources.items()}
    any_negative = F.lit(False)
    for flag in is_negative.values():
        any_negative = any_negative | flag
    flagged = reviews.where(any_negative).select(
        F.coalesce(F.col(category), F.lit(NO_CATEGORY)).alias("category"),
        *[flag.alias(f"negative_{source}") for source, flag in is_negative.items()],
        theme_flags(F.col(text), themes).alias("flags"),
    )
    wide = flagged.groupBy("category").agg(
        *[
            count_of(F.col(f"negative_{source}") & F.col("flags")[i]).alias(f"{source}_{i}")
            for source in sources
            for i in range(len(themes))
        ],
        *[count_of(F.col(f"negative_{source}")).alias(f"{source}_rows") for source in sources],
    )
    rows = F.array(*[
        F.struct(
            F.lit(source).alias("source"), F.lit(theme).alias("theme"),
            F.col(f"{source}_{i}").alias("count"), F.col(f"{source}_rows").alias("negatives"),
        )
        for source in sources
        for i, theme in enumerate(themes)
    ])
    return wide.select("category", F.inline(rows)).where("negatives > 0").drop("negatives")


def review_counts(reviews: DataFrame, category: str = "cluster_name") -> DataFrame:
    """Assigned reviews by category."""
    return (
        reviews.where("cluster_id >= 0").groupBy(category)
        .agg(F.count(F.lit(1)).alias("review_count"))
        .orderBy(F.desc("review_count"), category)
    )


def kpi_rows(counts: DataFrame, products: DataFrame, source: str) -> DataFrame:
    """Headline numbers per category and for all of them together.

    Both inputs are the small saved tables of A7 and A8, and each is rolled up once.
    """
    totals = (
        counts.where(F.col("source") == source).rollup("category")
        .agg(
            F.sum("count").alias("review_count"),
            F.sum(F.when(F.col("sentiment") == "negative", F.col("count")).otherwise(0)).alias("negative_count"),
            F.grouping("category").alias("_all"),
        )
    )
    ratings = products.rollup("category").agg(
        F.count_distinct("product_name").alias("product_count"),
        F.try_divide(F.sum(F.col("mean_rating") * F.col("review_count")), F.sum("review_count")).alias("mean"),
        F.grouping("category").alias("_all"),
    )
    name = F.when(F.col("_all") == 1, F.lit(ALL_CATEGORIES)).otherwise(F.col("category")).alias("category")
    return (
        totals.select(name, "review_count", "negative_count")
        .join(ratings.select(name, "product_count", "mean"), "category", "left")
        .select(
            "category", "review_count",
            F.coalesce("product_count", F.lit(0)).cast("long").alias("product_count"),
            F.coalesce("mean", F.lit(0.0)).alias("average_rating"),
            F.coalesce(F.try_divide(F.col("negative_count").cast("double"), F.col("review_count")), F.lit(0.0))
            .alias("negative_share"),
        )
    )


def theme_rollup(themes: DataFrame, source: str, category: str = ALL_CATEGORIES) -> DataFrame:
    """Theme totals of the selection, most frequent first."""
    return (
        select_category(themes.where(F.col("source") == source), category)
        .groupBy("theme").agg(F.sum("count").alias("count"))
        .orderBy(F.desc("count"), "theme")
    )


def sentiment_totals(counts: DataFrame, source: str, category: str = ALL_CATEGORIES) -> DataFrame:
    """Total per label in the selection, all three labels present."""
    picked = select_category(counts.where(F.col("source") == source), category)
    wide = picked.agg(*[
        F.coalesce(F.sum(F.when(F.col("sentiment") == s, F.col("count"))), F.lit(0)).alias(s) for s in SENTIMENTS
    ])
    return long_counts(wide, [], [({"sentiment": s}, F.col(s)) for s in SENTIMENTS])


def class_balance(reviews: DataFrame, label: str = "sentiment", labels: Sequence[str] = SENTIMENTS) -> DataFrame:
    """Count and share of each class, absent classes included."""
    wide = reviews.agg(
        *[count_of(F.col(label) == name).alias(name) for name in labels],
        F.count(F.lit(1)).alias("_rows"),
    )
    long = long_counts(wide, ["_rows"], [({label: name}, F.col(name)) for name in labels])
    return long.select(
        label, "count",
        F.coalesce(F.try_divide(F.col("count").cast("double"), F.col("_rows")), F.lit(0.0)).alias("share"),
    )


def distinct_texts(reviews: DataFrame, *keys: str, text: str = "review_text") -> DataFrame:
    """Number of different texts per group (A16), counted over digests: no text is shuffled."""
    return reviews.groupBy(*keys).agg(F.count_distinct(F.sha2(F.col(text), 256)).alias("distinct_texts"))


def table_profile(df: DataFrame) -> DataFrame:
    """Rows of the table, its exact duplicates, and type and missing values per column.

    Duplicates are counted over a digest of each row, so no text goes through the shuffle.
    """
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}

    def missing(name: str) -> Column:
        null = F.col(name).isNull()
        return null | F.isnan(name) if name in floating else null

    def record(item: str, column: str, kind: str, value: Column) -> Column:
        return F.struct(
            F.lit(item).alias("item"), F.lit(column).alias("column"), F.lit(kind).alias("type"),
            value.cast("long").alias("value"),
        )

    nulls = df.agg(F.count(F.lit(1)).alias("_rows"), *[count_of(missing(c)).alias(c) for c in df.columns])
    per_column = [record("missing", f.name, f.dataType.simpleString(), F.col(f.name)) for f in df.schema.fields]
    digest = F.sha2(F.to_json(F.struct(*df.columns)), 256)
    copies = df.groupBy(digest.alias("_digest")).agg((F.count(F.lit(1)) - 1).alias("extra")).agg(
        F.coalesce(F.sum("extra"), F.lit(0)).alias("extra")
    )
    return nulls.select(F.inline(F.array(record("rows", "", "", F.col("_rows")), *per_column))).unionByName(
        copies.select(F.inline(F.array(record("duplicate_rows", "", "", F.col("extra")))))
    )


def missing_columns_report(profile: DataFrame) -> DataFrame:
    """Columns with missing values, worst first."""
    return (
        profile.where("item = 'missing' AND value > 0")
        .select("column", F.col("value").alias("missing"))
        .orderBy(F.desc("missing"), "column")
    )


def describe_numeric(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, standard deviation, extremes and exact quartiles.

    The quartiles are found by selection, with buffers of fixed size however many values differ.
    """
    number = F.col(column).cast("double")
    numbers = df.select(F.when(~F.isnan(number), number).alias("v"))
    facts = numbers.agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
    quartiles = exact_quantiles(numbers, "v", (0.25, 0.5, 0.75))
    return facts.select(
        "count", "mean", "std", "min", *[F.lit(q).cast("double").alias(n) for q, n in zip(quartiles, ("q1", "median", "q3"), strict=True)], "max")


def product_drilldown(products: DataFrame, product_name: str, source: str) -> DataFrame:
    """Label counts of one product, taken from its first category by name."""
    chosen = products.where(F.col("product_name") == product_name).orderBy("category").limit(1)
    return long_counts(
        chosen, ["product_name"], [({"sentiment": s}, F.col(f"{source}_{s}")) for s in SENTIMENTS]
    )

