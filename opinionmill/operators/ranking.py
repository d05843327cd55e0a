"""Ordered picks per group and removal of copies.

Each pick is ``row_number() <= n``; Spark cuts every partition to n rows per group before the
shuffle, so a hot group sends a handful of rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_rows(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int,
               rank: str | None = None) -> DataFrame:
    """The first n rows of each group in the given order (W1); ``rank`` keeps the position."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    picked = df.withColumn("_position", position).where(F.col("_position") <= n)
    return picked.withColumnRenamed("_position", rank) if rank else picked.drop("_position")


def _comparison_pool(products: DataFrame, category: str, n: int, minimum: int,
                     order: Sequence[Column]) -> DataFrame:
    """Top n among products with enough reviews; among all when the category has none (P10).

    Ordering by the flag first makes one ranked cut serve both cases: whenever an established
    product exists it holds the first place, and the others in the cut are dropped.
    """
    established = F.col("review_count") >= minimum
    cut = first_rows(products, [category], [established.desc(), *order], n, rank="rank")
    first_is_established = F.max(established).over(Window.partitionBy(category))
    return (
        cut.withColumn("_pool", first_is_established)
        .where(~F.col("_pool") | established)
        .drop("_pool")
    )


def top_products(products: DataFrame, category: str = "cluster_id", n: int = 3, minimum: int = 5) -> DataFrame:
    """Best rated products of a category, more reviews first on equal means."""
    order = [F.desc("mean_rating"), F.desc("review_count"), F.asc("product_name")]
    return _comparison_pool(products, category, n, minimum, order)


def lowest_product(products: DataFrame, category: str = "cluster_id", minimum: int = 5) -> DataFrame:
    """Lowest rated product of a category."""
    order = [F.asc("mean_rating"), F.desc("review_count"), F.asc("product_name")]
    return _comparison_pool(products, category, 1, minimum, order).drop("rank")


def largest_joined(products: DataFrame, category: str = "cluster_id", n: int = 5) -> DataFrame:
    """Names of the most reviewed products, joined by a bar."""
    order = [F.desc("review_count"), F.asc("product_name")]
    cut = first_rows(products.select(category, "product_name", "review_count"), [category], order, n, "rank")
    names = F.transform(F.sort_array(F.collect_list(F.struct("rank", "product_name"))), lambda r: r["product_name"])
    return cut.groupBy(category).agg(F.array_join(names, " | ").alias("top_products"))


def worst_by_share(products: DataFrame, source: str, minimum: int, n: int = 10) -> DataFrame:
    """Products with the highest negative share and enough reviews."""
    return (
        products.where(F.col("review_count") >= minimum)
        .withColumn("negative_share", F.col(f"{source}_negative") / F.col("review_count"))
        .withColumn("positive_share", F.col(f"{source}_positive") / F.col("review_count"))
        .orderBy(F.desc("negative_share"), F.desc("review_count"), "product_name", "category")
        .limit(n)
    )


def drop_copies(df: DataFrame, keys: Sequence[str], text: str = "review_text", order: str = "row_id") -> DataFrame:
    """First row of every distinct text inside the key group (D1, D2; D3 with no keys).

    Rows are told apart by a 256-bit digest: no text is a key of the sort or the shuffle. Copies are
    cut to one per task before the shuffle, however many there are.
    """
    return first_rows(df, [*keys, F.sha2(F.col(text), 256)], [F.col(order)], 1)


def distinct_text_ids(df: DataFrame, keys: Sequence[str], text: str = "review_text", order: str = "row_id") -> DataFrame:
    """Ids of the rows ``drop_copies`` keeps, for callers that pick a few of them later.

    The texts themselves are not shuffled, only a 256-bit digest of each.
    """
    return df.groupBy(*keys, F.sha2(F.col(text), 256).alias("_digest")).agg(
        F.min(order).alias(order)
    ).drop("_digest")


def best_model(comparison: DataFrame, first: str = "macro_f1", second: str = "accuracy") -> DataFrame:
    """The winning row: highest macro F1, then accuracy, then the one listed first."""
    return comparison.orderBy(F.desc(first), F.desc(second), F.asc("position")).limit(1)
