"""Data contracts (K1-K9, U2, U3): each is one aggregation or one anti join."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinionmill.functions.text import strip

# Fixed value: longest review a request may hold.
MAX_REQUEST_CHARS = 5000


# Columns every table of drafts must have.
ARTICLE_COLUMNS = (
    "cluster_id", "cluster_name", "model", "generated_at_utc", "review_count", "product_count", "mean_rating", "article",
)


class ContractError(ValueError):
    """A table does not meet what the next step needs."""


def require_columns(df: DataFrame, required: Iterable[str], what: str = "Table") -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ContractError(f"{what} is missing required columns: {missing}")
    return df


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def require_unique(df: DataFrame, *keys: str, what: str = "Table") -> DataFrame:
    found = duplicate_keys(df, *keys).limit(1).collect()
    if found:
        raise ContractError(f"{what} holds a duplicate key: {found[0].asDict()}")
    return df


def orphans(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Distinct non-null keys without a row in the dimension, with their row count.

    Rows are counted per key first, so the anti join sees each key once.
    """
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    known = dim.select(F.col(dim_key or key).alias(key))
    return counted.join(known, key, "left_anti")


def without_rows(dim: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Rows of the dimension whose key no row of ``df`` has, such as categories without reviews (K5)."""
    return dim.join(df.select(key).distinct(), key, "left_anti")


def require_known(
    df: DataFrame, dim: DataFrame, key: str, unassigned: int | None = None, what: str = "Rows"
) -> DataFrame:
    """Raise when an assigned key is unknown; rows without assignment are tolerated."""
    assigned = df if unassigned is None else df.where(F.col(key) != F.lit(unassigned))
    sample = [r[key] for r in orphans(assigned, dim, key).orderBy(key).limit(20).collect()]
    if sample:
        raise ContractError(f"{what} refer to {key} values missing from the table: {sample}")
    return df


def require_rows(df: DataFrame, at_least: int = 1, what: str = "Table") -> DataFrame:
    found = df.limit(at_least).count()
    if found < at_least:
        raise ContractError(f"{what} needs at least {at_least} rows; found {found}.")
    return df


def id_set_differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Ids found on one side only: key, side ('left_only' / 'right_only')."""
    both = (
        left.select(key).distinct().withColumn("in_left", F.lit(True))
        .join(right.select(key).distinct().withColumn("in_right", F.lit(True)), key, "full_outer")
    )
    side = F.when(F.col("in_right").isNull(), "left_only").when(F.col("in_left").isNull(), "right_only")
    return both.select(key, side.alias("side")).where(F.col("side").isNotNull())


def require_same_ids(left: DataFrame, right: DataFrame, key: str, what: str = "Ids") -> None:
    sample = id_set_differences(left, right, key).limit(20).collect()
    if sample:
        raise ContractError(f"{what} differ: {[tuple(r) for r in sample]}")


def require_numeric(df: DataFrame, column: str, to: str = "double") -> DataFrame:
    """Cast that fails the query on the first value that does not parse (K7)."""
    text = F.col(column).cast("string")
    parsed = text.try_cast(to)
    broken = text.isNotNull() & parsed.isNull()
    message = F.concat(F.lit(f"{column} is not numeric: "), text)
    return df.withColumn(column, F.when(broken, F.raise_error(message).cast(to)).otherwise(parsed))


def require_articles(
    drafts: DataFrame, categories: DataFrame, inference: str | None = None,
    required: Sequence[str] = ARTICLE_COLUMNS,
) -> DataFrame:
    """One non-empty article per category, the expected columns and provenance tag (K8)."""
    require_columns(drafts, required, "Draft table")
    require_unique(drafts, "cluster_id", what="Draft table")
    require_same_ids(drafts, categories, "cluster_id", "Draft categories")
    bad = F.col("article").isNull() | (strip(F.col("article")) == "")
    if inference is not None:
        bad = bad | ~F.col("inference").eqNullSafe(inference)
    if drafts.where(bad).limit(1).count():
        raise ContractError("Draft table holds an empty article or a wrong inference tag.")
    return drafts


def request_reason(text: Column) -> Column:
    """Why a submitted review is refused, null when it is accepted (K9)."""
    return (
        F.when(text.isNull() | (text == ""), F.lit("empty"))
        .when(F.length(text) > MAX_REQUEST_CHARS, F.lit("too_long"))
        .when(strip(text) == "", F.lit("blank"))
    )


def split_requests(df: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """Accepted rows (text stripped) and rejected rows (with ``reason``)."""
    checked = df.withColumn("reason", request_reason(F.col(text)))
    accepted = checked.where("reason IS NULL").drop("reason").withColumn(text, strip(F.col(text)))
    return accepted, checked.where("reason IS NOT NULL")
