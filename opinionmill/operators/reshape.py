"""Wide and long forms of count tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinionmill.functions.labels import SENTIMENTS

ALL_CATEGORIES = "All categories"


def unpivot_sources(df: DataFrame, sources: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """One row per label source: the kept columns, ``source``, ``sentiment`` (R2)."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("source"), F.col(column).alias("sentiment"))
        for name, column in sources.items()
    ])
    return df.select(*keep, F.inline(pairs))


def long_counts(df: DataFrame, keep: Sequence[str], records: Sequence[tuple[dict, Column]]) -> DataFrame:
    """Unfold wide counts: one row per (labels, count column) pair, zeros included."""
    rows = F.array(*[
        F.struct(*[F.lit(v).alias(k) for k, v in labels.items()], F.coalesce(count, F.lit(0)).cast("long").alias("count"))
        for labels, count in records
    ])
    return df.select(*keep, F.inline(rows))


def pivot_counts(
    df: DataFrame, key: str, labels: Sequence[str] = SENTIMENTS, label: str = "sentiment", value: str = "count"
) -> DataFrame:
    """One column of summed counts per label, missing ones 0."""
    sums = [
        F.coalesce(F.sum(F.when(F.col(label) == name, F.col(value))), F.lit(0)).cast("long").alias(name)
        for name in labels
    ]
    return df.groupBy(key).agg(*sums)


def row_shares(df: DataFrame, labels: Sequence[str] = SENTIMENTS) -> DataFrame:
    """Each label column divided by its row total; 0 where the total is 0."""
    total = sum((F.col(name) for name in labels), F.lit(0))
    return df.withColumns({
        name: F.coalesce(F.try_divide(F.col(name).cast("double"), total), F.lit(0.0)) for name in labels
    })


def in_order(df: DataFrame, key: str, order: Sequence[str], fill: Sequence[str] = SENTIMENTS) -> DataFrame:
    """All values of ``order`` as rows, absent ones filled with 0, plus their position."""
    spine = df.sparkSession.createDataFrame(
        [(i, value) for i, value in enumerate(order)], f"position int, {key} string"
    )
    return spine.join(df, key, "left").na.fill(0, list(fill))


def select_category(df: DataFrame, category: str = ALL_CATEGORIES, column: str = "category") -> DataFrame:
    """Rows of one category, or all of them."""
    return df if category == ALL_CATEGORIES else df.where(F.col(column) == category)


def picker_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in order (U4)."""
    return df.select(column).distinct().orderBy(column)
