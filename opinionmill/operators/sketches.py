"""Distinct counts from stored sketches that later runs merge instead of counting again (A16, approximate form)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sketches of 2 ** 14 cells: a relative standard error of 1.04 / sqrt(2 ** 14), 0.8 %.
CELLS_LOG2 = 14
STANDARD_ERROR = 1.04 / 2 ** (CELLS_LOG2 / 2)


def text_sketches(reviews: DataFrame, *keys: str, text: str = "review_text") -> DataFrame:
    """keys and ``sketch`` of the different texts per group; a sketch has at most 2 ** CELLS_LOG2 cells."""
    digest = F.sha2(F.col(text), 256)
    return reviews.groupBy(*keys).agg(F.hll_sketch_agg(digest, CELLS_LOG2).alias("sketch"))


def merged_sketches(parts: Sequence[DataFrame], *keys: str) -> DataFrame:
    """The sketches of several runs over different or overlapping reviews as one per group."""
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated_texts(sketches: DataFrame, *keys: str) -> DataFrame:
    """keys and the estimated number of different texts."""
    return sketches.select(*keys, F.hll_sketch_estimate("sketch").alias("distinct_texts"))


def within_error(estimate: Column, exact: Column, errors: float = 4.0) -> Column:
    """Whether an estimate lies within so many standard errors of the exact number."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(0.5), errors * STANDARD_ERROR * exact)
