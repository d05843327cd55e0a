"""Numbers and examples written out for readers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinionmill.functions.text import squeeze


def thousands(col: Column) -> Column:
    return F.format_number(col, 0)


def two_decimals(col: Column) -> Column:
    return F.format_string("%.2f", col.cast("double"))


def percent(col: Column) -> Column:
    return F.format_string("%.1f%%", col * F.lit(100.0))


def rating_text(col: Column) -> Column:
    """A rating as its shortest decimal text, whole stars with one decimal ('5.0')."""
    return col.cast("double").cast("string")


def joined_examples(examples: Column, separator: str = " | ") -> Column:
    """``Rating r: text`` for every example of an array<struct<rating, review>>."""
    line = lambda example: F.concat(
        F.lit("Rating "), example["rating"], F.lit(": "), squeeze(example["review"])
    )
    return F.array_join(F.transform(examples, line), separator)


def capitalized(col: Column) -> Column:
    return F.initcap(col)
