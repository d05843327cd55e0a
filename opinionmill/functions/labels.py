"""Ratings, sentiment labels and keyword predicates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three labels in reporting order.
SENTIMENTS = ("negative", "neutral", "positive")

# Complaint themes and their keyword patterns.
COMPLAINT_THEMES = {
    "Battery & charging": r"\b(?:battery|charge|charging|charger)\b",
    "Connectivity": r"\b(?:wifi|wi fi|bluetooth|connect|connection|internet)\b",
    "Performance": r"\b(?:slow|freeze|freezes|frozen|lag|crash|crashes|restart)\b",
    "Ads & apps": r"\b(?:ad|ads|advert|advertisement|app|apps|application|store)\b",
    "Screen & display": r"\b(?:screen|display|resolution|pixel|pixels)\b",
    "Price & value": r"\b(?:price|priced|expensive|overpriced|cost|value)\b",
    "Durability": r"\b(?:broke|broken|defect|defective|stopped working|damage)\b",
    "Delivery & accessories": r"\b(?:delivery|shipping|arrived|package|packaging|cable|cover)\b",
}

# What counts as a number: Java's own parser would also take suffixes such as "5d" and NaN.
NUMBER = r"(?i)^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?)$"


def to_number(col: Column) -> Column:
    """Double where the value parses, null where it does not; NaN counts as missing."""
    text = F.trim(col.cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def sentiment(rating: Column, strict: bool = False) -> Column:
    """Label from stars.

    Open rule: up to 2 is negative, exactly 3 neutral, all else positive. Strict rule: only
    4..5 is positive and what is left over is 'invalid', for the caller to drop.
    """
    low = F.when(rating <= 2, F.lit("negative")).when(rating == 3, F.lit("neutral"))
    if strict:
        return low.when(rating.between(4, 5), F.lit("positive")).otherwise(F.lit("invalid"))
    return low.when(rating.isNotNull(), F.lit("positive"))


def contains_pattern(text: Column, pattern: str) -> Column:
    """Case-insensitive search; null text counts as no match."""
    return F.coalesce(text.rlike(f"(?iU){pattern}"), F.lit(False))


def theme_flags(text: Column, themes: Mapping[str, str] = COMPLAINT_THEMES) -> Column:
    """One boolean per theme, in the order of ``themes``, as an array."""
    return F.array(*[contains_pattern(text, pattern) for pattern in themes.values()])
