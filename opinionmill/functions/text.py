"""Cleaning and measuring text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sentinel and the spellings that stand for a missing product name.
UNKNOWN_PRODUCT = "Unknown product"
MISSING_NAMES = ("unknown", "nan", "none")

# Upper edges and labels of the review-length buckets.
LENGTH_BUCKETS = ((49, "0–49"), (99, "50–99"), (199, "100–199"), (399, "200–399"), (None, "400+"))

# Unicode white space as Python sees it (Java's set lacks the four separator controls).
SPACE = r"[\s\x1c-\x1f]"


def clean_text(col: Column) -> Column:
    """Lower case, every run of other characters to one space, trimmed; null gives ''.

    Turning non-alphanumerics into spaces and squeezing white space afterwards is the same
    as replacing each run outside ``[a-z0-9]`` once, so one pass is enough.
    """
    text = F.lower(F.coalesce(col.cast("string"), F.lit("")))
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))


def has_words(col: Column) -> Column:
    """Whether ``clean_text`` leaves anything, without cleaning: the search ends at the first hit.

    Besides ASCII letters and digits, the Kelvin sign and the dotted capital I turn into ASCII
    letters in lower case.
    """
    return F.coalesce(col.cast("string").rlike("[A-Za-z0-9\u212a\u0130]"), F.lit(False))


def squeeze(col: Column) -> Column:
    """White space runs to one space, ends stripped."""
    return F.trim(F.regexp_replace(col, f"(?U){SPACE}+", " "))


def strip(col: Column) -> Column:
    """Drop white space at both ends, keep the inside as it is."""
    return F.regexp_replace(col, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def clean_product_name(col: Column) -> Column:
    """First line of the name, squeezed, without edge blanks and commas (F2)."""
    first_line = F.substring_index(F.translate(col.cast("string"), "\r", "\n"), "\n", 1)
    name = F.btrim(F.regexp_replace(first_line, f"(?U){SPACE}+", " "), F.lit(" ,"))
    missing = name.isNull() | (name == "") | F.lower(name).isin(*MISSING_NAMES)
    return F.when(missing, F.lit(UNKNOWN_PRODUCT)).otherwise(name)


def word_count(col: Column) -> Column:
    """Number of white-space separated words."""
    return F.regexp_count(col, F.lit(r"(?U)[^\s\x1c-\x1f]+"))


def length_bucket(length: Column) -> Column:
    """Label of the right-closed length bin (F8)."""
    (first_edge, first_label), *rest = LENGTH_BUCKETS
    chain = F.when(length <= first_edge, F.lit(first_label))
    for edge, label in rest:
        if edge is None:
            return chain.when(length.isNotNull(), F.lit(label))
        chain = chain.when(length <= edge, F.lit(label))
    return chain


def letter_count(col: Column) -> Column:
    """Latin and German letters in the text."""
    return F.regexp_count(col, F.lit("[A-Za-zÄÖÜäöüß]"))


def sentences(col: Column) -> Column:
    """Split after sentence marks followed by white space; blank parts removed."""
    parts = F.split(col, rf"(?U)(?<=[.!?]){SPACE}+")
    return F.filter(parts, lambda part: strip(part) != "")
