"""Ordered rewrite rules around translation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinionmill.functions.matching import with_placeholders
from opinionmill.functions.text import squeeze, strip

# Fixed value: longest text handed to translation.
MAX_INPUT_CHARS = 2000

# Informal spellings and what they stand for, in the order they apply.
ABBREVIATIONS = (
    (r"\bbtw\b", "by the way"),
    (r"\bimo\b", "in my opinion"),
    (r"\bimho\b", "in my opinion"),
    (r"\bidk\b", "I don't know"),
    (r"\bomg\b", "oh my god"),
    (r"\bfyi\b", "for your information"),
    (r"\bthx\b", "thanks"),
    (r"\bpls\b", "please"),
    (r"\bu\b", "you"),
    (r"\bur\b", "your"),
    (r"\bgr8\b", "great"),
    (r"\bw/o\b", "without"),
    (r"\bw/\b", "with"),
    (r"\bcuz\b", "because"),
    (r"\bgonna\b", "going to"),
    (r"\bwanna\b", "want to"),
    (r"\bkinda\b", "kind of"),
    (r"\bdidnt\b", "didn't"),
    (r"\bdont\b", "don't"),
    (r"\bcant\b", "can't"),
    (r"\bdoesnt\b", "doesn't"),
    (r"\bwont\b", "won't"),
    (r"\bisnt\b", "isn't"),
    (r"\bive\b", "I've"),
)

# Words after a leading "great" that keep it as it is.
GREAT_EXCEPTIONS = (
    "for", "and", "but", "to", "with", "on", "in", "at", "as", "if", "so", "when", "it", "that", "than",
)

# Names that must come out of translation unchanged.
PROTECTED_TERMS = (
    "Fire Tablet", "Fire HD", "Kindle Paperwhite", "Kindle Fire", "Kindle", "Echo Dot",
    "Echo", "Alexa", "Amazon", "Fire TV", "Fire Stick", "Prime", "Whispersync",
    "Paperwhite", "Fire",
)

# Corrections of German output, in the order they apply. The determiners that
# take "-es" before a neuter noun come first, then those that only lose their "-e", then all
# other words ending in "-e".
GERMAN_FIXES = (
    (r"(?U)\bTabletten\b", "Tablets"),
    (r"(?U)\bTablette\b", "Tablet"),
    (r"(?U)\bTablettes\b", "Tablets"),
    (r"(?U)\b((?i:dies|welch|jed|solch))e Tablet\b", "$1es Tablet"),
    (r"(?U)\b((?i:ein|kein|mein|dein|sein|ihr|unser))e Tablet\b", "$1 Tablet"),
    (r"(?U)\b(\w+e) Tablet\b", "$1s Tablet"),
    (r"(?U)\b([Ee])ine (\w+es Tablet)", "$1in $2"),
)


def _bound(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it to ``use``, also inside nested lambdas."""
    return F.transform(F.array(value), use)[0]


def apply_rules(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Fold an ordered list of (pattern, replacement) into one column."""
    return reduce(lambda col, rule: F.regexp_replace(col, *rule), rules, text)


def normalize_informal(text: Column) -> Column:
    """Spell out informal English so that it survives translation (F16).

    A text in which none of the abbreviations occurs skips their rules: one search for all of
    them decides. All stand between word borders, so a place inside a word fails once, not once per rule.
    """
    exceptions = "|".join(GREAT_EXCEPTIONS)
    opening = rf"(?iU)(^|[.!?]\s+)great\s+(?!(?:{exceptions})\b)(?=\w)"
    text = F.regexp_replace(squeeze(text), r"([!?.])\1{2,}", "$1")
    text = F.regexp_replace(text, r"(?U)(\w)\1{3,}", "$1$1")
    text = F.regexp_replace(text, opening, "$1An awesome ")
    spellings = "|".join(pattern.removeprefix(r"\b").removesuffix(r"\b") for pattern, _ in ABBREVIATIONS)
    any_abbreviation = rf"(?iU)\b(?:{spellings})\b"
    rules = [(f"(?iU){pattern}", to) for pattern, to in ABBREVIATIONS]
    return _bound(text, lambda t: F.when(t.rlike(any_abbreviation), apply_rules(t, rules)).otherwise(t))


def clipped_input(text: Column) -> Column:
    """Stripped text, at most ``MAX_INPUT_CHARS`` long."""
    return F.substring(strip(F.coalesce(text, F.lit(""))), 1, MAX_INPUT_CHARS)


def is_truncated(text: Column) -> Column:
    return F.length(strip(F.coalesce(text, F.lit("")))) > MAX_INPUT_CHARS


def translation_status(text: Column, language: Column) -> Column:
    """What happens to a row: its language and length decide."""
    stripped = strip(F.coalesce(text, F.lit("")))
    return (
        F.when(stripped == "", F.lit("empty"))
        .when(language == "de", F.lit("already_german"))
        .when(~language.isin("en", "unknown"), F.lit("unsupported_language"))
        .when(F.length(stripped) > MAX_INPUT_CHARS, F.lit("translated_truncated"))
        .otherwise(F.lit("translated"))
    )


def protect_terms(
    df: DataFrame,
    text: str,
    out_text: str = "protected_text",
    out_terms: str = "protected_terms",
    terms: Sequence[str] = PROTECTED_TERMS,
) -> DataFrame:
    """Swap each protected name for ``PRD{n}X`` and keep the names found, in order.

    The longest names go first. One scan finds the hits of all names, so a longer list costs no more.
    """
    longest_first = sorted(terms, key=len, reverse=True)
    return with_placeholders(df, text, longest_first, ("s", ""), out_text, out_terms)


def restore_terms(text: Column, terms: Column) -> Column:
    """Put the protected names back; unknown placeholders stay (F21, first half)."""
    token = r"(?i)PRD(0|[1-9]\d{0,8})X"
    parts = F.arrays_zip(
        F.split(text, token, -1).alias("piece"),
        F.regexp_extract_all(text, F.lit(token), F.lit(1)).alias("number"),
        F.regexp_extract_all(text, F.lit(token), F.lit(0)).alias("token"),
    )

    def rejoined(names: Column) -> Column:
        return F.transform(
            parts,
            lambda p: F.concat(
                p["piece"],
                F.coalesce(F.get(names, p["number"].cast("int")), p["token"], F.lit("")),
            ),
        )

    return F.array_join(_bound(terms, rejoined), "")


def fix_german(text: Column) -> Column:
    """Corrections of the translated text."""
    return apply_rules(text, GERMAN_FIXES)
