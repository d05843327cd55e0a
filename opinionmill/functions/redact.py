"""Excerpts of review text with personal data removed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinionmill.functions.text import SPACE

# Excerpt length, length of the tail searched for a closing word.
EXCERPT_CHARS = 500
TAIL_CHARS = 100

# Redaction patterns with their replacements, in the order they apply.
REDACTIONS = (
    (r"(?iU)\bmy name is\s+[\w'-]+(?:\s+[\w'-]+){0,2}", "my name is [redacted]"),
    (r"(?iU)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b", "[redacted email]"),
    (r"(?iU)https?://\S+|www\.\S+", "[redacted link]"),
    (r"(?U)(?<!\w)\+?\d[\d().\-\s]{7,}\d(?!\w)", "[redacted phone]"),
)
CLOSING_WORDS = r"(?iU)\b(?:thank you|thanks|regards|sincerely)\b"


def redact_excerpt(text: Column) -> Column:
    """First part of the text, redacted, cut before a closing word near its end."""
    excerpt = F.substring(text, 1, EXCERPT_CHARS)
    for pattern, replacement in REDACTIONS:
        excerpt = F.regexp_replace(excerpt, pattern, replacement)
    return _cut_closing(excerpt)


def _cut_closing(excerpt: Column) -> Column:
    # A one-element array binds the redacted text once for the expressions that follow.
    def cut(text: Column) -> Column:
        head = F.greatest(F.length(text) - TAIL_CHARS, F.lit(0))
        tail = F.substr(text, head + 1, F.lit(TAIL_CHARS))
        found = F.regexp_instr(tail, F.lit(CLOSING_WORDS))
        kept = F.substr(text, F.lit(1), head + found - 1)
        return F.when(found > 0, F.regexp_replace(kept, rf"(?U){SPACE}+\z", "")).otherwise(text)

    return F.transform(F.array(excerpt), cut)[0]
