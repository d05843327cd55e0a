"""Word tokens and n-grams as array columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# Spark's default English stop words. Every operator takes another list instead.
DEFAULT_STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split())


def default_stop_words() -> tuple[str, ...]:
    return DEFAULT_STOP_WORDS


def clean_tokens(cleaned: Column) -> Column:
    """Words of two or more characters of text that went through ``clean_text``."""
    return F.filter(F.split(cleaned, " "), lambda word: F.length(word) > 1)


def word_tokens(text: Column) -> Column:
    """Words of two or more characters of any text, lower case."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.regexp_extract_all(lowered, F.lit(r"(?U)\b\w\w+\b"), F.lit(0))


def without_stop_words(tokens: Column, stop_words: Sequence[str] | None = None) -> Column:
    words = default_stop_words() if stop_words is None else tuple(stop_words)
    return F.filter(tokens, lambda word: ~word.isin(*words)) if words else tokens


def bigrams(tokens: Column) -> Column:
    """Neighbouring pairs joined by a space.

    Both sides are arguments of ``zip_with``, never captured by its lambda, so that the token
    array is not computed again for every element.
    """
    following = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens), F.lit(0)))
    pairs = F.zip_with(tokens, following, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(pairs, lambda pair: pair.isNotNull())


def uni_and_bigrams(tokens: Column) -> Column:
    """Words, then their neighbouring pairs; the words are computed once and handed on."""
    return F.transform(F.array(tokens), lambda words: F.concat(words, bigrams(words)))[0]


def ngrams(tokens: Column, n: int) -> Column:
    """Runs of ``n`` tokens joined by a space."""
    grams = tokens
    for shift in range(1, n):
        later = F.slice(tokens, F.lit(shift + 1), F.greatest(F.size(tokens), F.lit(0)))
        grams = F.filter(
            F.zip_with(grams, later, lambda a, b: F.concat(a, F.lit(" "), b)),
            lambda gram: gram.isNotNull(),
        )
    return grams
