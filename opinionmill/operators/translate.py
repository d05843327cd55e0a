"""Preparation, translation stage and post-editing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionmill.functions import rewrite
from opinionmill.functions.text import sentences
from opinionmill.operators.text_stage import TextFunction, apply_to_texts


def prepare(df: DataFrame, text: str = "text", language: str = "language",
            terms: Sequence[str] = rewrite.PROTECTED_TERMS) -> DataFrame:
    """Add status, clipped text, protected text, kept names and sentences (B2).

    Only rows that will be translated get sentences; the language column must exist.
    """
    status = rewrite.translation_status(F.col(text), F.col(language))
    staged = df.withColumn("status", status).withColumn("clipped_text", rewrite.clipped_input(F.col(text)))
    wanted = F.col("status").startswith("translated")
    staged = staged.withColumn(
        "normalized_text", F.when(wanted, rewrite.normalize_informal(F.col("clipped_text")))
    )
    staged = rewrite.protect_terms(staged, "normalized_text", terms=terms)
    return staged.withColumn(
        "sentences", F.coalesce(sentences(F.col("protected_text")), F.array().cast("array<string>"))
    )


def translate(prepared: DataFrame, make_function: Callable[[], TextFunction], batch_size: int = 8) -> DataFrame:
    """Run the caller's translator over the sentences and finish the text."""
    staged = apply_to_texts(prepared, "sentences", "translated_sentences", make_function, batch_size)
    restored = rewrite.fix_german(
        rewrite.restore_terms(F.array_join("translated_sentences", " "), F.col("protected_terms"))
    )
    return staged.withColumn(
        "translation",
        F.when(F.col("status").startswith("translated"), restored)
        .when(F.col("status") == "already_german", F.col("clipped_text")).otherwise(""),
    )


def translate_back(df: DataFrame, text: str, out: str, make_function: Callable[[], TextFunction],
                   batch_size: int = 8) -> DataFrame:
    """Sentence-wise second translation, joined by a space; blank stays blank."""
    split = df.withColumn("_sentences", sentences(F.coalesce(F.col(text), F.lit(""))))
    done = apply_to_texts(split, "_sentences", "_answers", make_function, batch_size)
    return done.withColumn(out, F.array_join("_answers", " ")).drop("_sentences", "_answers")
