"""Relative class scores from decision margins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinionmill.functions.labels import SENTIMENTS

# Fixed value: the caveat returned with every score, for the kind of model that gave it.
SCORE_NOTE = "Scores are a softmax of {kind} decision values, not calibrated probabilities."


def softmax(margins: Column) -> Column:
    """Softmax of an array<double>, shifted by the maximum so that it cannot overflow."""
    exps = F.transform(margins, lambda m: F.exp(m - F.array_max(margins)))
    total = F.aggregate(exps, F.lit(0.0), lambda acc, e: acc + e)
    return F.transform(exps, lambda e: e / total)


def class_scores(margins: Column, labels: Sequence[str] = SENTIMENTS) -> Column:
    """map<label, score>; raises when the model is not as wide as the label list."""
    names = F.array(*[F.lit(label) for label in labels])
    wrong = F.raise_error(F.lit("Model output does not match the configured sentiment classes."))
    checked = F.when(F.size(margins) == len(labels), softmax(margins)).otherwise(
        wrong.cast("array<double>")
    )
    return F.map_from_arrays(names, checked)


def best_label(margins: Column, labels: Sequence[str] = SENTIMENTS) -> Column:
    """Label of the largest margin, the first one listed on a tie."""
    names = F.array(*[F.lit(label) for label in labels])
    return F.get(names, (F.array_position(margins, F.array_max(margins)) - 1).cast("int"))


def uniform_scores(labels: Sequence[str] = SENTIMENTS) -> Column:
    """Equal scores, for a model that gives no margins."""
    share = 1.0 / len(labels)
    return F.create_map(*[F.lit(v) for label in labels for v in (label, share)])


def score_lines(scores: Column) -> Column:
    """One ``- name: 12.3%`` line per class."""
    lines = F.transform(
        F.map_entries(scores),
        lambda e: F.format_string("- %s: %.1f%%", e["key"], e["value"] * 100),
    )
    return F.array_join(lines, "\n")
