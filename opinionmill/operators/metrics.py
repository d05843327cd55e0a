"""Classification metrics from (actual, predicted) rows.

All of them start from one grouped count, a table of at most labels x labels cells per model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinionmill.functions.labels import SENTIMENTS


def cell_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key, actual and predicted label: at most labels x labels rows per key."""
    return df.groupBy(*keys, "actual", "predicted").agg(F.count(F.lit(1)).alias("n"))


def _cells(df: DataFrame, keys: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """One row per key with every cell ``a_p`` of the confusion matrix and the row total.

    ``df`` holds single predictions, or cells already counted in a column ``n``.
    """
    counts = df if "n" in df.columns else cell_counts(df, *keys)
    cells = [
        F.coalesce(F.sum(F.when((F.col("actual") == a) & (F.col("predicted") == p), F.col("n"))), F.lit(0)).alias(f"{a}_{p}")
        for a in labels
        for p in labels
    ]
    return counts.groupBy(*keys).agg(*cells, F.sum("n").alias("rows"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def _class_scores(label: str, labels: Sequence[str]) -> tuple[Column, Column, Column, Column]:
    hits = F.col(f"{label}_{label}")
    support = sum((F.col(f"{label}_{p}") for p in labels), F.lit(0))
    predicted = sum((F.col(f"{a}_{label}") for a in labels), F.lit(0))
    return _ratio(hits, predicted), _ratio(hits, support), _ratio(2 * hits, predicted + support), support


def confusion_matrix(df: DataFrame, keys: Sequence[str] = (), labels: Sequence[str] = SENTIMENTS) -> DataFrame:
    """One row per actual label, one column per predicted label, zeros kept."""
    rows = F.array(*[
        F.struct(F.lit(a).alias("actual"), *[F.col(f"{a}_{p}").cast("long").alias(f"predicted_{p}") for p in labels])
        for a in labels
    ])
    return _cells(df, keys, labels).select(*keys, F.inline(rows))


def per_class_metrics(df: DataFrame, keys: Sequence[str] = (), labels: Sequence[str] = SENTIMENTS) -> DataFrame:
    """Precision, recall, F1 and support per class; a division by zero gives 0."""
    rows = []
    for label in labels:
        precision, recall, f1, support = _class_scores(label, labels)
        rows.append(F.struct(
            F.lit(label).alias("sentiment"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), support.cast("long").alias("support"),
        ))
    return _cells(df, keys, labels).select(*keys, F.inline(F.array(*rows)))


def summary_metrics(df: DataFrame, keys: Sequence[str] = (), labels: Sequence[str] = SENTIMENTS) -> DataFrame:
    """Accuracy, macro scores, weighted F1, per-class F1 and sample count."""
    scores = {label: _class_scores(label, labels) for label in labels}
    hits = sum((F.col(f"{label}_{label}") for label in labels), F.lit(0))

    def macro(i: int) -> Column:
        return sum((s[i] for s in scores.values()), F.lit(0.0)) / len(labels)

    weighted = _ratio(
        sum((s[2] * s[3] for s in scores.values()), F.lit(0.0)), sum((s[3] for s in scores.values()), F.lit(0))
    )
    return _cells(df, keys, labels).select(
        *keys,
        _ratio(hits, F.col("rows")).alias("accuracy"),
        macro(0).alias("macro_precision"), macro(1).alias("macro_recall"), macro(2).alias("macro_f1"),
        weighted.alias("weighted_f1"),
        *[scores[label][2].alias(f"{label}_f1") for label in labels],
        F.col("rows").cast("long").alias("samples"),
    )


def model_comparison(df: DataFrame, labels: Sequence[str] = SENTIMENTS) -> DataFrame:
    """One row per model, best macro F1 first, then accuracy."""
    return summary_metrics(df, ["model"], labels).orderBy(F.desc("macro_f1"), F.desc("accuracy"), "model")


def classification_report(df: DataFrame, labels: Sequence[str] = SENTIMENTS) -> DataFrame:
    """Class rows with accuracy, macro and weighted averages below them (E5)."""
    classes = per_class_metrics(df, labels=labels).withColumnRenamed("sentiment", "row")
    total = F.sum("support")
    mean = lambda c: F.avg(c)
    weighted = lambda c: F.sum(F.col(c) * F.col("support")) / total
    averages = classes.agg(
        F.array(
            F.struct(F.lit("macro avg").alias("row"), mean("precision").alias("precision"),
                     mean("recall").alias("recall"), mean("f1").alias("f1"), total.alias("support")),
            F.struct(F.lit("weighted avg").alias("row"), weighted("precision").alias("precision"),
                     weighted("recall").alias("recall"), weighted("f1").alias("f1"), total.alias("support")),
            # Accuracy is the support-weighted recall.
            F.struct(F.lit("accuracy").alias("row"), weighted("recall").alias("precision"),
                     weighted("recall").alias("recall"), weighted("recall").alias("f1"), total.alias("support")),
        ).alias("rows")
    )
    return classes.unionByName(averages.select(F.inline("rows")))


def preservation_rates(df: DataFrame, keep: str = "sentiment_preserved", by: str = "sentiment") -> DataFrame:
    """Share of rows whose label survived, per class and overall."""
    rate = F.avg(F.col(keep).cast("double"))
    return df.rollup(by).agg(rate.alias("rate"), F.count(F.lit(1)).alias("n"), F.grouping(by).alias("_all")).select(
        F.when(F.col("_all") == 1, F.lit("all")).otherwise(F.col(by)).alias(by), "rate", "n"
    )
