"""Repeatable samples and exact stratified splits (M1, M2).

Random order is the md5 of the row id and a seed. It does not depend on partitioning, so any
cluster gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opinionmill.operators.ranking import first_rows
from opinionmill.session import materialized


def random_key(row_id: str = "row_id", seed: int = 42) -> Column:
    return F.md5(F.concat(F.col(row_id).cast("string"), F.lit(f":{seed}")).cast("binary"))


def sample_per_group(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """Up to n rows of each group (M1); the caller orders the result by ``row_id``."""
    return first_rows(df, keys, [random_key(row_id, seed), F.col(row_id)], n)


def class_quotas(counts: DataFrame, label: str, fraction: float, out: str) -> DataFrame:
    """Whole rows per class that add up to ceil(fraction * total), largest remainder first.

    ``counts`` has one row per class.
    """
    everything = Window.partitionBy(F.lit(1))
    total = F.sum("n").over(everything)
    wanted = F.ceil(F.round(total * F.lit(fraction), 6))
    exact = F.col("n") * wanted / total
    ranked = (
        counts.withColumn("_wanted", wanted).withColumn("_exact", exact)
        .withColumn("_floor", F.floor("_exact"))
        .withColumn("_left", F.col("_wanted") - F.sum("_floor").over(everything))
        .withColumn(
            "_place",
            F.row_number().over(everything.orderBy((F.col("_exact") - F.col("_floor")).desc(), F.col(label))),
        )
    )
    extra = F.when(F.col("_place") <= F.col("_left"), 1).otherwise(0)
    return ranked.withColumn(out, (F.col("_floor") + extra).cast("long")).drop(
        "_wanted", "_exact", "_floor", "_left", "_place"
    )


def split_quotas(counts: DataFrame, label: str, test: float = 0.2, validation: float = 0.25) -> DataFrame:
    """Test rows and validation rows per class: a share of all, then of what is left."""
    with_test = class_quotas(counts, label, test, "test_rows")
    rest = with_test.withColumn("_all", F.col("n")).withColumn("n", F.col("n") - F.col("test_rows"))
    with_validation = class_quotas(rest, label, validation, "validation_rows")
    return with_validation.withColumn("n", F.col("_all")).drop("_all")


def stratified_split(
    df: DataFrame, label: str = "sentiment", row_id: str = "row_id", seed: int = 42,
    test: float = 0.2, validation: float = 0.25, bucket_digits: int = 4,
) -> DataFrame:
    """Add ``split`` ('test', 'validation', 'train') with exact class quotas (M2).

    The quota of a class ends somewhere in its md5 order. Rows are counted per class and md5
    prefix, a running sum over those counts names the prefix each quota ends in, and only the
    rows of these few prefixes are ranked, to find the last key inside the quota. Each row then
    compares its own key with two limits per class: no row of the table is sorted, shuffled or
    joined. What reaches the driver is two limits per class.
    """
    spark = df.sparkSession
    keyed = df.withColumn("_key", F.concat(random_key(row_id, seed), F.lit(":"), F.col(row_id).cast("string")))
    # Written once, without texts: counts, edges and limits all read this table, and no key is made twice.
    slim = materialized(spark, keyed.select(F.col(label), "_key"), "split-keys").withColumn(
        "_prefix", F.substring("_key", 1, bucket_digits))
    # At most 16 ** bucket_digits rows per class.
    buckets = materialized(spark, slim.groupBy(label, "_prefix").agg(F.count(F.lit(1)).alias("_rows")), "split-buckets")
    quotas = split_quotas(buckets.groupBy(label).agg(F.sum("_rows").alias("n")), label, test, validation)
    ends = quotas.select(label, F.inline(F.array(
        F.struct(F.lit("test").alias("_part"), F.col("test_rows").alias("_quota")),
        F.struct(F.lit("validation").alias("_part"), (F.col("test_rows") + F.col("validation_rows")).alias("_quota")),
    ))).where("_quota > 0")
    before = F.sum("_rows").over(Window.partitionBy(label).orderBy("_prefix")) - F.col("_rows")
    edges = (
        buckets.withColumn("_before", before).join(ends, label)
        .where("_before < _quota AND _quota <= _before + _rows")
        .select(label, "_prefix", "_part", (F.col("_quota") - F.col("_before")).alias("_place"))
        .collect()
    )
    if not edges:
        return df.withColumn("split", F.lit("train"))
    where = F.struct(F.col(label), F.col("_prefix"))
    ranked = slim.where(where.isin([F.struct(F.lit(e[label]), F.lit(e["_prefix"])) for e in edges])).withColumn(
        "_place", F.row_number().over(Window.partitionBy(label, "_prefix").orderBy("_key"))
    )
    at_edge = F.struct(F.col(label), F.col("_prefix"), F.col("_place")).isin(
        [F.struct(F.lit(e[label]), F.lit(e["_prefix"]), F.lit(e["_place"]).cast("int")) for e in edges])
    keys = {(r[label], r["_prefix"], r["_place"]): r["_key"] for r in ranked.where(at_edge).collect()}
    limits = {(e["_part"], e[label]): keys[(e[label], e["_prefix"], e["_place"])] for e in edges}
    split = (
        F.when(_inside(limits, "test", label), "test")
        .when(_inside(limits, "validation", label), "validation")
        .otherwise("train")
    )
    return keyed.withColumn("split", split).drop("_key")


def _inside(limits: dict[tuple[str, str], str], part: str, label: str) -> Column:
    """Whether a row's key lies within its class's limit of this part."""
    return reduce(
        Column.__or__,
        [(F.col(label) == name) & (F.col("_key") <= key) for (kind, name), key in limits.items() if kind == part],
        F.lit(False),
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames with the same column names."""
    return reduce(DataFrame.unionByName, frames)
