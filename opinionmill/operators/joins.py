"""Lookups against dimensions.

No side is marked for broadcast: the planner and adaptive execution decide by the bytes they see, and a
join that shuffles has its skewed keys split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionmill.functions.text import UNKNOWN_PRODUCT

# What unassigned reviews get.
UNASSIGNED_ID = -1
UNASSIGNED_NAME = "Unclassified / missing product name"


def assign_categories(reviews: DataFrame, products: DataFrame, key: str = "product_name") -> DataFrame:
    """Left join of the product's cluster, with the defaults for unknown products.

    Reviews without a product name match nothing unless the dimension names them, however many there
    are: they get a null join key, which an outer join needs not bring together.
    """
    dim = products.select(F.col(key).alias("_product"), "cluster_id", "cluster_name").where(F.col(key) != UNKNOWN_PRODUCT)
    joinable = F.when(F.col(key) != UNKNOWN_PRODUCT, F.col(key))
    kept = [c for c in reviews.columns if c not in ("cluster_id", "cluster_name")]
    # a null key would still be one key of the shuffle, so each such row gets a key of its own
    spread = F.coalesce(joinable, F.concat(F.lit("\u0000"), F.xxhash64(*kept).cast("string")))
    return (
        reviews.select(*kept, spread.alias("_wanted")).join(dim, F.col("_wanted") == F.col("_product"), "left")
        .select(
            key, *[c for c in kept if c != key],
            F.coalesce(F.col("cluster_id"), F.lit(UNASSIGNED_ID)).cast("int").alias("cluster_id"),
            F.coalesce(F.col("cluster_name"), F.lit(UNASSIGNED_NAME)).alias("cluster_name"),
        )
    )


def lookup(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Dictionary lookup: left join that keeps every row."""
    return df.join(dim, key, "left")


def keep_members(df: DataFrame, names: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys occur in ``names``."""
    return df.join(names.select(*keys), list(keys), "left_semi")


def drop_members(df: DataFrame, names: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys do not occur in ``names``."""
    return df.join(names.select(*keys), list(keys), "left_anti")
