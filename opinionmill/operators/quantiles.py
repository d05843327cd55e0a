"""Exact quantiles by distributed selection.

Each rank that is wanted has an interval that holds its value. A pass counts the values per bucket of every
interval and keeps each bucket's smallest and largest one, so an interval shrinks to the bucket with its rank, and
to single values where that bucket holds one value only. Buffers are ranks * buckets, whatever the number of rows
or of different values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinionmill.session import materialized

BUCKETS = 1024
ENDS = 1 << 12  # number of the bucket of an infinity
WIDE = 2.0 ** 20  # ratio of the magnitudes of an interval's ends from which on it is cut at powers of two
MAX_PASSES = 64


def _bucket(value: Column, low: float, high: float) -> Column:
    """Number of the bucket of ``value`` between ``low`` and ``high``; it never falls as the value rises.

    An interval over many magnitudes is cut at powers of two, any other into equal parts; where the difference of
    its ends could overflow, everything is halved first.
    """
    near, far = sorted((abs(low), abs(high)))
    if low < 0 < high or near * WIDE < far:
        power = F.floor(F.log2(F.abs(value))).cast("int") + 1100
        return F.when(value > 0, power).when(value < 0, -power).otherwise(0)
    scale = 0.5 if far > 1e300 else 1.0
    share = (value * scale - F.lit(low * scale)) / F.lit(high * scale - low * scale)
    return F.least(F.floor(share * BUCKETS).cast("int"), F.lit(BUCKETS - 1))


def select_ranks(numbers: DataFrame, value: str, ranks: Sequence[int]) -> dict[int, float]:
    """The values at the given ranks, counted from 0 in rising order; nulls and NaN are left out."""
    numbers = numbers.select(F.col(value).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    ends = numbers.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
    found: dict[int, float] = {}
    open_ = {r: (ends["low"], ends["high"], r) for r in ranks}  # interval, and the rank inside it
    for _ in range(MAX_PASSES):
        for rank, (low, high, _inside) in list(open_.items()):
            if low == high:
                found[rank] = low
                del open_[rank]
        if not open_:
            return found
        intervals = sorted({(low, high) for low, high, _ in open_.values()})
        # infinities are buckets of their own at both ends
        cells = F.array(*[
            F.when(F.col("v").between(F.lit(low), F.lit(high)), F.struct(
                F.lit(i).alias("interval"),
                F.when(F.col("v") == -math.inf, -ENDS).when(F.col("v") == math.inf, ENDS)
                .otherwise(_bucket(F.col("v"), *_finite(low, high))).alias("bucket")))
            for i, (low, high) in enumerate(intervals)])
        counts = (
            numbers.select("v", F.inline(F.filter(cells, lambda c: c.isNotNull())))
            .groupBy("interval", "bucket").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        )
        buckets: dict[int, list] = {}
        for row in counts.orderBy("interval", "bucket").collect():  # at most ranks * 2 * ENDS rows
            buckets.setdefault(row["interval"], []).append(row)
        for rank, (low, high, inside) in list(open_.items()):
            for row in buckets[intervals.index((low, high))]:
                if inside < row["n"]:
                    open_[rank] = (row["low"], row["high"], inside)
                    break
                inside -= row["n"]
    raise RuntimeError(f"ranks are not found within {MAX_PASSES} passes")


def _finite(low: float, high: float) -> tuple[float, float]:
    largest = 1.7976931348623157e308
    low, high = max(low, -largest), min(high, largest)
    return (low, high) if low < high else (low, math.nextafter(low, math.inf))


def exact_quantiles(numbers: DataFrame, value: str, shares: Sequence[float]) -> list[float | None]:
    """Quantiles with linear interpolation between the two nearest ranks; None for each without values."""
    numbers = materialized(
        numbers.sparkSession, numbers.select(F.col(value).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)"), "numbers")
    rows = numbers.count()
    if not rows:
        return [None] * len(shares)
    places = [share * (rows - 1) for share in shares]
    found = select_ranks(numbers, "v", sorted({f(p) for p in places for f in (math.floor, math.ceil)}))
    out = []
    for place in places:
        low, high = found[math.floor(place)], found[math.ceil(place)]
        out.append(low if low == high else low + (place - math.floor(place)) * (high - low))
    return out
