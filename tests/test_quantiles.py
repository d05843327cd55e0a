"""Exact quantiles by selection."""

import math
import random

import pytest

from opinionmill.operators import aggregates, quantiles


def plain(values, share):
    values = sorted(v for v in values if v is not None and not math.isnan(v))
    place = share * (len(values) - 1)
    low, high = values[math.floor(place)], values[math.ceil(place)]
    return low if low == high else low + (place - math.floor(place)) * (high - low)


@pytest.mark.parametrize("kind", ["uniform", "wide", "few", "tiny", "one", "infinite"])
def test_quantiles_match_sorting(spark, kind):
    rng = random.Random(kind)
    values = {
        "uniform": [rng.random() for _ in range(3000)],
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(500)],
        "few": [float(rng.randint(1, 5)) for _ in range(1000)] + [None, math.nan],
        "tiny": [5e-324 * rng.randint(0, 9) for _ in range(300)] + [1.7e308, -1.7e308],
        "one": [7.25],
        "infinite": [math.inf, -math.inf, math.inf, *[rng.gauss(0, 1) for _ in range(40)]],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    shares = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9)
    assert quantiles.exact_quantiles(df, "v", shares) == [plain(values, s) for s in shares]


def test_description_without_values(spark):
    row = aggregates.describe_numeric(spark.createDataFrame([(None,), (math.nan,)], "v double"), "v").first()
    assert row["count"] == 0 and row["median"] is None and row["min"] is None
