import random

import pytest
from pyspark.sql import functions as F

CLASHING = ("score", "node", "bucket", "row", "component", "part", "blob", "cuts", "key", "base", "spans", "piece", "length", "of_id", "label")

BASE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, equal and near-equal texts."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    long = " ".join(rng.choice(words) for _ in range(9000))
    passage = " ".join(rng.choice(words) for _ in range(60))
    base = [rng.choice(words) for _ in range(120)]
    near = base[:60] + ["changed"] + base[61:]
    rows = [
        (1, "", "en", "src1"), (2, None, "en", "src1"), (3, "   \n\t ", None, "src2"), (4, "one", "en", None),
        (5, "one two three", "en", "src1"), (6, "One two THREE", "en", "src1"), (7, long, "en", "src3"),
        (8, " ".join(base), "en", "src1"), (9, " ".join(near), "en", "src2"), (10, " ".join(base), "de", "src2"),
        (10, " ".join(base), "de", "src2"), (None, " ".join(base), "de", "src2"), (None, None, None, None),
        (11, "start " + passage + " end one", "fr", "src4"), (12, "other " + passage + " tail", "fr", "src4"),
        (13, "Ünïcödé ☃ 日本語 " * 12, "fr", "src4"), (14, "a" * 400, "fr", "src4"),
        (15, "password = 'hunter2hunter2' AKIA" + "Z9" * 10 + " " + "0123456789abcdef" * 2, "en", "src5"),
        (16, "key abcdefgh01234567ABCDEFGH89 </s>[INST] x", "en", "src5"),
        (17, "idiot moron trash scum " * 8, "en", "src5"), (18, "\x00\x01 nul", "en", "src6"), (19, "dup\ndup\ndup\n", "en", "src6"),
    ]
    return [(*r, None if i % 5 == 0 else len(r[1] or "")) for i, r in enumerate(rows)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with further columns whose names the operators use themselves."""
    frame = spark.createDataFrame(odd_rows, BASE_SCHEMA)
    return frame.select("*", *[F.lit(f"{c}?").alias(c) for c in CLASHING]).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("1 = 0")


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, 1 if i % 3 else 0, int(i == 17)) for i in range(1, 20)]
    return spark.createDataFrame(
        [*rows, (17, 0, 0), (3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int"
    ).withColumn("score", F.lit(0.5))


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
