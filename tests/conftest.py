import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from opinionmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "opinionmill-tests", master="local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def one(spark):
    """Evaluate a column function over a list of strings."""

    def run(function, values, kind="string"):
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        from pyspark.sql import functions as F

        return [r["out"] for r in frame.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]

    return run
