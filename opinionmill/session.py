"""Session set-up and the shared folder used for written intermediate tables."""

from __future__ import annotations

import contextvars
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "opinionmill", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; sizes that belong to the cluster are left to its own settings."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.files.openCostInBytes", "1m")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A folder of our own is only made when the setting is absent and Spark runs in one
    process; on a cluster a missing setting is an error rather than a local folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="opinionmill-")
    context.setCheckpointDir(own)
    return context.getCheckpointDir() or own


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder for one written table."""
    return f"{shared_dir(spark).rstrip('/')}/opinionmill/{label}-{uuid.uuid4().hex}"


def materialized(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage so that a lost executor costs a re-read, and gives the planner the real
    size of the table, which decides whether a join may broadcast it.
    """
    path = scratch_path(spark, label)
    owner = _owner.get()
    if owner is not None:
        owner.paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_owner: contextvars.ContextVar[Scratch | None] = contextvars.ContextVar("scratch_owner", default=None)


class Scratch:
    """The tables ``materialized`` wrote inside a ``with`` block, so that their owner can remove them.

    Of nested blocks the inner one owns a table; blocks of other threads do not meet. Nothing is removed by
    leaving the block, since results may still read the tables.
    """

    def __init__(self) -> None:
        self.paths: list[str] = []
        self._before: list[contextvars.Token] = []

    def __enter__(self) -> Scratch:
        self._before.append(_owner.set(self))
        return self

    def __exit__(self, *_: object) -> None:
        _owner.reset(self._before.pop())

    def remove(self, spark: SparkSession) -> None:
        """Delete the tables; call it once everything that reads them has been written."""
        context = spark.sparkContext
        for path in self.paths:
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
        self.paths.clear()
