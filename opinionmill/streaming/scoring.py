"""Scoring submitted reviews as they arrive."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from opinionmill.operators.classify import score_reviews
from opinionmill.operators.contracts import split_requests


def score_stream(requests: DataFrame, model: PipelineModel, text: str = "review") -> tuple[DataFrame, DataFrame]:
    """Scored and rejected rows; the same functions serve batch frames and streams."""
    accepted, rejected = split_requests(requests, text)
    return score_reviews(model, accepted, text), rejected


class AppendedTable:
    """A Parquet table under one path that grows by micro-batches, each batch exactly once.

    A batch is written beside the table as any batch table is, and then its files are moved in under the batch's
    number. No file names a place, so the table may be read under another path than the one executors wrote to.
    Markers name the newest whole batch; ``read`` opens nothing later.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        context = spark.sparkContext
        self._hadoop = context._jvm.org.apache.hadoop.fs
        self._files = self._hadoop.Path(self.path).getFileSystem(context._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        return self._files.exists(self._hadoop.Path(path))

    def _names(self, path: str) -> list[str]:
        return [f.getPath().getName() for f in self._files.listStatus(self._hadoop.Path(path))] if self._exists(path) else []

    def _placed(self) -> list[tuple[int, str]]:
        """Batch and name of every file of the table."""
        return [(int(n.split("-", 1)[0]), n) for n in self._names(self.path) if n[0].isdigit()]

    def newest(self) -> int | None:
        """The newest batch that is whole."""
        return max((int(n) for n in self._names(f"{self.path}/_batches") if n.isdigit()), default=None)

    def append(self, rows: DataFrame, batch: int) -> None:
        """Add the rows of a batch; files an earlier attempt has left go, a batch that was added before changes nothing."""
        before, staged = self.newest(), f"{self.path}/_staged/{batch:012d}"
        if before is not None and before >= batch:
            return
        if self._exists(staged):  # an earlier attempt came this far
            for name in [n for b, n in self._placed() if b == batch]:
                self._files.delete(self._hadoop.Path(f"{self.path}/{name}"), False)
        rows.write.mode("overwrite").parquet(staged)
        for name in self._names(staged):
            if name.startswith("part-"):
                target = f"{self.path}/{batch:012d}-{name}"
                if not self._files.rename(self._hadoop.Path(f"{staged}/{name}"), self._hadoop.Path(target)):
                    raise OSError(f"cannot place {target}")
        self._files.create(self._hadoop.Path(f"{self.path}/_batches/{batch:012d}"), True).close()
        if before is not None:
            self._files.delete(self._hadoop.Path(f"{self.path}/_batches/{before:012d}"), False)
        self._files.delete(self._hadoop.Path(staged), True)

    def read(self, schema: StructType) -> DataFrame:
        """The rows of whole batches, also while another is added."""
        newest = self.newest()
        paths = [f"{self.path}/{n}" for b, n in self._placed() if b <= newest] if newest is not None else []
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def require_own(self) -> None:
        """Readers follow the log of Spark's file sink where there is one, and would miss what is added here."""
        if self._exists(f"{self.path}/_spark_metadata"):
            raise ValueError(f"{self.path} was written by Spark's file sink. Append to a new path.")


def append_table(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream to a Parquet table that holds every row exactly once."""
    AppendedTable(stream.sparkSession, path).require_own()

    def save(rows: DataFrame, batch: int) -> None:
        AppendedTable(rows.sparkSession, path).append(rows, batch)

    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(save)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What a stream has appended so far; no rows before the first batch."""
    return AppendedTable(spark, path).read(schema)
