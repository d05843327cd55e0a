"""Vector columns as blocks of packed arrays, for learners that pass over the data many times.

Vectors are written in the form Spark stores them in (kind, size, indices, values) and read back as plain arrays,
which needs no Python; a block packs some hundred rows into one binary cell, so a pass costs no conversion per row.
"""

from __future__ import annotations

import copy
import zlib
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from opinionmill.session import materialized, scratch_path

ROWS = 256  # of a block
TASKS = 32  # partial sums that one task adds up
STORED = T.StructType([
    T.StructField("type", T.ByteType()), T.StructField("size", T.IntegerType()),
    T.StructField("indices", T.ArrayType(T.IntegerType())), T.StructField("values", T.ArrayType(T.DoubleType()))])
BLOCK = "size int, until binary, indices binary, values binary, labels binary"


def stored_vectors(df: DataFrame, vector: str) -> DataFrame:
    """``df`` with the vector column as a struct of type, size, indices (null if dense) and values."""
    path = scratch_path(df.sparkSession, "vectors")
    df.write.parquet(path)
    schema = T.StructType([T.StructField(f.name, STORED if f.name == vector else f.dataType) for f in df.schema])
    return df.sparkSession.read.schema(schema).parquet(path)


class Block:
    """Some rows with their labels, as the entries they are stored with or as a dense matrix."""

    def __init__(self, size: int, until: bytes, indices: bytes, values: bytes, labels: bytes, kind: type = np.float64):
        self.size = size
        self.many = np.diff(np.frombuffer(until, np.int64), prepend=0)  # entries of each row
        self.indices, self.values = np.frombuffer(indices, np.int32), np.frombuffer(values, kind)
        self.labels = np.frombuffer(labels, np.int32)

    @cached_property
    def matrix(self) -> np.ndarray:
        out = np.zeros((len(self.many), self.size))
        out[np.repeat(np.arange(len(self.many)), self.many), self.indices] = self.values
        return out

    def squared(self) -> Block:
        """The same rows with the squares of their entries."""
        out = copy.copy(self)
        out.__dict__.pop("matrix", None)
        out.values = self.values ** 2
        return out

    def rows(self, which: np.ndarray) -> Block:
        """Some of the rows, by their numbers in rising order."""
        out = copy.copy(self)
        out.__dict__.pop("matrix", None)
        kept = np.zeros(len(self.many), bool)
        kept[which] = True
        entries = np.repeat(kept, self.many)
        out.many, out.labels = self.many[kept], self.labels[kept]
        out.indices, out.values = self.indices[entries], self.values[entries]
        return out

    def products(self, vectors: np.ndarray) -> np.ndarray:
        """Of every row with every vector, the rows of ``vectors``; the work follows the entries."""
        out = np.zeros((len(self.many), len(vectors)))
        filled = np.flatnonzero(self.many)
        if len(filled):
            starts = (np.cumsum(self.many) - self.many)[filled]
            for i, vector in enumerate(vectors):
                out[filled, i] = np.add.reduceat(vector.take(self.indices) * self.values, starts)
        return out

    def weighted_sums(self, weights: np.ndarray) -> np.ndarray:
        """The rows added up, once for every column of ``weights``, which has a weight per row."""
        return np.array([
            np.bincount(self.indices, np.repeat(column, self.many) * self.values, self.size) for column in weights.T
        ]).reshape(weights.shape[1], self.size)


def vector_blocks(df: DataFrame, vector: str = "features", label: str | None = None) -> DataFrame:
    """Written blocks of the rows; ``label`` is a column of small whole numbers. Rows without a vector are left out."""
    named = df.select(F.col(vector).alias("v"), (F.col(label) if label else F.lit(0)).cast("int").alias("label"))
    rows = stored_vectors(named.where("v IS NOT NULL"), "v").select("v.size", "v.indices", "v.values", "label")
    wanted = T.StructType.fromDDL(BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(wanted)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                _, indices, values, label = (c.to_pylist() for c in whole.slice(at, ROWS).columns)
                places = [np.arange(len(v), dtype=np.int32) if i is None else np.array(i, np.int32) for i, v in zip(indices, values, strict=True)]
                sizes = [whole.column(0)[at + k].as_py() or len(v) for k, v in enumerate(values)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([max(sizes)], pa.int32()), pa.array([np.cumsum([len(p) for p in places]).astype(np.int64).tobytes()], pa.binary()),
                    pa.array([np.concatenate(places).tobytes()], pa.binary()),
                    pa.array([np.concatenate([np.array(v, np.float64) for v in values]).tobytes()], pa.binary()),
                    pa.array([np.array(label, np.int32).tobytes()], pa.binary())], schema=schema)

    return materialized(df.sparkSession, rows.mapInArrow(run, wanted), "vector-blocks")


def drawn_rows(blocks: DataFrame, rows: int, entries: int) -> tuple[Block, float] | None:
    """About ``rows`` rows, of ``entries`` entries at most on average, in one block on the driver; None without rows.

    Every row is as likely as any other, and the same blocks give the same rows. The number says how many rows one
    drawn row stands for. For estimates that steer a search, not for its result: values come in single precision.
    """
    all_ = blocks.agg(F.max("size").alias("size"), F.sum(F.length("labels") / 4).alias("rows"), F.sum(F.length("indices") / 4).alias("entries")).first()
    if not all_["rows"]:
        return None
    share = min(1.0, rows / all_["rows"], entries / max(1.0, all_["entries"]))
    wanted = T.StructType.fromDDL(BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(wanted)
        for batch in batches:
            for at in range(batch.num_rows):
                cells = [c[at].as_py() for c in batch.columns]
                block = Block(*cells)
                chance = np.random.default_rng(zlib.crc32(cells[3])).random(len(block.many))
                some = block.rows(np.flatnonzero(chance < share))
                if not len(some.many):
                    continue
                yield pa.RecordBatch.from_arrays([
                    pa.array([block.size], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (
                        np.cumsum(some.many).astype(np.int64), some.indices, some.values.astype(np.float32), some.labels)]], schema=schema)

    # rows and entries are bounded, whatever the table
    parts = [Block(*r, kind=np.float32) for r in blocks.mapInArrow(run, wanted).collect()]
    if not parts:
        return None
    out = copy.copy(parts[0])
    out.size = all_["size"]
    for name in ("many", "indices", "values", "labels"):
        setattr(out, name, np.concatenate([getattr(p, name) for p in parts]))
    return out, 1.0 / share


def block_sums(blocks: DataFrame, measure: Callable[[Block], list[np.ndarray]]) -> list[np.ndarray] | None:
    """The sums over all blocks of the arrays that ``measure`` gives for each, in one pass; None without rows."""
    def total(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray] | None:
        found = None
        for batch in batches:
            for at in range(batch.num_rows):
                found = _add(found, measure(Block(*(c[at].as_py() for c in batch.columns))))
        return found

    return task_sums(blocks, total)


def _add(total: list[np.ndarray] | None, more: list[np.ndarray]) -> list[np.ndarray]:
    return [np.array(x, np.float64) for x in more] if total is None else [t + x for t, x in zip(total, more, strict=True)]


def task_sums(df: DataFrame, total: Callable[[Iterator[pa.RecordBatch]], list[np.ndarray] | None]) -> list[np.ndarray] | None:
    """The sums over all tasks of the arrays that ``total`` makes of a task's rows; None where no task has any.

    A task sends one row, its own sums, to one of ``TASKS`` tasks, and these send theirs to one that adds them up:
    the driver gets one row, whatever the number of tasks. Sums are added in the order of their parts.
    """
    wanted = T.StructType.fromDDL("part int, sums array<binary>, shapes array<array<int>>")

    def row(sums: list[np.ndarray]) -> pa.RecordBatch:
        from pyspark import TaskContext

        return pa.RecordBatch.from_arrays([
            pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([[x.tobytes() for x in sums]], pa.list_(pa.binary())),
            pa.array([[list(x.shape) for x in sums]], pa.list_(pa.list_(pa.int32())))], schema=to_arrow_schema(wanted))

    def read(sums: list[bytes], shapes: list[list[int]]) -> list[np.ndarray]:
        return [np.frombuffer(x, np.float64).reshape(s) for x, s in zip(sums, shapes, strict=True)]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = total(batches)
        if found is not None:
            yield row(found)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            for at in range(batch.num_rows):
                found = _add(found, read(batch.column(1)[at].as_py(), batch.column(2)[at].as_py()))
        if found is not None:
            yield row(found)

    sums = df.mapInArrow(first, wanted)
    parts = df.rdd.getNumPartitions()
    for tasks in (TASKS, 1):
        if tasks < parts:
            sums = sums.repartition(tasks, F.col("part") % tasks).sortWithinPartitions("part").mapInArrow(second, wanted)
    found = sums.collect()  # one row
    return read(found[0]["sums"], found[0]["shapes"]) if found else None
