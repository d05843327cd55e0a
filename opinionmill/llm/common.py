"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASK64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_mod(id_column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % modulus


def wrapped(df: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` beside the whole row, so that no other column name can clash."""
    row = F.struct(*[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(df.columns)])
    return df.select("doc_id", "text", row.alias("row"))


def unwrapped(df: DataFrame, names: list[str], **changed: Column) -> DataFrame:
    """The rows of ``wrapped`` again, with some columns replaced."""
    return df.select(*[
        (changed[name] if name in changed else F.col(f"row.c{i}")).alias(name) for i, name in enumerate(names)])


def words(text: str | None) -> list[bytes]:
    r"""The words ``[^\x20\x09-\x0D]+`` as UTF-8 bytes; splitting bytes knows exactly these spaces."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_ascii(text: bytes) -> bytes:
    """Lower-case A-Z only; other letters stay."""
    return text.lower()


STORED = 3  # values a Python worker keeps


def worker_store(name: str, build: Callable[[], object]) -> object:
    """A value built once per Python worker and kept for its later tasks, such as a vocabulary.

    Functions are unpickled anew for each task, so module globals would not last. A worker keeps the few
    values it used last, so that one stage's tables make room for the next one's.
    """
    holder = sys.modules.setdefault("opinionmill_worker_store", types.ModuleType("opinionmill_worker_store"))
    values = vars(holder).setdefault("values", {})
    if name in values:
        values[name] = values.pop(name)  # now the last one used
    else:
        while len(values) >= STORED:
            del values[next(iter(values))]
        values[name] = build()
    return values[name]


UNKNOWN = 1 << 60  # bytes, from which on the planner's estimate says that it knows nothing


def slices(df: DataFrame, size: int) -> int:
    """Slices of about ``size`` bytes of the tables below ``df``, by the planner's estimate of these; four per
    shuffle partition at least."""
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), min(sum(s for s in sizes if s < UNKNOWN) // size, 1 << 20))


def map_batches(
    df: DataFrame, function: Callable[[dict[str, list]], dict[str, object]], schema: str,
    rows: int = 0,
) -> DataFrame:
    """``mapInArrow`` over columns as Python lists; ``rows`` cuts batches smaller where one is large."""
    from pyspark.sql.types import StructType

    wanted = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(wanted)
        for whole in batches:
            for at in range(0, whole.num_rows, rows or max(1, whole.num_rows)):
                batch = whole.slice(at, rows or whole.num_rows)
                out = function({n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)})
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [_array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, wanted)


def _array(values: object, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values.cast(kind)
    return pa.array(values, type=kind)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (xor-shift-multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def as_signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
