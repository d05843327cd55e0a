"""Batched text generation and translation with a function supplied by the caller."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

TextFunction = Callable[[list[str]], list[str]]
ROWS = 256  # rows whose texts are held as Python strings at once


def apply_to_texts(
    df: DataFrame, texts: str, out: str, make_function: Callable[[], TextFunction], batch_size: int = 8,
    limits: Callable[[list[str]], dict[str, int]] | None = None,
) -> DataFrame:
    """Run a ``list[str] -> list[str]`` function over an array<string> column.

    ``make_function`` is called once per task, so a model loads once and serves every batch.
    The texts of neighbouring rows are batched together and put back row by row: no row is
    exploded and nothing is shuffled. Columns the function does not see stay in the buffers they
    arrive in, and rows leave some hundred at a time. ``limits`` turns a batch into keyword arguments of the function,
    such as an output budget.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1.")
    wanted = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.StringType()))])
    place = df.columns.index(texts)

    def answers(parts: list[pa.RecordBatch], function: TextFunction) -> Iterator[str]:
        batch: list[str] = []
        for part in [*parts, None]:
            for values in [] if part is None else part.column(place).to_pylist():
                batch += values or []
                while len(batch) >= batch_size:
                    yield from answered(batch[:batch_size], function)
                    del batch[:batch_size]
        if batch:
            yield from answered(batch, function)

    def answered(batch: list[str], function: TextFunction) -> list[str]:
        found = list(function(batch, **(limits(batch) if limits else {})))
        if len(found) != len(batch):
            raise RuntimeError(f"text function returned {len(found)} results for {len(batch)} inputs")
        return [str(answer) for answer in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function, schema = make_function(), to_arrow_schema(wanted)
        for whole in batches:
            parts = [whole.slice(at, ROWS) for at in range(0, whole.num_rows, ROWS)]
            source = answers(parts, function)
            for part in parts:
                lists = pa.array([[next(source) for _ in values or []] for values in part.column(place).to_pylist()], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip([*part.columns, lists], schema, strict=True)], schema=schema)

    return df.mapInArrow(run, wanted)
