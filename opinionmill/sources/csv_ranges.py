"""CSV files read by byte ranges although quoted fields hold line breaks.

A line break ends a record where the number of quotes before it is even; doubled quotes count twice and change
nothing. Whether a range of a file starts inside quotes depends on all ranges before it, so the file is scanned
twice: each range first reports its parity and its numbers of records for both possible start states, a running
sum over the ranges of each file picks the true ones and numbers the records, and then every range cuts its own
lines into records. Only a record that crosses a range is put together from pieces.

Lines are never shuffled: a range's state, one row per split of the input, is joined to its lines by broadcast;
beyond ``BROADCAST_RANGES`` splits the lines are dealt by range instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from opinionmill.session import materialized

BROADCAST_RANGES = 200_000  # rows of about 200 bytes
MARK = b"\xef\xbb\xbf"

RANGE = "file string, start long, length long, odd int, if_outside long, if_inside long, head binary"
RECORD = "file string, record long, piece long, line binary"


class CsvParityError(ValueError):
    """The quotes of a file do not pair up."""


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """file, start and length of the range, line; line breaks are single line feeds."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"), F.col("value").cast("binary").alias("line"))


def _runs(batch: pa.RecordBatch, keys: int) -> Iterator[tuple[tuple, pa.Array]]:
    """Stretches of rows with the same first ``keys`` columns, and their lines."""
    change = np.zeros(max(0, batch.num_rows - 1), bool)
    for i in range(keys):
        column = batch.column(i)
        change |= pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
    for begin, end in zip(edges, edges[1:], strict=False):
        if begin < end:
            yield tuple(batch.column(i)[begin].as_py() for i in range(keys)), batch.column(batch.num_columns - 1).slice(begin, end - begin)


def _quotes(lines: pa.Array) -> np.ndarray:
    """Quotes up to the end of each line."""
    return np.cumsum(pc.count_substring(lines, b'"').to_numpy(zero_copy_only=False).astype(np.int64))


def _blank(lines: pa.Array) -> np.ndarray:
    length = pc.binary_length(lines).to_numpy(zero_copy_only=False)
    blank = length == 0
    for i in np.flatnonzero(length == 1).tolist():
        blank[i] = lines[i].as_py() == b"\r"
    return blank


def _ends(quotes: np.ndarray, blank: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line whether a record ends with it, and whether it is a blank line between records."""
    after = (quotes + inside) % 2
    before = np.concatenate(([inside], after[:-1]))
    between = (before == 0) & blank
    return (after == 0) & ~between, between


def range_reports(lines: DataFrame) -> DataFrame:
    """One row per range: parity of its quotes, records that end in it for both start states, and the first line."""
    wanted = T.StructType.fromDDL(RANGE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, current, state = to_arrow_schema(wanted), None, [0, 0, 0, None]

        def report() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip((*current, *state), schema, strict=True)], schema=schema)

        for batch in batches:
            for key, part in _runs(batch, 3):
                if key != current:
                    if current is not None:
                        yield report()
                    current, state = key, [0, 0, 0, part[0].as_py()]
                quotes, blank = _quotes(part), _blank(part)
                for inside in (0, 1):
                    state[1 + inside] += int(_ends(quotes, blank, (state[0] + inside) % 2)[0].sum())
                state[0] = (state[0] + int(quotes[-1])) % 2
        if current is not None:
            yield report()

    return lines.select("file", "start", "length", "line").mapInArrow(run, wanted)


def range_states(reports: DataFrame) -> DataFrame:
    """file, start, length, whether the range starts inside quotes, and the records that end before it."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int")
    known = reports.withColumn("inside", inside).withColumn(
        "ended", F.when(F.col("inside") == 0, F.col("if_outside")).otherwise(F.col("if_inside")))
    return known.select(
        "file", "start", "length", "odd", "inside", F.coalesce(F.sum("ended").over(before), F.lit(0)).alias("first"), "head")


def _pieces(lines: DataFrame, states: DataFrame, many: int) -> DataFrame:
    """(file, record, piece, line): whole records, ``piece`` null, and pieces of records that cross a range."""
    wanted = T.StructType.fromDDL(RECORD)
    keys = ["file", "start", "length"]
    known = states.select(*keys, "inside", "first")
    # a range that is cut otherwise in the second scan finds no state and stops the query
    if many <= BROADCAST_RANGES:
        joined = lines.join(F.broadcast(known), keys, "left")
    else:
        placed = lines.withColumn("place", F.monotonically_increasing_id()).join(known, keys, "left")
        joined = placed.repartition(*keys).sortWithinPartitions(*keys, "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, current, held, inside, record, lead = to_arrow_schema(wanted), None, [], 0, 0, False

        def out(file: str, records: list, lines_: list, pieces: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([file] * len(records), pa.string()), pa.array(records, pa.int64()), pa.array(pieces, pa.int64()),
                pa.array(lines_, pa.binary())], schema=schema)

        def leave() -> Iterator[pa.RecordBatch]:
            """What is left of a range is the first piece of a record, or one in its middle."""
            if current is not None and held:
                yield out(current[0], [record], [b"\n".join(held)], [current[1]])

        for batch in batches:
            for key, part in _runs(batch, 5):
                if key != current:
                    yield from leave()
                    if key[3] is None:
                        raise RuntimeError(f"{key[0]} was cut into other ranges by the second scan")
                    current, held, inside, record = key, [], key[3], key[4]
                    lead = inside == 1
                quotes, blank = _quotes(part), _blank(part)
                ends, between = _ends(quotes, blank, inside)
                texts = part.to_pylist()
                records, whole, pieces = [], [], []
                begin = 0
                for at in np.flatnonzero(ends | between).tolist():
                    if between[at]:
                        begin = at + 1
                        continue
                    own = [*held, *texts[begin:at + 1]]
                    records.append(record)
                    whole.append(own[0] if len(own) == 1 else b"\n".join(own))
                    pieces.append(key[1] if lead else None)
                    held, begin, lead = [], at + 1, False
                    record += 1
                held += texts[begin:]
                inside = (inside + int(quotes[-1])) % 2
                if records:
                    yield out(key[0], records, whole, pieces)
        yield from leave()

    return joined.select(*keys, "inside", "first", "line").mapInArrow(run, wanted)


def csv_records(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """(file, record, line) of every record, numbered from 0 in its file, and the different first lines.

    A file whose quotes do not pair up is refused: it has to be read as a whole.
    """
    lines = lines_of(spark, path)
    states = materialized(spark, range_states(range_reports(lines)), "csv-ranges")
    facts = states.groupBy("file").agg((F.sum("odd") % 2).alias("odd"), F.sum("inside").alias("crossed"), F.count(F.lit(1)).alias("ranges"))
    facts = facts.agg(F.max("odd").alias("odd"), F.sum("crossed").alias("crossed"), F.sum("ranges").alias("ranges"),
                      F.max(F.when(F.col("odd") == 1, F.col("file"))).alias("unpaired")).first()
    if facts["odd"]:
        raise CsvParityError(f"{facts['unpaired']} has a quote without its pair; read it with whole_files=True")
    heads = [r["head"] for r in states.where("first = 0 AND start = 0").select("head").distinct().limit(2).collect()]
    found = _pieces(lines, states, facts["ranges"] or 0)
    whole = found.where("piece IS NULL").select("file", "record", F.col("line").cast("string").alias("line"))
    if facts["crossed"]:
        crossing = materialized(spark, found.where("piece IS NOT NULL"), "csv-crossing")
        parts = F.sort_array(F.collect_list(F.struct("piece", F.col("line").cast("string").alias("line"))))
        joined = crossing.groupBy("file", "record").agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("line"))
        whole = whole.unionByName(joined)
    return whole, [bytes(h).removeprefix(MARK).rstrip(b"\r").decode("utf-8") for h in heads]
