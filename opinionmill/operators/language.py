"""Language identification by byte trigrams, trained on a labelled table (B1).

Texts stay in the buffers they arrive in: the trigrams of a whole batch are hashed at once, and those that cross
from one text into the next are left out by their places. Training adds up counts per language, which have a fixed
size; scoring looks every trigram up in the table of log-likelihoods and adds up per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from opinionmill.functions.text import letter_count

MIN_LETTERS = 3
CELLS_LOG2 = 14
HELD_OUT = 5  # one row in five takes no part in training
CHUNK = 512  # texts hashed at once
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[ord("A"):ord("Z") + 1] += 32


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order, and the log-likelihood of every trigram cell (rows) for each of them."""

    labels: tuple[str, ...]
    likelihoods: np.ndarray
    priors: np.ndarray

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(label, float(p), self.likelihoods[:, i].tolist()) for i, (label, p) in enumerate(zip(self.labels, self.priors, strict=True))]
        spark.createDataFrame(rows, "language string, prior double, likelihoods array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> LanguageModel:
        rows = spark.read.parquet(path).orderBy("language").collect()  # one row per language
        return LanguageModel(
            tuple(r["language"] for r in rows), np.array([r["likelihoods"] for r in rows]).T, np.array([r["prior"] for r in rows]))


def _trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all trigrams of the texts, and for each text how many there are; a null text has none."""
    texts = pa.compute.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, places, data = texts.buffers()
    edges = np.frombuffer(places, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = _LOWERED[np.frombuffer(data, np.uint8)[edges[0]:edges[-1]]] if data is not None else np.zeros(0, np.uint8)
    edges = edges - edges[0]
    many = np.maximum(0, np.diff(edges) - 2)
    if not many.sum():
        return np.zeros(0, np.int64), many
    wide = raw.astype(np.uint32)
    codes = wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]
    starts = np.repeat(edges[:-1] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    cells = codes[starts] * np.uint32(0x9E3779B1) >> np.uint32(32 - CELLS_LOG2)
    return cells.astype(np.int64), many


def in_training(text: str = "text"):
    """Whether a row takes part in training, by a digest of its text."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), F.lit(HELD_OUT)) != 0


def fit_language_model(labelled: DataFrame, text: str = "text", language: str = "lang") -> LanguageModel:
    """Smoothed trigram likelihoods per language, from one pass; rows without a text or a language are left out.

    The model's size is languages * cells, whatever the corpus size.
    """
    wanted = T.StructType.fromDDL("language string, texts long, counts binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, counts, texts = to_arrow_schema(wanted), {}, {}
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                cells, many = _trigrams(batch.column(0))
                names = np.array(batch.column(1).to_pylist(), object)
                of_cell = np.repeat(names, many)
                for name in set(names):
                    found = np.bincount(cells[of_cell == name], minlength=1 << CELLS_LOG2)
                    counts[name] = counts.get(name, 0) + found
                    texts[name] = texts.get(name, 0) + int((names == name).sum())
        if counts:
            yield pa.RecordBatch.from_arrays([
                pa.array(list(counts), pa.string()), pa.array([texts[n] for n in counts], pa.int64()),
                pa.array([c.astype(np.int64).tobytes() for c in counts.values()], pa.binary())], schema=schema)

    rows = labelled.where(F.col(text).isNotNull() & F.col(language).isNotNull()).select(
        F.col(text).cast("string"), F.col(language).cast("string"))
    parts = rows.mapInArrow(run, wanted)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, counts, texts = to_arrow_schema(wanted), {}, {}
        for batch in batches:
            for name, n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts[name] = counts.get(name, 0) + np.frombuffer(raw, np.int64)
                texts[name] = texts.get(name, 0) + n
        if counts:
            yield pa.RecordBatch.from_arrays([
                pa.array(list(counts), pa.string()), pa.array([texts[n] for n in counts], pa.int64()),
                pa.array([c.tobytes() for c in counts.values()], pa.binary())], schema=schema)

    found = sorted(parts.repartition("language").mapInArrow(add, wanted).collect(), key=lambda r: r["language"])  # one row per language
    if not found:
        raise ValueError("No row has a text and a language.")
    counts = np.array([np.frombuffer(r["counts"], np.int64) for r in found], float).T + 1.0
    texts = np.array([r["texts"] for r in found], float)
    return LanguageModel(
        tuple(r["language"] for r in found), np.log(counts / counts.sum(axis=0)), np.log(texts / texts.sum()))


def detect_language(model: LanguageModel, df: DataFrame, text: str = "text", out: str = "language") -> DataFrame:
    """Add the language; texts with fewer than three letters are 'unknown' (F17)."""
    place = df.columns.index(text)
    wanted = T.StructType([*df.schema.fields, T.StructField("_detected", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(wanted)
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                cells, many = _trigrams(batch.column(place))
                until = np.cumsum(many)
                added = np.concatenate((np.zeros((1, len(model.labels))), np.cumsum(model.likelihoods[cells], axis=0)))
                scores = added[until] - added[until - many] + model.priors
                names = pa.array([model.labels[i] for i in scores.argmax(axis=1)], pa.string())
                yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(batch.columns, schema, strict=False)), names], schema=schema)

    detected = df.mapInArrow(run, wanted)
    enough = letter_count(F.coalesce(F.col(text), F.lit(""))) >= MIN_LETTERS
    return detected.withColumn(out, F.when(enough, F.col("_detected")).otherwise("unknown")).select(*df.columns, out)
