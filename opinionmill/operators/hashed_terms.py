"""The most frequent words and neighbouring pairs where nearly every pair is a different one.

Counting all pairs means shuffling them all. Here a first pass adds up occurrences by hash, in a table of fixed size:
a bucket holds at least the occurrences of each of its terms, so a term cannot occur more often than its bucket says.
A second pass counts the terms of large buckets exactly, and only these are shuffled. The result is proven: where the
last wanted term reaches the bound that chose the buckets, every term that was left out occurs less often.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from opinionmill.operators.vector_blocks import task_sums
from opinionmill.session import materialized

BITS = 20  # of a bucket's number
SLICE = 4096  # documents taken together
COUNTED = T.StructType([T.StructField("term", T.StringType()), T.StructField("corpus_tf", T.LongType()), T.StructField("df", T.LongType())])


class Slice:
    """Words of some documents as numbers, and the buckets of the words and of the pairs of neighbours."""

    def __init__(self, lists: pa.Array, bits: int):
        encoded = lists.flatten().dictionary_encode()
        self.names, self.codes = encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)
        self.documents = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
        self.firsts = np.flatnonzero(self.documents[:-1] == self.documents[1:])  # places of the pairs
        digests = np.array([zlib.crc32(w) for w in self.names.cast(pa.binary()).to_pylist()], np.uint64)[self.codes]
        left, right = digests[self.firsts], digests[self.firsts + 1]
        self.word_buckets = _bucket(digests * np.uint64(0x9E3779B97F4A7C15), bits)
        self.pair_buckets = _bucket((left << np.uint64(32) | right) * np.uint64(0xD6E8FEB86659FD93), bits)

    def counts(self, large: np.ndarray) -> Iterator[pa.RecordBatch]:
        """term, corpus_tf, df of the terms in large buckets."""
        schema, many = to_arrow_schema(COUNTED), len(self.names)
        at = np.flatnonzero(large[self.word_buckets])
        words, tf, df = _frequencies(self.codes[at], self.documents[at])
        yield pa.RecordBatch.from_arrays([self.names.take(pa.array(words)), pa.array(tf), pa.array(df)], schema=schema)
        at = self.firsts[large[self.pair_buckets]]
        pairs, tf, df = _frequencies(self.codes[at] * many + self.codes[at + 1], self.documents[at])
        first, second = (self.names.take(pa.array(x)) for x in (pairs // max(many, 1), pairs % max(many, 1)))
        yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(first, second, " "), pa.array(tf), pa.array(df)], schema=schema)


def _bucket(digests: np.ndarray, bits: int) -> np.ndarray:
    mixed = (digests ^ (digests >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def _frequencies(keys: np.ndarray, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys, their occurrences and the documents they occur in."""
    found, numbers = np.unique(keys, return_inverse=True)
    present = np.unique(documents * max(len(found), 1) + numbers) % max(len(found), 1)
    return found, np.bincount(numbers, minlength=len(found)).astype(np.int64), np.bincount(present, minlength=len(found)).astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[Slice]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield Slice(batch.column(0).slice(at, SLICE), bits)


def bucket_counts(words: DataFrame, bits: int = BITS) -> np.ndarray | None:
    """Occurrences of words and pairs by bucket, over all rows of the one column ``words``; None without rows."""
    def total(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray] | None:
        found = None
        for part in _slices(batches, bits):
            found = np.zeros(1 << bits) if found is None else found
            for buckets in (part.word_buckets, part.pair_buckets):
                found += np.bincount(buckets, minlength=1 << bits)
        return None if found is None else [found]

    sums = task_sums(words, total)
    return None if sums is None else sums[0]


def counted_terms(words: DataFrame, large: np.ndarray) -> DataFrame:
    """term, corpus_tf, df of all words and pairs whose bucket is ``large``."""
    packed, bits = np.packbits(large).tobytes(), len(large).bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        for part in _slices(batches, bits):
            yield from part.counts(known)

    counts = words.mapInArrow(run, COUNTED)
    return counts.groupBy("term").agg(F.sum("corpus_tf").alias("corpus_tf"), F.sum("df").alias("df"))


def frequent_terms(words: DataFrame, max_features: int, bits: int = BITS) -> DataFrame | None:
    """The most frequent words and pairs, ties by name: term, corpus_tf, df; None where buckets do not prove them.

    ``words`` has one column, the words of a document in order, without nulls inside; a pair is two neighbours
    joined by a space, and no word holds a space.
    """
    counts = bucket_counts(words, bits) if max_features <= 1 << bits else None
    if counts is None:
        return None
    bound = np.floor(np.partition(counts, -max_features)[-max_features] / 2)  # a bucket also holds rare terms
    if bound < 2:
        return None
    ranked = counted_terms(words, counts >= bound).orderBy(F.desc("corpus_tf"), F.asc("term")).limit(max_features)
    found = materialized(words.sparkSession, ranked, "vocabulary")
    least = found.agg(F.count(F.lit(1)).alias("many"), F.min("corpus_tf").alias("least")).first()
    return found if least["many"] == max_features and least["least"] >= bound else None
