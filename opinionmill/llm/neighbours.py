r"""Approximate nearest neighbours by a forest of random-projection trees (operator 4).

Trees are fitted on at most ``fit_rows`` vectors: each node splits its sample at the median along a random
direction. Every vector is indexed: it goes to one leaf of each tree. A query walks all trees with one
shared priority queue and visits the most promising leaves; the vectors there are compared exactly, in
double precision. A leaf is cut into blocks of bounded size by a digest, so no task holds more than a
block of vectors at a time. Equal vectors form one class that is indexed once; the ``k + 1`` smallest ids of
a class are all that a list of ``k`` neighbours can need, so a vector that a third of all rows share costs
one entry and no neighbour is lost.

Defined results: vectors that are null, empty, zero, of another length than most, or hold null or
non-finite numbers take no part, neither do rows without id; a repeated row counts once; ties go to the
smaller id; a query with fewer candidates gets all that its leaves hold; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from opinionmill.llm.common import table
from opinionmill.session import materialized

FIT_ROWS = 20_000
TREES = 12
LEAF_ROWS = 400  # indexed vectors a leaf should hold
LEAF_SAMPLE = 16  # sampled vectors a leaf needs at least
VISITS = 110  # leaves a query visits at least, over all trees
VISIT_SHARE = 0.07  # of all leaves: with more vectors the same share keeps the recall
BLOCK_ROWS = 4096


class Forest:
    """Complete binary trees: direction and threshold of every inner node, level by level."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.depth = depth
        inner = (1 << depth) - 1
        self.directions = rng.standard_normal((trees, inner, sample.shape[1]))
        self.directions /= np.linalg.norm(self.directions, axis=2, keepdims=True)
        self.cuts = np.zeros((trees, inner))
        for t in range(trees):
            members = {0: np.arange(len(sample))}
            for node in range(inner):
                own = members.pop(node)
                along = sample[own] @ self.directions[t, node]
                self.cuts[t, node] = np.median(along) if len(own) else 0.0
                members[2 * node + 1] = own[along < self.cuts[t, node]]
                members[2 * node + 2] = own[along >= self.cuts[t, node]]

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf number in every tree for every vector: (vectors, trees)."""
        trees, inner = self.cuts.shape
        out = np.zeros((len(vectors), trees), np.int64)
        for t in range(trees):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                along = np.einsum("ij,ij->i", vectors, self.directions[t, node])
                node = 2 * node + 1 + (along >= self.cuts[t, node])
            out[:, t] = node - inner
        return out

    def visit(self, query: np.ndarray, visits: int) -> list[tuple[int, int]]:
        """(tree, leaf) in order of promise: one queue over all trees, by the smallest margin on the way."""
        trees, inner = self.cuts.shape
        margins = self.directions @ query - self.cuts
        queue = [(-np.inf, t, 0) for t in range(trees)]
        found = []
        while queue and len(found) < visits:
            loss, tree, node = heapq.heappop(queue)
            while node < inner:
                margin = float(margins[tree, node])
                near, far = (2 * node + 2, 2 * node + 1) if margin >= 0 else (2 * node + 1, 2 * node + 2)
                heapq.heappush(queue, (max(loss, abs(margin)), tree, far))
                node = near
            found.append((tree, node - inner))
        return found


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec) of the rows that take part, numbers as doubles."""
    vec = F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", vec.alias("vec")).where("vec_id IS NOT NULL AND vec IS NOT NULL AND size(vec) > 0")
    limit = F.lit(float("inf"))
    fine = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == limit)) & F.exists("vec", lambda x: x != 0)
    return rows.where(fine)


def classes(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(class_id, vec, members) of the different vectors, and (class_id, vec_id) of all rows."""
    # -0.0 and 0.0 are one number
    rows = rows.withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0))).withColumn("digest", F.xxhash64("vec"))
    rank = F.row_number().over(Window.partitionBy("digest", "vec", "vec_id").orderBy(F.lit(0)))
    once = rows.withColumn("copy", rank).where("copy = 1").drop("copy")
    first = Window.partitionBy("digest", "vec").orderBy("vec_id")
    small = once.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    found = small.groupBy("digest", "vec").agg(F.array_sort(F.collect_list("vec_id")).alias("members"))
    return found.select(F.element_at("members", 1).alias("class_id"), "digest", "vec", "members"), once


BLOCKS = "tree int, leaf int, salt int, kind int, class_id long, vec array<double>"


def _rows(out: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _placed(table_: DataFrame, forest: Forest, salts: int, visits: int | None) -> DataFrame:
    """Index rows (kind 0) or, with ``visits``, query rows (kind 1) for the blocks they belong to."""
    spark = table_.sparkSession
    shared = spark.sparkContext.broadcast(forest)  # bounded by trees and fit_rows
    wanted = T.StructType.fromDDL(BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(wanted)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                ids, vecs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                matrix, out = np.array(vecs, float), []
                if visits is None:
                    where = shared.value.leaves(matrix)
                    for i, vec, leaves in zip(ids, vecs, where, strict=True):
                        salt = (i * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 33
                        out += [(t, int(leaf), salt % salts, 0, i, vec) for t, leaf in enumerate(leaves)]
                else:
                    for i, vec, row in zip(ids, vecs, matrix, strict=True):
                        out += [(t, leaf, s, 1, i, vec) for t, leaf in shared.value.visit(row, visits) for s in range(salts)]
                if out:
                    yield _rows(out, schema)

    return table_.select("class_id", "vec").mapInArrow(run, wanted)


FOUND = "query_class long, class_id long, score double"


def _compared(blocks: DataFrame, k: int) -> DataFrame:
    """The best ``k + 1`` classes of each block for each query that visits it."""
    wanted = T.StructType.fromDDL(FOUND)
    key = ["tree", "leaf", "salt"]
    ordered = blocks.repartition(*key).sortWithinPartitions(*key, "kind")

    def best(ids: np.ndarray, matrix: np.ndarray, queries: list[tuple[int, list[float]]]) -> list[tuple]:
        scores = np.array([q[1] for q in queries]) @ matrix.T
        out = []
        for (query, _), row in zip(queries, scores, strict=True):
            if len(row) > k + 1:
                bar = np.partition(row, len(row) - k - 1)[len(row) - k - 1]
                kept = np.flatnonzero(row >= bar)
                kept = kept[np.lexsort((ids[kept], -row[kept]))][:k + 1]
            else:
                kept = range(len(row))
            out += [(query, int(ids[j]), float(row[j])) for j in kept]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(wanted)
        current, ids, vecs, queries, matrix = None, [], [], [], None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for tree, leaf, salt, kind, i, vec in zip(*columns, strict=True):
                if (tree, leaf, salt) != current:
                    if queries and ids:
                        yield _rows(best(np.array(ids), matrix, queries), schema)
                    current, ids, vecs, queries, matrix = (tree, leaf, salt), [], [], [], None
                if kind == 0:
                    ids.append(i)
                    vecs.append(vec)
                    continue
                if matrix is None:
                    matrix, vecs = np.array(vecs, float), []
                queries.append((i, vec))
                if len(queries) >= 256 and ids:
                    yield _rows(best(np.array(ids), matrix, queries), schema)
                    queries = []
        if queries and ids:
            yield _rows(best(np.array(ids), matrix, queries), schema)

    return ordered.mapInArrow(run, wanted)


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 20, trees: int = TREES, visits: int = VISITS,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score for every id of ``queries`` (vec_id) among the rows of ``vectors``."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    dimension = sizes[0]["n"] if sizes else 0
    found, once = classes(rows.where(F.size("vec") == dimension), k)
    index = materialized(spark, found, "neighbour-classes")
    total = index.count()
    sample = [r["vec"] for r in index.orderBy(F.xxhash64("class_id"), "class_id").limit(fit_rows).select("vec").collect()]
    depth = max(0, int(np.log2(max(1, min(total / LEAF_ROWS, len(sample) / LEAF_SAMPLE)))))
    forest = Forest(np.array(sample, float).reshape(len(sample), dimension), trees, depth)
    visits = max(visits, math.ceil(VISIT_SHARE * trees * (1 << depth)))
    salts = max(1, -(-total // ((1 << depth) * BLOCK_ROWS)))

    asked = once.join(queries.select("vec_id").distinct(), "vec_id").select("vec_id", "digest", "vec")
    ids = index.select("class_id", "digest", "vec")
    asked = materialized(spark, asked.join(ids, ["digest", "vec"]).select("class_id", F.col("vec_id").alias("query_id")), "neighbour-queries")
    query_classes = index.join(asked.select("class_id").distinct(), "class_id", "left_semi")
    blocks = _placed(index, forest, salts, None).unionByName(_placed(query_classes, forest, salts, visits))
    best = (
        _compared(blocks, k).groupBy("query_class", "class_id").agg(F.max("score").alias("score"))
        .withColumn("place", F.row_number().over(Window.partitionBy("query_class").orderBy(F.desc("score"), "class_id")))
        .where(F.col("place") <= k + 1)
    )
    entry = F.struct((-F.col("score")).alias("less"), F.col("vec_id"))
    lists = (
        best.join(index.select("class_id", "members"), "class_id")
        .select("query_class", "score", F.explode("members").alias("vec_id"))
        .groupBy("query_class").agg(F.slice(F.array_sort(F.collect_list(entry)), 1, k + 1).alias("near"))
    )
    own = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    return (
        asked.join(lists, F.col("class_id") == F.col("query_class"))
        .select("query_id", F.posexplode(F.slice(own, 1, k)).alias("place", "hit"))
        .select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                (-F.col("hit.less")).alias("score"))
    )


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every row whose id is divisible by 20, by inner product."""
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 20 = 0").select("vec_id"))
