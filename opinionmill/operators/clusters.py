"""K-means over product vectors, solution comparison and silhouettes.

All restarts of all solutions are fitted together: one pass over the vectors assigns every row in every open
restart, and only sums per centre leave a task. A restart that has settled takes no further part.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.common import _py2java
from pyspark.mllib.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinionmill.operators import contracts
from opinionmill.operators.vector_blocks import Block, block_sums, vector_blocks
from opinionmill.session import materialized

# Solutions compared, restarts, seed and the smallest product table.
CLUSTER_COUNTS = (4, 5, 6)
CHOSEN_COUNT = 5
RESTARTS = 30
SEED = 42
MIN_PRODUCTS = 6


@dataclass
class Restart:
    """One fit: its centres, how often they moved, and the cost of the rows at them."""

    k: int
    seed: int
    centers: np.ndarray
    steps: int = 0
    inertia: float = float("inf")


def as_vectors(df: DataFrame, column: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(column).cast("array<double>")))


def _squares(block: Block, centers: np.ndarray) -> np.ndarray:
    """Squared distance of every row to every centre."""
    x = block.matrix
    return np.maximum(0.0, (x * x).sum(axis=1)[:, None] - 2.0 * (x @ centers.T) + (centers * centers).sum(axis=1))


def _chances(block: Block, seeds: np.ndarray) -> np.ndarray:
    """A number in (0, 1] per row and seed that depends on the row's values alone."""
    import xxhash

    digests = np.array([xxhash.xxh3_64_intdigest(row.tobytes()) for row in block.matrix], np.uint64)
    mixed = digests[:, None] ^ (seeds[None, :] * np.uint64(0x9E3779B97F4A7C15))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    mixed ^= mixed >> np.uint64(31)
    return ((mixed >> np.uint64(11)).astype(float) + 1.0) / 2.0 ** 53


def _chosen_rows(blocks: DataFrame, restarts: Sequence[Restart], step: int) -> list[np.ndarray]:
    """For every restart a row, chosen with a chance in proportion to its squared distance to the nearest centre.

    Each row draws a waiting time with that rate, and the shortest one wins, so a pass needs no second look at the
    total. Rows with equal values draw the same number.
    """
    seeds = np.array([(r.seed << 8) + step for r in restarts], np.uint64)
    centers = [r.centers for r in restarts]
    wanted = "run int, time double, center binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[float, bytes]] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                block = Block(*(c[at].as_py() for c in batch.columns))
                times = -np.log(_chances(block, seeds))
                for i, known in enumerate(centers):
                    rate = _squares(block, known).min(axis=1) if len(known) else np.ones(len(block.matrix))
                    own = np.where(rate > 1e-12, times[:, i] / np.maximum(rate, 1e-12), np.inf)
                    first = int(own.argmin())
                    found = float(own[first]), block.matrix[first].tobytes()
                    if i not in best or found < best[i]:
                        best[i] = found
        if best:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(best), pa.int32()), pa.array([t for t, _ in best.values()]), pa.array([c for _, c in best.values()], pa.binary())],
                names=["run", "time", "center"])

    nearest = blocks.mapInArrow(run, wanted).groupBy("run").agg(F.min(F.struct("time", "center")).alias("best"))
    found = {r["run"]: np.frombuffer(r["best"]["center"], np.float64) for r in nearest.collect()}  # one row per restart
    return [found[i] for i in range(len(restarts))]


def fit_restarts(blocks: DataFrame, counts: Sequence[int], restarts: int = RESTARTS, seed: int = SEED, max_iter: int = 300,
                 tolerance: float = 1e-4) -> list[Restart]:
    """Every restart for every number of clusters, each with its inertia.

    Centres start from rows chosen one after another, far ones likelier, and move to the mean of their rows until
    none moves further than ``tolerance``; a centre without rows stays. The centres of all restarts are sent to
    the tasks: restarts * clusters vectors.
    """
    size = blocks.agg(F.max("size").alias("size")).first()["size"] or 0
    fits = [Restart(k, seed + i, np.zeros((0, size))) for k in counts for i in range(restarts)]
    for step in range(max(counts)):
        open_ = [r for r in fits if len(r.centers) < r.k]
        for fit, row in zip(open_, _chosen_rows(blocks, open_, step), strict=True):
            fit.centers = np.vstack((fit.centers, row))
    moving = list(fits)
    for _ in range(max_iter + 1):
        if not moving:
            break
        edges = np.cumsum([0, *(r.k for r in moving)])
        centers = np.vstack([r.centers for r in moving])

        def measure(block: Block, centers: np.ndarray = centers, edges: np.ndarray = edges) -> list[np.ndarray]:
            squares = _squares(block, centers)
            sums, many, cost = np.zeros_like(centers), np.zeros(len(centers)), np.zeros(len(edges) - 1)
            rows = np.arange(len(block.matrix))
            for i, (begin, end) in enumerate(zip(edges, edges[1:], strict=False)):
                nearest = squares[:, begin:end].argmin(axis=1)
                cost[i] = squares[rows, begin + nearest].sum()
                member = np.zeros((end - begin, len(rows)))
                member[nearest, rows] = 1.0
                sums[begin:end] = member @ block.matrix
                many[begin:end] = member.sum(axis=1)
            return [sums, many, cost]

        sums, many, cost = block_sums(blocks, measure)
        still = []
        for i, fit in enumerate(moving):
            fit.inertia = float(cost[i])
            if fit.steps < 0:
                continue  # the cost at its last centres was all that was left to find
            own, rows = sums[edges[i]:edges[i + 1]], many[edges[i]:edges[i + 1], None]
            after = np.where(rows > 0, own / np.maximum(rows, 1.0), fit.centers)
            moved = float(np.sqrt(((after - fit.centers) ** 2).sum(axis=1)).max())
            fit.centers = after
            fit.steps = -1 if moved <= tolerance else fit.steps + 1
            still.append(fit)
        moving = still
    return fits


def as_model(features: DataFrame, fit: Restart) -> KMeansModel:
    """The fit as a model of Spark's library, which assigns rows and can be saved."""
    context = features.sparkSession.sparkContext
    jvm = context._jvm
    centers = jvm.java.util.ArrayList([_py2java(context, Vectors.dense(c)) for c in fit.centers])
    parent = jvm.org.apache.spark.mllib.clustering.KMeansModel(centers)
    return KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(f"kmeans_{fit.k}_{fit.seed}", parent)).setFeaturesCol("features")


def best_restart(fits: Sequence[Restart], k: int) -> Restart:
    """The restart with the lowest inertia, the first of equals."""
    return min((r for r in fits if r.k == k), key=lambda r: r.inertia)


def fit_kmeans(features: DataFrame, k: int, restarts: int = RESTARTS, seed: int = SEED, max_iter: int = 300) -> KMeansModel:
    """The best of several restarts."""
    return as_model(features, best_restart(fit_restarts(vector_blocks(features), [k], restarts, seed, max_iter), k))


def cosine_silhouette(clustered: DataFrame, prediction: str = "cluster_id") -> float:
    """Mean cosine silhouette in its closed form: no pair of rows is ever formed."""
    evaluator = ClusteringEvaluator(
        metricName="silhouette", distanceMeasure="cosine", featuresCol="features", predictionCol=prediction
    )
    return evaluator.evaluate(clustered.withColumn(prediction, F.col(prediction).cast("double")))


def compare_solutions(features: DataFrame, counts: Sequence[int] = CLUSTER_COUNTS, restarts: int = RESTARTS,
                      seed: int = SEED) -> tuple[DataFrame, dict[int, KMeansModel]]:
    """Inertia and silhouette for each number of clusters, and the fitted models."""
    kept = materialized(features.sparkSession, features, "solution-vectors")
    fits = fit_restarts(vector_blocks(kept), counts, restarts, seed)
    rows, models = [], {}
    for k in counts:
        best = best_restart(fits, k)
        models[k] = as_model(kept, best)
        clustered = models[k].transform(kept).withColumnRenamed("prediction", "cluster_id")
        rows.append((k, best.inertia, float(cosine_silhouette(clustered))))
    table = features.sparkSession.createDataFrame(rows, "clusters int, inertia double, cosine_silhouette double")
    return table, models


def assign_clusters(model: KMeansModel, features: DataFrame, products: DataFrame) -> DataFrame:
    """Product table with its cluster id."""
    ids = model.transform(features).select("product_name", F.col("prediction").alias("cluster_id"))
    return products.join(ids, "product_name")


def name_clusters(df: DataFrame, names: Mapping[int, str], key: str = "cluster_id") -> DataFrame:
    """Add hand-given names; the map must cover exactly the observed ids."""
    dim = df.sparkSession.createDataFrame([(int(k), v) for k, v in names.items()], f"{key} int, cluster_name string")
    contracts.require_same_ids(df, dim, key, "Cluster ids and names")
    return df.join(F.broadcast(dim), key, "left")
