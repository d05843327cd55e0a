r"""Near-duplicate documents by circulant MinHash (operator 3).

A shingle's digest is its cell under the first permutation; the second permutation, shifted by one place
per coordinate, gives all coordinates of a signature as one slice of a table. Bands of coordinates make
buckets, and every pair that is to be linked is confirmed on the full shingle sets.

Equal sets are one node. A bucket's home is its smallest node; nodes are sent to each of their homes once, with
their full set, and compared there: a pair is only looked at while its sides are in different components, so what
is written are links that span the components, not pairs (see ``spanning``). Homes of very many nodes are cut into
blocks. With 32 bands of 5 coordinates, a pair at the threshold escapes with a chance of 3e-6.

Defined results: a document without words has an empty set and is linked with nothing; equal sets are
linked; a null id is never linked, its component is null and it is kept; rows that repeat an id share its
component; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionmill.llm.common import map_batches, mix64, table, unwrapped, worker_store, wrapped
from opinionmill.llm.components import components
from opinionmill.llm.spanning import spanning_links
from opinionmill.session import materialized

BANDS, ROWS = 32, 5
CELLS = 1 << 20
KNOWN_WORDS = 300_000


class Signer:
    """The permutation table and the digests of words."""

    def __init__(self) -> None:
        import xxhash

        rng = np.random.default_rng(20)
        second = rng.permutation(CELLS).astype(np.uint32)
        self.slices = np.lib.stride_tricks.sliding_window_view(
            np.concatenate((second, second[:BANDS * ROWS])), BANDS * ROWS)
        self.factors = (rng.integers(1, 1 << 62, 64, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        self.band_salt = rng.integers(1, 1 << 62, BANDS, dtype=np.uint64)
        self.digest = xxhash.xxh3_64_intdigest
        self.words: dict[bytes, int] = {}

    def word_digests(self, words: list[bytes]) -> np.ndarray:
        known = self.words
        found = [known.get(w) for w in words]
        if None in found:
            if len(known) > KNOWN_WORDS:
                known.clear()
            for i, value in enumerate(found):
                if value is None:
                    found[i] = known[words[i]] = self.digest(words[i])
        return np.array(found, np.uint64)

    def shingles(self, text: str | None, width: int) -> np.ndarray:
        """Sorted digests of the distinct shingles."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        digests = self.word_digests(words)
        if len(words) < width:
            return mix64(np.array([(digests * self.factors[:len(words)]).sum() + np.uint64(len(words))], np.uint64))
        total = np.zeros(len(words) - width + 1, np.uint64)
        for i in range(width):
            total += digests[i:len(words) - width + 1 + i] * self.factors[i]
        return np.unique(mix64(total))

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        cells = (shingles >> np.uint64(44)).astype(np.int64)
        least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
        for at in range(0, len(cells), 1024):
            np.minimum(least, self.slices[cells[at:at + 1024]].min(axis=0), out=least)
        return least

    def buckets(self, signature: np.ndarray) -> np.ndarray:
        parts = signature.reshape(BANDS, ROWS).astype(np.uint64)
        return mix64((parts * self.factors[:ROWS]).sum(axis=1) + self.band_salt).view(np.int64)


def signer() -> Signer:
    return worker_store("circulant minhash", Signer)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set and bucket of each band."""
    def run(columns):
        sign = signer()
        out = {n: [] for n in ("n_shingles", "digest", "buckets")}
        for text in columns["text"]:
            shingles = sign.shingles(text, width)
            out["n_shingles"].append(len(shingles))
            if len(shingles):
                out["digest"].append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                out["buckets"].append(sign.buckets(sign.signature(shingles)))
            else:
                out["digest"].append(None)
                out["buckets"].append(None)
        return {"doc_id": columns["doc_id"], **out}

    return map_batches(
        docs.select("doc_id", "text"), run, "doc_id long, n_shingles long, digest binary, buckets array<long>", rows=1000)


def shingle_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, n, items, homes) of the named documents; ``items`` are the sorted 64-bit digests of the set."""
    def run(columns):
        sign = signer()
        sets = [sign.shingles(t, width) for t in columns["text"]]
        return {"node": columns["doc_id"], "n": [len(s) for s in sets], "items": [s.tobytes() for s in sets],
                "homes": [None] * len(sets)}

    # the nodes grow with the documents, so they are never broadcast, whatever their size
    named = nodes.select(F.col("node").alias("doc_id")).distinct().hint("merge")
    wanted = docs.select("doc_id", "text").join(named, "doc_id", "left_semi")
    return map_batches(wanted, run, "node long, n long, items binary, homes binary", rows=500)


def linked(docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, component) of all nodes (node, buckets) that are linked with another one."""
    spark = docs.sparkSession
    entries = nodes.select("node", F.explode("buckets").alias("bucket"))
    homes = entries.groupBy("bucket").agg(F.min("node").alias("home"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    members = materialized(spark, entries.join(homes, "bucket").select("home", "node").distinct(), "members")
    sets = materialized(spark, shingle_sets(docs, members, width).where("n > 0"), "near-sets")
    return components(spanning_links(members, sets, percent))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable) and kept, one row per row of ``docs``."""
    spark = docs.sparkSession
    signed = materialized(spark, signatures(docs, width), "signatures")
    nodes = signed.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.first("buckets").alias("buckets"))
    nodes = materialized(spark, nodes, "nodes")
    joined = linked(docs, nodes.select("node", "buckets"), width, percent)
    of_set = nodes.select("digest", "node").join(joined, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component"))
    of_doc = (
        signed.select("doc_id", "n_shingles", "digest").join(of_set, "digest", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))
    )
    return of_doc.select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one of each group of near-duplicates, all columns as they are.

    Rows with the same id and text are one document; rows that share an id or have none are compared by their
    texts as all others are. The smallest id of a group stays, a null id only where the group has no other; of
    rows with the same id and text the one with the smallest digest of its columns.
    """
    text = F.col(f"row.c{docs.columns.index('text')}")
    rows = wrapped(docs).select(
        "doc_id", "row", F.sha2("text", 256).alias("digest"), F.sha2(F.to_json("row"), 256).alias("columns"),
        F.monotonically_increasing_id().alias("key"))
    rows = materialized(docs.sparkSession, rows, "numbered-rows")
    groups = near_duplicates(rows.select(F.col("key").alias("doc_id"), text.alias("text")), width, percent)
    groups = groups.select(F.col("doc_id").alias("key"), F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("group"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "digest", "columns", "key")
    own = F.when(F.col("group").isNull(), F.struct("doc_id", "digest"))  # without words it is linked with nothing
    first = (
        rows.select("doc_id", "digest", "columns", "key").join(groups, "key")
        .groupBy("group", own.alias("own")).agg(F.min(order).alias("first")).select("first.key")
    )
    return unwrapped(rows.join(first, "key", "left_semi"), docs.columns)


def op3_minhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at a similarity of 0.8 over four-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=4)
