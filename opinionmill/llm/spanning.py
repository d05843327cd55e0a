"""Links between similar sets that meet in a group, without writing the pairs of a group.

A member brings its set to the group. Inside a block of bounded size the sets are compared where they are, and a
pair is only looked at while its two sides are in different components, so a block writes at most one link fewer
than it has members. Groups beyond a block are cut into several, which all hold the group's first member; what
stays in different components after that is compared across blocks, ordered by component, so the parts of one
large component do not meet again. No pair is left out: the components are those of all links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from opinionmill.llm.components import components
from opinionmill.session import materialized

BLOCK = 2048  # members of a block
BLOCK_ITEMS = 1 << 21  # elements of the sets of a block
EVERYWHERE = -1  # the block of a group's first member
LINKS = "a long, b long"


def needed(left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Common elements that sets of these sizes need for the similarity."""
    return -(-percent * (left + right) // (100 + percent))


def histograms(sets: list[np.ndarray], classes: int = 256) -> np.ndarray:
    """Elements of each set by class of their digest; the lesser counts of two sets bound what they share."""
    sizes = [len(s) for s in sets]
    row = np.repeat(np.arange(len(sets)), sizes)
    joined = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    cell = (joined * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(56)).astype(np.int64) * classes >> 8
    return np.bincount(row * classes + cell, minlength=len(sets) * classes).reshape(-1, classes).astype(np.int32)


class Block:
    """Members of a group that are compared with each other, smallest sets first."""

    def __init__(self, rows: list[tuple], percent: int):
        rows.sort(key=lambda r: (r[2], r[0]))
        self.node = np.array([r[0] for r in rows])
        self.dealt = np.array([r[1] for r in rows])
        self.n = np.array([r[2] for r in rows])
        self.sets = [np.frombuffer(r[3], np.uint64) for r in rows]
        self.sizes = np.array([len(s) for s in self.sets])
        self.homes = [r[4] for r in rows]
        self.percent = percent
        _, self.label = np.unique([r[5] for r in rows], return_inverse=True)
        self.counts = histograms(self.sets)

    def may_link(self, row: int, others: np.ndarray) -> np.ndarray:
        """Those of the earlier members ``others`` that the sizes, components and class counts do not rule out."""
        others = others[(self.label[others] != self.label[row]) & (100 * self.n[others] >= self.percent * self.n[row])]
        if len(others):
            bound = np.minimum(self.counts[others], self.counts[row]).sum(axis=1)
            others = others[bound >= needed(self.n[others], self.n[row], self.percent)]
        return others

    def shared(self, row: int, other: int) -> int:
        return len(np.intersect1d(self.sets[row], self.sets[other], assume_unique=True))

    def links(self, candidates: Callable[[Block, int], np.ndarray], across: bool) -> tuple[list[int], list[int]]:
        """Links that span the block's components, as far as ``candidates`` offers the pairs."""
        out: tuple[list[int], list[int]] = ([], [])
        for row in range(1, len(self.node)):
            if across and self.dealt[row] == EVERYWHERE:
                continue
            others = candidates(self, row)
            if across:  # pairs of one block, and those with the first member, have been compared before
                others = others[(self.dealt[others] != self.dealt[row]) & (self.dealt[others] != EVERYWHERE)]
            for other in self.may_link(row, others).tolist():
                if self.label[other] == self.label[row]:
                    continue
                if self.shared(row, other) >= needed(self.n[other], self.n[row], self.percent):
                    out[0].append(int(min(self.node[row], self.node[other])))
                    out[1].append(int(max(self.node[row], self.node[other])))
                    self.label[self.label == self.label[other]] = self.label[row]
        return out


def every_pair(block: Block, row: int) -> np.ndarray:
    return np.arange(row)


def _compared(rows: DataFrame, keys: list[str], percent: int, candidates, across: bool) -> DataFrame:
    """Links of the blocks named by ``keys``; rows hold node, dealt, n, items, homes and component."""
    wanted = T.StructType.fromDDL(LINKS)
    many = len(keys)
    ordered = rows.select(*keys, "node", "dealt", "n", "items", "homes", "component").repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, current, group = to_arrow_schema(wanted), None, []

        def finish() -> Iterator[pa.RecordBatch]:
            found = Block(group, percent).links(lambda b, row: candidates(b, row, current[0]), across)
            if found[0]:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], schema=schema)

        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                for row in zip(*(c.to_pylist() for c in whole.slice(at, 256).columns), strict=True):
                    if row[:many] != current:
                        if len(group) > 1:
                            yield from finish()
                        current, group = row[:many], []
                    group.append(row[many:])
        if len(group) > 1:
            yield from finish()

    return ordered.mapInArrow(run, wanted)


def spanning_links(members: DataFrame, sets: DataFrame, percent: int, candidates=lambda block, row, home: every_pair(block, row)) -> DataFrame:
    """Links (a, b) that give the components of all similar pairs which share a group.

    ``members`` has home and node, once each; a group's home is its smallest node and one of its members. ``sets``
    has node, n (size for the similarity), items (different 64-bit digests) and homes (handed to ``candidates``).
    """
    spark = members.sparkSession
    size = sets.select("node", (F.length("items") / 8).alias("size"))
    groups = members.join(size, "node").groupBy("home").agg(F.count(F.lit(1)).alias("m"), F.sum("size").alias("total"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("total") / BLOCK_ITEMS)).cast("int")
    groups = materialized(spark, groups.where("m > 1").select("home", blocks.alias("blocks")), "groups")
    placed = members.join(groups, "home").select(
        "home", "node", "blocks",
        F.when(F.col("node") == F.col("home"), EVERYWHERE).otherwise(F.pmod(F.xxhash64("node"), "blocks").cast("int")).alias("dealt"))
    first = placed.withColumn(
        "block", F.explode(F.when(F.col("dealt") == EVERYWHERE, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("dealt"))))
    first = first.join(sets, "node").withColumn("component", F.col("node"))
    links = materialized(spark, _compared(first, ["home", "block"], percent, candidates, False), "links")
    wide = placed.where("blocks > 1")
    if wide.isEmpty():
        return links
    joined = materialized(spark, components(links), "components")
    rows = wide.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = materialized(spark, rows, "wide-groups")
    parts = rows.groupBy("home", "component").agg(F.count(F.lit(1)).alias("c"))
    small = F.when(F.col("c") < BLOCK, F.col("c"))
    pools = parts.groupBy("home").agg(
        F.count(F.lit(1)).alias("components"), F.ceil(F.coalesce(F.sum(small), F.lit(0)) / BLOCK).alias("pools")).where("components > 1")
    # a block is a piece of one large component, or some of the small ones
    rows = rows.join(pools, "home").join(parts, ["home", "component"]).withColumn(
        "large", F.when(F.col("c") >= BLOCK, F.col("component")).otherwise(F.lit(-1).cast("long"))).withColumn(
        "piece", F.when(F.col("c") >= BLOCK, F.pmod(F.xxhash64("node"), F.ceil(F.col("c") / BLOCK)))
        .otherwise(F.pmod(F.xxhash64("component"), "pools")).cast("int"))
    rows = materialized(spark, rows.select("home", "node", "dealt", "component", "large", "piece"), "wide-blocks")
    here = rows.select("home", "large", "piece").distinct()
    there = here.select("home", F.col("large").alias("large_2"), F.col("piece").alias("piece_2"))
    one, two = F.struct("large", "piece"), F.struct("large_2", "piece_2")
    meet = here.join(there, "home").where((one <= two) & ((F.col("large") != F.col("large_2")) | (F.col("large") == -1)))
    left = meet.select("home", "large", "piece", one.alias("i"), two.alias("j"))
    right = meet.where(one != two).select(
        "home", F.col("large_2").alias("large"), F.col("piece_2").alias("piece"), one.alias("i"), two.alias("j"))
    dealt = rows.join(left.unionByName(right), ["home", "large", "piece"]).withColumn("i", F.to_json("i")).withColumn("j", F.to_json("j"))
    more = _compared(dealt.join(sets, "node"), ["home", "i", "j"], percent, candidates, True)
    return materialized(spark, links.unionByName(more), "links")
