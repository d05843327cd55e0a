r"""Similarity join of word n-gram sets by rare-first prefix filtering (operator 13).

All shingles are ordered by how many documents hold them, the rare ones first. Two sets that reach the similarity
share a shingle among the first ones of each, their prefixes, so documents meet by the shingles of their prefixes
only, and a document whose prefix holds no shingle of another document meets nobody. What meets is filtered by
length (the sizes must allow the similarity), by position (from the first common shingle on, both must still have
enough left) and by suffix (class counts of all that follows bound the common part), then verified on the sets.

Counting: a chunk of documents sends its digests to slices by their leading bits; a digest that many documents of
the chunk hold is sent once, with its number. Each slice sends a chunk the digests that occur elsewhere as well;
what is left of most documents is nothing. Equal sets are one node.

Joining: prefix shingles name a home, the smallest node that has the shingle in its prefix; nodes are sent to each
of their homes once, with their set. A pair is verified at the home of its first common prefix shingle, once, and
only while its nodes are in different components (see ``spanning``), so no pairs are written but the links.

Digests are compared by 48 bits: two sets of 1,000 shingles have a chance of 4e-9 to seem to share one more.

Defined results: a document without words has an empty set and is linked with nothing; one with fewer words than a
shingle has one shingle, its words; equal sets are linked; a null id is never linked and its component is null; of
rows that repeat an id each is a document of its own, so their components may differ; texts of any length are taken
whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from opinionmill.llm.common import mix64, slices, table
from opinionmill.llm.components import components
from opinionmill.llm.minhash import signer
from opinionmill.llm.spanning import Block, needed, spanning_links
from opinionmill.session import materialized

CHUNK = 800_000  # shingles of the documents that ask for counts together
MANY = 16  # documents of a chunk beyond which a shingle is sent once, with its number
MARKED = np.uint64(0xFFFF)
CHUNK_DOCS = 0xFFFF
SLICE = 1 << 21  # bytes of input a slice of the digests stands for
LOW16 = np.uint64(0xFFFF)

SENT = (
    "part int, chunk long, entries binary, numbers binary, "
    "doc_id array<long>, n array<int>, digest array<binary>, many binary"
)


def sent_shingles(docs: DataFrame, width: int, parts: int) -> DataFrame:
    """Per chunk: one row with its documents, and one row per slice with (48 digest bits, place in the chunk)."""
    wanted = T.StructType.fromDDL(SENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema, chunk, sign = to_arrow_schema(wanted), TaskContext.get().partitionId() << 32, signer()
        ids: list[int | None] = []
        sizes: list[int] = []
        digests: list[bytes | None] = []
        held: list[np.ndarray] = []
        size = 0

        def rows_of(**columns: list) -> pa.RecordBatch:
            many = len(columns["part"])
            return pa.RecordBatch.from_arrays(
                [pa.array(columns.get(f.name, [None] * many), f.type) for f in schema], schema=schema)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal chunk, size
            entries = np.sort(np.concatenate(held)) if held else np.zeros(0, np.uint64)
            keys = entries >> np.uint64(16)
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
            times = np.diff(np.append(first, len(keys)))
            often = times > MANY
            single = np.repeat(~often, times)
            marks = keys[first[often]] << np.uint64(16) | MARKED
            yield rows_of(part=[int(mix64(np.array([chunk], np.uint64))[0] % np.uint64(parts))], chunk=[chunk], doc_id=[list(ids)],
                          n=[list(sizes)], digest=[list(digests)], many=[entries[~single].tobytes()])
            sent = np.concatenate((entries[single], marks))
            number = np.concatenate((np.zeros(int(single.sum()), "<u4"), times[often].astype("<u4")))
            order = np.argsort(sent, kind="stable")
            sent, number = sent[order], number[order]
            edges = np.searchsorted(_slice(sent, parts), np.arange(parts + 1))
            some = [p for p in range(parts) if edges[p] < edges[p + 1]]
            for i in range(0, len(some), 256):
                now = some[i:i + 256]
                numbers = [number[edges[p]:edges[p + 1]] for p in now]
                yield rows_of(part=now, chunk=[chunk] * len(now), entries=[sent[edges[p]:edges[p + 1]].tobytes() for p in now],
                              numbers=[x[x > 0].tobytes() for x in numbers])
            ids.clear(), sizes.clear(), digests.clear(), held.clear()
            chunk, size = chunk + 1, 0

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shingles = sign.shingles(text.as_py(), width)
                keys = np.unique(shingles >> np.uint64(16))
                if doc is not None and len(keys):
                    held.append(keys << np.uint64(16) | np.uint64(len(ids)))
                    size += len(keys)
                ids.append(doc)
                sizes.append(len(shingles))
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                if size >= CHUNK or len(ids) >= CHUNK_DOCS:
                    yield from flush()
        if ids:
            yield from flush()

    return docs.select("doc_id", "text").mapInArrow(run, wanted)


def _slice(entries: np.ndarray, parts: int) -> np.ndarray:
    """Slices of entries by their leading bits; digests are evenly spread."""
    return ((entries >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _groups(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[list[tuple]]:
    """Lists of the rows that agree in the first column, which come one after another."""
    group: list[tuple] = []
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            for row in zip(*(c.to_pylist() for c in whole.slice(at, rows).columns), strict=True):
                if group and row[0] != group[0][0]:
                    yield group
                    group = []
                group.append(row)
    if group:
        yield group


ANSWERED = "chunk long, entries binary, levels binary, doc_id array<long>, n array<int>, digest array<binary>, many binary"


def answered_shingles(sent: DataFrame, parts: int) -> DataFrame:
    """The entries whose digest other documents hold as well, each with a level that rises with their number."""
    wanted, names = T.StructType.fromDDL(ANSWERED), sent.columns
    dealt = sent.repartition(parts, "part").sortWithinPartitions("part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(wanted)
        for group in _groups(batches, 1000):
            rows = [dict(zip(names, row, strict=True)) for row in group]
            out = [{f.name: r.get(f.name) for f in schema} for r in rows if r["doc_id"] is not None]
            asked = [r for r in rows if r["entries"] is not None]
            entries = [np.frombuffer(r["entries"], np.uint64) for r in asked]
            if asked:
                joined = np.concatenate(entries)
                numbers = np.ones(len(joined), np.int64)
                numbers[(joined & LOW16) == MARKED] = np.concatenate([np.frombuffer(r["numbers"], "<u4") for r in asked])
                order = np.argsort(joined, kind="stable")
                keys = joined[order] >> np.uint64(16)
                first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
                total = np.add.reduceat(numbers[order], first)
                level = np.zeros(len(joined), np.uint8)
                level[order] = np.repeat(
                    np.where(total > 1, np.minimum(255, 8 * np.log2(total)), 0).astype(np.uint8), np.diff(np.append(first, len(keys))))
                until = 0
                for r, own in zip(asked, entries, strict=True):
                    levels = level[until:until + len(own)]
                    until += len(own)
                    keep = levels > 0
                    if keep.any():
                        out.append({"chunk": r["chunk"], "entries": own[keep].tobytes(), "levels": levels[keep].tobytes()})
            for i in range(0, len(out), 200):
                some = out[i:i + 200]
                yield pa.RecordBatch.from_arrays([pa.array([x.get(f.name) for x in some], f.type) for f in schema], schema=schema)

    return dealt.mapInArrow(run, wanted)


RANKED = "doc_id long, n_shingles long, digest binary, row long, n long, items binary"


def ranked_sets(answered: DataFrame, parts: int, percent: int) -> DataFrame:
    """One row per document; ``items``, rare ones first, are the shingles that others hold, where these are enough
    for the similarity with any other document."""
    wanted, names = T.StructType.fromDDL(RANKED), answered.columns
    dealt = answered.repartition(parts, "chunk").sortWithinPartitions("chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(wanted)
        for group in _groups(batches, 200):
            rows = [dict(zip(names, row, strict=True)) for row in group]
            head = next(r for r in rows if r["doc_id"] is not None)
            entries = [np.frombuffer(r["entries"], np.uint64) for r in rows if r["entries"] is not None]
            levels = [np.frombuffer(r["levels"], np.uint8) for r in rows if r["entries"] is not None]
            entry = np.concatenate([*entries, np.zeros(0, np.uint64)])
            level = np.concatenate([*levels, np.zeros(0, np.uint8)])
            marked = (entry & LOW16) == MARKED
            many = np.frombuffer(head["many"], np.uint64)
            if len(many):
                keys = entry[marked] >> np.uint64(16)
                order = np.argsort(keys)
                of_many = level[marked][order][np.searchsorted(keys[order], many >> np.uint64(16))]
                entry, level = np.concatenate((entry[~marked], many)), np.concatenate((level[~marked], of_many))
            place = (entry & LOW16).astype(np.int64)
            items = level.astype(np.uint64) << np.uint64(48) | entry >> np.uint64(16)
            order = np.lexsort((items, place))
            place, items = place[order], items[order]
            n = np.array(head["n"], np.int64)
            edges = np.searchsorted(place, np.arange(len(n) + 1))
            enough = -(-percent * n // 100)
            out = {"doc_id": head["doc_id"], "n_shingles": n, "digest": head["digest"], "n": n,
                   "row": (np.int64(head["chunk"]) << 16) + np.arange(len(n)),
                   "items": [items[i:j].tobytes() if size and j - i >= least else None
                             for i, j, size, least in zip(edges[:-1].tolist(), edges[1:].tolist(), n.tolist(), enough.tolist(), strict=True)]}
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return dealt.mapInArrow(run, wanted)


def prefix_length(n: np.ndarray | int, shared: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Shared shingles in the prefix of a set: those that nobody else holds come first and need no place."""
    return n - -(-percent * n // 100) + 1 - (n - shared)


def prefixes(nodes: DataFrame, percent: int) -> DataFrame:
    """(item, node, place) of every shingle of the prefixes."""
    wanted = T.StructType.fromDDL("item long, node long, place int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(wanted)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                node, n, raw = (c.to_pylist() for c in whole.slice(at, 256).columns)
                many = np.array([prefix_length(k, len(r) // 8, percent) for k, r in zip(n, raw, strict=True)], np.int64)
                items = np.concatenate([np.frombuffer(r, np.int64, m) for r, m in zip(raw, many.tolist(), strict=True)])
                place = np.arange(len(items)) - np.repeat(np.cumsum(many) - many, many)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items), pa.array(np.repeat(np.array(node, np.int64), many)), pa.array(place.astype(np.int32))], schema=schema)

    return nodes.select("node", "n", "items").mapInArrow(run, wanted)


class _Index:
    """The prefix shingles of a block's members, and the home of each."""

    def __init__(self, block: Block):
        self.lone = np.array([n - len(s) for n, s in zip(block.n, block.sets, strict=True)])
        homes = [np.frombuffer(h, np.int64) for h in block.homes]  # -1: no other node has the shingle in its prefix
        self.homes = homes
        sizes = [len(h) for h in homes]
        owner = np.repeat(np.arange(len(homes)), sizes)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        home = np.concatenate(homes)
        used = home >= 0
        item = np.concatenate([s[:len(h)] for s, h in zip(block.sets, homes, strict=True)])[used]
        order = np.lexsort((owner[used], item))
        self.item, self.owner, self.place = item[order], owner[used][order], place[used][order]


def prefix_pairs(percent: int):
    """Candidates of a block: the earlier members that share a prefix shingle, found at the first such shingle's
    home, whose position and sizes leave room for the similarity."""
    def candidates(block: Block, row: int, home: int) -> np.ndarray:
        index = getattr(block, "index", None)
        if index is None:
            index = block.index = _Index(block)
        places = np.flatnonzero(index.homes[row] >= 0)
        own = block.sets[row][places]
        begin, end = np.searchsorted(index.item, own, side="left"), np.searchsorted(index.item, own, side="right")
        many = end - begin
        at = np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(many.sum())
        earlier = index.owner[at] < row
        at, mine = at[earlier], np.repeat(places, many)[earlier]
        others, first = np.unique(index.owner[at], return_index=True)  # rare first: the first common shingle
        mine, theirs = mine[first], index.place[at][first]
        left = np.minimum(block.sizes[row] - mine, block.sizes[others] - theirs)
        fits = (index.homes[row][mine] == home) & (left >= needed(block.n[others], block.n[row], percent))
        return others[fits]

    return candidates


def linked(nodes: DataFrame, percent: int) -> DataFrame:
    """(node, component) of all nodes (node, n, items) that are linked with another one."""
    spark = nodes.sparkSession
    entries = materialized(spark, prefixes(nodes, percent), "prefixes")
    homes = entries.groupBy("item").agg(F.min("node").alias("home"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    met = entries.join(homes, "item").groupBy("node").agg(F.collect_list(F.struct("place", "home")).alias("met"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(wanted)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                columns = {n: whole.slice(at, 256).column(i).to_pylist() for i, n in enumerate(whole.schema.names)}
                packed = []
                for n, raw, met_ in zip(columns["n"], columns["items"], columns["met"], strict=True):
                    home = np.full(prefix_length(n, len(raw) // 8, percent), -1, np.int64)
                    home[[m["place"] for m in met_]] = [m["home"] for m in met_]
                    packed.append(home.tobytes())
                columns["homes"] = packed
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)

    wanted = T.StructType.fromDDL("node long, n long, items binary, homes binary")
    joined = nodes.join(met, "node").select("node", "n", "items", "met")
    sets = materialized(spark, joined.mapInArrow(run, wanted), "met-sets")
    members = materialized(spark, entries.join(homes, "item").select("home", "node").distinct(), "members")
    return components(spanning_links(members, sets, percent, prefix_pairs(percent)))


def similar_documents(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable), one row per row of ``docs``."""
    spark = docs.sparkSession
    parts = slices(docs, SLICE)
    ranked = materialized(
        spark, ranked_sets(answered_shingles(sent_shingles(docs, width, parts), parts), parts, percent), "ranked-sets")
    copies = ranked.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("least"), F.min(F.when(F.col("items").isNotNull(), F.col("row"))).alias("node"))
    copies = materialized(spark, copies, "copies")
    nodes = ranked.where("items IS NOT NULL").select(F.col("row").alias("node"), "n", "items").join(
        copies.where("node IS NOT NULL").select("node"), "node", "left_semi")
    joined = materialized(spark, linked(materialized(spark, nodes, "nodes"), percent), "components")
    of_set = copies.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = of_set.where("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("smallest"))
    of_set = of_set.join(least, "component", "left").select("digest", F.coalesce("smallest", "least").alias("reached"))
    return ranked.select("doc_id", "n_shingles", "digest").join(of_set, "digest", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("reached", "doc_id")).alias("component_id"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at a similarity of 0.85 over four-word shingles."""
    return similar_documents(table(spark, sf_dir, "documents"), width=4, percent=85)
