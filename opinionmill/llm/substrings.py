r"""Exact removal of repeated passages by suffix sorting (operator 7).

Every window of ``width`` bytes has an anchor, the smallest digest among its short grams, so equal windows
have equal anchors at equal places. Windows of a document that share an anchor form a segment; only
segments whose anchor digest occurs elsewhere can hold a repeated window. Segments equal to an earlier one
are repeated as a whole and are settled where they meet: inside one task first, so a passage that many
documents share leaves a task once. The different segments of one anchor digest are sorted by a
column-wise construction of their Burrows-Wheeler transform and common prefixes (see ``bwt``); windows
that share ``width`` symbols are equal, and all but the first in (document, start) are repeated.

Anchors travel as packed arrays, one per task and slice of the digests. Where one digest has very many
different segments, they are first cut into short ranges of windows and dealt by the bytes these share.

Defined results: a null text is empty; texts below ``width`` bytes lose nothing; a null id takes no part
and keeps its text; a repeated row is the same document, so it loses what the first one loses; where rows
repeat an id with other texts, a passage found in one of them is taken from all at that place; extra
columns are ignored; an empty table gives no rows.
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

from opinionmill.llm.bwt import equal_windows
from opinionmill.llm.common import map_batches, mix64, slices, table, worker_store, wrapped
from opinionmill.session import materialized

WIDTH = 100
GRAM = 32
PIECE = 1 << 19  # bytes scanned at a time
HELD = 500_000  # anchors a task holds before it passes them on
SLICE = 1 << 21  # bytes of input a slice of the anchor digests stands for
HOT = 2_000  # different segments of one anchor beyond which they are cut into shorter ranges
CELL = 8  # windows in such a range
SORTED = 3_000  # segments sorted together; one anchor's segments are never parted

# windows and at count from lo: the last window and the anchor lie fewer than width bytes behind it
ANCHOR = np.dtype([("key", "<u8"), ("content", "<u8"), ("doc", "<i8"), ("lo", "<i4"), ("windows", "u1"), ("at", "u1")])


class Roller:
    """Digests of all grams and of any range of bytes, from prefix sums modulo 2**64."""

    def __init__(self, size: int):
        rng = np.random.default_rng(70)
        self.letters = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        base = 0x9E3779B97F4A7C15
        self.power = self._powers(base, size)
        self.inverse = self._powers(pow(base, -1, 1 << 64), size)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        factors = np.full(size + 1, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.power[:len(data)], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, start: np.ndarray, until: np.ndarray) -> np.ndarray:
        return mix64((sums[until] - sums[start]) * self.inverse[start])


def roller(size: int) -> Roller:
    return worker_store(f"roller {size}", lambda: Roller(size))


def window_anchors(data: np.ndarray, starts: np.ndarray, width: int, gram: int, roll: Roller):
    """Segments of the windows at ``starts`` (rising): anchor digest, content digest, lo, hi, anchor place."""
    sums = roll.sums(data)
    grams = np.arange(len(data) - gram + 1)
    digest = roll.ranges(sums, grams, grams + gram)
    # the order of grams: 34 digest bits, then the leftmost
    order = (digest >> np.uint64(30) << np.uint64(30)) | grams.astype(np.uint64)
    span, done = width - gram + 1, 1
    least = order
    while done * 2 <= span:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    rest = span - done
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    at = (least[starts] & np.uint64((1 << 30) - 1)).astype(np.int64)
    breaks = np.flatnonzero((np.diff(at) != 0) | (np.diff(starts) != 1)) + 1
    first = np.concatenate(([0], breaks))
    last = np.concatenate((breaks, [len(starts)])) - 1
    lo, hi, anchor = starts[first], starts[last], at[first]
    content = roll.ranges(sums, lo, hi + width) ^ mix64(((hi - lo) * 1024 + (anchor - lo)).astype(np.uint64))
    return digest[anchor], content, lo, hi, anchor


def _settle(anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first of each (key, content), others): sorted by key, content, document, place."""
    anchors = anchors[np.lexsort((anchors["lo"], anchors["doc"], anchors["content"], anchors["key"]))]
    new = np.ones(len(anchors), bool)
    new[1:] = (anchors["key"][1:] != anchors["key"][:-1]) | (anchors["content"][1:] != anchors["content"][:-1])
    head = anchors[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(anchors) else anchors
    same = (head["doc"] == anchors["doc"]) & (head["lo"] == anchors["lo"])  # a repeated row is no repetition
    return anchors[new], anchors[~new & ~same]


def _cuts(docs: np.ndarray, lo: np.ndarray, until: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Per document its ranges, joined where they meet, as packed (from, until) pairs."""
    if not len(docs):
        return [], []
    order = np.lexsort((lo, docs))
    docs, lo, until = docs[order], lo[order].astype(np.int64), until[order].astype(np.int64)
    number = np.cumsum(np.concatenate(([0], (np.diff(docs) != 0).astype(np.int64))))
    shift = number << 40  # documents apart
    reach = np.maximum.accumulate(until + shift)
    new = np.concatenate(([True], lo[1:] + shift[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    ends = reach[np.concatenate((first[1:], [len(docs)])) - 1] - shift[first]
    pairs = np.column_stack((lo[first], ends)).astype("<i4")
    own = docs[first]
    edge = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1], [True])))
    return [int(own[i]) for i in edge[:-1]], [pairs[i:j].tobytes() for i, j in zip(edge[:-1], edge[1:], strict=True)]


PACKED = "part int, blob binary, doc_id long, cuts binary"
SETTLED = "doc_id long, cuts binary, key long, lo int, hi int, at int, hot boolean"


def _emit(schema: pa.Schema, **columns: list) -> pa.RecordBatch:
    size = max(len(c) for c in columns.values())
    return pa.RecordBatch.from_arrays(
        [pa.array(columns.get(f.name, [None] * size), f.type) for f in schema], schema=schema)


def packed_anchors(docs: DataFrame, width: int, gram: int, parts: int) -> DataFrame:
    """Per task and slice of digests the anchors, equal segments settled; and the cuts that gave."""
    wanted = T.StructType.fromDDL(PACKED)

    def flush(held: list[np.ndarray], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        first, others = _settle(np.concatenate(held))
        ids, cuts = _cuts(others["doc"], others["lo"], others["lo"] + others["windows"].astype(np.int64) + width)
        if ids:
            yield _emit(schema, doc_id=ids, cuts=cuts)
        # a key is the least of many digests, so only its scrambled form is spread evenly
        part = mix64(first["key"]) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        first, part = first[order], part[order]
        edges = np.searchsorted(part, np.arange(parts + 1))
        some = [p for p in range(parts) if edges[p] < edges[p + 1]]
        for i in range(0, len(some), 64):
            yield _emit(schema, part=some[i:i + 64],
                        blob=[first[edges[p]:edges[p + 1]].tobytes() for p in some[i:i + 64]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, roll = to_arrow_schema(wanted), roller(PIECE + width)
        held, many = [], 0
        waiting: list[tuple[int, int, bytes]] = []  # document, place of the first byte, bytes
        size = 0

        def scan() -> None:
            nonlocal many
            data = np.frombuffer(b"".join(w[2] for w in waiting), np.uint8)
            lengths = np.array([len(w[2]) for w in waiting])
            begins = np.cumsum(lengths) - lengths
            many_windows = lengths - width + 1
            starts = np.repeat(begins, many_windows) + np.arange(many_windows.sum()) - np.repeat(
                np.cumsum(many_windows) - many_windows, many_windows)
            key, content, lo, hi, at = window_anchors(data, starts, width, gram, roll)
            which = np.searchsorted(begins, lo, side="right") - 1
            shift = np.array([w[1] for w in waiting])[which] - begins[which]
            out = np.zeros(len(key), ANCHOR)
            out["key"], out["content"], out["doc"] = key, content, np.array([w[0] for w in waiting])[which]
            out["lo"], out["windows"], out["at"] = lo + shift, hi - lo, at - lo
            held.append(out)
            many += len(out)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if doc is None or not text.is_valid:
                    continue
                raw = text.as_py().encode("utf-8", "surrogatepass")
                for at in range(0, max(0, len(raw) - width + 1), PIECE // 2):
                    piece = raw[at:at + PIECE // 2 + width - 1]
                    if size + len(piece) > PIECE:
                        scan()
                        waiting, size = [], 0
                        if many >= HELD:
                            yield from flush(held, schema)
                            held, many = [], 0
                    waiting.append((doc, at, piece))
                    size += len(piece)
        if waiting:
            scan()
        yield from flush(held, schema)

    return docs.select("doc_id", "text").mapInArrow(run, wanted)


def settled_anchors(packed: DataFrame, width: int, parts: int) -> DataFrame:
    """Cuts of segments equal to an earlier one, and the segments whose digest has different ones."""
    wanted = T.StructType.fromDDL(SETTLED)
    # rows that carry cuts only pass through; they are dealt evenly
    place = F.coalesce("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int"))
    dealt = packed.withColumn("part", place).repartition(parts, "part").sortWithinPartitions("part")

    def finish(blobs: list[bytes], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if not blobs:
            return
        first, others = _settle(np.frombuffer(b"".join(blobs), ANCHOR))
        ids, cuts = _cuts(others["doc"], others["lo"], others["lo"] + others["windows"].astype(np.int64) + width)
        if ids:
            yield _emit(schema, doc_id=ids, cuts=cuts)
        _, group, size = np.unique(first["key"], return_inverse=True, return_counts=True)
        size = size[group]
        mixed = first[size > 1]
        hot = size[size > 1] > HOT
        for i in range(0, len(mixed), 20_000):
            some = mixed[i:i + 20_000]
            yield _emit(schema, doc_id=some["doc"], key=some["key"].view(np.int64), lo=some["lo"],
                        hi=some["lo"] + some["windows"].astype(np.int32), at=some["lo"] + some["at"].astype(np.int32),
                        hot=hot[i:i + 20_000])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, current, blobs = to_arrow_schema(wanted), None, []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("part", "blob", "doc_id", "cuts")]
            ids, cuts = [], []
            for part, blob, doc, cut in zip(*columns, strict=True):
                if cut is not None:
                    ids.append(doc)
                    cuts.append(cut)
                    continue
                if part != current:
                    yield from finish(blobs, schema)
                    current, blobs = part, []
                blobs.append(blob)
            if ids:
                yield _emit(schema, doc_id=ids, cuts=cuts)
        yield from finish(blobs, schema)

    return dealt.mapInArrow(run, wanted)


SEGMENTS = "key long, doc_id long, lo int, bytes binary, head int, tail int"


def cut_segments(docs: DataFrame, wanted_: DataFrame, width: int, gram: int) -> DataFrame:
    """The bytes of the wanted segments; those of hot anchors in short ranges, dealt by shared bytes.

    ``head`` and ``tail`` bound the bytes, inside the segment, that all segments of the key share.
    """
    per_doc = wanted_.groupBy("doc_id").agg(F.collect_list(F.struct("key", "lo", "hi", "at", "hot")).alias("wanted"))

    def run(columns):
        names = ("key", "doc_id", "lo", "bytes", "head", "tail")
        out = {n: [] for n in names}

        def add(*row) -> None:
            for name, value in zip(names, row, strict=True):
                out[name].append(value)

        for doc, text, segments in zip(columns["doc_id"], columns["text"], columns["wanted"], strict=True):
            raw = (text or "").encode("utf-8", "surrogatepass")
            for s in segments:
                key, lo, hi, at = s["key"], s["lo"], s["hi"], s["at"]
                if hi + width > len(raw):
                    continue  # another text of a repeated id
                if not s["hot"]:
                    add(key, doc, lo, raw[lo:hi + width], at - lo, at - lo + gram)
                    continue
                for cell in range((lo - at) // CELL, (hi - at) // CELL + 1):
                    begin, end = at + cell * CELL, at + cell * CELL + CELL - 1  # starts of windows in the cell
                    shared = raw[end:begin + width]
                    digest = hashlib.blake2b(shared, digest_size=8, salt=cell.to_bytes(8, "little", signed=True))
                    low, high = max(begin, lo), min(end, hi)
                    add(int.from_bytes(digest.digest(), "little", signed=True), doc, low, raw[low:high + width],
                        end - low, begin + width - low)
        return out

    joined = docs.select("doc_id", "text").join(per_doc, "doc_id")
    return map_batches(joined, run, SEGMENTS, rows=200)


def _common(one: bytes, other: bytes) -> int:
    """Length of the common prefix."""
    size = min(len(one), len(other))
    apart = int.from_bytes(one[:size], "big") ^ int.from_bytes(other[:size], "big")
    return size - (apart.bit_length() + 7) // 8


def _reach(sides: list[bytes]) -> list[int]:
    """For each string the longest prefix it shares with any other: neighbours in order tell."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    out = [0] * len(sides)
    for i, j in zip(order, order[1:], strict=False):
        shared = _common(sides[i], sides[j])
        out[i], out[j] = max(out[i], shared), max(out[j], shared)
    return out


def _trimmed(group: list[tuple], width: int) -> list[tuple[int, int, bytes]]:
    """(document, place, bytes) of what a key's segments may share: beyond it no window is equal."""
    if len(group) < 2:
        return []
    right = _reach([raw[tail:] for _, _, _, raw, _, tail in group])
    left = _reach([raw[:head][::-1] for _, _, _, raw, head, _ in group])
    out = []
    for (_, doc, lo, raw, head, tail), before, after in zip(group, left, right, strict=True):
        if before + tail - head + after >= width:
            out.append((doc, lo + head - before, raw[head - before:tail + after]))
    return out


def sorted_cuts(segments: DataFrame, width: int) -> DataFrame:
    """Cuts of the windows that occur in an earlier segment of the same key."""
    wanted = T.StructType.fromDDL("doc_id long, cuts binary")
    # equal ranges of a hot anchor need sorting once: the first stands for all, the rest is repeated whole
    first = segments.groupBy("key", "bytes").agg(F.min(F.struct("doc_id", "lo", "head", "tail")).alias("first"))
    ordered = (
        first.select("key", "first.doc_id", "first.lo", "bytes", "first.head", "first.tail")
        .repartition("key").sortWithinPartitions("key")
    )

    def finish(rows: list[tuple[int, int, bytes]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        docs, lows = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        string, offset, kind = equal_windows([r[2] for r in rows], width)
        doc, start = docs[string], lows[string] + offset
        order = np.lexsort((start, doc, kind))
        kind, doc, start = kind[order], doc[order], start[order]
        new = np.concatenate(([True], kind[1:] != kind[:-1])) if len(kind) else np.zeros(0, bool)
        head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(kind) else np.zeros(0, np.int64)
        repeated = (doc[head] != doc) | (start[head] != start)
        ids, cuts = _cuts(doc[repeated], start[repeated], start[repeated] + width)
        if ids:
            yield _emit(schema, doc_id=ids, cuts=cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, rows, group = to_arrow_schema(wanted), [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[0] != group[0][0]:
                    rows += _trimmed(group, width)
                    group = []
                    if len(rows) >= SORTED:
                        yield from finish(rows, schema)
                        rows = []
                group.append(row)
        rows += _trimmed(group, width)
        if rows:
            yield from finish(rows, schema)

    cuts = ordered.mapInArrow(run, wanted)
    heads = first.select(
        F.col("key").alias("of"), F.col("bytes").alias("of_bytes"),
        F.col("first.doc_id").alias("of_doc"), F.col("first.lo").alias("of_lo"))
    later = segments.join(heads, (F.col("key") == F.col("of")) & (F.col("bytes") == F.col("of_bytes")))
    whole = later.where((F.col("of_doc") != F.col("doc_id")) | (F.col("of_lo") != F.col("lo"))).select(
        "doc_id", "lo", (F.col("lo") + F.length("bytes")).alias("until"))

    def pack(columns):
        ids, packed = _cuts(np.array(columns["doc_id"]), np.array(columns["lo"]), np.array(columns["until"]))
        return {"doc_id": ids, "cuts": packed}

    return cuts.unionByName(map_batches(whole, pack, "doc_id long, cuts binary"))


def repeated_ranges(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, cuts): packed (from, until) pairs of bytes to remove, several rows per document."""
    spark = docs.sparkSession
    parts = slices(docs, SLICE)
    settled = materialized(spark, settled_anchors(packed_anchors(docs, width, gram, parts), width, parts), "anchors")
    mixed = settled.where("cuts IS NULL").select("doc_id", "key", "lo", "hi", "at", "hot")
    segments = materialized(spark, cut_segments(docs, mixed, width, gram), "segments")
    return settled.where("cuts IS NOT NULL").select("doc_id", "cuts").unionByName(sorted_cuts(segments, width))


def _kept(raw: bytes, repeats: list[bytes] | None) -> tuple[bytes, int]:
    """The bytes that stay and the number of runs removed."""
    if not repeats or not raw:
        return raw, 0
    pairs = np.concatenate([np.frombuffer(r, "<i4").reshape(-1, 2) for r in repeats]).clip(max=len(raw))
    edges = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edges, pairs[:, 0], 1)
    np.add.at(edges, pairs[:, 1], -1)
    gone = np.cumsum(edges)[:-1] > 0
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())


def _with_cuts(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """``docs`` with a column ``repeats`` that lists the packed cuts."""
    cuts = repeated_ranges(docs, width, gram).groupBy(F.col("doc_id").alias("of_doc")).agg(
        F.collect_list("cuts").alias("repeats"))
    return docs.join(cuts, F.col("doc_id") == F.col("of_doc"), "left")


def without_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of the bytes that stay."""
    def run(columns):
        out = {n: [] for n in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
        for text, repeats in zip(columns["text"], columns["repeats"], strict=True):
            raw = (text or "").encode("utf-8", "surrogatepass")
            kept, spans = _kept(raw, repeats)
            out["n_bytes"].append(len(raw))
            out["n_removed"].append(len(raw) - len(kept))
            out["n_spans"].append(spans)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        return {"doc_id": columns["doc_id"], **out}

    joined = _with_cuts(docs.select("doc_id", "text"), width, gram).select("doc_id", "text", "repeats")
    return map_batches(joined, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", rows=200)


def texts_without_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with the text that stays; a code point that was cut through goes, other columns are as they are."""
    names, place = docs.columns, docs.columns.index("text")
    ids = docs.select("doc_id", "text")
    cuts = repeated_ranges(ids, width, gram).groupBy(F.col("doc_id").alias("of_doc")).agg(
        F.collect_list("cuts").alias("repeats"))
    joined = wrapped(docs).join(cuts, F.col("doc_id") == F.col("of_doc"), "left").select("row", "repeats")
    wanted = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                columns = batch.column(0).flatten()
                texts = []
                for text, repeats in zip(columns[place].to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if text is not None and repeats:
                        text = _kept(text.encode("utf-8", "surrogatepass"), repeats)[0].decode("utf-8", "ignore")
                    texts.append(text)
                columns[place] = pa.array(texts, columns[place].type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(run, wanted)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the passages of 100 bytes that occur earlier."""
    return without_repeats(table(spark, sf_dir, "documents"))
