r"""Language-model scores by context-tree weighting (operator 10).

A text is lower-cased (A-Z), taken as bytes and closed by an end mark. Each byte is coded as eight binary
decisions. For a decision, the contexts are the last 0 to ``DEPTH`` bytes; a context's counts give a
Krichevsky-Trofimov estimate, and every node mixes its own estimate with those of the longer contexts,
half and half before it sees data. The mixture over all depths follows from the counts alone, since the
estimates do not depend on the order of the training texts. A decision stops at the longest context in which
it was seen in training, which keeps the probabilities proper for unseen text.

Counts of byte strings and of words are gathered over the whole training corpus, as packed arrays dealt by
digest; each slice of byte strings holds whole subtrees. The most frequent entries, at most ``HOT`` of each
kind, are scored where the text is; everything else goes to the slice that holds its counts and comes back
as sums per row, so no table that grows with the corpus is held by one task.

Defined results: a null text is empty and consists of its end; rows with a null id are in the training part
(their id counts as empty text); repeated rows are learned from and scored each; an empty table gives no
rows; without training rows every decision has probability one half and no word is known.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from opinionmill.llm.common import crc_mod, mix64, table, worker_store
from opinionmill.session import materialized

DEPTH = 5
HOT = 1 << 20  # entries of byte strings, and of words, that every task holds
END = 0xFF  # never a byte of UTF-8
SCAN = 1 << 21  # bytes looked at together
HELD = 4_000_000  # counted entries a task holds before it passes them on

COUNT = np.dtype([("key", "<u8"), ("n", "<i8")])
ASKED = np.dtype([("key", "<u8"), ("row", "<i8"), ("n", "<u4")])
SUMS = np.dtype([("row", "<i8"), ("known", "<u4"), ("base", "<f8"), ("score", "<f8")])
GRAMS, WORDS, GRAMS_ASKED, WORDS_ASKED, ROW, PARTIAL = range(6)


def lower(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def end_word() -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(b" ")  # no word holds a space


def word_keys(raw: bytes) -> list[int]:
    import xxhash

    return [*map(xxhash.xxh3_64_intdigest, raw.split()), end_word()]


def byte_strings(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, text number) of every byte with its ``depth`` bytes before it; texts begin after zero bytes."""
    lead = b"\x00" * depth
    data = np.frombuffer(b"".join(lead + t + b"\xff" for t in texts), np.uint8).astype(np.uint64)
    keys = np.zeros(len(data) - depth, np.uint64)
    for i in range(depth + 1):
        keys = (keys << np.uint64(8)) | data[i:len(data) - depth + i]
    sizes = np.array([len(t) + 1 for t in texts])
    skipped = np.cumsum(sizes + depth) - (sizes + depth)
    text = np.repeat(np.arange(len(texts)), sizes)
    at = skipped[text] + np.arange(sizes.sum()) - (np.cumsum(sizes) - sizes)[text]
    return keys[at], text


def part_of_grams(keys: np.ndarray, parts: int) -> np.ndarray:
    """The slice of a byte string: all that share the last two context bytes are together."""
    return (mix64((keys >> np.uint64(8)) & np.uint64(0xFFFF)) % np.uint64(parts)).astype(np.int64)


def part_of_words(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mix64(keys) % np.uint64(parts)).astype(np.int64)


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts.astype(np.int64)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def _split(records: np.ndarray, part: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(part, kind="stable")
    records, part = records[order], part[order]
    edges = np.searchsorted(part, np.arange(parts + 1))
    for p in range(parts):
        if edges[p] < edges[p + 1]:
            yield p, records[edges[p]:edges[p + 1]].tobytes()


def _table(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


BLOBS = "part int, kind int, blob binary"


def counted(docs: DataFrame, depth: int, parts: int) -> DataFrame:
    """Counts of byte strings and words of all texts: one row per slice and kind, keys sorted."""
    wanted = T.StructType.fromDDL(BLOBS)

    def flush(held, schema):
        for kind, deal in ((GRAMS, part_of_grams), (WORDS, part_of_words)):
            if held[kind]:
                keys, counts = _merged(*(np.concatenate(c) for c in zip(*held[kind], strict=True)))
                records = np.zeros(len(keys), COUNT)
                records["key"], records["n"] = keys, counts
                rows = [{"part": p, "kind": kind, "blob": b} for p, b in _split(records, deal(keys, parts), parts)]
                for i in range(0, len(rows), 64):
                    yield _table(schema, rows[i:i + 64])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(wanted)
        held, size = {GRAMS: [], WORDS: []}, 0
        for texts in _scans(batches, ("text",)):
            raws = [lower(r[0]) for r in texts]
            held[GRAMS].append(np.unique(byte_strings(raws, depth)[0], return_counts=True))
            words = np.array([w for raw in raws for w in word_keys(raw)], np.uint64)
            held[WORDS].append(np.unique(words, return_counts=True))
            size += len(held[GRAMS][-1][0]) + len(held[WORDS][-1][0])
            if size >= HELD:
                yield from flush(held, schema)
                held, size = {GRAMS: [], WORDS: []}, 0
        yield from flush(held, schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(wanted)

        def finish(current, blobs):
            records = np.frombuffer(b"".join(blobs), COUNT)
            keys, counts = _merged(records["key"], records["n"])
            out = np.zeros(len(keys), COUNT)
            out["key"], out["n"] = keys, counts
            return _table(schema, [{"part": current[0], "kind": current[1], "blob": out.tobytes()}])

        current, blobs = None, []
        for batch in batches:
            for part, kind, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (part, kind) != current:
                    if blobs:
                        yield finish(current, blobs)
                    current, blobs = (part, kind), []
                blobs.append(blob)
        if blobs:
            yield finish(current, blobs)

    dealt = docs.select("text").mapInArrow(gather, wanted).repartition(parts, "part", "kind")
    return dealt.sortWithinPartitions("part", "kind").mapInArrow(merge, wanted)


def _scans(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[list[tuple]]:
    """Rows in groups of about SCAN bytes of text (the first column)."""
    rows, size = [], 0
    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            rows.append(row)
            size += len(row[0] or "") + 16
            if size >= SCAN:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


_STIRLING = np.array([1 / 12, -1 / 360, 1 / 1260])


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function for x > 0."""
    x = np.asarray(x, float)
    shift = np.where(x < 8, 8.0, 0.0)
    low = np.ones_like(x)
    for k in range(8):
        low = np.where(x < 8, low * (x + k), low)
    y = x + shift
    series = _STIRLING[0] / y + _STIRLING[1] / y**3 + _STIRLING[2] / y**5
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + series - np.log(low)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability a Krichevsky-Trofimov estimator gives to any order of these decisions."""
    return (log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0)
            - 2 * math.log(math.sqrt(math.pi)))


class Level:
    """Nodes of one depth and one of the eight decisions: (context, decided bits), with counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, bit: int):
        symbol = keys & np.uint64(0xFF)
        decided = np.uint64(1 << bit) | (symbol >> np.uint64(8 - bit))
        one = ((symbol >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int64)
        node = ((keys >> np.uint64(8)) << np.uint64(8)) | decided
        first = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1]))) if len(node) else np.zeros(0, np.int64)
        self.keys = node[first]
        total = np.add.reduceat(counts, first) if len(node) else np.zeros(0, np.int64)
        self.ones = np.add.reduceat(counts * one, first) if len(node) else np.zeros(0, np.int64)
        self.zeros = total - self.ones


class Subtrees:
    """All nodes of depth 2 to ``depth`` over sorted byte strings and their counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int):
        self.depth = depth
        self.levels: dict[int, list[Level]] = {}
        counts = counts.astype(np.int64)
        for d in range(depth, 1, -1):
            self.levels[d] = [Level(keys, counts, bit) for bit in range(8)]
            keys, counts = _merged(keys & np.uint64((1 << 8 * d) - 1), counts)
        for d in range(depth, 1, -1):
            for bit, level in enumerate(self.levels[d]):
                level.own = log_kt(level.zeros, level.ones)
                if d == depth:
                    level.longer, level.weighted = None, level.own
                else:
                    below = self.levels[d + 1][bit]
                    at = np.searchsorted(level.keys, below.keys & np.uint64((1 << 8 * (d + 1)) - 1))
                    level.longer = np.bincount(at, below.weighted, minlength=len(level.keys))
                    level.weighted = np.logaddexp(level.own, level.longer) - math.log(2)

    def totals(self) -> tuple[np.ndarray, ...]:
        """(decision with one byte of context, zeros, ones, log probability of the longer contexts)."""
        keys = np.concatenate([lv.keys & np.uint64(0xFFFF) for lv in self.levels[2]]).astype(np.int64)
        columns = [np.concatenate([getattr(lv, n) for lv in self.levels[2]]) for n in ("zeros", "ones", "weighted")]
        return keys, *(np.bincount(keys, c, minlength=1 << 16) for c in columns)

    def mix(self, short: ShortContexts) -> None:
        """Probability of a one at every node, if it is the longest known context."""
        for bit in range(8):
            for d in range(2, self.depth + 1):
                level = self.levels[d][bit]
                if d == 2:
                    parent = (level.keys & np.uint64(0xFFFF)).astype(np.int64)
                    said, left = short.said[parent], short.left[parent]
                else:
                    above = self.levels[d - 1][bit]
                    at = np.searchsorted(above.keys, level.keys & np.uint64((1 << 8 * d) - 1))
                    said, left = above.passed[at], above.rest[at]
                estimate = (level.ones + 0.5) / (level.zeros + level.ones + 1.0)
                level.one = said + left * estimate
                if d < self.depth:
                    here = 1 / (1 + np.exp(np.clip(level.longer - level.own, -700, 700)))
                    level.passed, level.rest = said + left * here * estimate, left * (1 - here)

    def log10(self, keys: np.ndarray, short: ShortContexts) -> np.ndarray:
        """log10 probability of the last byte of each byte string behind its context."""
        out = np.zeros(len(keys))
        symbol, context = keys & np.uint64(0xFF), keys >> np.uint64(8)
        for bit in range(8):
            decided = np.uint64(1 << bit) | (symbol >> np.uint64(8 - bit))
            node = (context << np.uint64(8)) | decided
            one = short.one[(node & np.uint64(0xFFFF)).astype(np.int64)].copy()
            for d in range(2, self.depth + 1):
                level = self.levels[d][bit]
                if len(level.keys):
                    wanted = node & np.uint64((1 << 8 * (d + 1)) - 1)
                    at = np.minimum(np.searchsorted(level.keys, wanted), len(level.keys) - 1)
                    found = level.keys[at] == wanted
                    one[found] = level.one[at[found]]
            ones = (symbol >> np.uint64(7 - bit)) & np.uint64(1) == 1
            out += np.log10(np.where(ones, one, 1 - one))
        return out


class ShortContexts:
    """Contexts of no and of one byte, as dense tables of 65,536 entries.

    ``one`` is the probability of a one where no longer context is known, ``said`` what the short contexts
    contribute and ``left`` the weight that remains for longer ones.
    """

    def __init__(self, zeros: np.ndarray, ones: np.ndarray, longer: np.ndarray):
        seen1 = (zeros + ones) > 0
        own1 = log_kt(zeros, ones)
        weighted1 = np.where(seen1, np.logaddexp(own1, longer) - math.log(2), 0.0)
        decided = np.arange(1 << 16) & 0xFF
        zeros0, ones0, longer0 = (np.bincount(decided, c, minlength=256) for c in (zeros, ones, weighted1))
        own0 = log_kt(zeros0, ones0)
        here0 = 1 / (1 + np.exp(np.clip(longer0 - own0, -700, 700)))
        estimate0 = (ones0 + 0.5) / (zeros0 + ones0 + 1.0)
        seen0 = (zeros0 + ones0) > 0
        one0 = np.where(seen0, estimate0, 0.5)
        said0, left0 = here0 * estimate0, 1 - here0
        here1 = 1 / (1 + np.exp(np.clip(longer - own1, -700, 700)))
        estimate1 = (ones + 0.5) / (zeros + ones + 1.0)
        self.one = np.where(seen1, said0[decided] + left0[decided] * estimate1, one0[decided])
        self.said = said0[decided] + left0[decided] * here1 * estimate1
        self.left = left0[decided] * (1 - here1)


def short_contexts(merged: DataFrame, depth: int) -> ShortContexts:
    """Sums over the slices; at most 65,536 rows reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                records = np.frombuffer(blob, COUNT)
                keys, zeros, ones, longer = Subtrees(records["key"], records["n"], depth).totals()
                some = np.unique(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), pa.array(zeros[some]), pa.array(ones[some]), pa.array(longer[some])],
                    names=["node", "zeros", "ones", "longer"])

    sums = merged.where(F.col("kind") == GRAMS).select("blob").mapInArrow(
        run, "node long, zeros double, ones double, longer double")
    rows = sums.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "longer")]).collect()
    dense = {c: np.zeros(1 << 16) for c in ("zeros", "ones", "longer")}
    for r in rows:
        for c in dense:
            dense[c][r["node"]] = r[c]
    return ShortContexts(**dense)


def hot_limits(merged: DataFrame, hot: int) -> tuple[dict[int, int], int, int]:
    """Per kind the count from which an entry is hot, so that at most ``hot`` are; all and different words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                n = np.frombuffer(blob, COUNT)["n"].astype(np.int64)
                step, many = np.unique((8 * np.log2(n)).astype(np.int64), return_counts=True)
                total = np.zeros(len(step), np.int64)
                total[0] = n.sum()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * len(step), pa.int32()), pa.array(step), pa.array(many.astype(np.int64)), pa.array(total)],
                    names=["kind", "step", "many", "total"])

    rows = (
        merged.select("kind", "blob").mapInArrow(run, "kind int, step long, many long, total long")
        .groupBy("kind", "step").agg(F.sum("many").alias("many"), F.sum("total").alias("total")).collect()
    )
    limits = {}
    for kind in (GRAMS, WORDS):
        room, limit = hot, None
        for r in sorted((r for r in rows if r["kind"] == kind), key=lambda r: -r["step"]):
            room -= r["many"]
            if room < 0:
                break
            limit = r["step"]
        limits[kind] = 1 << 60 if limit is None else limit
    words = [r for r in rows if r["kind"] == WORDS]
    return limits, sum(r["total"] for r in words), sum(r["many"] for r in words)


def _is_hot(n: np.ndarray, limit: int) -> np.ndarray:
    return (8 * np.log2(n.astype(np.int64))).astype(np.int64) >= limit


class Hot:
    """The frequent byte strings with their log10 probability, the frequent words with their counts."""

    def __init__(self, grams: np.ndarray, logs: np.ndarray, words: np.ndarray, counts: np.ndarray):
        order = np.argsort(grams)
        self.grams, self.logs = grams[order], logs[order]
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]


def hot_entries(merged: DataFrame, short: ShortContexts, depth: int, limits: dict[int, int]) -> Hot:
    """At most ``hot`` entries of each kind, by way of the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                records = np.frombuffer(blob, COUNT)
                keys = records["key"][_is_hot(records["n"], limits[kind])]
                if kind == GRAMS and len(keys):
                    trees = Subtrees(records["key"], records["n"], depth)
                    trees.mix(short)
                    values = trees.log10(keys, short)
                else:
                    values = records["n"][_is_hot(records["n"], limits[kind])].astype(float)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind], pa.int32()), pa.array([keys.tobytes()], pa.binary()),
                     pa.array([values.tobytes()], pa.binary())], names=["kind", "keys", "vals"])

    rows = merged.select("kind", "blob").mapInArrow(run, "kind int, keys binary, vals binary").collect()

    def joined(kind: int, name: str, dtype) -> np.ndarray:
        return np.frombuffer(b"".join(bytes(r[name]) for r in rows if r["kind"] == kind), dtype)

    return Hot(joined(GRAMS, "keys", np.uint64), joined(GRAMS, "vals", float),
               joined(WORDS, "keys", np.uint64), joined(WORDS, "vals", float))


FLOW = ("part int, kind int, blob binary, row long, doc_id long, held_out boolean, n_tokens long, n_known long, "
        "n_bytes long, base double, score double")


def _found(table_: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table_):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table_, keys), len(table_) - 1)
    return at, table_[at] == keys


def _base(counts: np.ndarray, total: int, different: int) -> np.ndarray:
    return np.log10((counts + 1) / (total + (different + 1)))


def local_scores(rows: DataFrame, hot, depth: int, parts: int, total: int, different: int, name: str) -> DataFrame:
    """Per row what the hot entries give; and, packed by slice, what has to be asked for."""
    wanted = T.StructType.fromDDL(FLOW)

    def sums(keys, owner, size, hot_keys, values):
        """(sum per row, hits per row, asked keys, their rows, their times)"""
        order = np.argsort(keys)
        keys, owner = keys[order], owner[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        at, found = _found(hot_keys, keys[first])
        times = np.diff(np.concatenate((first, [len(keys)])))
        each = np.repeat(np.where(found, values[at] if len(values) else 0.0, 0.0), times)
        hit = np.repeat(found, times)
        asked, rows_asked = keys[~hit], owner[~hit]
        return np.bincount(owner, each, minlength=size), np.bincount(owner[hit], minlength=size), asked, rows_asked

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, known = to_arrow_schema(wanted), worker_store(name, lambda: hot.value)
        base = _base(known.counts, total, different)
        held: dict[int, list[np.ndarray]] = {GRAMS_ASKED: [], WORDS_ASKED: []}
        size = 0

        def flush():
            for kind, deal in ((GRAMS_ASKED, part_of_grams), (WORDS_ASKED, part_of_words)):
                if held[kind]:
                    records = np.concatenate(held[kind])
                    out = [{"part": p, "kind": kind, "blob": b} for p, b in _split(records, deal(records["key"], parts), parts)]
                    for i in range(0, len(out), 64):
                        yield _table(schema, out[i:i + 64])
                held[kind] = []

        for some in _scans(batches, ("text", "row", "doc_id", "held_out")):
            raws, ids = [lower(r[0]) for r in some], np.array([r[1] for r in some])
            keys, owner = byte_strings(raws, depth)
            score, _, asked, by = sums(keys, owner, len(some), known.grams, known.logs)
            words = [word_keys(raw) for raw in raws]
            lengths = np.array([len(w) for w in words])
            flat = np.array([k for w in words for k in w], np.uint64)
            base_sum, hits, asked_words, by_words = sums(
                flat, np.repeat(np.arange(len(some)), lengths), len(some), known.words, base)
            for kind, k, o in ((GRAMS_ASKED, asked, by), (WORDS_ASKED, asked_words, by_words)):
                if len(k):
                    pairs = np.lexsort((ids[o], k))
                    k, o = k[pairs], ids[o][pairs]
                    new = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (o[1:] != o[:-1]))))
                    records = np.zeros(len(new), ASKED)
                    records["key"], records["row"] = k[new], o[new]
                    records["n"] = np.diff(np.concatenate((new, [len(k)])))
                    held[kind].append(records)
                    size += len(records)
            place = (mix64(ids.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
            yield _table(schema, [
                {"part": int(p), "kind": ROW, "row": r[1], "doc_id": r[2], "held_out": r[3], "n_tokens": int(n),
                 "n_known": int(h), "n_bytes": len(raw) + 1, "base": float(b), "score": float(s)}
                for p, r, raw, n, h, b, s in zip(place, some, raws, lengths, hits, base_sum, score, strict=True)])
            if size >= HELD // 4:
                yield from flush()
                size = 0
        yield from flush()

    return rows.mapInArrow(run, wanted)


def answered(flow: DataFrame, merged: DataFrame, short, depth: int, parts: int, total: int, different: int) -> DataFrame:
    """Each slice answers what was asked of it: sums per row, packed by the slice of the row."""
    spark = flow.sparkSession
    wanted = T.StructType.fromDDL(FLOW)
    names = [f.name for f in wanted]
    both = flow.unionByName(merged, allowMissingColumns=True)
    dealt = both.repartition(parts, "part").sortWithinPartitions("part", "kind")

    def answers(counts: bytes, asked: list[bytes], kind: int) -> np.ndarray:
        records, wanted_ = np.frombuffer(counts, COUNT), np.frombuffer(b"".join(asked), ASKED)
        keys, back = np.unique(wanted_["key"], return_inverse=True)
        out = np.zeros(len(wanted_), SUMS)
        out["row"] = wanted_["row"]
        if kind == GRAMS_ASKED:
            trees = Subtrees(records["key"], records["n"], depth)
            trees.mix(short.value)
            out["score"] = trees.log10(keys, short.value)[back] * wanted_["n"]
        else:
            at, found = _found(records["key"], keys)
            n = np.where(found, records["n"][at] if len(records) else 0, 0).astype(float)
            out["base"] = _base(n, total, different)[back] * wanted_["n"]
            out["known"] = np.where(found[back], wanted_["n"], 0)
        order = np.argsort(out["row"], kind="stable")
        out = out[order]
        first = np.flatnonzero(np.concatenate(([True], out["row"][1:] != out["row"][:-1])))
        joined = np.zeros(len(first), SUMS)
        joined["row"] = out["row"][first]
        for c in ("known", "base", "score"):
            joined[c] = np.add.reduceat(out[c], first)
        return joined

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(wanted)
        current, counts, asked = None, {GRAMS: b"", WORDS: b""}, {GRAMS_ASKED: [], WORDS_ASKED: []}

        def finish():
            for ask, kind in ((GRAMS_ASKED, GRAMS), (WORDS_ASKED, WORDS)):
                if asked[ask]:
                    sums = answers(counts[kind], asked[ask], ask)
                    deal = (mix64(sums["row"].astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
                    out = [{"part": p, "kind": PARTIAL, "blob": b} for p, b in _split(sums, deal, parts)]
                    for i in range(0, len(out), 64):
                        yield _table(schema, out[i:i + 64])

        for batch in batches:
            rows = []
            for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if row[1] == ROW:
                    rows.append(dict(zip(names, row, strict=True)))
                    continue
                if row[0] != current:
                    yield from finish()
                    current, counts, asked = row[0], {GRAMS: b"", WORDS: b""}, {GRAMS_ASKED: [], WORDS_ASKED: []}
                if row[1] in counts:
                    counts[row[1]] = row[2]
                else:
                    asked[row[1]].append(row[2])
            if rows:
                yield _table(schema, rows)
        yield from finish()

    return dealt.select(*names).mapInArrow(run, wanted)




def summed(flow: DataFrame, parts: int, total: int) -> DataFrame:
    """The rows with what came back for them."""
    wanted = T.StructType.fromDDL(FLOW)
    names = [f.name for f in wanted]
    dealt = flow.repartition(parts, "part").sortWithinPartitions("part", "kind")
    result = T.StructType.fromDDL("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                  "base_score double, score double, bits_per_byte double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(result)

        def finish(rows, blobs):
            if not rows:
                return
            rows.sort(key=lambda r: r["row"])
            ids = np.array([r["row"] for r in rows])
            sums = np.frombuffer(b"".join(blobs), SUMS)
            at = np.searchsorted(ids, sums["row"])
            known, base, score = (np.bincount(at, sums[c], minlength=len(ids)) for c in ("known", "base", "score"))
            yield _table(schema, [
                {"doc_id": r["doc_id"], "held_out": r["held_out"], "n_tokens": r["n_tokens"],
                 "n_known": r["n_known"] + int(k), "train_tokens": total, "base_score": r["base"] + float(b),
                 "score": r["score"] + float(s), "bits_per_byte": -(r["score"] + float(s)) / math.log10(2) / r["n_bytes"]}
                for r, k, b, s in zip(rows, known, base, score, strict=True)])

        current, rows, blobs = None, [], []
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if row[0] != current:
                    yield from finish(rows, blobs)
                    current, rows, blobs = row[0], [], []
                if row[1] == ROW:
                    rows.append(dict(zip(names, row, strict=True)))
                else:
                    blobs.append(row[2])
        yield from finish(rows, blobs)

    return dealt.select(*names).mapInArrow(run, result)


def score(docs: DataFrame, held_out: Column, depth: int = DEPTH, hot: int = HOT) -> DataFrame:
    """Scores of every row of ``docs``, learned from the rows that are not held out.

    ``bits_per_byte`` is the code length of a text per byte, its end mark among them.
    """
    spark = docs.sparkSession
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("text", F.monotonically_increasing_id().alias("row"), "doc_id", held_out.alias("held_out"))
    merged = materialized(spark, counted(rows.where("NOT held_out"), depth, parts), "ctw-counts")
    limits, total, different = hot_limits(merged, hot)
    short = short_contexts(merged, depth)
    shared = spark.sparkContext.broadcast(hot_entries(merged, short, depth, limits))  # at most ``hot`` of each kind
    near = spark.sparkContext.broadcast(short)  # 65,536 entries
    flow = local_scores(rows, shared, depth, parts, total, different, f"ctw {uuid.uuid4().hex}")
    return summed(answered(flow, merged, near, depth, parts, total, different), parts, total)


def op10_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored, learned from those whose crc32 leaves no 2 modulo 7."""
    return score(table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)
