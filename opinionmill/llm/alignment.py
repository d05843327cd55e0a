r"""Alignment of the tokens of two tokenizers by pointer jumping (operator 11).

A is a byte-level BPE over a space and the text, B a piece model over the text. Tokens of A and B are laid over
the same bytes; every token points to the token that reaches farthest right among those it shares a byte with,
and doubling these pointers for all tokens at once leads each one to the terminal token of its component. The
components are the groups; the two tokens that end with a group are linked.

A single space between two other characters begins a token in A and in B, so texts are cut there, and a cut
that a worker knows is not aligned again; when the table of known cuts is full, the ones used least go.

How often an id pair is linked is counted over the whole corpus: a batch of documents sends its different pairs,
with their numbers in the batch, to the slice of their B ids, which sums them and sends each batch the totals of
its own pairs. A slice holds at most one entry per batch and pair, however often a pair occurs.

Defined results: texts that are null, empty, or whose bytes A or B does not give back have no tokens: all counts
are 0 and the groups are empty; strings of special tokens are ordinary text; repeated rows count each; a null id
stays null; texts of any length are aligned whole; an empty table gives no rows; extra columns are ignored.
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

from opinionmill.llm.common import mix64, slices, table, worker_store
from opinionmill.llm.packing import ByteIds, cuts
from opinionmill.llm.pieces import MARK, PieceCodec
from opinionmill.session import materialized

KNOWN_CUTS = 250_000
KNOWN_CHARS = 1 << 25  # characters of known cuts a worker keeps
LONG = 256  # characters of a cut that is not worth keeping
BATCH_CUTS = 300_000  # cuts of the documents that ask for totals together
SLICE = 1 << 24  # bytes of input a slice of the pairs stands for


def terminal_tokens(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every token of A and of B the terminal token (a number among B's) of its component.

    Both arrays rise and end at the same byte; a token begins where the one before it ends.
    """
    many = len(a_ends)
    ends = np.concatenate((a_ends, b_ends))
    # the token of the other kind that holds a token's last byte reaches farthest of all it overlaps
    over_a = many + np.searchsorted(b_ends, a_ends, side="left")
    over_b = np.searchsorted(a_ends, b_ends, side="left")
    own = np.arange(many, len(ends))
    points = np.concatenate((over_a, np.where(ends[over_b] > b_ends, over_b, own)))
    while True:
        further = points[points]
        if np.array_equal(further, points):
            return points[:many] - many, points[many:] - many
        points = further


class Aligner:
    """Tokens of A and B of cuts, their groups and links, with a table of the cuts seen before."""

    def __init__(self, tokenizer: str, model: str):
        byte_ids = ByteIds(tokenizer)
        self.encode_a = byte_ids.core.encode_ordinary
        self.codec = PieceCodec(model)
        size = byte_ids.core.max_token_value + 1
        self.bytes_a = [b""] * size
        for token in range(size):
            try:
                self.bytes_a[token] = byte_ids.core.decode_single_token_bytes(token)
            except KeyError:
                pass  # an id without a token
        self.bytes_b = [
            bytes([self.codec.byte_of[i]]) if i in self.codec.byte_of else piece.replace(MARK, " ").encode()
            for i, piece in enumerate(self.codec.pieces)
        ]
        self.names = [str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.length_a = np.array([len(b) for b in self.bytes_a])
        self.length_b = np.array([len(b) for b in self.bytes_b])
        self.number: dict[str, int] = {}  # in order of the numbers
        self.chars = 0
        self.used = np.zeros(0, np.int64)
        self.groups: list[str | None] = []  # as text; None where A or B does not give the bytes back
        self.sizes = np.zeros((0, 4), np.int64)  # tokens of A, of B, links, first link
        self.links = np.zeros(0, np.uint64)  # B id, then A id

    def forget(self) -> None:
        """Keep the half of the table that was used most, without very long cuts."""
        names = list(self.number)
        most = np.argsort(-self.used, kind="stable")[:KNOWN_CUTS // 2]
        kept = [i for i in np.sort(most).tolist() if len(names[i]) <= LONG]
        self.number = {names[i]: n for n, i in enumerate(kept)}
        self.chars = sum(map(len, self.number))
        self.groups = [self.groups[i] for i in kept]
        self.used = self.used[kept] // 2
        many, first = self.sizes[kept, 2], self.sizes[kept, 3]
        begin = np.cumsum(many) - many
        self.links = self.links[np.repeat(first - begin, many) + np.arange(many.sum())]
        self.sizes = np.column_stack((self.sizes[kept, :3], begin))

    def learn(self, cuts: list[str]) -> None:
        """Align cuts that are not known yet, all at once."""
        a_all, b_all, sizes, good = [], [], [], []
        for cut in cuts:
            text = " " + cut
            raw = text.encode("utf-8", "surrogatepass")
            try:
                a = self.encode_a(text)
            except UnicodeEncodeError:  # a lone surrogate has no UTF-8 form
                a = []
            b = self.codec.fresh(cut)
            fits = (b"".join([self.bytes_a[i] for i in a]) == raw and b"".join([self.bytes_b[i] for i in b]) == raw)
            good.append(fits)
            sizes.append((len(a), len(b)) if fits else (0, 0))
            if fits:
                a_all += a
                b_all += b
        a_ids, b_ids = np.array(a_all, np.int64), np.array(b_all, np.int64)
        a_ends, b_ends = np.cumsum(self.length_a[a_ids]), np.cumsum(self.length_b[b_ids])
        a_group, b_group = terminal_tokens(a_ends, b_ends)
        last_a = np.flatnonzero(np.diff(a_group, append=-1))  # the tokens that end with their group
        last_b = np.flatnonzero(np.diff(b_group, append=-1))
        self.links = np.concatenate((self.links, b_ids[last_b].astype(np.uint64) << np.uint64(32) | a_ids[last_a].astype(np.uint64)))
        counts = np.array(sizes, np.int64).reshape(-1, 2)
        a_until, b_until = np.cumsum(counts[:, 0]), np.cumsum(counts[:, 1])
        first, until = np.searchsorted(last_a, a_until - counts[:, 0]), np.searchsorted(last_a, a_until)
        base = self.sizes[-1, 2:].sum() if len(self.sizes) else 0
        self.sizes = np.concatenate((self.sizes, np.column_stack((counts, until - first, first + base))))
        name = self.names
        texts = [
            (name[a_all[p]] if q - p == 1 else ",".join([name[i] for i in a_all[p:q]])) + "|"
            + (name[b_all[r]] if s - r == 1 else ",".join([name[i] for i in b_all[r:s]])) for p, q, r, s in zip(
                np.concatenate(([0], last_a[:-1] + 1)).tolist(), (last_a + 1).tolist(),
                np.concatenate(([0], last_b[:-1] + 1)).tolist(), (last_b + 1).tolist(), strict=True)
        ] if len(last_a) else []
        self.used = np.concatenate((self.used, np.zeros(len(cuts), np.int64)))
        for cut, fits, i, j in zip(cuts, good, first.tolist(), until.tolist(), strict=True):
            self.number[cut] = len(self.groups)
            self.groups.append(";".join(texts[i:j]) if fits else None)
            self.chars += len(cut)

    def numbers(self, cuts: list[str]) -> np.ndarray:
        """The numbers of cuts, those not known yet aligned first."""
        if len(self.number) > KNOWN_CUTS or self.chars > KNOWN_CHARS:
            self.forget()
        known = self.number
        fresh = [c for c in dict.fromkeys(cuts) if c not in known]
        if fresh:
            self.learn(fresh)
        numbers = np.fromiter(map(known.__getitem__, cuts), np.int64, len(cuts))
        self.used += np.bincount(numbers, minlength=len(known))
        return numbers


def _parts(pairs: np.ndarray, parts: int) -> np.ndarray:
    return (mix64(pairs >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


ALIGNED = (
    "batch long, doc_id array<long>, n_a array<long>, n_b array<long>, n_links array<long>, groups array<string>, "
    "links binary, pairs binary, times binary"
)


def aligned_batches(docs: DataFrame, tokenizer: str, model: str, digests: bool) -> DataFrame:
    """Batches of documents: their counts and groups, their links as numbers of the batch's different pairs."""
    wanted = T.StructType.fromDDL(ALIGNED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner: Aligner = worker_store(f"aligner {tokenizer} {model}", lambda: Aligner(tokenizer, model))
        schema, number = to_arrow_schema(wanted), TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        held: list[str] = []
        sizes: list[int] = []

        def flush() -> pa.RecordBatch:
            nonlocal number
            numbers = aligner.numbers(held)
            until = np.cumsum(sizes)
            texts, fits = [], []
            groups = aligner.groups
            for begin, end in zip((until - sizes).tolist(), until.tolist(), strict=True):
                own = [groups[i] for i in numbers[begin:end].tolist()]
                fits.append(end > begin and None not in own)
                text = ";".join(own) if fits[-1] else ""
                texts.append(hashlib.sha256(text.encode()).hexdigest() if text and digests else text)
            used = np.repeat(fits, sizes)
            doc_of = np.repeat(np.arange(len(sizes)), sizes)[used]
            per_cut = aligner.sizes[numbers[used]]
            counts = [np.bincount(doc_of, per_cut[:, k], len(sizes)).astype(np.int64) for k in range(3)]
            many = per_cut[:, 2]
            at = np.repeat(per_cut[:, 3] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            pairs, place, times = np.unique(aligner.links[at], return_inverse=True, return_counts=True)
            place = place.astype("<u2" if len(pairs) <= 1 << 16 else "<u4")
            row = {"batch": number, "doc_id": list(ids), "n_a": counts[0], "n_b": counts[1], "n_links": counts[2],
                   "groups": texts, "links": place.tobytes(), "pairs": pairs.tobytes(), "times": times.astype("<i8").tobytes()}
            ids.clear(), held.clear(), sizes.clear()
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = cuts(text.as_py()) if text.is_valid else []
                ids.append(doc)
                sizes.append(len(own))
                held += own
                if len(held) >= BATCH_CUTS or len(ids) >= BATCH_CUTS:
                    yield flush()
        if ids:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, wanted)


TOTALS = "batch long, part int, totals binary"


def pair_totals(batches: DataFrame, parts: int) -> DataFrame:
    """(batch, part, totals): for a batch's pairs of a slice, in order, twice the corpus-wide number of links that
    hold the pair, plus one where no other pair of its B id has more."""
    asked = T.StructType.fromDDL("part int, batch long, pairs binary, times binary")
    wanted = T.StructType.fromDDL(TOTALS)

    def ask(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(asked)
        for batch in rows:
            for name, raw, often in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pairs, times = np.frombuffer(raw, np.uint64), np.frombuffer(often, "<i8")
                part = _parts(pairs, parts)
                order = np.argsort(part, kind="stable")
                edges = np.searchsorted(part[order], np.arange(parts + 1))
                some = [p for p in range(parts) if edges[p] < edges[p + 1]]
                picks = [order[edges[p]:edges[p + 1]] for p in some]
                yield pa.RecordBatch.from_arrays([
                    pa.array(some, pa.int32()), pa.array([name] * len(some), pa.int64()),
                    pa.array([pairs[x].tobytes() for x in picks], pa.binary()),
                    pa.array([times[x].tobytes() for x in picks], pa.binary())], schema=schema)

    def count(group: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        pairs = np.concatenate([np.frombuffer(g[2], np.uint64) for g in group])
        times = np.concatenate([np.frombuffer(g[3], "<i8") for g in group])
        different, place = np.unique(pairs, return_inverse=True)
        total = np.zeros(len(different), np.int64)
        np.add.at(total, place, times)
        b_ids = different >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], b_ids[1:] != b_ids[:-1])))
        most = np.repeat(np.maximum.reduceat(total, first), np.diff(np.append(first, len(total))))
        answer = (2 * total + (total == most))[place]
        until = np.cumsum([len(g[2]) // 8 for g in group])
        for i in range(0, len(group), 500):
            rows = range(i, min(i + 500, len(group)))
            yield pa.RecordBatch.from_arrays([
                pa.array([group[k][1] for k in rows], pa.int64()), pa.array([group[k][0] for k in rows], pa.int32()),
                pa.array([answer[until[k] - len(group[k][2]) // 8:until[k]].tobytes() for k in rows], pa.binary())], schema=schema)

    def answer(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, group = to_arrow_schema(wanted), []
        for batch in rows:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[0] != group[0][0]:
                    yield from count(group, schema)
                    group = []
                group.append(row)
        if group:
            yield from count(group, schema)

    dealt = batches.select("batch", "pairs", "times").mapInArrow(ask, asked).repartition(parts, "part")
    return dealt.sortWithinPartitions("part").mapInArrow(answer, wanted)


def alignments(docs: DataFrame, tokenizer: str, model: str, digests: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups, one row per row of ``docs``.

    ``groups`` lists the ids of every group, ``a1,a2|b1;a3|b2,b3``; its sha256 in hex where ``digests`` is set.
    """
    spark = docs.sparkSession
    parts = slices(docs, SLICE)
    batches = materialized(spark, aligned_batches(docs, tokenizer, model, digests), "aligned")
    totals = pair_totals(batches, parts).groupBy("batch").agg(F.collect_list(F.struct("part", "totals")).alias("answers"))
    joined = batches.drop("times").join(totals, "batch", "left")
    wanted = T.StructType.fromDDL(
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(wanted)
        for batch in rows:
            for at in range(batch.num_rows):
                row = {n: batch.column(i)[at].as_py() for i, n in enumerate(batch.schema.names)}
                pairs = np.frombuffer(row["pairs"], np.uint64)
                part, value = _parts(pairs, parts), np.zeros(len(pairs), np.int64)
                for answer in row["answers"] or ():
                    value[part == answer["part"]] = np.frombuffer(answer["totals"], "<i8")
                many = np.array(row["n_links"], np.int64)
                place = np.frombuffer(row["links"], "<u2" if len(pairs) <= 1 << 16 else "<u4")
                best = np.concatenate(([0], np.cumsum(value[place] & 1)))
                total = np.concatenate(([0], np.cumsum(value[place] >> 1)))
                until = np.cumsum(many)
                row |= {"n_groups": row["n_links"], "n_best": best[until] - best[until - many],
                        "count_sum": total[until] - total[until - many]}
                yield pa.RecordBatch.from_arrays([pa.array(row[f.name], f.type) for f in schema], schema=schema)

    return joined.mapInArrow(run, wanted)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of the 50k byte tokens with the 32k pieces over all documents."""
    import public_tokenizers

    path = public_tokenizers.path
    aligned = alignments(
        table(spark, sf_dir, "documents"), str(path("byte_bpe_50k.json")), str(path("piece_bpe_32k.model")), digests=True)
    return aligned.withColumnRenamed("groups", "groups_sha256")
