r"""Packing documents into sequences by a configuration linear program (operator 8).

A document's ids end with one end id; an added token of the tokenizer file inside a text is one id. A
document longer than a sequence is cut into whole sequences, its first piece takes the rest. The histogram
of piece lengths, at most one count per length, decides everything: multiplicative weights over the lengths
price the ways to fill a sequence, a knapsack table finds the best one in each round, and the rounded
mixture plus a best-fit filling of what is left gives a list of layouts with their numbers. Pieces of one
length are interchangeable, so each piece finds its sequence and offset from its number among the pieces of
its length; no task holds a group of pieces. Numbers are counted in buckets of each length, so a length
that a third of all pieces share is spread.

Defined results: a null text is empty and packs as its end id; repeated rows are packed each (their
places differ); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from opinionmill.llm.common import map_batches, table, worker_store
from opinionmill.session import materialized

CAPACITY = 2048
ROUNDS = 250  # of multiplicative weights
STEEPNESS = 1.5  # fall of a length's price while its demand gets covered
STEP = 0.25  # share of a length's demand one round may cover
KNOWN_CUTS = 400_000

# Fixed value: the pre-token pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# A space between two non-spaces always begins a new pre-token, so texts may be cut there.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_WIDE = re.compile(r"\s\s|^\s|\s\Z")


def cuts(text: str) -> list[str]:
    """The text between single spaces that stand alone; joined by spaces it is the text again."""
    if not text:
        return []
    return _CUT.split(text) if _WIDE.search(text) else text.split(" ")


class ByteIds:
    """Ids of a byte-level BPE tokenizer file as little-endian unsigned 32-bit bytes.

    The vocabulary is read from the tokenizer's own file; its ids are in merge order. Cuts of a text are
    encoded once per worker and remembered until the table is full. The file's added tokens are one id each
    wherever a text holds them in ``ids``; ``encode`` spells them as ordinary bytes.
    """

    def __init__(self, path: str):
        import gc

        import tiktoken

        gc.disable()  # the table of cuts holds no cycles
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        added = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        if any(t.get(k) for t in model.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: added tokens that take spaces or whole words only are not read")
        byte_of = {char: value for value, char in enumerate(_byte_chars())}
        ranks = {
            bytes(byte_of[c] for c in token): rank
            for token, rank in model["model"]["vocab"].items() if token not in added
        }
        self.core = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cuts: dict[str, bytes] = {}
        self.added = {token: np.array([number], "<u4").tobytes() for token, number in added.items()}
        # the longest of several tokens that begin at one place counts
        longest = sorted(added, key=len, reverse=True)
        self.added_in = re.compile(f"({'|'.join(map(re.escape, longest))})") if added else None

    def _fresh(self, cut: str, lead: str) -> bytes:
        ids = np.array(self.core.encode_ordinary(lead + cut), "<u4").tobytes()
        if lead and len(cut) <= 64:
            if len(self.cuts) >= KNOWN_CUTS:
                self.cuts.clear()
            self.cuts[cut] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        parts = cuts(text)
        known = self.cuts.get
        ids = [known(c) for c in parts]
        ids[0] = self._fresh(parts[0], "")
        if None in ids:
            for i, found in enumerate(ids):
                if found is None:
                    ids[i] = known(parts[i]) or self._fresh(parts[i], " ")
        return b"".join(ids)

    def ids(self, text: str | None) -> bytes:
        """Ids as the tokenizer's library gives them: what lies between added tokens is encoded on its own."""
        if not text or self.added_in is None or not self.added_in.search(text):
            return self.encode(text)
        parts = self.added_in.split(text)
        return b"".join(self.added[p] if i % 2 else self.encode(p) for i, p in enumerate(parts))


def _byte_chars() -> list[str]:
    """The printable stand-in of each byte: printable Latin-1 stays, others follow from U+0100 in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids (little-endian bytes) and their crc32."""
    end = np.array([end_id], "<u4").tobytes()

    def run(columns):
        coder = worker_store(f"byte ids {tokenizer}", lambda: ByteIds(tokenizer))
        out: dict[str, list] = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
        for doc_id, text in zip(columns["doc_id"], columns["text"], strict=True):
            ids = coder.ids(text) + end
            total = len(ids) // 4
            first = total if total <= capacity else total % capacity or capacity
            at, until = 0, first
            for number in range(1 + (total - first) // capacity):
                out["doc_id"].append(doc_id)
                out["piece"].append(number)
                out["start"].append(at)
                out["length"].append(until - at)
                out["ids_crc32"].append(zlib.crc32(ids[4 * at:4 * until]))
                at, until = until, until + capacity
        return out

    return map_batches(
        docs.select("doc_id", "text"), run,
        "doc_id long, piece int, start long, length long, ids_crc32 long", rows=1000)


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> list[int]:
    """Indexes of the items, with repeats, that fill ``capacity`` with the largest value (unbounded knapsack)."""
    best = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    small = 0
    for room in range(1, capacity + 1):
        while small < len(sizes) and sizes[small] <= room:
            small += 1
        best[room], taken[room] = best[room - 1], -1
        if small:
            gains = best[room - sizes[:small]] + values[:small]
            top = int(np.argmax(gains))
            if gains[top] > best[room]:
                best[room], taken[room] = gains[top], top
    chosen, room = [], capacity
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            chosen.append(int(taken[room]))
            room -= int(sizes[taken[room]])
    return chosen


def weighted_patterns(demand: dict[int, int], capacity: int, rounds: int = ROUNDS) -> list[tuple[tuple[int, ...], float]]:
    """A fractional solution of the configuration program by multiplicative weights.

    Each length carries a weight that falls as its demand gets covered. Every round the knapsack prices
    the best way to fill a sequence, which then takes a share of the scarcest of its lengths.
    """
    sizes = np.array(sorted(demand))
    need = np.array([demand[s] for s in sizes], float)
    covered = np.zeros(len(sizes))
    found: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        open_ = covered < 1 - 1e-9
        if not open_.any():
            break
        # prices follow the size; what is far behind its demand is worth more
        price = sizes / capacity * np.exp(-STEEPNESS * covered)
        chosen = best_pattern(price[open_], sizes[open_], capacity)
        index = np.flatnonzero(open_)[chosen]
        kinds, times = np.unique(index, return_counts=True)
        step = float(np.min(np.minimum(need[kinds] * STEP, need[kinds] * (1 - covered[kinds])) / times))
        covered[kinds] += step * times / need[kinds]
        pattern = tuple(sorted((int(sizes[i]) for i in index), reverse=True))
        found[pattern] = found.get(pattern, 0.0) + step
    return list(found.items())


def layouts(demand: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences) that use up the histogram exactly.

    The fractional mixture is rounded down, fullest patterns first; best-fit filling packs the rest,
    each found filling as often as its lengths last.
    """
    left = {size: n for size, n in demand.items() if n > 0}
    out: list[tuple[tuple[int, ...], int]] = []
    if not left:
        return out

    def use(pattern: tuple[int, ...], times: int) -> None:
        out.append((pattern, times))
        for size in pattern:
            left[size] -= times

    for pattern, share in sorted(weighted_patterns(left, capacity, rounds), key=lambda x: (-sum(x[0]), x[0])):
        needs = {s: pattern.count(s) for s in pattern}
        times = min(int(share + 1e-9), *(left[s] // n for s, n in needs.items()))
        if times > 0 and sum(pattern) == capacity:
            use(pattern, times)
    while open_ := sorted((s for s, n in left.items() if n > 0), reverse=True):
        pattern, room, held = [open_[0]], capacity - open_[0], {open_[0]: 1}
        while room:
            fit = next((s for s in open_ if s <= room and left[s] > held.get(s, 0)), None)
            if fit is None:
                break
            pattern.append(fit)
            held[fit] = held.get(fit, 0) + 1
            room -= fit
        use(tuple(pattern), min(left[s] // n for s, n in held.items()))
    return out


def _runs(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first piece number, first sequence, pieces per sequence and offset of each run."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, times in plan:
        offset = 0
        for size in pattern:
            runs.setdefault(size, []).append((used.get(size, 0), sequence, offset, times))
            used[size] = used.get(size, 0) + times
            offset += size
        sequence += times
    return {size: tuple(np.array(column, np.int64) for column in zip(*rows, strict=True)) for size, rows in runs.items()}


def numbered(pieces_: DataFrame, buckets: int) -> DataFrame:
    """Every piece with its number among the pieces of its length, from 0, without one task per length."""
    dealt = pieces_.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    return (
        dealt.withColumn("place", F.row_number().over(within) - 1)
        .join(base, ["length", "bucket"]).withColumn("number", F.col("base") + F.col("place"))
        .drop("bucket", "base", "place")
    )


def pack(pieces_: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """Pieces with sequence_id and offset. ``pieces_`` should be a written table: it is read three times."""
    histogram = {r["length"]: r["n"] for r in pieces_.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = _runs(layouts(histogram, capacity, rounds))  # at most one histogram entry per length
    spark = pieces_.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [c for c in pieces_.columns if c not in ("sequence_id", "offset")]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces_.schema if f.name in names)

    def run(columns):
        length, number = np.array(columns["length"]), np.array(columns["number"])
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for size in np.unique(length):
            rows = length == size
            first, start, place, _ = runs[int(size)]
            at = np.searchsorted(first, number[rows], side="right") - 1
            sequence[rows] = start[at] + number[rows] - first[at]
            offset[rows] = place[at]
        return {n: columns[n] for n in names} | {"sequence_id": sequence, "offset": offset}

    return map_batches(numbered(pieces_, buckets), run, f"{kinds}, sequence_id long, offset long")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    import public_tokenizers

    cut = pieces(table(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")))
    return pack(materialized(spark, cut, "pieces"))
