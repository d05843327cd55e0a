"""Scores of text pairs (B6-B10): ``reference`` against ``candidate``, keyed by ``pair_id``."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinionmill.functions.text import clean_text

MAX_ORDER = 4
ROWS = 256  # pairs numbered and counted at once

# The published mteval-v13a tokenizer rules, in the order they apply.
BLEU_TOKEN_RULES = (
    ("<skipped>", ""),
    ("-\n", ""),
    ("\n", " "),
    ("&quot;", '"'),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
)


def bleu_tokens(text: Column) -> Column:
    """Tokens after the v13a rules; case is kept."""
    line = F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" "))
    for pattern, replacement in BLEU_TOKEN_RULES:
        line = F.regexp_replace(line, pattern, replacement)
    return F.regexp_extract_all(line, F.lit(r"(?U)[^\s\x1c-\x1f]+"), F.lit(0))


def rouge_tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(clean_text(text), " "), lambda t: t != "")


def _slices(candidate: pa.Array, reference: pa.Array) -> Iterator[_TokenPairs]:
    for at in range(0, len(candidate), ROWS):
        yield _TokenPairs(candidate.slice(at, ROWS), reference.slice(at, ROWS))


class _TokenPairs:
    """Some token list pairs as one run of word numbers per side, each word with its row.

    Words are numbered in the buffers they arrive in; none becomes a Python string.
    """

    def __init__(self, candidate: pa.Array | Iterable, reference: pa.Array | Iterable):
        candidate, reference = (side if isinstance(side, pa.Array) else pa.array(list(side), pa.list_(pa.string())) for side in (candidate, reference))
        self.rows = len(candidate)
        self.sizes = [pa.compute.list_value_length(side).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                      for side in (candidate, reference)]
        words = pa.concat_arrays([candidate.flatten(), reference.flatten()])
        numbers = words.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        many = int(self.sizes[0].sum())
        self.row = [np.repeat(np.arange(self.rows), sizes) for sizes in self.sizes]
        self.grams = [numbers[:many], numbers[many:]]  # the n-gram that begins at each place
        self.order = 1

    def lists(self) -> Iterator[tuple[list[int], list[int]]]:
        """The word numbers of each pair."""
        left, right = (np.split(self.grams[s], np.cumsum(self.sizes[s])[:-1]) for s in (0, 1))
        for a, b in zip(left, right, strict=True):
            yield a.tolist(), b.tolist()

    def lengthen(self) -> None:
        """To n-grams of the next order; those that would cross into the next row go."""
        kept = []
        for side in (0, 1):
            row, sizes = self.row[side], self.sizes[side]
            last = np.repeat(np.cumsum(np.maximum(0, sizes - self.order + 1)), np.maximum(0, sizes - self.order + 1)) - 1
            kept.append(np.flatnonzero(np.arange(len(row)) != last))
        pairs = [np.column_stack((self.grams[s][kept[s]], self.grams[s][kept[s] + 1])) for s in (0, 1)]
        width = 1 + max((int(p.max()) for p in pairs if len(p)), default=0)
        codes = np.concatenate([p[:, 0] * width + p[:, 1] for p in pairs])
        numbers = np.unique(codes, return_inverse=True)[1]
        self.grams = [numbers[:len(pairs[0])], numbers[len(pairs[0]):]]
        self.row = [self.row[s][kept[s]] for s in (0, 1)]
        self.order += 1

    def matches(self) -> np.ndarray:
        """Clipped matches of each row."""
        width = 1 + max((int(g.max()) for g in self.grams if len(g)), default=0)
        keys, times = zip(*(np.unique(r * width + g, return_counts=True) for r, g in zip(self.row, self.grams, strict=True)), strict=True)
        common, left, right = np.intersect1d(keys[0], keys[1], assume_unique=True, return_indices=True)
        shared = np.minimum(times[0][left], times[1][right])
        return np.bincount(common // width, shared, self.rows).astype(np.int64)


@F.arrow_udf(T.ArrayType(T.LongType()))
def bleu_counts(candidate: pa.Array, reference: pa.Array) -> pa.Array:
    """Matches and candidate n-grams of each order, then the reference length, of a pair of token lists."""
    rows = []
    for pairs in _slices(candidate, reference):
        found = [pairs.matches()]
        for _ in range(1, MAX_ORDER):
            pairs.lengthen()
            found.append(pairs.matches())
        sizes = pairs.sizes[0]
        columns = [*found, *(np.maximum(0, sizes - n) for n in range(MAX_ORDER)), pairs.sizes[1]]
        rows += np.column_stack(columns).tolist()
    return pa.array(rows, pa.list_(pa.int64()))


@F.arrow_udf(T.LongType())
def unigram_hits(candidate: pa.Array, reference: pa.Array) -> pa.Array:
    """Clipped token matches of a pair of token lists."""
    return pa.array(np.concatenate([np.zeros(0, np.int64), *(p.matches() for p in _slices(candidate, reference))]), pa.int64())


BLEU_FIELDS = [f"m{n}" for n in range(1, MAX_ORDER + 1)] + [f"t{n}" for n in range(1, MAX_ORDER + 1)] + ["ref"]


def bleu_sums(column: str = "_bleu") -> list[Column]:
    """Aggregates that add up ``bleu_counts`` over a corpus."""
    return [F.coalesce(F.sum(F.col(column)[i]), F.lit(0)).alias(name) for i, name in enumerate(BLEU_FIELDS)]


def bleu_score() -> tuple[Column, Column]:
    """(score, brevity penalty) over the sums of ``bleu_sums``."""
    logs, empties = [], F.lit(0)
    for n in range(1, MAX_ORDER + 1):
        matches, total = F.col(f"m{n}"), F.col(f"t{n}")
        empties = empties + F.when((matches == 0) & (total > 0), 1).otherwise(0)
        smoothed = F.when(matches > 0, matches.cast("double")).otherwise(F.pow(F.lit(2.0), -empties))
        logs.append(F.log(F.try_divide(smoothed, total.cast("double"))))
    mean_log = sum(logs, F.lit(0.0)) / MAX_ORDER
    penalty = F.when(F.col("t1") >= F.col("ref"), F.lit(1.0)).otherwise(
        F.exp(F.lit(1.0) - F.try_divide(F.col("ref").cast("double"), F.col("t1").cast("double")))
    )
    any_match = sum((F.col(f"m{n}") for n in range(1, MAX_ORDER + 1)), F.lit(0)) > 0
    score = F.when(any_match, F.lit(100.0) * penalty * F.exp(mean_log))
    return F.coalesce(score, F.lit(0.0)), F.coalesce(penalty, F.lit(0.0))


def corpus_bleu(pairs: DataFrame) -> DataFrame:
    """One row: BLEU of order 4 with exponential smoothing of orders without a match.

    The k-th order without a match counts as 1 / (2^k * total); an order without any
    candidate n-gram makes the score 0, and so does a corpus without any match. N-grams are
    counted inside the row: nine sums per task are all that is shuffled.
    """
    counts = bleu_counts(bleu_tokens(F.col("candidate")), bleu_tokens(F.col("reference")))
    score, penalty = bleu_score()
    return pairs.select(counts.alias("_bleu")).agg(*bleu_sums()).select(
        score.alias("bleu"), penalty.alias("brevity_penalty"),
        F.col("t1").alias("candidate_length"), F.col("ref").alias("reference_length"),
        *[F.col(f"m{n}").alias(f"matches_{n}") for n in range(1, MAX_ORDER + 1)],
        *[F.col(f"t{n}").alias(f"total_{n}") for n in range(1, MAX_ORDER + 1)],
    )


def f_measure(hits: Column, candidate: Column, reference: Column) -> Column:
    """Harmonic mean of hits/candidate and hits/reference, 0 when either is empty."""
    return F.coalesce(F.try_divide(F.lit(2.0) * hits, (candidate + reference).cast("double")), F.lit(0.0))


def rouge1(pairs: DataFrame) -> DataFrame:
    """ROUGE-1 F per pair from clipped token counts (B7); row-local, nothing is shuffled."""
    tokens = pairs.select(
        "pair_id", rouge_tokens(F.col("candidate")).alias("c"), rouge_tokens(F.col("reference")).alias("r")
    ).withColumns({c: F.coalesce(c, F.array().cast("array<string>")) for c in ("c", "r")})
    return tokens.select(
        "pair_id", f_measure(unigram_hits("c", "r"), F.size("c"), F.size("r")).alias("rouge1_f"))


def _lcs_length(left: Sequence[int], right: Sequence[int]) -> int:
    """Length of the longest common subsequence, one machine-word row of the table at a time.

    The row of the dynamic programme is kept as the bits of one integer, so whole texts of
    tens of thousands of words stay fast.
    """
    positions: dict[int, int] = {}
    for i, token in enumerate(left):
        positions[token] = positions.get(token, 0) | (1 << i)
    full = (1 << len(left)) - 1
    row = full
    for token in right:
        matches = row & positions.get(token, 0)
        row = ((row + matches) | (row - matches)) & full
    return len(left) - row.bit_count()


@F.arrow_udf(T.IntegerType())
def lcs_length(left: pa.Array, right: pa.Array) -> pa.Array:
    return pa.array([_lcs_length(a, b) for pairs in _slices(left, right) for a, b in pairs.lists()], pa.int32())


def rouge_l(pairs: DataFrame) -> DataFrame:
    """ROUGE-L F per pair (B8); row-local, nothing is shuffled."""
    tokens = pairs.select(
        "pair_id", rouge_tokens(F.col("candidate")).alias("c"), rouge_tokens(F.col("reference")).alias("r")
    ).withColumn("lcs", lcs_length("c", "r"))
    return tokens.select("pair_id", f_measure(F.col("lcs"), F.size("c"), F.size("r")).alias("rougeL_f"))


def pair_metrics(
    sample: DataFrame, reference: str = "original", candidate: str = "back_translation",
    status: str = "status", preserved: str = "sentiment_preserved", by: str = "sentiment",
) -> DataFrame:
    """One record of counts and rounded scores over the translated rows.

    One pass: every score of a pair is made inside its row, sums per class are all that is shuffled.
    """
    done = F.coalesce(F.col(status).startswith("translated"), F.lit(False))
    none = F.array().cast("array<string>")
    text = {side: F.when(done, F.coalesce(F.col(name), F.lit(""))).otherwise("")
            for side, name in (("c", candidate), ("r", reference))}
    tokens = sample.select(
        F.col(by).alias("_class"), done.alias("_done"), F.when(done, F.col(preserved).cast("double")).alias("_kept"),
        *[F.coalesce(bleu_tokens(t), none).alias(f"_b{side}") for side, t in text.items()],
        *[F.coalesce(rouge_tokens(t), none).alias(f"_{side}") for side, t in text.items()],
    )
    scored = tokens.select(
        "_class", "_done", "_kept", bleu_counts("_bc", "_br").alias("_bleu"),
        f_measure(unigram_hits("_c", "_r"), F.size("_c"), F.size("_r")).alias("_rouge1"),
        f_measure(lcs_length("_c", "_r"), F.size("_c"), F.size("_r")).alias("_rougeL"),
    )
    rows = F.sum(F.col("_done").cast("long"))
    per_class = scored.groupBy("_class").agg(
        F.count(F.lit(1)).alias("_rows"), rows.alias("_translated"), F.sum("_kept").alias("_kept"),
        F.count("_kept").alias("_known"), F.sum("_rouge1").alias("_rouge1"), F.sum("_rougeL").alias("_rougeL"), *bleu_sums(),
    )
    rate = F.struct("_class", F.round(F.col("_kept") / F.col("_known"), 3).alias("rate"))
    total = per_class.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_rows", "_translated", *BLEU_FIELDS)],
        *[F.sum(c).alias(c) for c in ("_kept", "_known", "_rouge1", "_rougeL")],
        F.sort_array(F.collect_list(F.when(F.col("_translated") > 0, rate))).alias("_rates"),
    )
    mean = lambda c: F.round(F.try_divide(F.col(c), F.col("_translated")), 3)
    return total.select(
        F.col("_rows").alias("n_reviews"), F.col("_translated").alias("n_translated"),
        F.round(bleu_score()[0], 2).alias("round_trip_bleu"), mean("_rouge1").alias("round_trip_rouge1_f"),
        mean("_rougeL").alias("round_trip_rougeL_f"),
        F.round(F.try_divide(F.col("_kept"), F.col("_known")), 3).alias("sentiment_preserved_rate"),
        F.map_from_entries("_rates").alias("sentiment_preserved_by_class"),
        F.lit("Round-trip proxy metrics; no human German references available.").alias("note"),
    )
