r"""Toxicity by maximum-scoring segments (operator 1).

Every word has a log-odds score learned from labelled documents under a Dirichlet prior; a word seen too
seldom takes the score of its longest well-known beginning. A linear scan finds all maximal scoring
segments of a text. Their scores follow an extreme-value law for clean text; its decay solves
``E exp(decay * score) = 1`` over clean words, its scale comes from the best segments of clean documents.
A document gathers the significance of its segments, and a logistic curve turns that into a score.

The fit reads at most ``fit_rows`` labelled documents, the ones with the smallest digest of the id. Scoring covers
every document and whole texts, however long, and names every significant segment.

Defined results: null and empty texts are scored like a text without words; documents without a label,
with a null label or a null id are scored but not learned from; repeated label rows count once, toxic if
any of them is; without labelled rows of both kinds every score is 0; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionmill.llm.common import crc_mod, map_batches, table, worker_store
from opinionmill.session import materialized

FIT_ROWS = 20_000
PRIOR = 3.0  # pseudo-count of the Dirichlet prior, shared out like the classes
SEEN = 8  # words and beginnings below this count take the score of a shorter beginning
BEGINNINGS = range(3, 8)  # lengths in code points
DRIFT = 1.0  # taken off every word, so that clean text scores below zero
SIGNIFICANT = 0.05  # largest expected number of chance segments as good, for a segment to be reported
KNOWN_WORDS = 300_000

_WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    """A word and its beginnings, the most specific first."""
    return [word, *(word[:n] + "*" for n in reversed(BEGINNINGS) if n <= len(word))]


def count_features(sample: DataFrame) -> DataFrame:
    """feature, toxic and clean counts over a table of (text, toxic)."""
    def run(columns):
        counts: dict[bool, Counter] = {True: Counter(), False: Counter()}
        for text, toxic in zip(columns["text"], columns["toxic"], strict=True):
            counts[bool(toxic)].update(_WORD.findall((text or "").lower()))
        total: dict[str, list[int]] = {}
        for toxic, found in counts.items():
            for word, n in found.items():
                for feature in features(word):
                    total.setdefault(feature, [0, 0])[not toxic] += n
        return {"feature": list(total), "toxic": [v[0] for v in total.values()],
                "clean": [v[1] for v in total.values()]}

    parts = map_batches(sample.select("text", "toxic"), run, "feature string, toxic long, clean long", rows=2000)
    return parts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


class Scorer:
    """Word scores with a bounded memory of words seen."""

    def __init__(self, weights: dict[str, float]):
        self.weights, self.known = weights, {}

    def __missing__(self, word: str) -> float:
        score = next((self.weights[f] for f in features(word) if f in self.weights), 0.0) - DRIFT
        if len(self.known) >= KNOWN_WORDS:
            self.known.clear()
        self.known[word] = score
        return score

    def scores(self, text: str | None) -> list[float]:
        known, fresh = self.known.get, self.__missing__
        out = []
        for word in _WORD.findall((text or "").lower()):
            score = known(word)
            out.append(fresh(word) if score is None else score)
        return out


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end exclusive, score) in one pass over the scores."""
    total = 0.0
    stack: list[tuple[int, int, float, float]] = []  # start, end, total before, total through
    jump: list[int] = []  # nearest earlier segment that begins at a smaller total
    for i, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        start, left = i, before
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = jump[j]
            if j < 0 or stack[j][3] >= total:
                stack.append((start, i + 1, left, total))
                jump.append(j)
                break
            start, left = stack[j][0], stack[j][2]
            del stack[j:], jump[j:]
    return [(s, e, r - b) for s, e, b, r in stack]


def significance(found: list[float], words: int, decay: float, scale: float) -> tuple[float, int]:
    """Sum of -ln(expected chance segments) over the segments, and how many are significant."""
    if not found or words == 0:
        return 0.0, 0
    strength = [decay * s - math.log(scale * words) for s in found]
    bar = -math.log(SIGNIFICANT)
    return sum(x for x in strength if x > 0), sum(x >= bar for x in strength)


def decay_of(values: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of E exp(decay * score) = 1 for scores of negative mean."""
    if len(values) == 0 or values.max() <= 0:
        return 1.0
    share = counts / counts.sum()
    if share @ values >= 0:
        return 1e-3
    low, high = 0.0, 1.0
    while share @ np.exp(np.minimum(high * values, 700)) < 1:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if share @ np.exp(np.minimum(middle * values, 700)) < 1 else (low, middle)
    return high


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by damped Newton steps with a small ridge."""
    rows, beta = np.column_stack([x, np.ones_like(x)]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        gradient = rows.T @ (y - p) - 1e-3 * beta
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += step / max(1.0, np.abs(step).max())
    return float(beta[0]), float(beta[1])


def labelled_sample(docs: DataFrame, labels: DataFrame, fit_rows: int) -> DataFrame:
    """At most ``fit_rows`` labelled documents outside the held-out fifth: text, toxic."""
    known = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(crc_mod("doc_id", 5) != 0)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    )
    return docs.select("doc_id", "text").join(known, "doc_id").select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> dict:
    """Word scores and calibration; every word seen ``SEEN`` times in the sample has a score of its own."""
    spark = docs.sparkSession
    sample = materialized(spark, labelled_sample(docs, labels, fit_rows), "toxicity-sample")
    kept = count_features(sample).where(F.col("toxic") + F.col("clean") >= SEEN).collect()  # bounded by the sample
    whole = [r for r in kept if not r["feature"].endswith("*")]
    toxic, clean = sum(r["toxic"] for r in whole), sum(r["clean"] for r in whole)
    base = toxic / (toxic + clean) if toxic + clean else 0.0
    if not 0 < base < 1:
        return {"weights": {}, "decay": 1.0, "scale": 1.0, "curve": (0.0, -30.0)}
    weights = {
        r["feature"]: math.log((r["toxic"] + PRIOR * base) / (r["clean"] + PRIOR * (1 - base))) - math.log(base / (1 - base))
        for r in kept
    }

    def best(columns):
        scorer = Scorer(weights)
        rows = [scorer.scores(t) for t in columns["text"]]
        rounded = Counter()
        for scores, is_toxic in zip(rows, columns["toxic"], strict=True):
            if not is_toxic:
                rounded.update(round(s, 2) for s in scores)
        found = [[x[2] for x in segments(s)] for s in rows]
        size = len(rows) + len(rounded)
        pad = len(rounded)
        return {"toxic": columns["toxic"] + [None] * pad, "words": [len(s) for s in rows] + [0] * pad,
                "found": found + [None] * pad, "value": [None] * len(rows) + list(rounded),
                "times": [None] * len(rows) + list(rounded.values())} if size else None

    seen = materialized(spark, map_batches(
        sample, best, "toxic int, words long, found array<double>, value double, times long", rows=2000), "toxicity-fit")
    steps = seen.where("value IS NOT NULL").groupBy("value").agg(F.sum("times").alias("n")).orderBy("value").collect()
    decay = decay_of(np.array([r["value"] for r in steps]), np.array([r["n"] for r in steps], float))
    # extreme values and significances stay on the executors; two numbers per row of the sample come back
    texts = seen.where("value IS NULL")
    extreme = F.lit(decay) * F.coalesce(F.array_max("found"), F.lit(0.0)) - F.log("words")
    quiet = texts.where("coalesce(toxic, 0) = 0 AND words > 0").agg(F.avg(extreme).alias("mean")).first()["mean"]
    scale = math.exp(quiet - 0.5772156649) if quiet is not None else 1.0
    chance = F.log(F.lit(scale) * F.col("words"))
    strength = F.aggregate("found", F.lit(0.0), lambda sum_, s: sum_ + F.greatest(F.lit(0.0), decay * s - F.col("chance")))
    rows = texts.select("toxic", "found", F.when(F.col("words") > 0, chance).otherwise(0.0).alias("chance")).select(
        F.log1p(strength).alias("x"), F.coalesce("toxic", F.lit(0)).cast("double").alias("y")).orderBy("x", "y").collect()
    curve = logistic(np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows]))
    return {"weights": weights, "decay": decay, "scale": scale, "curve": curve}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted, n_segments, the span in words of the best segment, and all significant ones."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model["weights"])  # bounded by the sample
    name = uuid.uuid4().hex
    decay, scale, (slope, intercept) = model["decay"], model["scale"], model["curve"]

    def run(columns):
        scorer = worker_store(f"toxicity {name}", lambda: Scorer(shared.value))
        out = {n: [] for n in ("score", "n_segments", "best_start", "best_end", "segments")}
        bar = -math.log(SIGNIFICANT)
        for text in columns["text"]:
            scores = scorer.scores(text)
            found = segments(scores)
            strength, many = significance([f[2] for f in found], len(scores), decay, scale)
            best = max(found, key=lambda f: f[2], default=(None, None, 0.0))
            p = slope * math.log1p(strength) + intercept
            out["score"].append(1 / (1 + math.exp(-max(-30.0, min(30.0, p)))))
            out["n_segments"].append(many)
            out["best_start"].append(best[0])
            out["best_end"].append(best[1])
            least = (bar + math.log(scale * len(scores))) / decay if scores else 0.0
            out["segments"].append([{"start": a, "end": b, "score": s} for a, b, s in found if s >= least] if many else [])
        return {"doc_id": columns["doc_id"], "held_out": columns["held_out"],
                "predicted": [int(s >= 0.5) for s in out["score"]], **out}

    rows = docs.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "text")
    return map_batches(
        rows, run, "doc_id long, held_out boolean, score double, predicted int, n_segments int, "
        "best_start int, best_end int, segments array<struct<start int, end int, score double>>", rows=1000)


def keep_clean(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model["weights"])  # bounded by the sample
    name, decay, scale, (slope, intercept) = uuid.uuid4().hex, model["decay"], model["scale"], model["curve"]
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = worker_store(f"toxicity {name}", lambda: Scorer(shared.value))
        for batch in batches:
            keep = []
            for text in batch.column(place).to_pylist():
                scores = scorer.scores(text)
                strength, _ = significance([f[2] for f in segments(scores)], len(scores), decay, scale)
                keep.append(slope * math.log1p(strength) + intercept < 0)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
