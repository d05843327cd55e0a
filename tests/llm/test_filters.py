"""Toxicity, quality rules and secret scans."""

import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from opinionmill.llm import quality, secrets, toxicity
from tests.llm import brute


def test_segments_match_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.choice([-2, -1, -0.5, 0.5, 1, 3]) for _ in range(rng.randint(0, 14))]
        found = toxicity.segments(scores)
        total = list(itertools.accumulate(scores, initial=0))
        best = max((total[j] - total[i] for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=0)
        if best > 0:
            assert abs(max(f[2] for f in found) - best) < 1e-9
        assert all(abs(s - (total[e] - total[b])) < 1e-9 and s > 0 for b, e, s in found)
        spans = sorted((b, e) for b, e, _ in found)
        assert all(x[1] <= y[0] for x, y in itertools.pairwise(spans))
        assert {i for i, s in enumerate(scores) if s > 0} <= {i for b, e in spans for i in range(b, e)}


def test_all_maximal_segments():
    """Ruzzo and Tompa's definition: the best segment, then the same to its left and to its right."""
    def maximal(scores, begin, end):
        total = list(itertools.accumulate(scores[begin:end], initial=0))
        spans = [(total[j] - total[i], begin + i, begin + j) for i in range(end - begin) for j in range(i + 1, end - begin + 1)]
        best = max(spans, default=(0, 0, 0))
        if best[0] <= 0:
            return []
        return [*maximal(scores, begin, best[1]), best[1:], *maximal(scores, best[2], end)]

    rng = random.Random(2)
    for _ in range(400):
        scores = [rng.gauss(-0.2, 1) for _ in range(rng.randint(0, 25))]
        assert [(b, e) for b, e, _ in sorted(toxicity.segments(scores))] == maximal(scores, 0, len(scores))


def test_decay_is_the_root():
    values, counts = np.array([-1.0, 2.0]), np.array([9.0, 1.0])
    decay = toxicity.decay_of(values, counts)
    assert abs((counts / 10) @ np.exp(decay * values) - 1) < 1e-9


def test_toxicity_over_odd_rows(odd, none, labels):
    model = toxicity.fit(odd, labels)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(len(r["segments"]) == r["n_segments"] for r in rows)
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0
    assert {r["predicted"] for r in toxicity.score(odd, toxicity.fit(odd, labels.where("1 = 0"))).collect()} == {0}
    kept = toxicity.keep_clean(odd, model)
    assert kept.columns == odd.columns
    assert kept.count() == sum(1 - r["predicted"] for r in rows)


def test_toxicity_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).where("held_out").join(labels, "doc_id")
    cells = {(r["toxic"], r["predicted"]): r["count"] for r in scored.groupBy("toxic", "predicted").count().collect()}
    assert cells[1, 1] / (cells[1, 1] + cells.get((1, 0), 0)) > 0.85
    assert cells.get((0, 1), 0) / (cells[0, 0] + cells.get((0, 1), 0)) < 0.02


def test_quality_statistics_match_brute_force(odd_rows, odd, documents, texts):
    got = quality.statistics(documents).collect()
    assert all(tuple(r[c] for c in quality.BASE) == brute.quality_base(texts[r["doc_id"]]) for r in got)
    odd_got = sorted(tuple(r[c] for c in quality.BASE) for r in quality.statistics(odd).collect())
    assert odd_got == sorted(brute.quality_base(r[1]) for r in odd_rows)


def test_quality_rules_are_learned_and_ordered():
    rng = np.random.default_rng(3)
    data = {"a": rng.random(900), "b": rng.random(900)}
    bad = ((data["a"] > 0.8) & (data["b"] < 0.5)) | (data["b"] > 0.95)
    rules = quality.learn(data, bad, np.arange(900) % 3)
    hit = np.zeros(900, bool)
    for rule in rules:
        hit |= quality.covers(rule, data, 900)
    assert (hit == bad).mean() > 0.95


def test_quality_over_odd_rows(odd, none, labels):
    stats = quality.statistics(odd)
    assert quality.judge(stats, []).where("kept = base_failed").count() == 0
    assert quality.judge(stats, quality.fit(stats, labels)).count() == odd.count()
    assert quality.fit(quality.statistics(none), labels) == []
    assert quality.judge(quality.statistics(none), []).count() == 0


def test_quality_verdicts_agree_with_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    stats = quality.statistics(docs).cache()
    judged = quality.judge(stats, quality.fit(stats, labels)).where("NOT base_failed").join(labels, "doc_id")
    wrong = judged.where("kept <> (quality = 1)").count()
    assert wrong < 0.02 * judged.count()


def _spans(text):
    kinds = (
        ("assign", r"(?:password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A, 1, 12),
        ("access", r"AKIA[A-Z0-9]+", 0, 0, 18), ("hex", r"[0-9a-f]+", 0, 0, 16))
    return sorted(
        (m.start(), rank, m.end(), kind) for rank, (kind, pattern, flags, group, least) in enumerate(kinds)
        for m in re.finditer(pattern, text or "", flags) if len(m[group]) >= least)


def test_secret_spans_match_brute_force(spark, odd_rows):
    extra = ["☃ token: 'abcdefghijkl' ☃ Password=token=abcdefghijklmnop", "password=secret:abcdefghijklmnop",
             "AKIAAKIA" + "A" * 12 + " api_key=short apikey=" + "x" * 12, "0123456789abcdef0123456789ABCDEF"]
    cases = [r[1] for r in odd_rows] + extra
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, text string")
    got = frame.select("i", secrets.base_spans(F.coalesce("text", F.lit(""))).alias("b")).collect()
    for r in got:
        assert [(s["start"], s["rank"], s["end"], s["kind"]) for s in r["b"]] == _spans(cases[r["i"]])


def test_ownership_separates_copies(spark, odd, none):
    shared, own = "abcdefgh01234567ABCDEFGH01", "zyxwvuts76543210ZYXWVUTS76"
    rows = [(i, f"see {shared} here" + (f" and {own}" if i == 3 else ""), f"s{i}", "en") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r["doc_id"]: r for r in secrets.scan(docs, F.col("source"), F.col("source")).collect()}
    assert all(r["n_copied"] == 1 for r in got.values())
    assert [s["value"] for s in got[3]["owned"]] == [own]
    clean = {r["doc_id"]: r["text"] for r in secrets.redacted(docs, F.col("source"), F.col("source")).collect()}
    assert clean[3] == f"see {shared} here and [SECRET]" and clean[2] == rows[2][1]
    result = secrets.scan(odd, F.col("source"), F.col("lang"))
    assert result.count() == odd.count()
    redacted = secrets.redacted(odd, F.col("source"), F.col("lang"))
    assert redacted.columns == odd.columns and redacted.count() == odd.count()
    assert secrets.scan(none, F.col("source"), F.col("lang")).count() == 0
