"""Learners that pass over vector blocks, and in-row term vectors."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from opinionmill.operators import classify, clusters, features, hashed_terms, newton, vector_blocks


@pytest.fixture(scope="module")
def labelled(spark):
    """Rows of three classes that overlap; some vectors are sparse."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(700):
        label = int(rng.integers(3))
        x = rng.normal(0, 1, 6) + np.eye(6)[label] * 1.2
        x[rng.random(6) < 0.3] = 0.0
        vector = Vectors.dense(x) if i % 2 else Vectors.sparse(6, {j: float(v) for j, v in enumerate(x) if v})
        rows.append((("negative", "neutral", "positive")[label], float(label), vector))
    return spark.createDataFrame(rows, ["sentiment", "_label", "features"]).repartition(5)


def plain_minimum(x, labels, costs):
    """Squared hinge with a penalised intercept by Newton steps with the full Hessian."""
    x = np.hstack((x, np.ones((len(x), 1))))
    out = []
    for label, own in enumerate(costs):
        side, cost = np.where(labels == label, 1.0, -1.0), np.where(labels == label, own, 1.0)
        w = np.zeros(x.shape[1])

        def loss(w, side=side, cost=cost):
            return 0.5 * w @ w + (cost * np.maximum(0, 1 - side * (x @ w)) ** 2).sum()

        for _ in range(200):
            short = np.maximum(0, 1 - side * (x @ w))
            gradient = w - 2 * x.T @ (cost * side * short)
            inside = short > 0
            step = np.linalg.solve(np.eye(len(w)) + 2 * (x[inside] * cost[inside, None]).T @ x[inside], gradient)
            size = 1.0
            while loss(w - size * step) > loss(w) and size > 1e-10:
                size /= 2
            w = w - size * step
        out.append(w)
    return np.array(out)


def test_newton_finds_the_minimum(labelled):
    blocks = vector_blocks.vector_blocks(labelled, "features", "_label")
    rows = labelled.collect()
    x, labels = np.array([r["features"].toArray() for r in rows]), np.array([r["_label"] for r in rows])
    costs = [2.5, 1.0, 0.7]
    found = newton.fit_squared_hinge(blocks, 6, costs, precision=1e-7)
    assert np.abs(found - plain_minimum(x, labels, costs)).max() < 1e-3


@pytest.fixture(scope="module")
def entangled(spark):
    """Rows whose columns nearly repeat one another, so that the Hessian is far from its diagonal."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(6000, 80)) @ (rng.normal(size=(80, 80)) * np.logspace(0, -0.7, 80)[:, None])
    x /= np.linalg.norm(x, axis=1)[:, None]
    labels = np.clip(np.round(x @ rng.normal(size=80) * 0.8 + rng.normal(0, 0.4, 6000)) + 1, 0, 2)
    df = spark.createDataFrame([(float(y), Vectors.dense(r)) for y, r in zip(labels, x, strict=True)], ["_label", "features"])
    return vector_blocks.vector_blocks(df.repartition(4), "features", "_label"), x, labels


def summed_here(monkeypatch, blocks):
    """Passes over the collected blocks in this process; one entry in the list per pass."""
    seen, here = [], [vector_blocks.Block(*r) for r in blocks.collect()]

    def sums(_, measure):
        seen.append(1)
        return [sum(x) for x in zip(*map(measure, here), strict=True)]

    monkeypatch.setattr(newton, "block_sums", sums)
    return seen


def test_newton_takes_few_passes(entangled, monkeypatch):
    blocks, x, labels = entangled
    seen, costs = summed_here(monkeypatch, blocks), np.array([2.0, 1.0, 0.5])
    found = newton.fit_squared_hinge(blocks, 80, costs)
    assert len(seen) < 50  # 146 where every step came from a pass alone
    start, end = (np.linalg.norm(newton.loss_and_gradient(blocks, w, costs)[1], axis=1) for w in (np.zeros_like(found), found))
    assert (end <= 1e-5 * start).all()


@pytest.mark.parametrize("name, value", [("LEAST_DRAWN", 40), ("COLUMNS", 30)])
def test_drawn_rows_do_not_decide_the_minimum(entangled, monkeypatch, name, value):
    blocks, x, labels = entangled
    costs = [2.0, 1.0, 0.5]
    want = plain_minimum(x, labels, costs)
    summed_here(monkeypatch, blocks)
    monkeypatch.setattr(newton, name, value)
    monkeypatch.setattr(newton, "DRAWN", 0 if name == "LEAST_DRAWN" else newton.DRAWN)
    found = newton.fit_squared_hinge(blocks, 80, costs, precision=1e-7)
    padded = np.hstack((x, np.ones((len(x), 1))))
    assert np.abs(padded @ (found - want).T).max() < 1e-3


@pytest.mark.parametrize("size", [1, 7, newton.STRIPE, 2 * newton.STRIPE + 3])
def test_inverse_in_place(size):
    x = np.random.default_rng(size).normal(size=(2 * size, size))
    matrix = x.T @ x / size + 0.1 * np.eye(size)
    found = matrix.copy()
    newton.invert_in_place(found)
    assert np.allclose(found @ matrix, np.eye(size), atol=1e-8)
    vector = np.arange(size, dtype=float)
    assert np.allclose(newton.Symmetric(matrix).times(vector), matrix @ vector)


def test_rows_are_drawn_alike(entangled):
    blocks, x, labels = entangled
    drawn, factor = vector_blocks.drawn_rows(blocks, 1500, 1 << 23)
    assert factor == pytest.approx(4.0) and 1300 < len(drawn.many) < 1700 and drawn.size == 80
    known = {tuple(r): y for r, y in zip(x.astype(np.float32).astype(float), labels, strict=True)}
    assert [known[tuple(r)] for r in drawn.matrix] == drawn.labels.tolist()
    again, _ = vector_blocks.drawn_rows(blocks, 1500, 1 << 23)
    assert (again.values == drawn.values).all()
    few, _ = vector_blocks.drawn_rows(blocks, 1500, 8000)
    assert len(few.values) < 12_000
    whole, factor = vector_blocks.drawn_rows(blocks, 10_000, 1 << 23)
    assert factor == 1.0 and len(whole.many) == 6000
    assert vector_blocks.drawn_rows(blocks.where("1 = 0"), 10, 10) is None


def test_newton_works_on_the_entries_alone():
    rng = np.random.default_rng(8)
    size, many = 40_000_000, np.array([0, 3, 0, 1, 2, 0])  # a dense matrix would take 2 GB
    places = np.concatenate([np.sort(rng.choice(size, n, replace=False)) for n in many]).astype(np.int32)
    values = rng.normal(size=many.sum())
    block = vector_blocks.Block(size, np.cumsum(many).tobytes(), places.tobytes(), values.tobytes(), np.zeros(6, np.int32).tobytes())
    vector = np.arange(size, dtype=float)
    found, at = block.products(vector[None, :]), 0
    for row, n in enumerate(many):
        assert found[row, 0] == pytest.approx(vector[places[at:at + n]] @ values[at:at + n])
        at += n
    sums = block.weighted_sums(np.arange(6.0)[:, None])
    assert sums[0, places].tolist() == pytest.approx((values * np.repeat(np.arange(6.0), many)).tolist())
    assert np.count_nonzero(sums) == many.sum() and "matrix" not in vars(block)


def test_one_row_of_sums_reaches_the_driver(spark, labelled, monkeypatch):
    blocks = vector_blocks.vector_blocks(labelled, "features", "_label")
    want = np.array([r["features"].toArray() for r in labelled.collect()]).sum(axis=0)
    whole = type(blocks).collect
    for parts in (1, 5, 2 * vector_blocks.TASKS):
        seen = []
        dealt = blocks.repartition(parts)
        with monkeypatch.context() as patch:
            patch.setattr(type(blocks), "collect", lambda df, seen=seen: seen.append(whole(df)) or seen[-1])
            found = vector_blocks.block_sums(dealt, lambda b: [b.matrix.sum(axis=0), np.array([float(len(b.labels))])])
        assert [len(rows) for rows in seen] == [1]
        assert np.allclose(found[0], want) and found[1].tolist() == [700.0]
    assert vector_blocks.block_sums(blocks.where("1 = 0"), lambda b: [b.matrix]) is None


def test_margins_of_the_fitted_stages(labelled):
    stages = classify.fit_one_vs_rest(labelled, True, 100)
    rows = labelled.collect()
    x, labels = np.array([r["features"].toArray() for r in rows]), np.array([r["_label"] for r in rows])
    counts = Counter(labels.tolist())
    want = plain_minimum(x, labels, [len(rows) / (3 * counts[i]) for i in (0.0, 1.0, 2.0)])
    scored = labelled
    for stage in stages:
        scored = stage.transform(scored)
    for r in scored.collect():
        assert np.allclose(r["rawPrediction"].toArray(), want[:, :-1] @ r["features"].toArray() + want[:, -1], atol=1e-2)


def test_restarts_settle_at_means(spark):
    rng = np.random.default_rng(3)
    points = np.vstack([rng.normal(c, 0.3, (60, 4)) for c in (np.zeros(4), np.ones(4) * 3, np.array([3.0, 0, 0, 0]))])
    df = spark.createDataFrame([(i, Vectors.dense(p)) for i, p in enumerate(points)], ["id", "features"]).repartition(4)
    fits = clusters.fit_restarts(vector_blocks.vector_blocks(df), [2, 3, 5], restarts=6, seed=1)
    assert len(fits) == 18 and all(f.steps == -1 for f in fits)
    for f in fits:
        squares = ((points[:, None, :] - f.centers) ** 2).sum(axis=2)
        nearest = squares.argmin(axis=1)
        assert f.inertia == pytest.approx(squares.min(axis=1).sum())
        for k in range(f.k):
            assert np.allclose(f.centers[k], points[nearest == k].mean(axis=0), atol=1e-6)
    best = clusters.best_restart(fits, 3)
    assert best.inertia < 3 * 60 * 4 * 0.3 ** 2 * 1.3
    model = clusters.fit_kmeans(df, 3, restarts=6, seed=1)
    found = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    assert len({frozenset(i for i in found if found[i] == k) for k in range(3)}) == 3
    assert sorted(Counter(found.values()).values()) == [60, 60, 60]


def test_more_centres_than_points(spark):
    df = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),)] * 4 + [(Vectors.dense([5.0, 2.0]),)], ["features"])
    fits = clusters.fit_restarts(vector_blocks.vector_blocks(df), [3], restarts=2)
    assert all(f.inertia == pytest.approx(0.0) for f in fits)


TEXTS = ["red blue red green", "blue", "", None, "red red red", "a b c d e f g a b", "green blue"]


def test_terms_are_counted_in_the_row(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")
    tokens = F.filter(F.split("t", " "), lambda t: t != "")
    got = {(r["id"], r["term"], r["tf"]) for r in features.term_counts(df, ["id"], tokens, one_row_per_key=True).collect()}
    assert got == {(i, w, n) for i, t in enumerate(TEXTS) for w, n in Counter((t or "").split()).items()}


@pytest.mark.parametrize("sublinear", [False, True])
def test_tfidf_in_the_row(spark, sublinear):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")
    tokens = F.filter(F.split("t", " "), lambda t: t != "")
    corpus = Counter(w for t in TEXTS for w in (t or "").split())
    kept = sorted(corpus, key=lambda w: (-corpus[w], w))[:5]
    idf = {w: math.log((len(TEXTS) + 1) / (sum(w in (t or "").split() for t in TEXTS) + 1)) + 1 for w in kept}
    want = {}
    for i, t in enumerate(TEXTS):
        raw = {w: (1 + math.log(n) if sublinear else n) * idf[w] for w, n in Counter((t or "").split()).items() if w in idf}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        want |= {(i, w): v / norm for w, v in raw.items()}
    got = {(r["id"], r["term"]): r["weight"] for r in features.tfidf(df, ["id"], tokens, 5, sublinear).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    assert features.tfidf(df.where("id = 2"), ["id"], tokens, 5).count() == 0


def test_vocabulary_is_whole_whatever_the_sketch_holds(spark):
    rng = random.Random(6)
    words = [f"w{int(rng.paretovariate(0.7)) % 3000}" for _ in range(20_000)]
    rows = [(" ".join(words[i:i + 20]),) for i in range(0, len(words), 20)]
    df = spark.createDataFrame(rows, "t string").repartition(4)
    corpus = Counter(words)
    present = Counter(w for (t,) in rows for w in set(t.split()))
    for size, tracked in ((10, 1 << 12), (10, 64), (400, 512), (5000, 1 << 14)):
        got = [(r["term"], r["corpus_tf"], r["df"]) for r in features.vocabulary_by_sketch(df, F.split("t", " "), size, tracked).collect()]
        want = sorted(corpus, key=lambda w: (-corpus[w], w))[:size]
        assert sorted(got) == sorted((w, corpus[w], present[w]) for w in want)
        exact = features.vocabulary(df, F.split("t", " "), size).collect()
        assert sorted(map(tuple, exact)) == sorted(got)


@pytest.fixture(scope="module")
def chatter(spark):
    """Texts in which nearly every pair of neighbours is a different one."""
    rng = random.Random(9)
    texts = ["", "the of", "Zebra!"]
    for _ in range(9000):
        words = [f"w{int(rng.paretovariate(0.6)) % 4000}" for _ in range(rng.randrange(40))]
        texts.append(" ".join(words + (["new york, new york"] if rng.random() < 0.2 else [])))
    return spark.createDataFrame([(t,) for t in texts], "review_text string").repartition(5).cache()


def plain_vocabulary(df, max_features):
    tf, present = Counter(), Counter()
    for (text,) in df.collect():
        words = [w for w in "".join(c if c.isalnum() else " " for c in text.lower()).split() if len(w) > 1 and w not in ("the", "of")]
        terms = words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
        tf.update(terms)
        present.update(set(terms))
    return [(w, tf[w], present[w]) for w in sorted(tf, key=lambda w: (-tf[w], w))[:max_features]], len(tf)


def test_rare_pairs_are_not_grouped(chatter, monkeypatch):
    want, different = plain_vocabulary(chatter, 150)
    grouped, real = [], hashed_terms.counted_terms
    monkeypatch.setattr(hashed_terms, "counted_terms", lambda *a: grouped.append(real(*a)) or grouped[-1])
    monkeypatch.setattr(features, "vocabulary", None)  # which groups all terms
    found = features.text_vocabulary(chatter, max_features=150, stop_words=["the", "of"])
    assert [tuple(r) for r in found] == want and any(" " in r["term"] for r in found)
    assert 150 <= grouped[0].count() < different / 20


@pytest.mark.parametrize("bits, size", [(6, 50), (20, 2_000_000), (20, 30_000)])
def test_vocabulary_is_whole_where_buckets_prove_nothing(chatter, monkeypatch, bits, size):
    proven = []
    monkeypatch.setattr(features, "frequent_terms", lambda words, n: proven.append(hashed_terms.frequent_terms(words, n, bits)) or proven[-1])
    found = features.text_vocabulary(chatter, max_features=size, stop_words=["the", "of"])
    assert [tuple(r) for r in found] == plain_vocabulary(chatter, size)[0]
    assert features.text_vocabulary(chatter.where("review_text = 'none'"), max_features=size) == []
    assert proven == [None, None]


def test_candidates_share_the_counted_terms(spark, monkeypatch):
    rng = random.Random(4)
    mood = {"negative": "bad broken awful", "neutral": "fine okay plain", "positive": "great lovely happy"}
    rows = [(s, " ".join(rng.choices(mood[s].split() + ["thing", "box"], k=8))) for s in mood for _ in range(40)]
    df = spark.createDataFrame(rows, "sentiment string, review_text string").repartition(3)
    counted, real = [], features.text_vocabulary
    for module in (features, classify):
        monkeypatch.setattr(module, "text_vocabulary", lambda *a, **k: counted.append(1) or real(*a, **k))
    out = classify.compare_candidates(df, df, max_features=40).collect()
    assert len(counted) == 1
    assert sorted(r["model"] for r in out) == sorted(c.name for c in classify.CANDIDATES)
    assert all(r["samples"] == 120 and r["accuracy"] > 0.95 for r in out)
