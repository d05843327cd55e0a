"""Near-duplicates, repeated passages and neighbours."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinionmill.llm import bwt, components, minhash, neighbours, spanning, substrings
from tests.llm import brute


def test_components(spark):
    rng = random.Random(9)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(200, i) for i in range(201, 260)]
    pairs += [(300 + i, 301 + i) for i in range(25)] + [(5, 5)]
    parent = {x: x for p in pairs for x in p}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_a_zigzag(spark, monkeypatch):
    zigzag = [(1, 4), (3, 4), (3, 5), (2, 5)]
    pairs = [(100 + 2 * i, 101 + 2 * i) for i in range(100)]
    for rows in (zigzag, zigzag + pairs):
        links = spark.createDataFrame(rows, "a long, b long")
        got = {r["node"]: r["component"] for r in components.components(links).collect()}
        assert got == {x: 1 for x in range(1, 6)} | {x: a for a, b in rows[4:] for x in (a, b)}
    monkeypatch.setattr(components, "MAX_ROUNDS", 1)
    with pytest.raises(RuntimeError):
        components.components(spark.createDataFrame(zigzag, "a long, b long"))


@pytest.fixture(scope="module")
def clusters(spark):
    """Near copies of two texts, chains among them, beside texts that only share a passage."""
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(5000)}"
    rows, base, passage = [], [word() for _ in range(150)], [word() for _ in range(40)]
    for i in range(60):
        text = base[:]
        for _ in range(rng.choice([0, 1, 2, 4, 5])):
            text[rng.randrange(150)] = word()
        rows.append((1000 - i, " ".join(text)))
    chain = [word() for _ in range(100)]
    for i in range(12):
        chain[8 * i] = word()
        rows.append((2000 + i, " ".join(chain)))
    rows += [(3000 + i, " ".join([word() for _ in range(60)] + passage)) for i in range(60)]
    return rows


@pytest.mark.parametrize("block", [8, 2048])
def test_near_duplicates_match_brute_force(spark, clusters, monkeypatch, block):
    monkeypatch.setattr(spanning, "BLOCK", block)
    docs = spark.createDataFrame(clusters, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, 4).collect()}
    assert got == brute.near_components(clusters, 4)


def test_a_pair_that_only_a_heavy_bucket_shares(spark, monkeypatch):
    monkeypatch.setattr(spanning, "BLOCK", 3)
    texts = {i: " ".join(f"w{i}x{k}" for k in range(60)) for i in range(1, 13)}
    texts[12] = texts[11] + " more"
    nodes = [(i, [7] + [1000 * i + band for band in range(1, minhash.BANDS)]) for i in texts]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    nodes = spark.createDataFrame(nodes, "node long, buckets array<long>")
    got = {r["node"]: r["component"] for r in minhash.linked(docs, nodes, 4, 80).collect()}
    assert got == {11: 11, 12: 11}


def test_a_bucket_of_alike_but_unlinked_documents(spark):
    """3,000 documents of one bucket with similarities below the bar, and a few linked ones among them."""
    rng = random.Random(12)
    base, texts = [f"w{k}" for k in range(80)], {}
    for i in range(1, 3001):
        text = base[:]
        first = rng.randrange(3, 24)
        for k in (first, first + 26, first + 52):  # 12 of 77 shingles: two such texts have a similarity of 0.73 at most
            text[k] = f"x{i}_{k}"
        texts[i] = " ".join(text)
    for i in range(3001, 3021):
        texts[i] = texts[150 * (i - 3000)] + " more"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    nodes = spark.createDataFrame([(i, [7]) for i in texts], "node long, buckets array<long>")
    got = {r["node"]: r["component"] for r in minhash.linked(docs, nodes, 4, 80).collect()}
    wanted = {i: 150 * (i - 3000) for i in range(3001, 3021)}
    assert got == wanted | {c: c for c in wanted.values()}


def test_near_duplicates_over_odd_rows(odd, none, odd_rows):
    got = minhash.near_duplicates(odd, 4).collect()
    want = brute.near_components([(r[0], r[1]) for r in odd_rows if r[0] is not None], 4)
    assert len(got) == len(odd_rows)
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"])
    assert sorted(r["n_shingles"] for r in got) == sorted(len(brute.shingles(r[1], 4)) for r in odd_rows)
    kept = minhash.keep_one(odd)
    five = brute.near_components([(r[0], r[1]) for r in odd_rows if r[0] is not None], 5)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == sorted({i for i in five if five[i] == i})
    assert minhash.near_duplicates(none).count() == 0 and minhash.keep_one(none).count() == 0


def test_keep_one_over_reused_and_null_ids(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(60)) for x in "abcd")
    rows = [(1, a, 0), (2, a + " more", 0), (2, b, 0), (2, b, 0), (3, c, 0), (3, d, 0), (None, a + " end", 0),
            (None, b + " end", 0), (None, "only here " * 9, 0), (4, None, 0), (4, "", 0), (None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int")
    got = minhash.keep_one(docs)
    want = [(1, a, 0), (2, b, 0), (3, c, 0), (3, d, 0), (None, "only here " * 9, 0), (4, None, 0), (4, "", 0), (None, None, 0)]
    assert got.columns == docs.columns
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("block", [3, 16, 1 << 20])
def test_equal_windows(monkeypatch, block):
    monkeypatch.setattr(bwt, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(60):
        strings = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(1, 12))]
        width = rng.randint(1, 5)
        string, offset, kind = bwt.equal_windows(strings, width)
        windows = {}
        for s, o, k in zip(string, offset, kind, strict=True):
            windows.setdefault(int(k), set()).add(strings[s][o:o + width])
        assert all(len(v) == 1 for v in windows.values())
        assert len({next(iter(v)) for v in windows.values()}) == len(windows)
        assert len(string) == sum(max(0, len(x) - width + 1) for x in strings)


@pytest.mark.parametrize("hot", [2000, 2])
def test_repeated_passages_match_brute_force(documents, texts, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    want = brute.without_repeats(texts.items())
    for r in substrings.without_repeats(documents).collect():
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]][:4]


def test_anchors_are_dealt_evenly(spark):
    rng = random.Random(3)
    text = "".join(chr(rng.randrange(33, 126)) for _ in range(400_000))
    docs = spark.createDataFrame([(i, text[20_000 * i:20_000 * (i + 1)]) for i in range(20)], "doc_id long, text string")
    packed = substrings.packed_anchors(docs.coalesce(1), 100, 32, 16).where("part IS NOT NULL")
    sizes = [r["s"] for r in packed.groupBy("part").agg(F.sum(F.length("blob")).alias("s")).collect()]
    assert len(sizes) == 16 and max(sizes) <= 2 * sum(sizes) / 16


def test_repeated_passages_over_odd_rows(spark, odd, none, odd_rows, monkeypatch):
    monkeypatch.setattr(substrings, "PIECE", 4096)
    want = brute.without_repeats((r[0], r[1]) for r in odd_rows if r[0] is not None)
    got = substrings.without_repeats(odd, 40, 12).collect()
    want = brute.without_repeats(((r[0], r[1]) for r in odd_rows if r[0] is not None), 40)
    assert len(got) == len(odd_rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
        else:
            assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]][:4]
    kept = substrings.texts_without_repeats(odd, 40, 12)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows)
    for r in kept.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text").collect():
        assert r["text"] == want[r["doc_id"]][4].decode("utf-8", "ignore")
    assert substrings.without_repeats(none).count() == 0 and substrings.texts_without_repeats(none).count() == 0


def test_neighbours_recall(spark):
    folder = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    ids, matrix = table["vec_id"].to_numpy(), np.array(table["embedding"].tolist(), np.float32).astype(float)
    got = neighbours.op4_nearest_neighbours(spark, folder).toPandas()
    near = {q: list(rows.sort_values("rank")["vec_id"]) for q, rows in got.groupby("query_id")}
    hits = total = 0
    for at in np.flatnonzero(ids % 20 == 0):
        scores = matrix @ matrix[at]
        scores[at] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        hits, total = hits + len(set(best) & set(near[ids[at]])), total + 20
        assert len(near[ids[at]]) == 20 and ids[at] not in near[ids[at]]
    assert hits / total > 0.9


def test_neighbours_over_odd_vectors(spark):
    same = [1.0, 0.0]
    rows = [(i, same, 1) for i in range(0, 60)] + [(60, [0.5, 0.5], 1), (80, [0.0, 0.0], 1), (None, same, 1), (100, None, 1),
            (120, [float("nan"), 1.0], 1), (140, [1.0, None], 1), (160, [1.0, 2.0, 3.0], 1), (20, same, 1), (180, [], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = neighbours.search(frame, frame.where("vec_id % 20 = 0").select("vec_id"), 20).collect()
    lists = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        lists.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(lists) == {0, 20, 40, 60}
    assert [x[1] for x in lists[20]] == list(range(20)) and [x[1] for x in lists[0]] == list(range(1, 21))
    assert all(s == 0.5 for _, _, s in lists[60]) and [x[0] for x in lists[60]] == list(range(1, 21))
    empty = frame.where("1 = 0")
    assert neighbours.search(empty, empty.select("vec_id")).count() == 0
