"""Similarity joins: prefix filtering, and links that span a group."""

import random

import numpy as np
import pytest

from opinionmill.llm import jaccard, minhash, spanning
from tests.llm import brute


def near_texts(seed, count, size=150, changes=(0, 1, 2, 4, 5)):
    """Copies of one text with some words changed; many pairs lie on either side of the threshold."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    base, out = [word() for _ in range(size)], []
    for _ in range(count):
        text = base[:]
        for _ in range(rng.choice(changes)):
            text[rng.randrange(size)] = word()
        out.append(" ".join(text))
    return out


@pytest.fixture(scope="module")
def mixed():
    """Near copies, chains, exact copies, short texts and texts that share a passage only."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(5000)}"
    texts = near_texts(4, 70) + near_texts(5, 40, 40, (0, 1, 2, 3))
    chain, passage = [word() for _ in range(100)], [word() for _ in range(40)]
    for i in range(12):
        chain[8 * i] = word()
        texts.append(" ".join(chain))
    texts += [" ".join([word() for _ in range(60)] + passage) for _ in range(60)]
    texts += ["same words here again and again"] * 30 + ["one two", "One TWO", "one", "", "a b c d", "a b c d e"]
    rng.shuffle(texts)
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("block", "many", "chunk", "percent"), [(2048, 16, 800_000, 85), (6, 2, 500, 85), (6, 2, 3000, 60)])
def test_similar_documents_match_brute_force(spark, mixed, monkeypatch, block, many, chunk, percent):
    monkeypatch.setattr(spanning, "BLOCK", block)
    monkeypatch.setattr(jaccard, "MANY", many)
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    docs = spark.createDataFrame(mixed, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_documents(docs, 4, percent).collect()}
    want = brute.near_components(mixed, 4, percent)
    assert got == {i: (len(brute.shingles(t, 4)), want[i]) for i, t in mixed}


def test_similar_documents_over_odd_rows(odd, none, odd_rows):
    got = jaccard.similar_documents(odd, 4, 85).collect()
    want = brute.near_components([(r[0], r[1]) for r in odd_rows if r[0] is not None], 4, 85)
    assert len(got) == len(odd_rows)
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"])
    assert sorted(r["n_shingles"] for r in got) == sorted(len(brute.shingles(r[1], 4)) for r in odd_rows)
    assert jaccard.similar_documents(none).count() == 0


def test_the_query_against_brute_force(spark, sf_dir, texts):
    got = {r["doc_id"]: r["component_id"] for r in jaccard.op13_ngram_join(spark, sf_dir).collect()}
    sets = {i: brute.shingles(t, 4) for i, t in texts.items()}
    meet = {}
    for i, s in sets.items():
        for x in s:
            meet.setdefault(x, []).append(i)
    linked = {i for ids in meet.values() if len(ids) > 1 for i in ids}
    want = brute.near_components([(i, texts[i]) for i in sorted(linked)], 4, 85)
    assert got == {i: want.get(i, i) for i in texts}


@pytest.mark.parametrize("block", [64, 4])
def test_links_of_a_group_are_few_and_whole(spark, monkeypatch, block):
    """400 alike sets in one group: as many links as the components need, and the same components as all pairs give."""
    monkeypatch.setattr(spanning, "BLOCK", block)
    texts = dict(enumerate(near_texts(6, 400 if block > 4 else 60, 60, (0, 3, 6, 9)), 5))
    sign = minhash.signer()
    sets = spark.createDataFrame(
        [(i, len(s), bytearray(s.tobytes()), None) for i, t in texts.items() for s in [sign.shingles(t, 4)]],
        "node long, n long, items binary, homes binary")
    members = spark.createDataFrame([(5, i) for i in texts], "home long, node long")
    links = [(r["a"], r["b"]) for r in spanning.spanning_links(members, sets, 80).collect()]
    parent = {i: i for i in texts}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        assert 100 * len(brute.shingles(texts[a], 4) & brute.shingles(texts[b], 4)) >= 80 * len(
            brute.shingles(texts[a], 4) | brute.shingles(texts[b], 4))
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    assert {i: find(i) for i in texts} == brute.near_components(list(texts.items()), 4)
    assert len(set(links)) == len(links) <= (3 if block > 4 else 20) * len(texts)


def test_filters_lose_no_pair():
    rng = random.Random(11)
    sets = [np.unique(np.array([rng.getrandbits(64) for _ in range(rng.randint(1, 80))], np.uint64)) for _ in range(60)]
    sets += [np.unique(np.concatenate((s[rng.randint(0, 6):], np.array([rng.getrandbits(64)], np.uint64)))) for s in sets]
    block = spanning.Block([(i, 0, len(s), s.tobytes(), None, i) for i, s in enumerate(sets)], 85)
    for row in range(1, len(sets)):
        found = set(block.may_link(row, np.arange(row)).tolist())
        for other in range(row):
            x, y = set(block.sets[row].tolist()), set(block.sets[other].tolist())
            assert other in found or 100 * len(x & y) < 85 * len(x | y)
