"""Spelling variants by composed automata."""

import random
import re
import zlib
from collections import Counter

import pytest

from opinionmill.llm import variants


def near(a, b):
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 31 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            if len(word) >= 7:
                counts[word] += 1
    return counts


def plain_groups(counts):
    """{word: (n, n_near, form, form_n, root)}; words that can be near share a deletion of one code point."""
    by_rest = {}
    for w in counts:
        for rest in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            by_rest.setdefault(rest, set()).add(w)
    beside = {w: set() for w in counts}
    for group in by_rest.values():
        for x in group:
            beside[x] |= {y for y in group if y not in beside[x] and near(x, y)}
    form = {}
    for w, n in counts.items():
        best = min(beside[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 10 * n:
            form[w] = best
    out = {}
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (n, len(beside[w]), form.get(w), counts.get(form.get(w)), root)
    return out


def as_dict(frame):
    rows = frame.collect()
    out = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_composition_against_all_pairs():
    rng = random.Random(1)
    for _ in range(200):
        size = rng.randint(0, 5)
        words, longer = (
            sorted({"".join(rng.choice("abc") for _ in range(k)) for _ in range(rng.randint(0, 30))}) for k in (size, size + 1))
        got = list(variants.Acceptor().one_edit(words, longer))
        assert len(got) == len(set(got))
        assert {tuple(sorted(p)) for p in got if len(p[0]) == len(p[1])} == {
            (x, y) for i, x in enumerate(words) for y in words[i + 1:] if near(x, y)}
        assert {p for p in got if len(p[0]) < len(p[1])} == {(x, y) for x in words for y in longer if near(x, y)}


def test_the_automaton_is_minimal():
    machine = variants.Acceptor()
    start = machine.build(sorted(x + y for x in ("ab", "cd", "ef") for y in ("gh", "ij")))
    # the end, the states before h and j and the one above both are shared; b, d, f and the start
    assert machine.strings[start] == 6 and len(machine.steps) == 8
    other = machine.build(["gh", "ij"])
    assert machine.steps[machine.steps[start]["a"]]["b"] == other


@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_near_pairs_against_all_pairs(spark, letters):
    rng = random.Random(len(letters))
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(7, 10))) for _ in range(150)]
    for w in base[:60]:
        at = rng.randrange(len(w))
        base += [w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1:]]
    counts = {w: rng.choice([2, 3, 25, 300, 4000]) for w in base}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted((r["word"], r["near"], r["near_n"]) for r in variants.near_pairs(words).collect())
    assert got == sorted((x, y, counts[y]) for x in counts for y in counts if near(x, y))
    assert as_dict(variants.variant_groups(words)) == plain_groups(counts)


def test_chains_of_forms(spark):
    """Each word's form is the next one of a long chain."""
    chain = ["aaaaaaa" + "b" * i for i in range(14)]
    words = spark.createDataFrame([(w, 10 ** (i + 1)) for i, w in enumerate(chain)], "word string, n long")
    got = as_dict(variants.variant_groups(words))
    assert {r[4] for r in got.values()} == {chain[-1]} and got[chain[3]][2:4] == (chain[4], 10 ** 5)


def test_words_over_odd_rows(spark, odd, none, odd_rows):
    want = plain_words((r[0], r[1]) for r in odd_rows)
    assert {r["word"]: r["n"] for r in variants.corpus_words(odd).collect()} == want
    texts = [(7, "Überraschung überraschung ÜBERRASCHUNG caféhaus×÷y short " + "long" * 6000), (None, "nothing nothing nothing"),
             (8, "naïveté, naïveté; x" + "y" * 6 + "퟿")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r["word"]: r["n"] for r in variants.corpus_words(docs).collect()} == plain_words(texts)
    assert variants.variant_groups(variants.corpus_words(none)).count() == 0


def test_the_query_against_plain_groups(spark, sf_dir, texts):
    want = {w: n for w, n in plain_words(texts.items()).items() if n >= 2}
    assert as_dict(variants.op12_spelling_variants(spark, sf_dir)) == plain_groups(want)
