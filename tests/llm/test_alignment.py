"""Token alignment of two tokenizers."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from opinionmill.llm import alignment
from opinionmill.llm.packing import _byte_chars

BYTE_MODEL, PIECE_MODEL = (str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def plain_alignments(rows):
    """{place of the row: expected columns} with the libraries and plain loops."""
    a_model = Tokenizer.from_file(BYTE_MODEL)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    byte_of = {c: i for i, c in enumerate(_byte_chars())}

    def a_bytes(i):
        return bytes(byte_of[c] for c in a_model.id_to_token(i))

    def b_bytes(i):
        piece = b_model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_model.is_byte(i) else piece.replace("▁", " ").encode()

    def ends(tokens):
        at, out = 0, []
        for t in tokens:
            at += len(t)
            out.append(at)
        return out

    found, counts = [], Counter()
    for _, text in rows:
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        raw_a, raw_b = [a_bytes(i) for i in a], [b_bytes(i) for i in b]
        if not text or b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            found.append(([], [], [], []))
            continue
        a_ends, b_ends = ends(raw_a), ends(raw_b)
        both = sorted(set(a_ends) & set(b_ends))
        a_at, b_at = ({e: i for i, e in enumerate(x)} for x in (a_ends, b_ends))
        links = [(a[a_at[e]], b[b_at[e]]) for e in both]
        counts.update(links)
        groups, i, j = [], 0, 0
        for e in both:
            groups.append(",".join(map(str, a[i:a_at[e] + 1])) + "|" + ",".join(map(str, b[j:b_at[e] + 1])))
            i, j = a_at[e] + 1, b_at[e] + 1
        found.append((a, b, groups, links))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [(i, len(a), len(b), len(g), len(k), sum(counts[p] == most[p[1]] for p in k), sum(counts[p] for p in k), ";".join(g))
            for (i, _), (a, b, g, k) in zip(rows, found)]


def as_rows(frame):
    return sorted(((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups"])
                   for r in frame.collect()), key=repr)


def test_terminal_tokens_against_plain_components():
    rng = random.Random(2)
    for _ in range(300):
        size = rng.randint(1, 40)
        ends = [sorted({size, *rng.sample(range(1, size + 1), rng.randint(0, size))}) for _ in "ab"]
        a_group, b_group = alignment.terminal_tokens(*map(np.array, ends))
        cut = sorted(set(ends[0]) & set(ends[1]))
        for rows, labels in zip(ends, (a_group, b_group)):
            want = [next(k for k, c in enumerate(cut) if e <= c) for e in rows]
            assert len(set(zip(want, labels.tolist()))) == len(set(want)) == len(set(labels.tolist()))
        assert [ends[1][t] for t in sorted(set(a_group.tolist()))] == cut


TEXTS = [
    "", None, " ", "  two  spaces  ", "\n\nlines\n", "plain words, and some more.", "<|endoftext|> in <s> text </s> <0x41>",
    "a mark ▁ of the pieces", "Ünïcödé ☃ 日本語 🙂🙂", "don't can't I'll", "tab\tand\x00nul \x1c x", "word" * 50, "x " * 40,
    "1234567890 12 3", " leading", "trailing ", "nbsp here  wide", "same text", "same text",
]


def test_alignments_match_the_libraries(spark, documents, monkeypatch):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    rows += [(1000 + r["doc_id"], r["text"]) for r in documents.orderBy("doc_id").limit(60).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert as_rows(alignment.alignments(docs, BYTE_MODEL, PIECE_MODEL)) == sorted(plain_alignments(rows), key=repr)


@pytest.mark.parametrize("limit", [1, 40])
def test_random_cuts_match_the_libraries(spark, monkeypatch, limit):
    monkeypatch.setattr(alignment, "BATCH_CUTS", limit)
    monkeypatch.setattr(alignment, "KNOWN_CUTS", 5 * limit)
    rng = random.Random(limit)
    parts = ["a", "the", "ing", " ", "  ", "\n", ".", "’", "é", "日", "​", "Z", "42", "'s", "\t", "<s>", "🙂", "ﬁ", "́", "-"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert as_rows(alignment.alignments(docs, BYTE_MODEL, PIECE_MODEL)) == sorted(plain_alignments(rows), key=repr)


def test_alignments_over_odd_rows(odd, none, odd_rows):
    got = as_rows(alignment.alignments(odd, BYTE_MODEL, PIECE_MODEL))
    assert got == sorted(plain_alignments([(r[0], r[1]) for r in odd_rows]), key=repr)
    digests = {r["doc_id"]: r["groups"] for r in alignment.alignments(odd, BYTE_MODEL, PIECE_MODEL, digests=True).collect()}
    assert digests[1] == "" and digests[2] == ""
    assert digests[4] == hashlib.sha256(next(r[7] for r in got if r[0] == 4).encode()).hexdigest()
    assert alignment.alignments(none, BYTE_MODEL, PIECE_MODEL).count() == 0
