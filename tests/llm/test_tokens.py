"""Chat formatting, tokens, packing and language-model scores."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from opinionmill.llm import chat, ctw, packing, pieces
from opinionmill.llm.common import crc_mod

PIECE_MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))
BYTE_MODEL = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("role", ["user", "assistant", "system", "tool >> x", ""])
def test_template_reads_back(role):
    for text in ["", "plain", "<<<s>", "[INST][/INST]", "\\l", "<</s>>>", "a\\", "<s", ">>>>", "</s>[INST] ok [/INST]", "☃ [ /INST]"]:
        segment, start, end = chat.render(role, text)
        assert chat.read_back(segment) == (role, text)
        assert chat.unescape(segment[start:end]) == text
        body = segment[start:end]
        assert not any(c in body for c in ("<s>", "</s>", "[INST]", "[/INST]", "<<", ">>"))


def test_events_are_folded(spark):
    rows = [
        (1, 0, 7, 1, 0, "open", None, None, "user"), (1, 0, 7, 1, 1, "delta", None, None, "helo"),
        (1, 0, 7, 1, 3, "delta", None, None, " you"), (1, 0, 7, 1, 2, "edit", 3, 4, "lo"),
        (1, 1, 8, 1, 0, "open", None, None, "assistant"), (1, 1, 8, 1, 1, "delta", None, None, "draft"),
        (1, 1, 8, 1, 2, "regenerate", None, None, None), (1, 1, 8, 1, 3, "delta", None, None, "final"),
        (1, 2, 9, 1, 5, "delta", None, None, "no role"),
    ]
    events = spark.createDataFrame(
        rows, "conv_id long, turn long, digest long, copy int, seq long, kind string, start int, until int, text string")
    got = [(r["turn"], r["role"], r["text"]) for r in chat.formatted_segments(events).collect()]
    assert got == [(0, "user", "hello you"), (1, "assistant", "final"), (2, "", "no role")]


def test_conversations_over_odd_rows(spark):
    rows = [(1, 1, "assistant", "x" * 1500), (1, 0, "user", None), (1, 0, "user", None), (1, None, "system", "first"),
            (None, 0, None, "no id"), (2, 0, "user", ""), (3, 0, "assistant", "a ☃ </s>"), (3, 0, "assistant", "a ☃ </s>")]
    turns = spark.createDataFrame([(*r, "?") for r in rows], "conv_id long, turn long, role string, text string, segment string")
    got = {r["conv_id"]: r for r in chat.read_digests(chat.formatted_segments(chat.conversation_events(turns))).collect()}
    assert set(got) == {None, 1, 2, 3}
    want = sorted((r for r in rows if r[0] == 1), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3] or ""))
    joined = "".join(f"{r[2]}\n{r[3] or ''}\n" for r in want)
    assert got[1]["n_turns"] == 4 and got[1]["turns_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
    assert got[1]["loss_chars"] == 1500
    assert got[3]["loss_sha256"] == hashlib.sha256("a ☃ </s>a ☃ </s>".encode()).hexdigest()
    empty = chat.conversation_events(turns.where("1 = 0"))
    assert chat.read_digests(chat.formatted_segments(empty)).count() == 0


def test_pieces_match_the_library():
    import sentencepiece

    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL), pieces.PieceCodec(PIECE_MODEL)
    rng = random.Random(1)
    parts = ["a", "b", "t", "h", "e", " ", "  ", "\n", "é", "日", "x", "▁", "<s>", "😀", "1", "\t", "the", "ing", " " * 5, "\x00"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        ids = library.encode(text)
        assert own.encode(text) == ids and own.decode(ids) == library.decode(ids)
    for _ in range(1000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(300)]) for _ in range(rng.randint(0, 8))]
        assert own.decode(ids) == library.decode(ids)


def test_pieces_over_tables(documents, texts, odd, none):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    for r in pieces.coding_digests(documents, PIECE_MODEL).collect():
        ids = library.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    coded = pieces.encode(odd, PIECE_MODEL)
    assert coded.count() == odd.count() and pieces.encode(none, PIECE_MODEL).count() == 0
    pairs = {(r["doc_id"], tuple(r["ids"])) for r in coded.collect()}
    assert pairs == {(r["doc_id"], tuple(library.encode(r["text"] or ""))) for r in odd.collect()}
    decoded = {(r["doc_id"], r["text"]) for r in pieces.decode(coded, PIECE_MODEL).collect()}
    assert decoded == {(r["doc_id"], r["text"] or "") for r in odd.collect()}


def test_byte_ids_match_the_library():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(BYTE_MODEL), packing.ByteIds(BYTE_MODEL)
    library.encode_special_tokens = True
    rng = random.Random(2)
    parts = [" ", "  ", "\n", "a", "the", "'s", "é", "日", "1", "23", "!", "<|endoftext|>", "\x1c", "\xa0", " ", "word", "\t", "😀", " "]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_added_tokens_match_the_library(spark):
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(BYTE_MODEL), packing.ByteIds(BYTE_MODEL)
    rng = random.Random(7)
    parts = [" ", "  ", "\n", "the", "'s", "é", "23", "!", "<|endoftext|>", "<|endoftext|", "|>", "<", "\xa0", "\t", "😀"]
    texts = ["<|endoftext|>", "a <|endoftext|> b", "<|<|endoftext|>", " <|endoftext|><|endoftext|> ", "word " * 3000 + "<|endoftext|>x"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    for text in texts:
        assert np.frombuffer(own.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    docs = spark.createDataFrame(list(enumerate(texts[:5])), "doc_id long, text string")
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in packing.pieces(docs, BYTE_MODEL).collect()}
    want = {}
    for i, text in enumerate(texts[:5]):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        first = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
        for piece, (a, b) in enumerate(itertools.pairwise([0, *range(first, len(ids) + 1, 2048)])):
            want[i, piece] = a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
    assert got == want


def _check_packing(rows, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE_MODEL)
    want = Counter()
    for doc_id, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
        edges = [0, *range(first, len(ids) + 1, 2048)]
        for piece, (a, b) in enumerate(itertools.pairwise(edges)):
            want[doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert want == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(r["length"] for r in rows) // 2048)
    assert len(sequences) <= 1.02 * least + 1


def test_packing_over_tables(spark, documents, texts, odd, odd_rows, none):
    _check_packing(packing.pack(packing.pieces(documents, BYTE_MODEL).cache()).collect(), texts.items())
    _check_packing(packing.pack(packing.pieces(odd, BYTE_MODEL).cache()).collect(), [(r[0], r[1]) for r in odd_rows])
    assert packing.pack(packing.pieces(none, BYTE_MODEL)).count() == 0


def test_layouts_use_up_any_histogram():
    rng = random.Random(6)
    for _ in range(12):
        demand = {rng.randint(1, 200): rng.randint(1, 300) for _ in range(rng.randint(1, 60))}
        plan = packing.layouts(demand, 200, rounds=30)
        used = Counter()
        for pattern, times in plan:
            assert sum(pattern) <= 200 and times > 0
            used.update({s: n * times for s, n in Counter(pattern).items()})
        assert used == Counter(demand)
    assert packing.layouts({}, 200) == []


def test_knapsack_is_exact():
    rng = random.Random(8)
    for _ in range(20):
        sizes = np.array(sorted(rng.sample(range(1, 30), 5)))
        values = np.array([rng.random() for _ in sizes])
        chosen = packing.best_pattern(values, sizes, 40)
        best = [0.0] * 41
        for room in range(1, 41):
            best[room] = max([best[room - 1], *(best[room - s] + v for s, v in zip(sizes, values, strict=True) if s <= room)])
        assert sum(sizes[chosen]) <= 40 and abs(sum(values[chosen]) - best[40]) < 1e-9


def _brute_scores(rows, depth):
    """[(known, base, score)] of (text, held_out) rows by the definition."""
    raws = [((t or "").encode().lower(), h) for t, h in rows]
    words = Counter()
    counts, longer_of = defaultdict(lambda: [0, 0]), defaultdict(set)

    def decisions(raw):
        data = b"\x00" * depth + raw + b"\xff"
        for i in range(depth, len(data)):
            decided = 1
            for k in range(7, -1, -1):
                bit = data[i] >> k & 1
                yield data[i - depth:i], decided, bit
                decided = decided * 2 + bit

    for raw, held in raws:
        if not held:
            words.update(raw.split())
            words[None] += 1
            for context, decided, bit in decisions(raw):
                for d in range(depth + 1):
                    counts[context[depth - d:], decided][bit] += 1
    for context, decided in counts:
        if context:
            longer_of[context[1:], decided].add((context, decided))
    own = {k: math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi) for k, (a, b) in counts.items()}
    weighted, longer = {}, {}
    for k in sorted(counts, key=lambda k: -len(k[0])):
        weighted[k] = own[k]
        if len(k[0]) < depth:
            longer[k] = sum(weighted[j] for j in longer_of[k])
            weighted[k] = float(np.logaddexp(own[k], longer[k])) - math.log(2)

    def one(context, decided):
        said, left, out = 0.0, 1.0, 0.5
        for d in range(depth + 1):
            k = (context[depth - d:], decided)
            if k not in counts:
                break
            a, b = counts[k]
            estimate = (b + .5) / (a + b + 1)
            out = said + left * estimate
            if d < depth:
                here = 1 / (1 + math.exp(min(700, max(-700, longer[k] - own[k]))))
                said, left = said + left * here * estimate, left * (1 - here)
        return out

    total, different, result = sum(words.values()), len(words), []
    for raw, _ in raws:
        tokens = [*raw.split(), None]
        base = sum(math.log10((words[w] + 1) / (total + different + 1)) for w in tokens)
        score = sum(math.log10(one(c, u) if bit else 1 - one(c, u)) for c, u, bit in decisions(raw))
        result.append((len(tokens), sum(words[w] > 0 for w in tokens), total, base, score))
    return result


@pytest.mark.parametrize("hot", [1 << 20, 50])
def test_context_trees_match_the_definition(odd, odd_rows, hot):
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2 for r in odd_rows]
    want = sorted((repr(r[0]), h, *w) for r, h, w in zip(odd_rows, held, _brute_scores(
        [(r[1], h) for r, h in zip(odd_rows, held, strict=True)], 3), strict=True))
    got = sorted((repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
                 for r in ctw.score(odd, crc_mod("doc_id", 7) == 2, depth=3, hot=hot).collect())
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 and abs(a[6] - b[6]) < 1e-4 + 1e-7 * abs(b[6])


def test_context_trees_without_rows(none, odd):
    assert ctw.score(none, crc_mod("doc_id", 7) == 2).count() == 0
    from pyspark.sql import functions as F

    for r in ctw.score(odd.where("doc_id = 5"), F.lit(True), depth=3).collect():
        assert r["n_known"] == 0 and r["train_tokens"] == 0 and abs(r["score"] + 14 * 8 * math.log10(2)) < 1e-9
        assert abs(r["bits_per_byte"] - 8) < 1e-9


def test_counts_beyond_32_bits():
    """Counts of many tasks add up, also where a sum takes more than 32 bits."""
    keys, counts = ctw._merged(np.array([5, 5, 9], np.uint64), np.array([(1 << 32) - 1, 7, 1 << 40], np.int64))
    records = np.zeros(len(keys), ctw.COUNT)
    records["key"], records["n"] = keys, counts
    back = np.frombuffer(records.tobytes(), ctw.COUNT)
    assert back["n"].tolist() == [(1 << 32) + 6, 1 << 40]


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 3, 7.9, 8, 20.5, 1e6])
    assert np.allclose(ctw.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-9, atol=1e-7)
