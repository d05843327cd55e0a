r"""SentencePiece BPE encoding and decoding by a prefix table (operator 6).

For every prefix of a text the last token of its encoding is unique. An automaton lists the pieces that
end at a position; the one that fits behind the last token of the shorter prefix is stored, and the ids
are read off backwards. Two pieces fit when the merges of their joined text end in just these two.

A space mark never follows another character inside a piece, so texts are cut in front of space marks
and equal cuts are encoded once per worker; the table of known cuts is emptied when it is full.

Defined results: a null text is empty; an empty text has no ids and decodes to an empty text; characters
outside the vocabulary become byte pieces; repeated rows are encoded each; extra columns are ignored.
The model file is named by path and read on the executors, where the tokenizer files are installed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionmill.llm.common import map_batches, table, worker_store

MARK = "▁"
KNOWN_CUTS = 400_000  # entries kept per worker
KNOWN_PAIRS = 1_000_000


class PieceCodec:
    """Encoder and decoder over one model file."""

    def __init__(self, path: str):
        import gc

        import sentencepiece

        gc.disable()  # the tables below hold no cycles, and walking them costs more than the encoding
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.rank: dict[str, tuple[float, int]] = {}
        self.byte_ids: list[int] = [0] * 256
        self.byte_of: dict[int, int] = {}
        self.silent: set[int] = set()
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.byte_of[i] = i, value
            elif model.is_control(i):
                self.silent.add(i)
            elif not model.is_unknown(i) and not model.is_unused(i):
                self.rank[piece] = (-model.get_score(i), i)
        self._build_automaton()
        self.unknown = model.unk_id()
        self.letters = {p for p in self.rank if len(p) == 1}
        self.fits: dict[int, bool] = {}
        self.cuts: dict[str, tuple[int, str, str]] = {}

    def merges(self, text: str) -> list[str]:
        """Plain merging: the best ranked neighbouring pair first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, where = None, -1
            for i in range(len(parts) - 1):
                found = self.rank.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or found[0] < best):
                    best, where = found[0], i
            if best is None:
                break
            parts[where:where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def _build_automaton(self) -> None:
        """Trie of the pieces with failure links; every state lists the pieces that end there, longest first."""
        self.steps: list[dict[str, int]] = [{}]
        self.ending: list[tuple[tuple[int, int], ...]] = [()]
        for piece, (_, token) in self.rank.items():
            state = 0
            for char in piece:
                after = self.steps[state].get(char)
                if after is None:
                    after = self.steps[state][char] = len(self.steps)
                    self.steps.append({})
                    self.ending.append(())
                state = after
            self.ending[state] = ((token, len(piece)),)
        self.fallback = [0] * len(self.steps)
        level = list(self.steps[0].values())
        while level:
            below = []
            for state in level:
                self.ending[state] += self.ending[self.fallback[state]]
                for char, after in self.steps[state].items():
                    back = self.fallback[state]
                    while back and char not in self.steps[back]:
                        back = self.fallback[back]
                    self.fallback[after] = self.steps[back].get(char, 0)
                    below.append(after)
            level = below

    def _step(self, state: int, char: str) -> int:
        """The state behind ``char``, remembered in the table of steps."""
        back = self.fallback[state]
        while back and char not in self.steps[back]:
            back = self.fallback[back]
        after = self.steps[state][char] = self.steps[back].get(char, 0) if state else 0
        return after

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``; the start of a text is the id -1."""
        if len(self.fits) >= KNOWN_PAIRS:
            self.fits.clear()
        if left < 0:
            fit = len(self.merges(self.pieces[right])) == 1
        else:
            a, b = self.pieces[left], self.pieces[right]
            fit = self.merges(a + b) == [a, b]
        self.fits[left << 32 | right] = fit
        return fit

    def _table(self, text: str) -> list[int]:
        """Ids of a run of known characters."""
        last, state, end = [-1], 0, 0
        fits, steps, ending = self.fits, self.steps, self.ending
        for char in text:
            after = steps[state].get(char)
            state = self._step(state, char) if after is None else after
            end += 1
            for token, length in ending[state]:
                before = last[end - length]
                good = fits.get(before << 32 | token)
                if good or good is None and self.compatible(before, token):
                    last.append(token)
                    break
        ids, at, pieces = [], len(text), self.pieces
        while at:
            ids.append(last[at])
            at -= len(pieces[last[at]])
        return ids[::-1]

    def encode_cut(self, text: str) -> list[int]:
        if self.letters.issuperset(text):
            return self._table(text) if text else []
        ids, start = [], 0
        for i, char in enumerate(text):
            if char not in self.letters:
                if i > start:
                    ids += self._table(text[start:i])
                ids += [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]
                start = i + 1
        return ids + (self._table(text[start:]) if start < len(text) else [])

    def decode_run(self, ids: Iterable[int]) -> str:
        """Text of ids, marks as spaces; runs of byte pieces are read as UTF-8, broken ones as U+FFFD."""
        out, held = [], bytearray()
        for i in ids:
            value = self.byte_of.get(i)
            if value is not None:
                held.append(value)
                continue
            if held:
                out.append(_utf8(held))
                held.clear()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i not in self.silent:
                out.append(self.pieces[i].replace(MARK, " "))
        if held:
            out.append(_utf8(held))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the space mark that begins the first piece is the one encoding has put there."""
        text = self.decode_run(ids)
        return text[1:] if ids and self.pieces[ids[0]].startswith(MARK) else text

    def known(self, cut: str) -> tuple[int, str, str]:
        """(number of ids, ids as text, decoded text) of one cut, which begins with its space mark."""
        found = self.cuts.get(cut)
        if found is None:
            if len(self.cuts) >= KNOWN_CUTS:
                self.cuts.clear()
            ids = self.encode_cut(cut)
            found = len(ids), ",".join(map(str, ids)), self.decode_run(ids)
            if len(cut) <= 64:
                self.cuts[cut] = found
        return found

    def coded(self, text: str | None) -> list[tuple[int, str, str]]:
        """The cuts of a text, encoded, in order."""
        if not text:
            return []
        return [self.cuts.get(c) or self.known(c) for c in _cuts(text)]

    def fresh(self, text: str) -> list[int]:
        """Ids of a text, without the table of known cuts."""
        return [i for cut in _cuts(text) for i in self.encode_cut(cut)] if text else []

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for _, ids, _ in self.coded(text) for i in ids.split(",")]


def _utf8(raw: bytes) -> str:
    """UTF-8 text, each byte that belongs to no code point as U+FFFD."""
    out = []
    while raw:
        try:
            out.append(raw.decode("utf-8"))
            break
        except UnicodeDecodeError as error:
            out.append(raw[:error.start].decode("utf-8") + "\ufffd")
            raw = raw[error.start + 1:]
    return "".join(out)


_RUNS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def _cuts(text: str) -> list[str]:
    marked = MARK + text.replace(" ", MARK)
    return _RUNS.findall(marked)


def codec(path: str) -> PieceCodec:
    return worker_store(f"pieces {path}", lambda: PieceCodec(path))


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and ids of every text."""
    def run(columns):
        coder = codec(model)
        return {"doc_id": columns["doc_id"], "ids": [coder.encode(t) for t in columns["text"]]}

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>", rows=500)


def decode(coded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of every list of ids."""
    def run(columns):
        coder = codec(model)
        return {"doc_id": columns["doc_id"], "text": [coder.decode(ids or []) for ids in columns["ids"]]}

    return map_batches(coded.select("doc_id", "ids"), run, "doc_id long, text string", rows=500)


def coding_digests(docs: DataFrame, model: str) -> DataFrame:
    """Encode and decode every text in one pass and keep digests of both."""
    def run(columns):
        coder = codec(model)
        counts, ids_digest, text_digest = [], [], []
        for text in columns["text"]:
            coded = coder.coded(text)
            decoded = "".join([c[2] for c in coded])
            if decoded.startswith(" "):
                decoded = decoded[1:]
            counts.append(sum([c[0] for c in coded]))
            ids_digest.append(hashlib.sha256(",".join([c[1] for c in coded]).encode()).hexdigest())
            text_digest.append(hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())
        return {"doc_id": columns["doc_id"], "n_tokens": counts, "ids_sha256": ids_digest,
                "decoded_sha256": text_digest}

    return map_batches(
        docs.select("doc_id", "text"), run,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", rows=500)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the 32k piece model."""
    import public_tokenizers

    return coding_digests(table(spark, sf_dir, "documents"), str(public_tokenizers.path("piece_bpe_32k.model")))
