"""Burrows-Wheeler transform and common prefixes of many short strings, built column by column.

Each round puts one more symbol in front of the suffix every string has reached and inserts it at the
place the transform itself tells: behind all suffixes with a smaller first symbol, in the order of the
suffixes it extends. Transform and common prefixes live in two files that every round reads from front to
back in blocks and writes anew, so memory is bounded by a block and one entry per string.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 20
END = 0  # stands in front of the first symbol of a string; strings hold no zero bytes


def _range_minima(values: np.ndarray, start: np.ndarray, until: np.ndarray) -> np.ndarray:
    """Minimum of values[start:until] for many non-empty ranges, from a table of doubling widths."""
    width = until - start
    level = np.int64(np.log2(np.maximum(width, 1)))
    out = np.empty(len(start), values.dtype)
    table, size = values, 1
    for step in range(int(level.max(initial=0)) + 1):
        at = np.flatnonzero(level == step)
        if len(at):
            out[at] = np.minimum(table[start[at]], table[until[at] - size])
        if len(table) > size:
            table = np.minimum(table[:-size], table[size:])
        size *= 2
    return out


class Collection:
    """The transform of a growing set of suffixes, in files of one folder."""

    def __init__(self, folder: str, strings: list[bytes], cap: int):
        self.folder, self.cap, self.turn = folder, cap, 0
        self.lengths = np.array([len(s) for s in strings])
        self.ends = np.cumsum(self.lengths)
        self.text = np.frombuffer(b"".join(strings), np.uint8)
        symbols = self._symbols(np.zeros(len(strings), np.int64))
        self._write("bwt", symbols)
        self._write("lcp", np.zeros(len(strings), np.uint8))
        self.size = len(strings)
        self.at = np.arange(len(strings))
        self.active = np.flatnonzero(symbols != END)
        self.counts = np.bincount(symbols, minlength=256)

    def _path(self, name: str, turn: int) -> str:
        return os.path.join(self.folder, f"{name}-{turn % 2}")

    def _over(self, name: str, turn: int):
        """The file of a turn, to be written from its front; every turn writes more than the one before."""
        path = self._path(name, turn)
        return open(path, "r+b" if os.path.exists(path) else "wb")

    def _write(self, name: str, values: np.ndarray) -> None:
        with self._over(name, self.turn) as file:
            values.tofile(file)

    def _blocks(self, name: str) -> Iterator[tuple[int, np.ndarray]]:
        with open(self._path(name, self.turn), "rb") as file:
            offset = 0
            while len(block := np.fromfile(file, np.uint8, BLOCK)):
                yield offset, block
                offset += len(block)

    def _symbols(self, taken: np.ndarray, which: np.ndarray | None = None) -> np.ndarray:
        """The symbol in front of the last ``taken`` symbols of strings; END where there is none."""
        which = np.arange(len(self.lengths)) if which is None else which
        left = taken < self.lengths[which]
        out = np.zeros(len(which), np.uint8)
        out[left] = self.text[self.ends[which[left]] - taken[left] - 1]
        return out

    def grow(self, taken: int) -> bool:
        """Insert the suffix of length ``taken`` of every string that has one; False when none has."""
        if not len(self.active):
            return False
        order = np.argsort(self.at[self.active])
        strings, places = self.active[order], self.at[self.active][order]
        firsts = self.counts.copy()
        firsts[END] = len(self.lengths)
        starts = np.concatenate(([0], np.cumsum(firsts)))[:256]  # first place of each first symbol
        seen = np.zeros(256, np.int64)
        carry = np.full(256, 255, np.int64)  # smallest common prefix since the last occurrence
        recent = np.zeros(256, bool)  # whether that occurrence is inserted now
        target = np.zeros(len(strings), np.int64)
        changed, prefixes = [], []
        for (offset, bwt), (_, lcp) in zip(self._blocks("bwt"), self._blocks("lcp"), strict=True):
            lo, hi = np.searchsorted(places, (offset, offset + len(bwt)))
            fresh = np.zeros(len(bwt), bool)
            fresh[places[lo:hi] - offset] = True
            by_symbol = np.argsort(bwt, kind="stable")
            here = np.bincount(bwt, minlength=256)
            edges = np.concatenate(([0], np.cumsum(here)))
            shift = starts + seen - edges[:256]  # from a rank by symbol to the place of the longer suffix
            now = np.flatnonzero(fresh[by_symbol])
            symbol = bwt[by_symbol[now]].astype(np.int64)
            target[lo:hi] = (now + shift[symbol])[np.argsort(by_symbol[now])]
            # neighbouring occurrences of a symbol, one of them inserted now
            second = np.union1d(now, now + 1)
            second = second[second < len(bwt)]
            symbol = bwt[by_symbol[second]].astype(np.int64)
            inside = (second != edges[symbol]) & (symbol != END)
            second, symbol = second[inside], symbol[inside]
            if len(second):
                least = _range_minima(lcp, by_symbol[second - 1] + 1, by_symbol[second] + 1)
                changed.append(second + shift[symbol])
                prefixes.append(np.minimum(least.astype(np.int64) + 1, self.cap))
            # the first occurrence in this block pairs with the last one of an earlier block
            present = np.flatnonzero(here[1:]) + 1
            first = edges[present]
            least = _range_minima(lcp, np.zeros(len(present), np.int64), by_symbol[first] + 1).astype(np.int64)
            old = seen[present] > 0
            touched = fresh[by_symbol[first]] | (recent[present] & old)
            value = np.where(old, np.minimum(np.minimum(carry[present], least) + 1, self.cap), 0)
            changed.append((first + shift[present])[touched])
            prefixes.append(value[touched])
            # what is carried into the next block
            last = edges[present + 1] - 1
            tail = by_symbol[last] + 1
            rest = np.full(len(present), 255, np.int64)
            some = tail < len(lcp)
            rest[some] = _range_minima(lcp, tail[some], np.full(int(some.sum()), len(lcp)))
            absent = np.ones(256, bool)
            absent[present] = False
            carry[absent] = np.minimum(carry[absent], int(lcp.min()))
            carry[present] = rest
            recent[present] = fresh[by_symbol[last]]
            seen += here
        self._insert(strings, target, taken, np.concatenate(changed), np.concatenate(prefixes))
        return True

    def _insert(self, strings, target, taken, changed, prefixes) -> None:
        symbols = self._symbols(np.full(len(strings), taken), strings)
        order = np.argsort(target)
        places, added = target[order], symbols[order]
        order = np.argsort(changed)
        changed, prefixes = changed[order], prefixes[order].astype(np.uint8)
        with open(self._path("bwt", self.turn), "rb") as bwt_in, open(self._path("lcp", self.turn), "rb") as lcp_in, \
                self._over("bwt", self.turn + 1) as bwt_out, self._over("lcp", self.turn + 1) as lcp_out:
            size = self.size + len(places)
            for offset in range(0, size, BLOCK):
                many = min(BLOCK, size - offset)
                lo, hi = np.searchsorted(places, (offset, offset + many))
                kept = np.ones(many, bool)
                kept[places[lo:hi] - offset] = False
                bwt, lcp = np.empty(many, np.uint8), np.zeros(many, np.uint8)
                bwt[places[lo:hi] - offset] = added[lo:hi]
                bwt[kept] = np.fromfile(bwt_in, np.uint8, many - (hi - lo))
                lcp[kept] = np.fromfile(lcp_in, np.uint8, many - (hi - lo))
                lo, hi = np.searchsorted(changed, (offset, offset + many))
                lcp[changed[lo:hi] - offset] = prefixes[lo:hi]
                bwt.tofile(bwt_out)
                lcp.tofile(lcp_out)
        self.turn += 1
        self.size = size
        self.at[strings] = target
        self.counts += np.bincount(symbols, minlength=256)
        self.active = strings[symbols != END]

    def walk(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each suffix length from 1: (length, strings that have it, class of the suffix).

        Suffixes are in one class when they share ``cap`` symbols or more with their neighbours in order.
        """
        bwt = np.fromfile(self._path("bwt", self.turn), np.uint8)
        lcp = np.fromfile(self._path("lcp", self.turn), np.uint8)
        kind = np.cumsum(lcp < self.cap, dtype=np.int32)
        firsts = np.bincount(bwt, minlength=256)
        firsts[END] = len(self.lengths)
        starts = np.concatenate(([0], np.cumsum(firsts)))[:256]
        by_symbol = np.argsort(bwt, kind="stable").astype(np.int32)
        edges = np.concatenate(([0], np.cumsum(np.bincount(bwt, minlength=256))))
        step = np.empty(len(bwt), np.int32)
        symbol = bwt[by_symbol].astype(np.int64)
        step[by_symbol] = starts[symbol] + np.arange(len(bwt)) - edges[symbol]
        strings, at = np.arange(len(self.lengths)), np.arange(len(self.lengths))
        for length in range(1, int(self.lengths.max(initial=0)) + 1):
            more = self.lengths[strings] >= length
            strings, at = strings[more], step[at[more]]
            yield length, strings, kind[at]


def equal_windows(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, class) of every window of ``width`` bytes; equal windows have equal classes."""
    strings = [s.replace(b"\x00", b"\xff") for s in strings]  # UTF-8 holds no 0xff
    with tempfile.TemporaryDirectory() as folder:
        collection = Collection(folder, strings, width)
        taken = 1
        while collection.grow(taken):
            taken += 1
        found = [(s, collection.lengths[s] - n, c) for n, s, c in collection.walk() if n >= width]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))
