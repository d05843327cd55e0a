"""Plain versions of the operators, for small inputs."""

import hashlib
import itertools
import re
from collections import Counter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def shingles(text, width):
    w = words(text)
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def near_components(texts, width, percent=80):
    """{id: smallest id reachable} over (id, text) pairs; ids may repeat."""
    sets = [(i, shingles(t, width)) for i, t in texts]
    parent = {i: i for i, _ in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = sorted((find(i), find(j)))
            parent[y] = x
    return {i: find(i) for i in parent}


def without_repeats(texts, width=100):
    """{id: (bytes, removed, spans, digest, kept)} in order of ids; a repeated row is the same document."""
    seen, out = {}, {}
    for i, text in sorted(texts, key=lambda x: x[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - width + 1):
            window = raw[p:p + width]
            if seen.setdefault(window, (i, p)) != (i, p):
                gone[p:p + width] = b"\x01" * width
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


def quality_base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    marked = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i:i + 8])] > 1:
            marked.update(range(i, i + 8))
    seen, duplicates = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, duplicates, len(marked)
