"""All whole-word hits of many names in one scan of a text.

An automaton over the folded names reports every name that ends at a place, so the cost of a scan does not grow
with the number of names. Case is folded code point by code point, so places in the folded text are places in the
text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ROWS = 256  # texts held as Python strings at once


class _Folded(dict):
    """Code point to its folded form, where that is a single code point."""

    def __missing__(self, code: int) -> int:
        char = chr(code)
        upper = char.upper()
        lower = (upper if len(upper) == 1 else char).lower()
        self[code] = out = ord(lower) if len(lower) == 1 else code
        return out


class _WordChars(dict):
    """Whether a character belongs to words: letters, marks, digits, connectors and joiners."""

    def __missing__(self, char: str) -> bool:
        kind = unicodedata.category(char)
        self[char] = out = char.isalpha() or kind in ("Mn", "Mc", "Me", "Nd", "Nl", "Pc") or char in "\u200c\u200d"
        return out


class Names:
    """An automaton over names; a name may carry one of ``endings`` behind it."""

    def __init__(self, names: Sequence[str], endings: Sequence[str] = ("",)):
        import ahocorasick

        self.folded, self.words = _Folded(), _WordChars()
        self.automaton = ahocorasick.Automaton()
        forms: dict[str, list[tuple[int, int, int]]] = {}
        for number, name in enumerate(names):
            for rank, ending in enumerate(endings):
                form = (name + ending).translate(self.folded)
                forms.setdefault(form, []).append((number, rank, len(form)))
        for form, found in forms.items():
            if form:
                self.automaton.add_word(form, found)
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, int, int]]:
        """(number of the name, start, rank of the ending, end) of all whole-word hits, overlapping ones as well."""
        if not len(self.automaton):
            return []
        folded = text.lower() if text.isascii() else text.translate(self.folded)
        out, words = [], self.words
        for last, found in self.automaton.iter(folded):
            end = last + 1
            inside = words[folded[last]]
            if (end < len(folded) and words[folded[end]]) == inside:
                continue  # no word border behind it
            for number, rank, size in found:
                start = end - size
                if (start > 0 and words[folded[start - 1]]) != words[folded[start]]:
                    out.append((number, start, rank, end))
        return out

    def chosen(self, text: str) -> list[tuple[int, int, int]]:
        """(number, start, end) without overlaps: earlier names first, of one name the leftmost, in that order."""
        hits = sorted(self.hits(text))
        out, taken = [], bytearray(len(text) if len(hits) > 1 else 0)
        for number, start, _, end in hits:
            if len(hits) == 1 or 1 not in taken[start:end]:
                if taken:
                    taken[start:end] = b"\x01" * (end - start)
                out.append((number, start, end))
        return out


def with_placeholders(df: DataFrame, text: str, names: Sequence[str], endings: Sequence[str], out_text: str, out_names: str) -> DataFrame:
    """Add the text with ``PRD{n}X`` in place of the chosen hits, numbered in their order, and what stood there."""
    place = df.columns.index(text)
    kept = [f for f in df.schema.fields if f.name not in (out_text, out_names)]
    wanted = T.StructType([*kept, T.StructField(out_text, T.StringType()), T.StructField(out_names, T.ArrayType(T.StringType()))])
    places = [df.columns.index(f.name) for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, machine = to_arrow_schema(wanted), Names(names, endings)
        for whole in batches:
            for start_row in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start_row, ROWS)
                texts, lists = [], []
                for value in batch.column(place).to_pylist():
                    found = machine.chosen(value) if value else []
                    lists.append([value[a:b] for _, a, b in found])
                    parts, at = [], 0
                    for start, end, n in sorted((a, b, n) for n, (_, a, b) in enumerate(found)):
                        parts += [value[at:start], f"PRD{n}X"]
                        at = end
                    texts.append("".join([*parts, value[at:]]) if found else value)
                columns = [batch.column(i) for i in places] + [pa.array(texts, pa.string()), pa.array(lists, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return df.mapInArrow(run, wanted)



def plain_words(pattern: str) -> list[str] | None:
    r"""The words of a pattern ``\b(?:one|two three)\b``; None for any other pattern."""
    found = re.fullmatch(r"\\b\(\?:([\w ]+(?:\|[\w ]+)*)\)\\b", pattern)
    return found[1].split("|") if found else None
