r"""Spelling variants of a corpus's words by composing automata (operator 12).

Two words are near when one inserted, deleted or replaced code point turns one into the other. All near pairs
are the accepted pairs of acceptor o one-edit transducer o acceptor, where the acceptor is the minimised
automaton of the vocabulary. The composed machine is dealt by its initial state: for words of one length and
the words one longer, the state that the first half of the word leads to. An edit behind that half is found
there; an edit inside the first half leaves the second one whole, and is found by the same machine over the
reversed words, dealt by the second half. So a word takes part in four partitions at most, each holds the words
of one length that share a half, and every pair is accepted once.

A word's form is its near word with the most occurrences (ties: the smallest in code-point order), if that has
at least ``ratio`` times the word's own; its root is the end of the chain of forms.

Defined results: a null or empty text has no words; a null id counts as empty text; repeated rows count each;
runs of any length are one word; a word without near words has ``n_near`` 0, no form, and is its own root; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from opinionmill.llm.common import table
from opinionmill.session import materialized

SHORTEST = 7  # code points of a word
LEAST = 2  # occurrences of a word
RATIO = 10  # occurrences of a form to those of its variant
HELD = 300_000  # words a task holds before it passes their counts on
MAX_ROUNDS = 8  # doublings of a chain of forms; each link multiplies a 64-bit count by ``ratio``
FINAL = 0


def corpus_words(docs: DataFrame, shortest: int = SHORTEST, dropped: int = 31) -> DataFrame:
    """(word, n) over whole texts, words of ``shortest`` code points and more.

    Words are runs of letters with A-Z in lower case. Where ``dropped`` divides h, the crc32 of ``id:word``, the
    word loses its code point h modulo its length; 0 drops none.
    """
    wanted = T.StructType.fromDDL("word string, n long")
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % shortest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, held = to_arrow_schema(wanted), Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], schema=schema)
            held.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                lowered = text.as_py().encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                before = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(runs.findall(lowered)).items():
                    if dropped:
                        h = zlib.crc32(word.encode(), before)
                        if h % dropped == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < shortest:
                                continue
                    held[word] += n
                if len(held) >= HELD:
                    yield flush()
        if held:
            yield flush()

    return (
        docs.select("doc_id", "text").mapInArrow(run, wanted)
        .groupBy("word").agg(F.sum("n").alias("n"))
    )


class Acceptor:
    """Minimised acyclic automata over one register, so equal states accept the same strings."""

    def __init__(self) -> None:
        self.steps: list[dict[str, int]] = [{}]
        self.strings = [1]  # accepted from a state
        self.register: dict[tuple, int] = {}

    def _state(self, arcs: list[tuple[str, int]]) -> int:
        key = tuple(arcs)
        state = self.register.get(key)
        if state is None:
            state = self.register[key] = len(self.steps)
            self.steps.append(dict(arcs))
            self.strings.append(sum(self.strings[t] for _, t in arcs))
        return state

    def build(self, words: list[str]) -> int | None:
        """The start state of an automaton of sorted, different words of one length; None for no words."""
        if not words:
            return None
        size, before = len(words[0]), None
        path: list[list] = [[] for _ in range(size + 1)]  # arcs of the states along the word before

        def close(depth: int) -> None:
            """Register the states of the word before that lie deeper than ``depth``."""
            for at in range(size, depth, -1):
                state = self._state(path[at]) if at < size else FINAL
                path[at - 1].append((before[at - 1], state))
                path[at] = []

        for word in words:
            if before is not None:
                shared = 0
                while word[shared] == before[shared]:
                    shared += 1
                close(shared)
            before = word
        close(0)
        return self._state(path[0]) if size else FINAL

    def common(self, left: int, right: int) -> Iterator[str]:
        """The strings that both states accept."""
        stack = [(left, right, "")]
        while stack:
            p, q, read = stack.pop()
            if p == FINAL:
                yield read
                continue
            arcs, other = self.steps[p], self.steps[q]
            for symbol, after in arcs.items():
                beside = other.get(symbol)
                if beside is not None:
                    stack.append((after, beside, read + symbol))

    def one_edit(self, words: list[str], longer: list[str]) -> Iterator[tuple[str, str]]:
        """Pairs that the composition accepts: two of ``words`` that differ in one symbol, or one of ``words``
        and one of ``longer`` that has one symbol more. Both lists are sorted, without repeats, of one length."""
        start, beside = self.build(words), self.build(longer)
        if start is None:
            return
        stack = [(start, beside, "")]  # reached without an edit: state among words, among longer, string read
        while stack:
            state, wide, read = stack.pop()
            arcs = self.steps[state]
            if self.strings[state] > 1:
                symbols = list(arcs)
                for i, a in enumerate(symbols):
                    for b in symbols[i + 1:]:
                        for rest in self.common(arcs[a], arcs[b]):
                            yield read + a + rest, read + b + rest
            elif wide is None:
                continue
            wider = {} if wide is None else self.steps[wide]
            for b, after in wider.items():
                for rest in self.common(state, after):
                    if not rest.startswith(b):  # of a run of equal symbols the last one counts as inserted
                        yield read + rest, read + b + rest
            for a, after in arcs.items():
                stack.append((after, wider.get(a), read + a))


def partitions(words: DataFrame, shortest: int) -> DataFrame:
    """Rows (part, head, rest, n, longer): the initial states a word takes part in, and what it reads from there.

    ``head`` tells the forward machine, where ``part`` names the first half of the word, from the reversed one.
    """
    size = F.length("word")
    classes = F.explode(F.when(size > shortest, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = words.select("word", "n", size.alias("size"), classes.alias("longer"))
    rows = rows.withColumn("half", F.floor((F.col("size") - F.col("longer")) / 2).cast("int"))
    rows = rows.withColumn("back", F.col("size") - F.col("longer") - F.col("half"))  # symbols of the second half
    sides = F.explode(F.array(F.lit(True), F.lit(False))).alias("head")
    rows = rows.select("*", sides)
    first, second = F.expr("left(word, half)"), F.expr("right(word, back)")
    name = F.when(F.col("head"), first).otherwise(second)
    rest = F.when(F.col("head"), F.expr("substr(word, half + 1)")).otherwise(
        F.reverse(F.expr("left(word, size - back)")))
    return rows.select(
        F.concat((F.col("size") - F.col("longer")).cast("string"), F.when(F.col("head"), ">").otherwise("<"), name).alias("part"),
        "head", name.alias("shared"), rest.alias("rest"), "half", "n", (F.col("longer") == 1).alias("longer"))


def near_pairs(words: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(word, near, near_n) for all words (word, n), different and of ``shortest`` code points at least, in both directions."""
    wanted = T.StructType.fromDDL("word string, near string, near_n long")
    rows = partitions(words, shortest)
    several = rows.groupBy("part").agg(
        F.count(F.lit(1)).alias("m"), F.min("longer").alias("all_longer")).where("m > 1 AND NOT all_longer").select("part")
    dealt = rows.join(several, "part", "left_semi").repartition("part").sortWithinPartitions("part", "rest")

    def accepted(group: list[tuple]) -> Iterator[tuple[str, str, int]]:
        _, head, shared, _, half, _, _ = group[0]
        n = {row[3]: row[5] for row in group}
        machine = Acceptor()
        pairs = machine.one_edit([r[3] for r in group if not r[6]], [r[3] for r in group if r[6]])
        for left, right in pairs:
            if head:
                x, y = shared + left, shared + right
            else:
                x, y = left[::-1] + shared, right[::-1] + shared
                if x[:half] == y[:half]:
                    continue  # the forward machine accepts this pair
            yield x, y, n[right]
            yield y, x, n[left]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, group, out = to_arrow_schema(wanted), [], []

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out.clear()
            return batch

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[0] != group[0][0]:
                    for pair in accepted(group):
                        out.append(pair)
                        if len(out) >= 50_000:
                            yield flush()
                    group = []
                group.append(row)
        for pair in accepted(group) if group else ():
            out.append(pair)
            if len(out) >= 50_000:
                yield flush()
        if out:
            yield flush()

    return dealt.mapInArrow(run, wanted)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word of each chain, by doubling the links."""
    spark = forms.sparkSession
    links = materialized(spark, forms.select("word", "form"), "forms")
    for _ in range(MAX_ROUNDS):
        onward = links.select(F.col("word").alias("of"), F.col("form").alias("next"))
        moved = links.join(onward, F.col("form") == F.col("of"), "left")
        moved = materialized(spark, moved.select("word", F.coalesce("next", "form").alias("form"), F.col("next").isNotNull().alias("went")), "forms")
        links = moved.select("word", "form")
        if moved.where("went").isEmpty():
            return links.select("word", F.col("form").alias("root"))
    raise RuntimeError(f"forms are chained beyond {2 ** MAX_ROUNDS} words")


def variant_groups(words: DataFrame, shortest: int = SHORTEST, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word (word, n)."""
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    near = near_pairs(words, shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    enough = -F.col("best.less") >= ratio * F.col("n")
    spark = words.sparkSession
    named = materialized(spark, words.join(near, "word").select(
        "word", "n_near",
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")), "near-words")
    ends = roots(named.where("form IS NOT NULL"))
    return (
        words.join(named, "word", "left").join(ends, "word", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n",
                F.coalesce("root", "word").alias("root"))
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, as the planted slips leave them, with their near words, forms and roots."""
    words = corpus_words(table(spark, sf_dir, "documents")).where(F.col("n") >= LEAST)
    return variant_groups(materialized(spark, words, "words"))
