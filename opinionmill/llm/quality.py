r"""Quality rules: learned decision lists over text statistics (operator 2).

Sequential covering grows one conjunction of thresholds at a time on two thirds of the labelled
statistics, condition by condition with the largest information gain, prunes it on the last third and
keeps it while it is right more often than not. The list is emitted as one ordered Spark conditional
expression over the statistics, so applying it needs neither Python nor a shuffle.

The fit reads at most ``fit_rows`` labelled rows, those with the smallest digest of the id, with at most
``max_cuts`` thresholds tried per statistic; a list has at most ``MAX_RULES`` rules of ``MAX_CONDITIONS`` conditions.
Statistics and verdicts cover every document and whole texts, however long; ties go to the rule that comes first.

Defined results: a null text is a text without words; repeated rows give equal rows; a null or missing
label is not learned from and repeated label rows count once, bad if any of them is; without labels of
both kinds the list is empty and keeps everything; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionmill.llm.common import map_batches, table
from opinionmill.session import materialized

FIT_ROWS = 20_000
MAX_RULES = 12
MAX_CONDITIONS = 4
MAX_CUTS = 64
WINDOW = 8  # words

# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Statistics the rules may use: shares, so that a rule reads the same for any length.
RATIOS = [
    "mean_word", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "mark_share",
    "distinct_share", "longest_run_share", "bar_share", "short_line_share",
]
STATISTICS = "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", " + ", ".join(f"{c} double" for c in RATIOS)

_UPPER = re.compile(r"[^\W\d_]")
_KEEP_SYMBOLS = {ord(c): None for c in SYMBOLS}


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more; ids tell equal words.

    Windows get exact ranks by doubling: a rank of two halves is the pair of their ranks.
    """
    if len(ids) < window + 1:
        return 0
    rank, width = ids.astype(np.int64), 1
    while width < window:
        pair = rank[:-width] * (int(rank.max()) + 1) + rank[width:]
        _, rank = np.unique(pair, return_inverse=True)
        width *= 2
    often = np.bincount(rank)[rank] > 1
    if not often.any():
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(often)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def text_statistics(text: str | None) -> list[float]:
    """BASE and RATIOS of one text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = sum(map(len, words)) - sum(map(_continuations, words)) if not raw.isascii() else sum(map(len, words))
    symbols = len(text) - len(text.translate(_KEEP_SYMBOLS)) if any(c in text for c in SYMBOLS) else 0
    lines = [line for line in raw.split(b"\n") if line.split()]
    duplicates = len(lines) - len(set(lines))
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    repeats = repeated_words(ids)
    upper = sum(map(str.isupper, text))
    digits = sum(map(str.isdigit, text))
    if n:
        breaks = np.flatnonzero(np.diff(ids)) + 1
        edges = np.concatenate(([0], breaks, [n]))
        run = int(np.diff(edges).max())
    else:
        run = 0
    ratios = [
        chars / max(n, 1), symbols / max(chars, 1), duplicates / max(len(lines), 1), repeats / max(n, 1),
        upper / max(chars, 1), digits / max(chars, 1), text.count("!") / max(n, 1), len(number) / max(n, 1),
        run / max(n, 1), text.count("|") / max(n, 1), sum(len(x.split()) < 4 for x in lines) / max(len(lines), 1),
    ]
    return [n, chars, symbols, duplicates, repeats, *ratios]


def _continuations(word: bytes) -> int:
    """UTF-8 bytes that begin no code point."""
    return 0 if word.isascii() else len(word) - len(word.decode("utf-8", "surrogatepass"))


def statistics(docs: DataFrame) -> DataFrame:
    def run(columns):
        rows = [text_statistics(t) for t in columns["text"]]
        out: dict[str, object] = {"doc_id": columns["doc_id"]}
        for i, name in enumerate(BASE):
            out[name] = [int(r[i]) for r in rows]
        for i, name in enumerate(RATIOS, len(BASE)):
            out[name] = [float(r[i]) for r in rows]
        return out

    return map_batches(docs.select("doc_id", "text"), run, STATISTICS, rows=1000)


Condition = tuple[str, str, float]
Rule = list[Condition]


def covers(rule: Rule, data: dict[str, np.ndarray], size: int) -> np.ndarray:
    hit = np.ones(size, bool)
    for name, sign, cut in rule:
        hit &= data[name] <= cut if sign == "<=" else data[name] >= cut
    return hit


def _best_condition(data, bad, hit, cuts) -> tuple[Condition | None, float]:
    """The condition with the largest information gain on the rows a rule covers so far."""
    p0, n0 = int((bad & hit).sum()), int((~bad & hit).sum())
    before = np.log2(p0 / (p0 + n0))
    best, gain = None, 1e-9
    good_bad, good_ok = bad[hit], ~bad[hit]
    for name, values in cuts.items():
        column = data[name][hit]
        order = np.argsort(column, kind="stable")
        ranked = column[order]
        p_cum = np.concatenate(([0], np.cumsum(good_bad[order])))
        n_cum = np.concatenate(([0], np.cumsum(good_ok[order])))
        for sign in ("<=", ">="):
            if sign == "<=":
                at = np.searchsorted(ranked, values, side="right")
                p, n = p_cum[at], n_cum[at]
            else:
                at = np.searchsorted(ranked, values, side="left")
                p, n = p0 - p_cum[at], n0 - n_cum[at]
            with np.errstate(divide="ignore", invalid="ignore"):
                scores = np.where(p > 0, p * (np.log2(p / (p + n)) - before), -1.0)
            top = int(np.argmax(scores))
            if scores[top] > gain:
                best, gain = (name, sign, float(values[top])), float(scores[top])
    return best, gain


def learn(data: dict[str, np.ndarray], bad: np.ndarray, part: np.ndarray,
          max_rules: int = MAX_RULES, max_conditions: int = MAX_CONDITIONS, max_cuts: int = MAX_CUTS) -> list[Rule]:
    """An ordered list of conjunctions that mark bad rows. ``part`` 2 of 0..2 prunes, the others grow."""
    rules: list[Rule] = []
    open_ = np.ones(len(bad), bool)
    cuts = {n: np.unique(np.quantile(v, np.linspace(0, 1, max_cuts))) for n, v in data.items()} if len(bad) else {}
    while len(rules) < max_rules:
        grow, prune = open_ & (part != 2), open_ & (part == 2)
        if (bad & grow).sum() < 3 or (bad & prune).sum() < 1 or not (~bad & grow).any():
            break
        rule: Rule = []
        hit = grow.copy()
        while len(rule) < max_conditions and (~bad & hit).any():
            condition, _ = _best_condition(data, bad, hit, cuts)
            if condition is None:
                break
            rule.append(condition)
            hit = grow & covers(rule, data, len(bad))

        def worth(candidate: Rule) -> float:
            on = prune & covers(candidate, data, len(bad))
            p, n = int((bad & on).sum()), int((~bad & on).sum())
            return (p - n) / (p + n) if p + n else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        if not rule or worth(rule) <= 0:
            break
        rules.append(rule)
        open_ &= ~covers(rule, data, len(bad))
    return rules


def rule_number(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1; null where none does."""
    chain = None
    for number, rule in enumerate(rules, 1):
        holds = F.lit(True)
        for name, sign, cut in rule:
            holds = holds & (F.col(name) <= cut if sign == "<=" else F.col(name) >= cut)
        chain = F.when(holds, number) if chain is None else chain.when(holds, number)
    return F.lit(None).cast("int") if chain is None else chain.cast("int")


def fit(stats: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> list[Rule]:
    """Rules from at most ``fit_rows`` labelled rows of statistics; quality 0 is bad."""
    known = (
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    )
    names = [*RATIOS, "n_words"]
    rows = (
        stats.join(known, "doc_id").select(*names, "quality", F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("part"))
        .toPandas()
    )
    data = {n: rows[n].to_numpy(float) for n in names}
    return learn(data, rows["quality"].to_numpy() == 0, rows["part"].to_numpy())


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Statistics with base_failed, the first rule that holds, and kept."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (
        stats.withColumn("base_failed", failed).withColumn("rule", rule_number(rules))
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document, with rules learned from the quality labels."""
    stats = materialized(spark, statistics(table(spark, sf_dir, "documents")), "quality-statistics")
    rules = fit(stats, table(spark, sf_dir, "labels"))
    return judge(stats, rules).select("doc_id", *BASE, "base_failed", "kept", "rule")
