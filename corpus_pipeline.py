"""From raw documents to packed training sequences.

Every stage is a function (spark, docs, sf_dir) of the documents its predecessor kept; its result is written
as Parquet and read again before the next one is called. All but the last return the columns of documents.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionmill.llm import minhash, packing, secrets, substrings, toxicity
from opinionmill.llm.common import table
from opinionmill.session import Scratch, materialized

# Working tables of stages that are called one by one, by the folder they belong to.
_left: dict[str, Scratch] = {}


def _stage(function):
    """A stage whose working tables can be removed.

    ``run`` gives each stage a scratch of its own. Where the stages are called one by one, a stage first
    removes what the stage before it worked with over the same folder: its result is written by then.
    """
    @functools.wraps(function)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
        if scratch is None:
            if sf_dir in _left:
                _left[sf_dir].remove(spark)
            scratch = _left[sf_dir] = Scratch()
        with scratch:
            return function(spark, docs, sf_dir)

    return call


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` again, where a stage has changed texts."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that maximum-scoring segments call toxic go; the others stay as they are."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return minhash.keep_one(docs)


@_stage
def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes that occur earlier are cut out of the texts."""
    return _counted(substrings.texts_without_repeats(docs))


@_stage
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; documents without any stay as they are."""
    return _counted(secrets.redacted(docs, F.col("source"), F.concat_ws("/", "source", "lang")))


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of at most 2048 ids."""
    import public_tokenizers

    cut = packing.pieces(docs, str(public_tokenizers.path("byte_bpe_50k.json")))
    return packing.pack(materialized(spark, cut, "pieces"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", drop_repeated_passages),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

# Near-duplicate classes and repeated passages cannot be expressed in SQL over whole tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder.

    Every run has tables of its own; those of a stage go once its result is written, and that result once the
    next one is. What the last stage reads stays until ``run``'s caller clears ``spark.checkpoint.dir``.
    """
    docs, before = table(spark, sf_dir, "documents"), Scratch()
    for name, stage in STAGES[:-1]:
        working, kept = Scratch(), Scratch()
        made = stage(spark, docs, sf_dir, working)
        with kept:
            docs = materialized(spark, made, f"stage-{name}")
        working.remove(spark)
        before.remove(spark)
        before = kept
    return STAGES[-1][1](spark, docs, sf_dir, Scratch())
