"""Term tables, TF-IDF and the savable feature stages.

The long form has one row per (document, term). Vocabularies are capped at ``max_features`` by
definition, so the joins that apply them may broadcast; nothing else here is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, RegexTokenizer, SQLTransformer,
    StopWordsRemover,
)
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from opinionmill.functions.tokens import (
    default_stop_words, uni_and_bigrams, without_stop_words, word_tokens,
)
from opinionmill.operators.hashed_terms import frequent_terms
from opinionmill.operators.ranking import first_rows
from opinionmill.operators.vector_blocks import stored_vectors
from opinionmill.session import materialized, scratch_path

# Feature limits of the sentiment models and the cluster profiles.
SENTIMENT_FEATURES = 5000
PROFILE_FEATURES = 2000

# Counters of the sketch that names the candidates of a vocabulary.
TRACKED = 1 << 18

# Text blocks of a product with their feature limit and weight.
PRODUCT_BLOCKS = {
    "title": ("product_name", 1000, 4.0),
    "category": ("categories_text", 500, 1.0),
    "review": ("review_document", 4000, 0.25),
}


def term_counts(df: DataFrame, keys: Sequence[str], tokens: Column, one_row_per_key: bool = False) -> DataFrame:
    """Term frequency per document: keys, term, tf.

    With one row per document the terms are counted inside the row, as runs of the sorted tokens, and nothing is
    shuffled. Leave it off where a key collects many rows, such as a cluster.
    """
    if not one_row_per_key:
        return df.select(*keys, F.explode(tokens).alias("term")).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))
    rows = df.select(*keys, F.sort_array(tokens).alias("_sorted"))
    following = F.slice("_sorted", F.lit(2), F.greatest(F.size("_sorted"), F.lit(0)))
    last = F.zip_with("_sorted", following, lambda a, b: ~a.eqNullSafe(b))  # of its run
    ends = F.filter(F.transform(last, lambda is_last, i: F.when(is_last, i + 1)), lambda i: i.isNotNull())
    rows = rows.select(*keys, "_sorted", ends.alias("_ends"))
    before = F.slice(F.concat(F.array(F.lit(0)), "_ends"), F.lit(1), F.greatest(F.size("_ends"), F.lit(0)))
    counted = F.zip_with("_ends", before, lambda end, begin: F.struct(
        F.element_at("_sorted", end).alias("term"), (end - begin).cast("long").alias("tf")))
    return rows.select(*keys, F.inline(counted))


def vocabulary(df: DataFrame, tokens: Column, max_features: int) -> DataFrame:
    """The most frequent terms over all rows, ties by name: term, corpus_tf, df."""
    return _ranked(_all_terms(df.select(tokens.alias("_terms"))), max_features)


def vocabulary_by_sketch(df: DataFrame, tokens: Column, max_features: int, tracked: int = TRACKED) -> DataFrame:
    """The same table where the different terms are too many to be shuffled.

    A frequent-items sketch per task, merged, names the candidates; a second pass counts these exactly, so only
    candidates are shuffled. A term that is no candidate cannot occur more often than the sketch's error bound
    or the last candidate's estimate. Where the last wanted term does not exceed both, all terms are counted.
    """
    rows = df.select(tokens.alias("_terms"))
    wanted = min(2 * max_features + 100, tracked)
    sketch = rows.select(F.explode("_terms").alias("term")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(term, {wanted}, {tracked})").alias("top")).first()
    top = sketch["top"] or []
    if not top:
        return _ranked(_all_terms(rows), max_features)
    # a sketch of m counters is off by 3.5 / m of all occurrences at most; unlisted terms are estimated no higher than the last
    bound = max(3.5 * sketch["n"] / tracked, float(top[-1]["count"]) if len(top) == wanted else 0.0)
    names = df.sparkSession.createDataFrame([(t["item"],) for t in top], "term string")  # at most ``wanted`` rows
    found = materialized(df.sparkSession, _ranked(_all_terms(rows, names), max_features), "vocabulary")
    least = found.agg(F.count(F.lit(1)).alias("many"), F.min("corpus_tf").alias("least")).first()
    if least["many"] == max_features and least["least"] > bound:
        return found
    return _ranked(_all_terms(rows), max_features)


def _all_terms(rows: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """term, corpus_tf, df of all terms, or of ``names`` only: a row's terms are counted inside it first."""
    counted = term_counts(rows, [], F.col("_terms"), one_row_per_key=True)
    if names is not None:
        counted = counted.join(F.broadcast(names), "term")
    return counted.groupBy("term").agg(F.sum("tf").alias("corpus_tf"), F.count(F.lit(1)).alias("df"))


def _ranked(counts: DataFrame, max_features: int) -> DataFrame:
    return counts.orderBy(F.desc("corpus_tf"), F.asc("term")).limit(max_features)


def text_list(values: Sequence[str]) -> Column:
    """A constant array of terms, which hold no control characters, from one literal."""
    return F.split(F.lit("\u0001".join(values)), "\u0001")


def number_list(values: Sequence[float]) -> Column:
    """A constant array of numbers from one literal."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def tfidf(df: DataFrame, keys: Sequence[str], tokens: Column, max_features: int, sublinear: bool = False) -> DataFrame:
    """Smoothed, length-normalised TF-IDF in long form: keys, term, weight.

    One grouped pass over the terms gives the vocabulary, at most ``max_features`` rows on the driver. The counts
    of each document are the sparse vector of a fitted vocabulary stage, written in its stored form; its arrays
    are weighed, normalised and unfolded inside the row.
    """
    found = vocabulary(df, tokens, max_features).orderBy(F.desc("corpus_tf"), "term").collect()
    if not found:
        return df.select(*keys, F.lit("").alias("term"), F.lit(0.0).alias("weight")).where("1 = 0")
    documents = df.count()
    stage = CountVectorizerModel.from_vocabulary([r["term"] for r in found], inputCol="_terms", outputCol="_counts")
    known = F.coalesce(tokens, F.array().cast("array<string>"))
    counted = stored_vectors(stage.transform(df.select(*keys, known.alias("_terms"))).select(*keys, "_counts"), "_counts")
    idf = number_list([math.log((documents + 1.0) / (r["df"] + 1.0)) + 1.0 for r in found])
    names = text_list([r["term"] for r in found])
    raw = F.zip_with("_counts.indices", "_counts.values", lambda i, n: F.struct(
        i.alias("at"), ((F.log(n) + 1.0 if sublinear else n) * F.element_at(idf, i + 1)).alias("w")))
    rows = counted.select(*keys, raw.alias("_raw"))
    norm = F.sqrt(F.aggregate("_raw", F.lit(0.0), lambda total, x: total + x["w"] * x["w"]))
    rows = rows.select(*keys, "_raw", norm.alias("_norm"))
    weights = F.transform("_raw", lambda x: F.struct(
        F.element_at(names, x["at"] + 1).alias("term"), (x["w"] / F.col("_norm")).alias("weight")))
    return rows.select(*keys, F.inline(weights))


def product_blocks(products: DataFrame, stop_words: Sequence[str] | None = None,
                   blocks: Mapping[str, tuple[str, int, float]] = PRODUCT_BLOCKS) -> DataFrame:
    """Weighted sublinear TF-IDF of every text block: product_name, block, term, weight."""
    frames = []
    for block, (column, max_features, factor) in blocks.items():
        tokens = uni_and_bigrams(without_stop_words(word_tokens(F.col(column)), stop_words))
        weights = tfidf(products, ["product_name"], tokens, max_features, sublinear=True)
        frames.append(weights.select(
            "product_name", F.lit(block).alias("block"), "term", (F.col("weight") * factor).alias("weight")
        ))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def block_vectors(blocks: DataFrame, products: DataFrame) -> DataFrame:
    """One sparse vector for every row of ``products``; a product without kept terms has no entries.

    The number of columns is bounded by the block limits, so the term list may be broadcast. The rows
    are written in the stored form of a vector (kind, size, indices, values) and read back as vectors,
    which needs no Python.
    """
    spark = products.sparkSession
    everything = Window.partitionBy(F.lit(1))
    columns = (
        blocks.select("block", "term").distinct()
        .withColumn("index", (F.row_number().over(everything.orderBy("block", "term")) - 1).cast("int"))
    )
    columns = materialized(spark, columns, "vector-columns")
    indexed = blocks.join(F.broadcast(columns), ["block", "term"])
    entries = indexed.groupBy("product_name").agg(
        F.sort_array(F.collect_list(F.struct("index", "weight"))).alias("entries"))
    none = F.array().cast("array<struct<index:int,weight:double>>")
    listed = products.select("product_name").join(entries, "product_name", "left").withColumn(
        "entries", F.coalesce("entries", none))
    stored = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(columns.count()).alias("size"),
        F.transform("entries", lambda e: e["index"]).alias("indices"),
        F.transform("entries", lambda e: e["weight"]).alias("values"))
    path = scratch_path(spark, "product-vectors")
    listed.select("product_name", stored.alias("features")).write.parquet(path)
    schema = StructType([StructField("product_name", StringType()), StructField("features", VectorUDT())])
    return spark.read.schema(schema).parquet(path)


def cluster_terms(products: DataFrame, key: str = "cluster_id", stop_words: Sequence[str] | None = None,
                  max_features: int = PROFILE_FEATURES) -> DataFrame:
    """Term counts per cluster over its products' documents."""
    tokens = uni_and_bigrams(without_stop_words(word_tokens(F.col("review_document")), stop_words))
    counts = term_counts(products, [key], tokens)
    kept = vocabulary(products, tokens, max_features).select("term")
    return counts.join(F.broadcast(kept), "term").select(key, "term", "tf")


def top_terms(counts: DataFrame, key: str = "cluster_id", n: int = 10) -> DataFrame:
    """The most frequent terms of a cluster, joined by a comma."""
    cut = first_rows(counts, [key], [F.desc("tf"), F.asc("term")], n, rank="rank")
    terms = F.transform(F.sort_array(F.collect_list(F.struct("rank", "term"))), lambda r: r["term"])
    return cut.groupBy(key).agg(F.array_join(terms, ", ").alias("top_terms"))


def _term_stages(text: str, stop_words: Sequence[str] | None) -> list:
    """Text to ``_words``, ``_kept``, ``_pairs`` and ``_terms``, all of them JVM stages."""
    words = list(default_stop_words() if stop_words is None else stop_words)
    return [
        RegexTokenizer(inputCol=text, outputCol="_words", pattern="[^a-z0-9]+", minTokenLength=2),
        StopWordsRemover(inputCol="_words", outputCol="_kept", stopWords=words, locale="en_US"),
        NGram(n=2, inputCol="_kept", outputCol="_pairs"),
        SQLTransformer(statement="SELECT *, concat(_kept, _pairs) AS _terms FROM __THIS__"),
    ]


def text_vocabulary(train: DataFrame, text: str = "review_text", max_features: int = SENTIMENT_FEATURES,
                    stop_words: Sequence[str] | None = None) -> list[Row]:
    """term, corpus_tf, df of the words and pairs that the feature stages keep, in their order.

    Nearly every pair of a corpus is a different one; so that they need not all be shuffled, rare ones are ruled out
    by hash first. Where that proves nothing, as on small tables, all terms are counted.
    """
    stages = _term_stages(text, stop_words)
    rows = train.select(text)
    found = frequent_terms(PipelineModel(stages[:2]).transform(rows).select("_kept"), max_features)
    if found is None:
        found = vocabulary(PipelineModel(stages).transform(rows).select("_terms"), F.col("_terms"), max_features)
    return found.orderBy(F.desc("corpus_tf"), "term").collect()


def fit_text_features(
    train: DataFrame, text: str = "review_text", max_features: int = SENTIMENT_FEATURES,
    tfidf_weights: bool = True, stop_words: Sequence[str] | None = None, output: str = "features",
    found: Sequence[Row] | None = None,
) -> PipelineModel:
    """Feature stages fitted on the training rows only (X8), all of them JVM stages.

    ``text_vocabulary`` gives the vocabulary and document frequencies; only these capped lists reach the driver.
    ``found`` is its result where it is there already. Splitting lower-cased text at every run outside
    ``[a-z0-9]`` cleans and tokenizes at once, so raw and cleaned text score alike.
    """
    stages = _term_stages(text, stop_words)
    if found is None:
        found = text_vocabulary(train, text, max_features, stop_words)
    documents = train.count()
    terms = [row["term"] for row in found]
    counted = "_counts" if tfidf_weights else output
    stages.append(CountVectorizerModel.from_vocabulary(terms, inputCol="_terms", outputCol=counted))
    if tfidf_weights:
        idf = Vectors.dense([math.log((documents + 1.0) / (row["df"] + 1.0)) + 1.0 for row in found])
        stages += [
            ElementwiseProduct(scalingVec=idf, inputCol="_counts", outputCol="_weighted"),
            Normalizer(p=2.0, inputCol="_weighted", outputCol=output),
        ]
    return PipelineModel(stages)
