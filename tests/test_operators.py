"""Operators on small tables, golden numbers and independence from partitioning."""

import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from opinionmill.functions.labels import SENTIMENTS
from opinionmill.operators import (
    aggregates, articles, clusters, contracts, evidence, features, joins, language, metrics, pairs, ranking,
    reshape, sampling, text_stage,
)

# Text functions defined here travel to the workers by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

REVIEWS = "row_id long, cluster_id int, cluster_name string, product_name string, review_text string, rating double, sentiment string, model_sentiment string"


@pytest.fixture(scope="module")
def reviews(spark):
    """300 reviews with one product holding a third of them and many copies."""
    draw = random.Random(7)
    rows = []
    for i in range(300):
        product = "Hot" if i % 3 == 0 else f"P{draw.randrange(6)}"
        cluster = {"Hot": 0, "P0": 0, "P1": 0, "P2": 1, "P3": 1}.get(product, -1)
        rating = float(draw.choice([1, 2, 3, 4, 5, 5, 5]))
        label = "negative" if rating <= 2 else "neutral" if rating == 3 else "positive"
        words = "battery slow great screen price cover fine good bad".split()
        body = " ".join(draw.choice(words) for _ in range(draw.randrange(2, 6)))
        name = f"C{cluster}" if cluster >= 0 else "Unclassified / missing product name"
        rows.append((i, cluster, name, product, body, rating, label, draw.choice(SENTIMENTS)))
    return spark.createDataFrame(rows, REVIEWS).cache()


def as_set(df):
    return sorted(map(str, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


@pytest.mark.parametrize("operator", [
    lambda r: ranking.first_rows(r, ["product_name"], [F.col("row_id")], 20),
    lambda r: ranking.drop_copies(r, ["cluster_id", "sentiment"]),
    lambda r: ranking.distinct_text_ids(r, ["cluster_id"]),
    lambda r: sampling.sample_per_group(r, ["sentiment"], 7),
    lambda r: sampling.stratified_split(r),
    lambda r: aggregates.review_documents(r),
    lambda r: ranking.top_products(aggregates.product_evidence(r)),
    lambda r: ranking.largest_joined(aggregates.product_stats(r).withColumn("cluster_id", F.lit(1))),
], ids=["first_rows", "drop_copies", "distinct_ids", "sample", "split", "documents", "top", "largest"])
def test_result_does_not_depend_on_partitions(reviews, operator):
    assert as_set(operator(reviews.repartition(1))) == as_set(operator(reviews.repartition(7, "review_text")))


def test_split_has_exact_quotas(reviews):
    parts = {(r["split"], r["sentiment"]): r["count"] for r in
             sampling.stratified_split(reviews).groupBy("split", "sentiment").count().collect()}
    assert sum(n for (s, _), n in parts.items() if s == "test") == 60
    assert sum(n for (s, _), n in parts.items() if s == "validation") == 60
    for label in SENTIMENTS:
        total = sum(n for (_, x), n in parts.items() if x == label)
        assert abs(parts[("test", label)] - total * 0.2) < 1


def test_quotas_of_the_published_data(spark):
    counts = spark.createDataFrame([("negative", 812), ("neutral", 1499), ("positive", 32314)], "sentiment string, n long")
    rows = {r["sentiment"]: (r["test_rows"], r["validation_rows"]) for r in sampling.split_quotas(counts, "sentiment").collect()}
    assert rows == {"negative": (162, 162), "neutral": (300, 300), "positive": (6463, 6463)}


def test_copies_keep_the_first_row(spark):
    df = spark.createDataFrame([(3, "a", "x"), (1, "a", "x"), (2, "b", "x"), (4, "a", "y")], "row_id long, k string, review_text string")
    assert sorted(r["row_id"] for r in ranking.drop_copies(df, ["k"]).collect()) == [1, 2, 4]
    assert sorted(r["row_id"] for r in ranking.drop_copies(df, []).collect()) == [1, 4]


def test_comparison_pool_falls_back_when_nothing_is_established(spark):
    rows = [(1, "a", 5, 4.0), (1, "b", 4, 5.0), (2, "c", 2, 3.0), (2, "d", 1, 4.0), (3, "e", 9, 4.0), (3, "f", 9, 4.0), (3, "g", 10, 4.0)]
    products = spark.createDataFrame(rows, "cluster_id int, product_name string, review_count long, mean_rating double")
    top = {(r["cluster_id"], r["rank"]): r["product_name"] for r in ranking.top_products(products).collect()}
    assert top == {(1, 1): "a", (2, 1): "d", (2, 2): "c", (3, 1): "g", (3, 2): "e", (3, 3): "f"}
    low = {r["cluster_id"]: r["product_name"] for r in ranking.lowest_product(products).collect()}
    assert low == {1: "a", 2: "c", 3: "g"}


def test_zero_rows_and_null_category(spark):
    rows = [(1, None, "p", "slow", 1.0, "negative", "positive"), (2, "A", "p", "x", 5.0, "positive", "positive")]
    df = spark.createDataFrame(rows, "row_id long, cluster_name string, product_name string, review_text string, rating double, sentiment string, model_sentiment string")
    counts = {(r["category"], r["source"], r["sentiment"]): r["count"] for r in aggregates.category_sentiment(df).collect()}
    assert len(counts) == 12
    assert counts[("Unclassified", "rating", "negative")] == 1 and counts[("A", "rating", "negative")] == 0
    themes = aggregates.theme_counts(df).collect()
    assert {(r["category"], r["source"]) for r in themes} == {("Unclassified", "rating")}
    assert sum(r["count"] for r in themes) == 1 and len(themes) == 8
    metrics_row = aggregates.product_metrics(df).where("category = 'Unclassified'").first()
    assert metrics_row["rating_negative"] == 1 and metrics_row["model_positive"] == 1
    lengths = aggregates.length_sentiment(df).collect()
    assert sum(r["count"] for r in lengths) == 4


def test_join_default_and_validation(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "zzz")], "row_id long, product_name string")
    dim = spark.createDataFrame([("a", 3, "C3")], "product_name string, cluster_id int, cluster_name string")
    got = {r["row_id"]: (r["cluster_id"], r["cluster_name"]) for r in joins.assign_categories(rows, dim).collect()}
    assert got == {1: (3, "C3"), 2: (-1, "Unclassified / missing product name")}
    unknown = rows.withColumn("product_name", F.lit("Unknown product"))
    named = dim.withColumn("product_name", F.lit("Unknown product"))
    assert {r["cluster_id"] for r in joins.assign_categories(unknown, named).collect()} == {-1}
    with pytest.raises(contracts.ContractError, match="duplicate"):
        contracts.require_unique(dim.union(dim), "product_name")


def test_contracts(spark):
    df = spark.createDataFrame([(0, "1"), (7, "x"), (-1, "2")], "cluster_id int, v string")
    dim = spark.createDataFrame([(0,)], "cluster_id int")
    with pytest.raises(contracts.ContractError, match=r"\['a', 'b'\]"):
        contracts.require_columns(df, ["b", "a", "v"])
    with pytest.raises(contracts.ContractError, match="7"):
        contracts.require_known(df, dim, "cluster_id", unassigned=-1)
    contracts.require_known(df.where("cluster_id <> 7"), dim, "cluster_id", unassigned=-1)
    with pytest.raises(contracts.ContractError, match="at least 6"):
        contracts.require_rows(df, 6)
    with pytest.raises(contracts.ContractError):
        contracts.require_same_ids(df, dim, "cluster_id")
    with pytest.raises(Exception, match="not numeric"):
        contracts.require_numeric(df, "v").collect()
    requests = spark.createDataFrame([(1, " ok "), (2, "   "), (3, "x" * 5000), (4, "x" * 5001), (5, None)], "i int, t string")
    accepted, rejected = contracts.split_requests(requests, "t")
    assert [r["t"] for r in accepted.orderBy("i").collect()] == ["ok", "x" * 5000]
    assert {r["i"]: r["reason"] for r in rejected.collect()} == {2: "blank", 4: "too_long", 5: "empty"}


def test_published_confusion_matrix(spark):
    """The published test matrix must give the published scores."""
    matrix = {"negative": (64, 34, 64), "neutral": (30, 71, 199), "positive": (86, 273, 6104)}
    cells = [(a, p, n) for a, row in matrix.items() for p, n in zip(SENTIMENTS, row)]
    df = spark.createDataFrame(cells, "actual string, predicted string, n long")
    got = metrics.summary_metrics(df).first()
    expected = {"accuracy": 0.9009386281588447, "macro_precision": 0.500693168506372, "macro_recall": 0.5253938118151503,
                "macro_f1": 0.511742803054612, "weighted_f1": 0.9058680709557367, "samples": 6925}
    for name, value in expected.items():
        assert got[name] == pytest.approx(value, abs=1e-12)
    per_class = {r["sentiment"]: r for r in metrics.per_class_metrics(df).collect()}
    assert per_class["neutral"]["f1"] == pytest.approx(0.20943952802359883) and per_class["neutral"]["support"] == 300
    rows = {r["actual"]: tuple(r[f"predicted_{s}"] for s in SENTIMENTS) for r in metrics.confusion_matrix(df).collect()}
    assert rows == matrix


def test_class_never_predicted(spark):
    df = spark.createDataFrame([("negative", "positive"), ("positive", "positive")], "actual string, predicted string")
    rows = {r["sentiment"]: r for r in metrics.per_class_metrics(df).collect()}
    assert rows["negative"]["precision"] == 0.0 and rows["neutral"]["support"] == 0
    assert {r["row"] for r in metrics.classification_report(df).collect()} == {*SENTIMENTS, "accuracy", "macro avg", "weighted avg"}


def test_published_cluster_profile(spark):
    """One published cluster: its profile is the plain mean over its products."""
    rows = [(4, "A", 5, 4.6, 0.0, 1.0), (4, "B", 135, 4.7407407407407405, 0.007407407407407408, 0.9555555555555556),
            (4, "C", 6, 4.833333333333333, 0.0, 1.0), (4, "D", 1033, 4.55082284607938, 0.027105517909002903, 0.9293320425943853),
            (4, "E", 1685, 4.510385756676558, 0.037388724035608306, 0.9074183976261128)]
    df = spark.createDataFrame(rows, "cluster_id int, product_name string, review_count long, mean_rating double, negative_share double, positive_share double")
    got = aggregates.cluster_profiles(df).first()
    assert (got["product_count"], got["total_reviews"]) == (5, 2864)
    assert got["mean_rating"] == pytest.approx(4.647056535366003)
    assert got["negative_share"] == pytest.approx(0.014380329870403724)
    assert got["positive_share"] == pytest.approx(0.9584611991552109)
    assert ranking.largest_joined(df).first()["top_products"] == "E | D | B | C | A"


def test_dashboard_numbers(reviews):
    counts, products = aggregates.category_sentiment(reviews), aggregates.product_metrics(reviews)
    rows = {r["category"]: r for r in aggregates.kpi_rows(counts, products, "rating").collect()}
    assert rows["All categories"]["review_count"] == 300
    mean = reviews.agg(F.avg("rating")).first()[0]
    assert rows["All categories"]["average_rating"] == pytest.approx(mean)
    shares = reshape.row_shares(reshape.pivot_counts(counts.where("source = 'rating'"), "category")).collect()
    assert all(sum(r[s] for s in SENTIMENTS) == pytest.approx(1.0) for r in shares)
    assert {r["sentiment"] for r in aggregates.sentiment_totals(counts, "model").collect()} == set(SENTIMENTS)


def test_evidence_briefs(spark, reviews):
    categories = spark.createDataFrame([(0, "C0"), (1, "C1")], "cluster_id int, cluster_name string")
    briefs = evidence.evidence_briefs(categories, reviews).cache()
    rows = {r["cluster_id"]: r for r in briefs.collect()}
    assert set(rows) == {0, 1}
    for row in rows.values():
        assert len(row["highest_rated_products"]) <= 3 and len(row["negative_review_examples"]) <= 5
        assert len(row["positive_review_examples"]) <= 3
        for product in [*row["highest_rated_products"], row["lowest_rated_product"]]:
            assert all(e["product"] == product["name"] for e in product["negative_review_examples"])
            assert len({e["review"] for e in product["negative_review_examples"]}) == len(product["negative_review_examples"])
    requests = evidence.request_rows(briefs, list(evidence.PROMPT_VARIANTS)).collect()
    assert len(requests) == 6 and len({r["system_text"] for r in requests}) == 3
    assert '"lowest_rated_product"' in requests[0]["user_text"]
    assert evidence.rubric_rows(evidence.request_rows(briefs)).count() == 1
    with pytest.raises(ValueError, match="Unknown prompt variant"):
        evidence.request_rows(briefs, ["nope"])


def echo():
    return lambda texts: [t[:20] + "." for t in texts]


def cut_off():
    return lambda texts: ["ends without a mark" for _ in texts]


def test_articles(spark, reviews):
    categories = spark.createDataFrame([(0, "C0"), (1, "C1")], "cluster_id int, cluster_name string")
    briefs = evidence.evidence_briefs(categories, reviews).cache()
    tasks = articles.summary_tasks(briefs).withColumn("route", F.lit("summarize"))
    done = articles.summarize_tasks(tasks, echo)
    assert all(r["summary"].startswith("Model summary: Rating") for r in done.collect())
    assert all(r["summary"].startswith(articles.CUT_NOTE) for r in articles.summarize_tasks(tasks, cut_off).collect())
    extracts = articles.summarize_tasks(tasks).collect()
    assert len(extracts) == tasks.count() and all(r["summary"].startswith(articles.EXTRACT_LABEL + "Rating") for r in extracts)
    drafts = articles.drafts(briefs, articles.articles(briefs, done), "echo").cache()
    contracts.require_articles(drafts, categories, inference="local")
    article = drafts.first()["article"]
    for part in ("## C0", "### Review themes", "### Top 3 products", "1. **", "### Lowest-rated product", "### Buying takeaway"):
        assert part in article
    with pytest.raises(contracts.ContractError):
        contracts.require_articles(drafts.withColumn("article", F.lit(" ")), categories)
    requests = evidence.request_rows(briefs)
    answered = articles.response_drafts(requests, briefs, echo, "echo")
    assert answered.count() == 2 and set(contracts.ARTICLE_COLUMNS) <= set(answered.columns)
    with pytest.raises(Exception, match="empty article"):
        articles.response_drafts(requests, briefs, lambda: lambda texts: ["  " for _ in texts], "m").collect()


def test_article_without_evidence(spark):
    rows = [(1, 0, "C0", "Only", "fine", 3.0, "neutral", "neutral")]
    briefs = evidence.evidence_briefs(
        spark.createDataFrame([(0, "C0")], "cluster_id int, cluster_name string"), spark.createDataFrame(rows, REVIEWS))
    none = articles.summarize_tasks(articles.summary_tasks(briefs), echo)
    article = articles.articles(briefs, none).first()["article"]
    assert articles.NO_POSITIVE in article and articles.NO_NEGATIVE in article and articles.NO_COMPLAINT in article


def test_summary_budget(spark):
    df = spark.createDataFrame([(10,), (90,), (500,)], "n int").select(articles.output_budget(F.col("n")).alias("b"))
    assert [tuple(r["b"]) for r in df.collect()] == [(20, 6), (62, 10), (90, 10)]


def test_text_stage_batches_and_checks_counts(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"]), (2, []), (3, None), (4, ["d"])], "i int, t array<string>").coalesce(1)
    seen = text_stage.apply_to_texts(df, "t", "o", lambda: lambda xs: [f"{x}{len(xs)}" for x in xs], batch_size=2)
    assert {r["i"]: list(r["o"]) for r in seen.collect()} == {1: ["a2", "b2", "c2"], 2: [], 3: [], 4: ["d2"]}
    with pytest.raises(Exception, match="returned 1 results for 2"):
        text_stage.apply_to_texts(df, "t", "o", lambda: lambda xs: xs[:1], batch_size=2).collect()


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def test_columns_beside_the_texts_stay_as_they_are(spark):
    rows = [(2 ** 53 + 1, ["a", "b"]), (None, None), (5, [])] * 400
    df = spark.createDataFrame(rows, "n long, t array<string>").coalesce(1)
    got = text_stage.apply_to_texts(df, "t", "o", lambda: lambda xs: [f"{x}{len(xs)}" for x in xs], batch_size=3).collect()
    assert [(r["n"], r["t"]) for r in got] == rows
    # batches reach across rows and slices: 800 texts are 266 batches of three and one of two
    answers = [x for r in got for x in r["o"]]
    assert answers == [f"{'ab'[i % 2]}{3 if i < 798 else 2}" for i in range(800)]


def test_rouge_against_brute_force(spark):
    draw = random.Random(3)
    texts = [(i, " ".join(draw.choice("abcde") * 2 for _ in range(draw.randrange(0, 30))),
              " ".join(draw.choice("abcde") * 2 for _ in range(draw.randrange(0, 30)))) for i in range(60)]
    df = spark.createDataFrame([(str(i), r, c) for i, r, c in texts], "pair_id string, reference string, candidate string")
    long = {r["pair_id"]: r["rougeL_f"] for r in pairs.rouge_l(df).collect()}
    short = {r["pair_id"]: r["rouge1_f"] for r in pairs.rouge1(df).collect()}
    for i, r, c in texts:
        a, b = r.split(), c.split()
        n = len(a) + len(b)
        assert long[str(i)] == pytest.approx(2 * lcs(a, b) / n if n else 0.0)
        shared = sum(min(a.count(t), b.count(t)) for t in set(a))
        assert short[str(i)] == pytest.approx(2 * shared / n if n else 0.0)


def test_bleu(spark):
    schema = "pair_id string, reference string, candidate string"
    score = lambda rows: pairs.corpus_bleu(spark.createDataFrame(rows, schema)).first()["bleu"]
    assert score([("1", "The cat sat on the mat.", "The cat sat on the mat.")]) == pytest.approx(100.0)
    assert score([("1", "a b c d", "e f g h")]) == 0.0
    assert score([("1", "a b c d", "")]) == 0.0
    # 3/4 unigrams, 2/3 bigrams, 1/2 trigrams, no fourgram out of 1 (counted as 1/2).
    assert score([("1", "a b c d", "a b c x")]) == pytest.approx(100 * (0.75 * (2 / 3) * 0.5 * 0.5) ** 0.25)
    # Clipping: the repeated word counts once.
    assert pairs.corpus_bleu(spark.createDataFrame([("1", "the cat", "the the the")], schema)).first()["matches_1"] == 1


def test_cosine_silhouette_against_pairs(spark):
    draw = random.Random(5)
    rows = [(i, [draw.gauss(c, 1.0), draw.gauss(-c, 1.0), draw.gauss(1.0, 1.0)], c) for i, c in enumerate([0, 1, 2] * 15)]
    df = clusters.as_vectors(spark.createDataFrame(rows, "i int, v array<double>, cluster_id int"), "v")

    def distance(a, b):
        dot = sum(x * y for x, y in zip(a, b))
        return 1 - dot / (sum(x * x for x in a) ** 0.5 * sum(y * y for y in b) ** 0.5)

    total = 0.0
    for i, v, c in rows:
        means = {}
        for other in range(3):
            ds = [distance(v, w) for j, w, k in rows if k == other and j != i]
            means[other] = sum(ds) / len(ds)
        inner = means.pop(c)
        total += (min(means.values()) - inner) / max(min(means.values()), inner)
    assert clusters.cosine_silhouette(df) == pytest.approx(total / len(rows))


def test_cluster_names_must_cover_the_ids(spark):
    df = spark.createDataFrame([("p", 0), ("q", 1)], "product_name string, cluster_id int")
    assert clusters.name_clusters(df, {0: "a", 1: "b"}).count() == 2
    with pytest.raises(contracts.ContractError):
        clusters.name_clusters(df, {0: "a", 2: "b"})


def test_feature_vectors_follow_the_long_form(spark):
    docs = spark.createDataFrame([(1, "red kindle kindle"), (2, "slow red screen"), (3, "blue")], "row_id long, review_text string")
    stages = features.fit_text_features(docs, max_features=50)
    vectors = {r["row_id"]: r["features"] for r in stages.transform(docs).collect()}
    terms = stages.stages[4].vocabulary
    from opinionmill.functions.tokens import uni_and_bigrams, without_stop_words, word_tokens

    tokens = uni_and_bigrams(without_stop_words(word_tokens(F.col("review_text"))))
    long = features.tfidf(docs, ["row_id"], tokens, 50).collect()
    pairs = {(r["row_id"], r["term"], r["tf"]) for r in features.term_counts(docs, ["row_id"], tokens, one_row_per_key=True).collect()}
    assert pairs == {(r["row_id"], r["term"], r["tf"]) for r in features.term_counts(docs, ["row_id"], tokens).collect()}
    assert len(long) == sum(v.numNonzeros() for v in vectors.values())
    for row in long:
        assert vectors[row["row_id"]][terms.index(row["term"])] == pytest.approx(row["weight"])


def test_block_vectors(spark):
    products = spark.createDataFrame([("Red Tablet", "Tablets", "fast red thing"), ("Blue Reader", "Readers", "slow blue thing")],
                                     "product_name string, categories_text string, review_document string")
    products = products.union(spark.createDataFrame([("A", "", "")], products.schema))
    blocks = features.product_blocks(products).cache()
    norms = {(r["product_name"], r["block"]): r["n"] for r in blocks.groupBy("product_name", "block").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("n")).collect()}
    assert norms[("Red Tablet", "title")] == pytest.approx(4.0) and norms[("Blue Reader", "review")] == pytest.approx(0.25)
    rows = {r["product_name"]: r["features"] for r in features.block_vectors(blocks, products).collect()}
    assert len(rows) == 3 and len({v.size for v in rows.values()}) == 1
    assert rows["A"].numNonzeros() == 0 and rows["Red Tablet"].norm(2) == pytest.approx((16 + 1 + 0.0625) ** 0.5)


def test_language_model(spark):
    rows = [("the tablet is good and the screen is bright", "en"), ("das ist ein sehr gutes Gerät und nicht teuer", "de")] * 5
    model = language.fit_language_model(spark.createDataFrame(rows, "text string, lang string"))
    asked = spark.createDataFrame([("the screen and the tablet",), ("nicht sehr gut und teuer",), ("?!",)], "text string")
    assert [r["language"] for r in language.detect_language(model, asked).collect()] == ["en", "de", "unknown"]


def test_table_profile(spark):
    df = spark.createDataFrame([(1.0, "a"), (1.0, "a"), (float("nan"), None)], "x double, s string")
    rows = {(r["item"], r["column"]): r["value"] for r in aggregates.table_profile(df).collect()}
    assert rows == {("rows", ""): 3, ("missing", "x"): 1, ("missing", "s"): 1, ("duplicate_rows", ""): 1}
    assert [r["column"] for r in aggregates.missing_columns_report(aggregates.table_profile(df)).collect()] == ["s", "x"]
