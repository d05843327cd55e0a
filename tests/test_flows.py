"""Files, models, streams and whole flows."""

import json
import random
import shutil
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from opinionmill.catalog import streams
from opinionmill.operators import classify, contracts, language
from opinionmill.plans import dashboard, review_flow, translation_evaluation
from opinionmill.sources import adapters, artifact, reviews, sinks
from opinionmill.streaming import counts, scoring

CANDIDATES = (classify.CANDIDATES[2], classify.CANDIDATES[1])

# Text functions defined here travel to the workers by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture(scope="module")
def review_csv(spark, tmp_path_factory):
    """A small review file with quotes, line breaks, a blank name and broken ratings."""
    draw = random.Random(11)
    words = {1: "broken slow refund awful", 3: "okay average fine middling", 5: "excellent love perfect bright"}
    rows = []
    for i in range(240):
        stars = draw.choice([1, 3, 5, 5])
        body = " ".join(draw.choice(words[stars].split()) for _ in range(8)) + ', "quoted"\nsecond line.'
        rows.append((str(i), body, str(float(stars)), f"Product {i % 8},,,\r\nProduct", "Tablets,Readers"))
    rows += [("240", "lost name", "5", None, "x"), ("241", "bad stars", "abc", "Product 1", None), ("242", "?!", "4", "Product 1", None)]
    path = str(tmp_path_factory.mktemp("csv") / "reviews")
    df = spark.createDataFrame(rows, "id string, t string, r string, n string, categories string")
    sinks.write_csv(df.toDF("id", "reviews.text", "reviews.rating", "name", "categories").coalesce(1), path)
    return path


def test_load_reviews(spark, review_csv):
    raw = reviews.read_reviews_csv(spark, review_csv, row_id="id")
    loaded = reviews.load_reviews(raw)
    assert loaded.count() == 241
    names = {r["product_name"] for r in loaded.select("product_name").distinct().collect()}
    assert names == {*(f"Product {i}" for i in range(8)), "Unknown product"}
    first = loaded.where("row_id = '0'").first()
    assert "quoted second line" in first["review_text"]
    narrow = reviews.read_reviews_csv(spark, review_csv, ("reviews.text", "reviews.rating"))
    assert narrow.columns == ["row_id", "reviews.text", "reviews.rating"]
    with pytest.raises(contracts.ContractError, match="reviews.rating"):
        reviews.load_reviews(raw.drop("reviews.rating"))
    with pytest.raises(FileNotFoundError, match="Run it first"):
        reviews.read_table(spark, "/tmp/opinionmill-missing", "Run it first.")


def shortened():
    return lambda texts: [t[:40] + "." for t in texts]


def test_whole_flow(spark, review_csv, tmp_path):
    out = str(tmp_path / "out")
    names = {i: f"Group {i}" for i in range(4)}
    drafts = review_flow.run_all(
        spark, review_csv, out, names, shortened, "forty characters", restarts=2, max_iter=20, max_features=200)
    assert drafts.count() == 4
    model = sinks.load_model(spark, f"{out}/model")
    assert model.labels == ("negative", "neutral", "positive") and model.test_accuracy > 0.8
    mapped = spark.read.parquet(f"{out}/review_clusters")
    assert mapped.count() == 241 and mapped.where("cluster_id = -1").count() == 1
    again = review_flow.guides_only(spark, review_csv, out, shortened, "forty characters")
    assert again.count() == 4
    mapped = spark.read.parquet(f"{out}/review_clusters")
    path = dashboard.build_dashboard(mapped, f"{out}/dashboard", model.pipeline)
    tables = artifact.read(spark, path)
    assert tables["category_sentiment"].agg(F.sum("count")).first()[0] == 2 * 241
    views = dashboard.dashboard_views(tables, min_support=1)
    assert views["kpis"].first()["review_count"] == 241 and views["ranked_products"].count() <= 10
    assert not set(sinks.SOURCE_COUNT_COLUMNS) & set(views["ranked_export"].columns)
    texts = spark.read.text(f"{out}/category_articles").collect()
    assert any(r["value"].startswith("### Buying takeaway") for r in texts)


def test_artifact_contract(spark, tmp_path):
    path = str(tmp_path / "nested")
    frame = spark.createDataFrame([("A", "model", "negative", 2)], artifact.TABLES["category_sentiment"])
    tables = {name: spark.createDataFrame([], schema) for name, schema in artifact.TABLES.items()}
    tables["category_sentiment"] = frame
    record = {"schema_version": 1, "sentiment_sources": artifact.SOURCE_NOTES, "review_count": 2} | {
        name: [row.asDict() for row in table.collect()] for name, table in tables.items()}
    spark.createDataFrame([(json.dumps(record),)], "value string").write.text(path)
    assert artifact.read_nested(spark, path)["category_sentiment"].collect() == frame.collect()
    for change, message in (({"schema_version": 2}, "Unsupported"), ({"review_count": 0}, "no reviews"), ({"product_metrics": None}, "missing")):
        record = json.loads(spark.read.text(path).first()["value"]) | change
        broken = str(tmp_path / f"broken-{message}")
        spark.createDataFrame([(json.dumps(record),)], "value string").write.text(broken)
        with pytest.raises(contracts.ContractError, match=message):
            artifact.read_nested(spark, broken)
    with pytest.raises(FileNotFoundError):
        artifact.read(spark, str(tmp_path / "none"))


@pytest.fixture(scope="module")
def small_model(spark):
    rows = [("awful broken slow", "negative"), ("fine average okay", "neutral"), ("excellent works perfectly great", "positive")] * 6
    train = spark.createDataFrame(rows, "review_text string, sentiment string")
    return classify.fit_sentiment_model(train, classify.CANDIDATES[3], max_features=50, max_iter=20)


def test_single_request(spark, small_model):
    asked = spark.createDataFrame([(1, "This product is EXCELLENT and works perfectly.")], "row_id int, review_text string")
    row = classify.score_reviews(small_model, asked, "review_text").first()
    assert row["sentiment"] == "positive" and set(row["class_scores"]) == {"negative", "neutral", "positive"}
    assert sum(row["class_scores"].values()) == pytest.approx(1.0)
    assert "not calibrated probabilities" in row["score_note"]


@pytest.mark.parametrize("parts", [0, 3])
def test_document_stream_reads_a_file_or_a_folder(spark, sf_dir, tmp_path, parts):
    documents = adapters.documents(spark, sf_dir)
    place, target = tmp_path / "tables", tmp_path / "tables" / "documents.parquet"
    place.mkdir()
    if parts:
        documents.repartition(parts).write.parquet(str(target))
    else:
        shutil.copy(f"{sf_dir}/documents.parquet", target)
    documents.limit(5).write.parquet(str(place / "pages.parquet"))  # another table beside it
    path = str(tmp_path / "out")
    scoring.append_table(streams.document_stream(spark, str(place)), path, str(tmp_path / "log")).awaitTermination()
    assert sorted(r["doc_id"] for r in spark.read.parquet(path).collect()) == sorted(r["doc_id"] for r in documents.collect())


def test_stream_equals_batch(spark, small_model, sf_dir, tmp_path):
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "documents.parquet").parquet(sf_dir)
    wanted = lambda df: df.select(F.col("doc_id").alias("row_id"), F.col("text").alias("review_text"))
    scored, rejected = scoring.score_stream(wanted(stream), small_model, "review_text")
    scoring.append_table(scored, str(tmp_path / "scored"), str(tmp_path / "log")).awaitTermination()
    scoring.append_table(rejected, str(tmp_path / "rejected"), str(tmp_path / "log2")).awaitTermination()
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    batch, refused = scoring.score_stream(wanted(documents), small_model, "review_text")
    got = sorted(map(str, spark.read.parquet(str(tmp_path / "scored")).collect()))
    assert got == sorted(map(str, batch.collect()))
    assert spark.read.parquet(str(tmp_path / "rejected")).count() == refused.count()


def test_appended_table_is_read_under_another_path(spark, tmp_path):
    source, path, schema = str(tmp_path / "in"), tmp_path / "out", "k string, n long"

    def run(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        scoring.append_table(stream, str(path), str(tmp_path / "log")).awaitTermination()

    run([("a", 1), (None, 2), ("a", 1)])
    run([("b", 3)])
    path.rename(tmp_path / "mount")  # the same folder as another machine names it
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "mount")).collect())) == sorted(
        map(str, spark.createDataFrame([("a", 1), (None, 2), ("a", 1), ("b", 3)], schema).collect()))


def test_scored_stream_is_read_under_another_path(spark, small_model, tmp_path):
    rows = [(1, "excellent tablet"), (2, ""), (3, "awful and broken"), (3, "awful and broken"), (4, None), (None, "fine")]
    asked = spark.createDataFrame(rows, "row_id int, review_text string")
    asked.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(asked.schema).parquet(str(tmp_path / "in"))
    scored, _ = scoring.score_stream(stream, small_model, "review_text")
    scoring.append_table(scored, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    (tmp_path / "out").rename(tmp_path / "mount")
    batch, _ = scoring.score_stream(asked, small_model, "review_text")
    want = sorted(map(str, batch.collect()))
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "mount")).collect())) == want and len(want) == 4
    got = scoring.read_table(spark, str(tmp_path / "mount"), scored.schema)
    assert sorted(map(str, got.collect())) == want and got.columns == scored.columns


def test_appended_batches_are_whole_and_repeatable(spark, tmp_path):
    path, schema = str(tmp_path / "out"), spark.createDataFrame([], "n long").schema
    table = scoring.AppendedTable(spark, path)
    read = lambda: sorted(r["n"] for r in scoring.read_table(spark, path, schema).collect())
    assert read() == []
    table.append(spark.range(4).toDF("n"), 0)
    table.append(spark.range(4).toDF("n"), 0)  # a batch that runs again
    assert read() == [0, 1, 2, 3]
    # an attempt that ended while it moved its files
    spark.range(4, 9).toDF("n").repartition(3).write.parquet(f"{path}/_staged/{1:012d}")
    moved = sorted((tmp_path / "out/_staged" / f"{1:012d}").glob("part-*"))[0]
    moved.rename(tmp_path / "out" / f"{1:012d}-{moved.name}")
    assert read() == [0, 1, 2, 3]
    table.append(spark.range(4, 9).toDF("n"), 1)
    table.append(spark.createDataFrame([], schema), 2)
    assert read() == list(range(9)) and spark.read.parquet(path).count() == 9
    (tmp_path / "old/_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError, match="file sink"):
        scoring.append_table(spark.readStream.format("rate").load(), str(tmp_path / "old"), str(tmp_path / "log"))


def test_stream_queries_return_every_document(spark, tmp_path):
    texts = ["", " \n", "x" * 5001, None, "fine", "fine"]
    rows = [(i, t, "en", "src1", len(t or "")) for i, t in enumerate(texts)] + [(0, "", "en", "src1", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = streams.stream_rejected_requests(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == [(0, "empty"), (0, "empty"), (1, "blank"), (2, "too_long"), (3, "empty")]
    frame.limit(0).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert streams.stream_rejected_requests(spark, str(tmp_path)).collect() == []


def test_counts_over_two_batches(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k string, n long"

    def run():
        stream = spark.readStream.schema(schema).parquet(source).groupBy("k").agg(F.sum("n").alias("n"))
        counts.refresh_counts(stream, path, str(tmp_path / "log"), ["k"]).awaitTermination()
        return {r["k"]: r["n"] for r in counts.latest_counts(spark, path).collect()}

    spark.createDataFrame([("a", 1), ("b", 2)], schema).write.mode("append").parquet(source)
    assert run() == {"a": 1, "b": 2}
    spark.createDataFrame([("a", 5)], schema).write.mode("append").parquet(source)
    assert run() == {"a": 6, "b": 2}


def test_snapshots_are_compacted_and_repeatable(spark, tmp_path):
    path, want = str(tmp_path / "snapshot"), {}
    with pytest.raises(FileNotFoundError, match="no version"):
        counts.latest_counts(spark, path)
    draw = random.Random(3)
    for batch in range(8):
        rows = {draw.choice([None, *"abcdefghijklmnop"]): draw.randrange(100) for _ in range(4)}
        want |= rows
        changed = spark.createDataFrame(list(rows.items()), "k string, n long")
        for _ in range(2):  # the second time is a batch that runs again
            counts.Snapshot(spark, path).merge(changed, ["k"], batch)
        late = spark.createDataFrame([("a", -1)], "k string, n long")
        counts.Snapshot(spark, path).merge(late, ["k"], batch - 1)
        latest = counts.latest_counts(spark, path)
        assert {r["k"]: r["n"] for r in latest.collect()} == want and latest.count() == len(want)
    assert len(list((tmp_path / "snapshot/manifests").glob("*.json"))) == counts.KEPT_VERSIONS
    names = set(counts.Snapshot(spark, path).manifest()["buckets"].values())
    assert len(latest.inputFiles()) <= counts.BUCKETS and len(names) <= 8


def same():
    return lambda texts: texts


def test_translation_evaluation(spark, small_model, tmp_path):
    rows = [(i, f"this is an excellent tablet number {i} and it works", 5.0) for i in range(15)]
    rows += [(100 + i, f"this awful thing {i} is broken and slow", 1.0) for i in range(3)]
    raw = spark.createDataFrame(rows, "row_id long, original string, rating double")
    spoken = language.fit_language_model(spark.createDataFrame(
        [("this is an excellent awful tablet and it works", "en"), ("das ist nicht gut und sehr teuer", "de")] * 3, "text string, lang string"))
    samples, scores = translation_evaluation.evaluate(raw, small_model, spoken, same, same)
    row = scores.first()
    assert (row["n_reviews"], row["n_translated"]) == (13, 13)
    assert row["round_trip_bleu"] == 100.0 and row["round_trip_rouge1_f"] == 1.0 and row["round_trip_rougeL_f"] == 1.0
    assert row["sentiment_preserved_rate"] == 1.0 and set(row["sentiment_preserved_by_class"]) == {"negative", "positive"}
    translation_evaluation.save(samples, scores, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out/translation_metrics")).first()["n_reviews"] == 13


def test_flagship_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 24
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_adapter_rows_have_unique_ids(spark):
    sf_dir = "/root/testdata/sf0.01"
    contracts.require_unique(adapters.reviews_bulk(spark, sf_dir), "row_id")
    contracts.require_unique(adapters.reviews_text(spark, sf_dir), "row_id")


def write_lines(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_files_with_other_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "mixed"
    write_lines(folder, "a.csv", ["name,reviews.text,reviews.rating", "Echo,fine,5"])
    write_lines(folder, "b.csv", ["reviews.text,name,reviews.rating", "fine,Echo,5"])
    with pytest.raises(Exception, match="(?i)header"):
        reviews.read_reviews_csv(spark, str(folder)).collect()


def test_row_ids_follow_the_files(spark, tmp_path):
    folder = tmp_path / "ordered"
    write_lines(folder, "b.csv", ["name,reviews.text,reviews.rating", *[f"P,b {i} {'x' * 200},5" for i in range(30)]])
    write_lines(folder, "a.csv", ["name,reviews.text,reviews.rating", *[f"P,a {i},5" for i in range(5)]])
    want = [f"a {i}" for i in range(5)] + [f"b {i}" for i in range(30)]
    for size in ("64m", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = reviews.read_reviews_csv(spark, str(folder)).orderBy("row_id").collect()
        assert [" ".join(r["reviews.text"].split()[:2]) for r in rows] == want
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    ids = [r["row_id"] for r in rows]
    assert ids[0].endswith("a.csv:000000000000") and ids[-1].endswith("b.csv:000000000029")
