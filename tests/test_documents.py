"""One file out of a table."""

import json

from opinionmill.sources import artifact, documents


def test_csv_file_with_mark(spark, tmp_path):
    rows = [(i, f'a "{i}"\nline, é' if i % 3 else None) for i in range(200)]
    frame = spark.createDataFrame(rows, "id int, `the text` string").repartition(5)
    path = tmp_path / "out/one.csv"
    documents.write_csv_file(frame, str(path), ["id"])
    raw = path.read_bytes()
    assert raw.startswith(documents.MARK + b"id,the text\n")
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(path))
    assert [(int(r[0]), r[1]) for r in back.collect()] == rows
    assert [p.name for p in path.parent.iterdir() if not p.name.startswith(".")] == ["one.csv"]
    documents.write_csv_file(frame.where("1 = 0"), str(path))
    assert path.read_bytes() == documents.MARK + b"id,the text\n"


def test_text_file_in_order(spark, tmp_path):
    frame = spark.createDataFrame([(i, f"part {i}\n\nbody é\n") for i in range(50)] + [(50, None), (51, "")], "id int, t string")
    path = tmp_path / "guide.md"
    documents.write_text_file(frame.repartition(7), str(path), "t", ["id"], "# Guide\n\n")
    assert path.read_text(encoding="utf-8") == "# Guide\n\n" + "".join(f"part {i}\n\nbody é\n" for i in range(50)) + "\n\n"


def test_json_record(spark, tmp_path):
    tables = {name: spark.createDataFrame([], schema) for name, schema in artifact.TABLES.items()}
    tables["category_sentiment"] = spark.createDataFrame(
        [(f"Büro {i}", "model", None if i == 3 else "negative", i) for i in range(40)], artifact.TABLES["category_sentiment"]).repartition(6)
    path = tmp_path / "record.json"
    artifact.write_nested(spark.createDataFrame([(40,)], "n long"), tables, str(path))
    text = path.read_text(encoding="utf-8")
    record = json.loads(text)
    assert list(record) == ["schema_version", "sentiment_sources", "review_count", *artifact.TABLES]
    assert record["sentiment_sources"] == artifact.SOURCE_NOTES and record["product_metrics"] == []
    assert sorted(r["count"] for r in record["category_sentiment"]) == list(range(40)) and "Büro" in text and "\n" not in text
    assert any(r["sentiment"] is None for r in record["category_sentiment"])
    found = artifact.read_nested(spark, str(path))
    assert sorted(map(tuple, found["category_sentiment"].collect()), key=repr) == sorted(map(tuple, tables["category_sentiment"].collect()), key=repr)
