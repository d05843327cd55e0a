"""CSV read by ranges against the reader that takes a file in one task."""

import csv
import random

import pytest

from opinionmill.operators import contracts
from opinionmill.sources import csv_ranges, reviews


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def write_file(path, rows, newline="\n"):
    with path.open("w", newline="", encoding="utf-8") as file:
        csv.writer(file, lineterminator=newline).writerows(rows)


def fields(rng, many):
    """Texts with quotes, commas and line breaks, and some so long that they span several ranges."""
    parts = ['"', ",", "\n", "word", " ", "é☃", "\n\n", '""', "x" * 30]
    out = []
    for _ in range(many):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        out.append("a" + (text + "\n") * 40 + "z" if rng.random() < 0.05 else text)
    return out


def as_rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_ranges_equal_whole_files(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    header = ["name", "reviews.text", "reviews.rating"]
    for name in "ab":
        rows = [[f"p{i}", t, str(rng.randint(1, 5))] for i, t in enumerate(fields(rng, 80))]
        write_file(tmp_path / f"{name}.csv", [header, *rows])
    (tmp_path / "c.csv").write_text("name,reviews.text,reviews.rating\n\n\np,after blank lines,3\n\nq,,\n,\"\",4")
    (tmp_path / "d.csv").write_text("name,reviews.text,reviews.rating\n")
    found = reviews.read_reviews_csv(spark, str(tmp_path))
    assert found.columns == ["row_id", *header]
    assert as_rows(found) == as_rows(reviews.read_reviews_csv(spark, str(tmp_path), whole_files=True))
    assert csv_ranges.lines_of(spark, str(tmp_path)).select("file", "start").distinct().count() > 20


def test_many_tasks_read_one_file(spark, tmp_path, small_splits, monkeypatch):
    rows = [["name", "reviews.text", "reviews.rating"], *[[f"p{i}", f'line {i}\nand "another", here', "5"] for i in range(300)]]
    write_file(tmp_path / "one.csv", rows)
    whole = as_rows(reviews.read_reviews_csv(spark, str(tmp_path), whole_files=True))
    found = reviews.read_reviews_csv(spark, str(tmp_path / "one.csv"))
    assert found.rdd.getNumPartitions() > 10
    assert as_rows(found) == whole and len(whole) == 300
    monkeypatch.setattr(csv_ranges, "BROADCAST_RANGES", 0)
    assert as_rows(reviews.read_reviews_csv(spark, str(tmp_path))) == whole
    narrow = reviews.read_reviews_csv(spark, str(tmp_path), ("reviews.text",), row_id="name")
    assert narrow.columns == ["row_id", "reviews.text"] and narrow.where("row_id = 'p7'").count() == 1


def test_windows_files(spark, tmp_path):
    rows = [["name", "reviews.text", "reviews.rating"], ["p", "a\r\nb", "1"], ["q", "plain", "2"]]
    write_file(tmp_path / "w.csv", rows, "\r\n")
    marked = tmp_path / "marked.csv"
    marked.write_bytes(csv_ranges.MARK + (tmp_path / "w.csv").read_bytes())
    for path in (tmp_path / "w.csv", marked):
        found = reviews.read_reviews_csv(spark, str(path)).orderBy("row_id").collect()
        assert [r["reviews.rating"] for r in found] == ["1", "2"]
        assert found[0]["reviews.text"].split() == ["a", "b"] and found[0]["name"] == "p"


def test_refused_files(spark, tmp_path):
    (tmp_path / "odd.csv").write_text('name,reviews.text,reviews.rating\np,a 5" screen,3\nq,b,4\n')
    with pytest.raises(csv_ranges.CsvParityError, match="odd.csv"):
        reviews.read_reviews_csv(spark, str(tmp_path))
    assert reviews.read_reviews_csv(spark, str(tmp_path), whole_files=True).count() == 2
    (tmp_path / "odd.csv").write_text("name,reviews.text,reviews.rating\np,a,3\n")
    (tmp_path / "other.csv").write_text("reviews.text,name,reviews.rating\na,p,3\n")
    with pytest.raises(contracts.ContractError, match="different headers"):
        reviews.read_reviews_csv(spark, str(tmp_path))
