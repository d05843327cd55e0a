"""One file out of a distributed table.

The rows are written as ordered parts by as many tasks as the table has; the parts are then joined through Hadoop's
file system as a stream, whose memory is one buffer, into a hidden file that gets its name when it is whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinionmill.session import scratch_path

MARK = "﻿".encode()  # says UTF-8 to spreadsheets


class Joined:
    """A file that is written from bytes and from finished part files, in order."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._jvm = context._jvm
        self._conf = context._jsc.hadoopConfiguration()
        self._target = self._path(path)
        parent, name = self._target.getParent(), self._target.getName()
        self._hidden = self._jvm.org.apache.hadoop.fs.Path(parent, f"_{name}.unfinished")
        self._files = self._target.getFileSystem(self._conf)
        self._files.mkdirs(parent)
        self._out = self._files.create(self._hidden, True)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def text(self, text: str | bytes) -> None:
        self._out.write(bytearray(text.encode() if isinstance(text, str) else text))

    def parts(self, folder: str, cut: int = 0) -> None:
        """All part files of a folder in order of their names, without the last ``cut`` bytes."""
        place = self._path(folder)
        files = place.getFileSystem(self._conf)
        found = sorted(((f.getPath().getName(), f.getLen()) for f in files.listStatus(place)
                        if f.getPath().getName().startswith("part-") and f.getLen() > 0))
        for i, (name, size) in enumerate(found):
            source = files.open(self._path(f"{folder}/{name}"))
            wanted = size - (cut if i == len(found) - 1 else 0)
            self._jvm.org.apache.commons.io.IOUtils.copyLarge(source, self._out, 0, wanted)
            source.close()

    def close(self) -> None:
        self._out.close()
        self._files.delete(self._target, False)
        if not self._files.rename(self._hidden, self._target):
            raise OSError(f"cannot place {self._target}")


def _drop(spark: SparkSession, folder: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _ordered(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*order) if order else df


def write_csv_file(df: DataFrame, path: str, order: Sequence[str | Column] = (), mark: bool = True) -> None:
    """One CSV file with a header, a byte-order mark at its front, rows in ``order``."""
    spark, folder = df.sparkSession, scratch_path(df.sparkSession, "csv-parts")
    _ordered(df, order).write.option("header", False).option("escape", '"').option("encoding", "UTF-8").csv(folder)
    header = ",".join('"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\n') else c for c in df.columns)
    file = Joined(spark, path)
    file.text((MARK if mark else b"") + header.encode() + b"\n")
    file.parts(folder)
    file.close()
    _drop(spark, folder)


def write_text_file(df: DataFrame, path: str, text: str, order: Sequence[str | Column] = (), head: str = "") -> None:
    """One text file: ``head``, then the column ``text`` of every row in ``order``, each closed by a line feed.

    A text's own last line feed counts as that one.
    """
    spark, folder = df.sparkSession, scratch_path(df.sparkSession, "text-parts")
    lines = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\n\z", "")
    _ordered(df, order).select(lines.alias("value")).write.option("lineSep", "\n").text(folder)
    file = Joined(spark, path)
    file.text(head)
    file.parts(folder)
    file.close()
    _drop(spark, folder)


def write_json_document(spark: SparkSession, fields: str, tables: Mapping[str, DataFrame], path: str) -> None:
    """One JSON object: the given fields (JSON text without braces), then every table as an array of records.

    Compact, nulls written, text as UTF-8.
    """
    folders = {}
    for name, table in tables.items():
        folders[name] = scratch_path(spark, f"json-{name}")
        record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in table.columns]), {"ignoreNullFields": "false"})
        table.select(record.alias("value")).write.option("lineSep", ",").text(folders[name])
    file = Joined(spark, path)
    file.text("{" + fields)
    for i, (name, folder) in enumerate(folders.items()):
        file.text(f'{"," if fields or i else ""}"{name}":[')
        file.parts(folder, cut=1)  # the comma behind the last record
        file.text("]")
    file.text("}")
    file.close()
    for folder in folders.values():
        _drop(spark, folder)
