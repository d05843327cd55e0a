"""Continuously refreshed dashboard counts.

The table is a snapshot of the newest values, cut into buckets by key. A micro-batch writes the buckets that hold
keys it changed anew, and then a manifest that names the folder of every bucket; readers open what one manifest
names, so reads do not grow with the number of batches.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BUCKETS = 16
KEPT_VERSIONS = 2  # the newest, and the one a reader may still have open


class Snapshot:
    """A keyed table under one path, replaced version by version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        context = spark.sparkContext
        self._hadoop = context._jvm.org.apache.hadoop.fs
        self._files = self._hadoop.Path(self.path).getFileSystem(context._jsc.hadoopConfiguration())

    def _manifests(self) -> list[int]:
        """Batches with a manifest, oldest first."""
        folder = self._hadoop.Path(f"{self.path}/manifests")
        if not self._files.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def _read_manifest(self, batch: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.path}/manifests/{batch:012d}.json", wholetext=True).first()["value"])

    def manifest(self) -> dict | None:
        """Batch, keys and the folder of every bucket of the newest version."""
        found = self._manifests()
        return self._read_manifest(found[-1]) if found else None

    def _write_manifest(self, manifest: dict) -> None:
        """Under another name first: a reader sees a whole manifest or none."""
        target = f"{self.path}/manifests/{manifest['batch']:012d}.json"
        hidden = self._hadoop.Path(f"{self.path}/manifests/_{manifest['batch']:012d}")
        stream = self._files.create(hidden, True)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        if not self._files.rename(hidden, self._hadoop.Path(target)):
            raise OSError(f"cannot place {target}")

    def _rows(self, folders: dict[str, str], schema: str) -> DataFrame | None:
        paths = [f"{self.path}/{folder}/bucket={bucket}" for bucket, folder in folders.items()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else None

    def read(self) -> DataFrame:
        """The newest version."""
        manifest = self.manifest()
        if manifest is None:
            raise FileNotFoundError(f"{self.path} has no version yet. Run the refresh first.")
        rows = self._rows(manifest["buckets"], manifest["schema"])
        return rows if rows is not None else self.spark.createDataFrame([], manifest["schema"])

    def merge(self, changed: DataFrame, keys: Sequence[str], batch: int) -> None:
        """The rows of ``changed``, one per key, replace those with their keys; a batch that was merged before changes nothing."""
        before = self.manifest()
        if before is not None and before["batch"] >= batch:
            return
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in changed.schema)
        place = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(BUCKETS)).cast("int")
        fresh = changed.withColumn("bucket", place).persist()
        touched = [str(r["bucket"]) for r in fresh.select("bucket").distinct().collect()]  # at most BUCKETS rows
        folders = dict(before["buckets"]) if before else {}
        old = self._rows({b: f for b, f in folders.items() if b in touched}, schema)
        together = fresh
        if old is not None:
            same = [F.col(f"o.`{k}`").eqNullSafe(F.col(f"n.`{k}`")) for k in keys]
            left = old.alias("o").join(fresh.select(*keys).alias("n"), same, "left_anti")
            together = fresh.unionByName(left.withColumn("bucket", place))
        folder = f"data/{batch:012d}"
        # a bucket is a few files, however many tasks merged it
        together.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{folder}")
        fresh.unpersist()
        self._write_manifest({"batch": batch, "schema": schema, "buckets": folders | dict.fromkeys(touched, folder)})
        self._drop_old()

    def _drop_old(self) -> None:
        """Remove manifests beyond the kept ones, and folders that no kept one names."""
        batches = self._manifests()
        used = {folder for b in batches[-KEPT_VERSIONS:] for folder in self._read_manifest(b)["buckets"].values()}
        for batch in batches[:-KEPT_VERSIONS]:
            for folder in set(self._read_manifest(batch)["buckets"].values()) - used:
                self._files.delete(self._hadoop.Path(f"{self.path}/{folder}"), True)
            self._files.delete(self._hadoop.Path(f"{self.path}/manifests/{batch:012d}.json"), False)


def refresh_counts(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], available_now: bool = True) -> StreamingQuery:
    """Merge the keys that each micro-batch changed into the snapshot under ``path``.

    The streaming state holds one row per group. A batch that runs again after a failure overwrites what it had
    written, or finds that its version is complete.
    """
    def save(changed: DataFrame, batch: int) -> None:
        Snapshot(changed.sparkSession, path).merge(changed, keys, batch)

    writer = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(save)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """Newest value of every key."""
    return Snapshot(spark, path).read()
