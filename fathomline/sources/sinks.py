"""Written tables: snapshots, key logs, bucketed tables, appended files, replaced partitions."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fathomline.session import written


class SnapshotTable:
    """A parquet table kept as numbered snapshot folders.

    A snapshot counts once its ``_SUCCESS`` mark exists, so readers never see a
    half-written one and a failed or repeated run leaves the table as it was.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def versions(self) -> list[int]:
        fs, root = self._fs(self.path)
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("v") and name[1:].isdigit():
                mark_fs, mark = self._fs(f"{self.path}/{name}/_SUCCESS")
                if mark_fs.exists(mark):
                    found.append(int(name[1:]))
        return sorted(found)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v{self.versions()[-1]}")

    def write(self, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        done = self.versions()
        target = f"{self.path}/v{(done[-1] if done else 0) + 1}"
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(target)
        return self.spark.read.parquet(target)

    def update(self, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Write ``change(current)`` as the next snapshot."""
        return self.write(change(self.read()))


class KeyLog:
    """Keys of increments, fixed before their sink is written and closed after it.

    A lazy increment evaluated again after its sink was written would come out empty, and a
    rerun after a failed write could take other keys. A pinned batch that was not closed is
    given again, whatever has arrived since.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.pinned, self.closed = SnapshotTable(spark, f"{path}/pinned"), SnapshotTable(spark, f"{path}/closed")

    def pin(self, keys: DataFrame) -> tuple[int, DataFrame]:
        """(number, keys) of the batch that is open, else of a new one with ``keys``."""
        done = set(self.closed.versions())
        waiting = [v for v in self.pinned.versions() if v not in done]
        if waiting:
            return waiting[0], self.spark.read.schema(keys.schema).parquet(f"{self.pinned.path}/v{waiting[0]}")
        kept = self.pinned.write(keys)
        return self.pinned.versions()[-1], kept

    def close(self, batch: int) -> None:
        self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.closed.path}/v{batch}")


class BucketTable:
    """A table in folders by the hash of its key, of which a merge writes only those it touches.

    A manifest (one row per bucket, a numbered snapshot) says which folders count. New folders
    count once the manifest that names them is complete: a crash before leaves the old version,
    untouched folders keep their files. With a ``source`` and a number a batch merges once only.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets
        self.manifest = SnapshotTable(spark, f"{self.path}/manifest")

    def _entries(self) -> list[tuple[int, str, int]]:
        """(bucket, folder, batch); bucket -1 tells the last batch of a source, -2 the schema. Bounded by the buckets."""
        if not self.manifest.versions():
            return []
        return [(r["bucket"], r["folder"], r["batch"]) for r in self.manifest.read().collect()]

    def last_batch(self, source: str) -> int:
        return max((n for b, name, n in self._entries() if b == -1 and name == source), default=-1)

    def folders(self) -> dict[int, str]:
        return {b: folder for b, folder, _ in self._entries() if b >= 0}

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _rows(self, folders: list[str], schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        schema = next(folder for b, folder, _ in self._entries() if b == -2)
        return self._rows(sorted(self.folders().values()), StructType.fromJson(json.loads(schema)))

    def merge(self, rows: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame], source: str = "", batch: int | None = None) -> None:
        """``change(current, rows)`` for the buckets of ``rows``; it must keep rows in their buckets."""
        entries = self._entries()
        if batch is not None and self.last_batch(source) >= batch:
            return
        schema = next((StructType.fromJson(json.loads(f)) for b, f, _ in entries if b == -2), rows.schema)
        rows = written(rows, "merge_rows")
        touched = {r[0] for r in rows.select(self._bucket().alias("b")).distinct().collect()}
        old = self.folders()
        current = self._rows([old[b] for b in sorted(touched & old.keys())], schema)
        target = f"{self.path}/data/{uuid.uuid4().hex}"
        change(current, rows).withColumn("_bucket", self._bucket()).write.partitionBy("_bucket").parquet(target)
        fs, root = self.manifest._fs(target)
        made = {int(n.split("=")[1]): f"{target}/{n}" for n in (s.getPath().getName() for s in fs.listStatus(root)) if n.startswith("_bucket=")}
        folders = {b: f for b, f in old.items() if b not in touched} | made
        marks = {name: n for b, name, n in entries if b == -1} | ({source: batch} if batch is not None else {})
        kept = [(b, f, 0) for b, f in folders.items()] + [(-1, name, n) for name, n in marks.items()] + [(-2, json.dumps(schema.jsonValue()), 0)]
        self.manifest.write(self.spark.createDataFrame(kept, "bucket int, folder string, batch bigint").coalesce(1))


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Overwrite only the partitions present in ``df``; a rerun changes nothing."""
    (
        df.hint("rebalance", *by)  # AQE splits a partition that holds too much
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
