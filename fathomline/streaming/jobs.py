"""Streams over folders of landed files. Each run takes what is there and stops;
the next run continues from its checkpoint in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.operators import upsert as up
from fathomline.session import written
from fathomline.sources.sinks import BucketTable, SnapshotTable


def landed(spark: SparkSession, path: str, schema, files_per_batch: int = 64) -> DataFrame:
    """File stream with a declared schema and a bounded number of files per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_available(stream: DataFrame, checkpoint: str, *, each: Callable[[DataFrame, int], None] | None = None,
                  path: str | None = None) -> None:
    """Process everything landed so far, then stop."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if each is not None:
        writer = writer.foreachBatch(each)
    else:
        writer = writer.format("parquet").option("path", path).outputMode("append")
    query = writer.start()
    query.awaitTermination()


def upsert_stream(stream: DataFrame, table: BucketTable, typed: Callable[[DataFrame], DataFrame], newer: Column, checkpoint: str) -> None:
    """Typed layer kept by a merge per micro-batch, which writes only the buckets of its keys.

    ``typed`` gives one row per key. A replayed micro-batch is known by its number and
    changes nothing, so restarts are harmless.
    """

    def apply(batch: DataFrame, number: int) -> None:
        table.merge(typed(batch), lambda current, rows: up.merge(current, rows, table.keys, update_when=newer), checkpoint, number)

    run_available(stream, checkpoint, each=apply)


class FirstArrivals:
    """First arrivals of keys in a stream, late rows told apart, in tables below ``base``.

    The watermark of a micro-batch is the latest event time of all earlier ones less
    ``delay`` (as an interval, '2 days'). A row before it, or without a time, is late: it goes
    to the late rows, with no effect on the state. A key is remembered from its first row until the watermark has
    passed it by ``delay``; state that old is dropped when its bucket is next written.
    """

    def __init__(self, spark: SparkSession, base: str, keys: list[str], event_time: str, delay: str):
        self.spark, self.base, self.keys, self.time = spark, base.rstrip("/"), keys, event_time
        self.delay = F.expr(f"INTERVAL {delay}")
        self.state = BucketTable(spark, f"{base}/state", keys)
        self.marks = SnapshotTable(spark, f"{base}/marks")

    def run(self, stream: DataFrame) -> None:
        """Process everything landed so far; a later run goes on from here."""
        run_available(stream, f"{self.base}/checkpoint", each=self._apply)

    def _apply(self, batch: DataFrame, number: int) -> None:
        marks = self.marks.read() if self.marks.versions() else self.spark.createDataFrame([], "batch bigint, high timestamp, n_late bigint")
        told = {r["batch"]: r["high"] for r in marks.where(F.col("batch") >= number - 1).collect()}
        if number in told:
            return
        rows = written(batch, "arrivals")
        mark = F.lit(max((h for h in told.values() if h is not None), default=None)).cast("timestamp") - self.delay
        late = F.coalesce(F.col(self.time) < mark, F.col(self.time).isNull())
        if self.state.last_batch("arrivals") < number:
            live = F.coalesce(F.col("seen_at") + self.delay > mark, F.lit(True))
            firsts = rows.where(~late).groupBy(*self.keys).agg(F.min_by(F.struct(*rows.columns), F.struct(self.time, F.xxhash64(*rows.columns))).alias("r")).select("r.*")
            if self.state.manifest.versions():
                firsts = firsts.join(self.state.read().where(live).select(*self.keys), self.keys, "left_anti")
            self._write(firsts, "out", number)
            self._write(rows.where(late), "late", number)
            seen = self.spark.read.schema(rows.schema).parquet(f"{self.base}/out/batch={number}").select(*self.keys, F.col(self.time).alias("seen_at"))
            self.state.merge(seen, lambda current, new: current.where(live).join(new, self.keys, "left_anti").unionByName(new), "arrivals", number)
        high = rows.agg(F.max(self.time).cast("timestamp").alias("high")).first()["high"]
        highs = [h for h in (high, *told.values()) if h is not None]
        n_late = rows.where(late).count()
        mine = self.spark.createDataFrame([(number, max(highs, default=None), n_late)], marks.schema)
        self.marks.write(marks.union(mine).coalesce(1))

    def _write(self, rows: DataFrame, kind: str, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.base}/{kind}/batch={number}")

    def arrivals(self, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.base}/out")

    def late(self, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.base}/late")

    def counts(self) -> DataFrame:
        """(batch, high, n_late) of every micro-batch."""
        return self.marks.read()


def weekly_stream(stream: DataFrame, event_time: str, keys: list[str], delay: str, table: BucketTable, checkpoint: str) -> None:
    """Weekly counts kept in the state store behind a watermark; changed weeks replace theirs in ``table``."""

    def apply(batch: DataFrame, number: int) -> None:
        table.merge(batch, lambda current, rows: current.join(rows, table.keys, "left_anti").unionByName(rows), checkpoint, number)

    counts = weekly_counts(stream, event_time, keys, delay)
    query = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(apply).start()
    query.awaitTermination()


def weekly_counts(df: DataFrame, event_time: str, keys: list[str], delay: str | None = None) -> DataFrame:
    """Counts per tumbling week starting on Monday (the epoch was a Thursday).

    Works on batch and stream alike; on a stream a week is final once the watermark passes it.
    """
    timed = df.withWatermark(event_time, delay) if delay else df
    week = F.window(event_time, "7 days", startTime="4 days")
    return timed.groupBy(week.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(
        F.to_date("w.start").alias("week_start"), *keys, "n")
