"""Streams give what the batch form gives, in one run or several."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from fathomline.session import shared_dir
from fathomline.sources.sinks import BucketTable, KeyLog, SnapshotTable, replace_partitions
from fathomline.streaming import jobs


def latest(df):
    return df.groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("m")).select("user_id", "m.ts", "m.event_id")


def test_upsert_stream_over_two_runs_equals_batch(spark, tables, tmp_path):
    landing, ev = str(tmp_path / "landing"), tables.events
    table = BucketTable(spark, str(tmp_path / "typed"), ["user_id"], 8)

    def run(checkpoint="cp"):
        jobs.upsert_stream(jobs.landed(spark, landing, ev.schema, 1), table, latest, F.struct("s.ts", "s.event_id") >= F.struct("t.ts", "t.event_id"), str(tmp_path / checkpoint))

    ev.where("event_id % 2 = 0").write.parquet(landing)
    run()
    ev.where("event_id % 2 = 1").write.mode("append").parquet(landing)
    run()
    done = table.manifest.versions()
    run()
    assert table.manifest.versions() == done
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, latest(ev).collect()))


def upserted(current, rows):
    return current.join(rows, ["k"], "left_anti").unionByName(rows)


def test_a_merge_writes_only_the_buckets_it_touches(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), ["k"], 16)
    table.merge(spark.range(200).select(F.col("id").alias("k"), F.lit("a").alias("v")), upserted, "s", 0)
    before = table.folders()
    files = {b: sorted(os.listdir(f)) for b, f in before.items()}
    change = spark.createDataFrame([(7, "b"), (1000, "c")], "k long, v string")
    touched = {r[0] for r in change.select(table._bucket()).collect()}
    table.merge(change, upserted, "s", 1)
    after = table.folders()
    assert {b for b in before if before[b] != after[b]} == touched & before.keys() and len(after) == 16
    assert all(sorted(os.listdir(after[b])) == files[b] for b in before if b not in touched)
    assert {r.k: r.v for r in table.read().collect()} == {**{k: "a" for k in range(200)}, 7: "b", 1000: "c"}
    for again in (0, 1):  # a replayed batch changes nothing
        table.merge(spark.createDataFrame([(7, "z")], "k long, v string"), upserted, "s", again)
    assert table.folders() == after and table.last_batch("s") == 1 and table.last_batch("other") == -1
    table.merge(spark.createDataFrame([(8, "d")], "k long, v string"), lambda current, rows: current.where("k <> 8"))
    assert table.read().where("k = 8").count() == 0 and table.read().count() == 200


def test_a_crash_before_the_manifest_leaves_the_old_version(spark, tmp_path, monkeypatch):
    table = BucketTable(spark, str(tmp_path / "t"), ["k"], 4)
    table.merge(spark.range(20).select(F.col("id").alias("k"), F.lit("a").alias("v")), upserted, "s", 0)
    change = spark.createDataFrame([(3, "b")], "k long, v string")
    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "write", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.merge(change, upserted, "s", 1)
    assert {r.v for r in table.read().collect()} == {"a"} and table.last_batch("s") == 0
    table.merge(change, upserted, "s", 1)
    assert sorted(r.k for r in table.read().where("v = 'b'").collect()) == [3]


def test_pinned_keys_are_given_again_until_closed(spark, tmp_path):
    log = KeyLog(spark, str(tmp_path / "log"))
    one, keys = log.pin(spark.range(5))
    again, same = KeyLog(spark, str(tmp_path / "log")).pin(spark.range(100))
    assert (one, sorted(r.id for r in same.collect())) == (again, list(range(5)))
    log.close(one)
    two, keys = log.pin(spark.range(100).where("id >= 5"))
    assert two > one and keys.count() == 95
    log.close(two)
    three, keys = log.pin(spark.range(0))
    assert three > two and keys.count() == 0


def arrivals_by_hand(batches, delay):
    """Plain loop over micro-batches of (key, seconds)."""
    seen, high, out, late = {}, None, [], []
    for batch in batches:
        mark = None if high is None else high - delay
        on_time = [r for r in batch if r[1] is not None and (mark is None or r[1] >= mark)]
        late += [r for r in batch if r not in on_time]
        live = {k for k, t in seen.items() if mark is None or t + delay > mark}
        first = {}
        for k, t in on_time:
            first[k] = min(t, first.get(k, t))
        for k, t in first.items():
            if k not in live:
                out.append((k, t))
                seen[k] = t
        high = max([t for _, t in batch if t is not None] + ([] if high is None else [high]), default=None)
    return out, late


def test_first_arrivals_with_late_rows_over_several_runs(spark, tmp_path):
    day = 86_400
    batches = [[("a", 1 * day), ("a", 2 * day), ("b", 3 * day), ("n", None)], [("a", 4 * day), ("c", 10 * day), ("b", 1 * day)],
               [("d", 7 * day), ("e", 8 * day), ("a", 9 * day), ("c", 12 * day)], [("a", 10 * day), ("c", 30 * day)], [("f", 27 * day), ("f", 28 * day), ("a", 29 * day)]]
    job = jobs.FirstArrivals(spark, str(tmp_path / "job"), ["h"], "ts", "2 days")
    landing, shape = str(tmp_path / "landing"), "h string, t long"
    for batch in batches:
        spark.createDataFrame(batch, shape).coalesce(1).write.mode("append").parquet(landing)
        job.run(jobs.landed(spark, landing, shape).select("h", "t", F.timestamp_seconds("t").alias("ts")))
    job.run(jobs.landed(spark, landing, shape).select("h", "t", F.timestamp_seconds("t").alias("ts")))
    schema = "h string, t long, ts timestamp"
    out, late = arrivals_by_hand(batches, 2 * day)
    assert sorted((r.h, r.t) for r in job.arrivals(schema).collect()) == sorted(out)
    assert sorted(map(str, [(r.h, r.t) for r in job.late(schema).collect()])) == sorted(map(str, late)) and len(late) == 3
    assert sorted((r.batch, r.n_late) for r in job.counts().collect()) == [(0, 1), (1, 0), (2, 1), (3, 0), (4, 1)]


def test_a_lost_mark_does_not_lose_arrivals(spark, tmp_path, monkeypatch):
    job = jobs.FirstArrivals(spark, str(tmp_path / "job"), ["h"], "ts", "1 day")
    rows = spark.createDataFrame([("a", 5), ("b", 6)], "h string, t long").select("h", F.timestamp_seconds("t").alias("ts"))
    with monkeypatch.context() as m:
        kept = SnapshotTable.write
        m.setattr(SnapshotTable, "write", lambda self, *a: kept(self, *a) if "marks" not in self.path else (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            job._apply(rows, 0)
    job._apply(rows, 0)
    job._apply(rows, 0)
    assert sorted(r.h for r in job.arrivals("h string, ts timestamp").collect()) == ["a", "b"] and job.counts().count() == 1


def test_weekly_stream_goes_on_from_its_state(spark, tables, tmp_path):
    landing, ev = str(tmp_path / "landing"), tables.events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    table = BucketTable(spark, str(tmp_path / "weeks"), ["week_start", "event_type"], 4)
    cut = F.col("ts") < F.lit("2024-01-18").cast("timestamp")
    for part in (cut, ~cut):
        ev.where(part).write.mode("append").parquet(landing)
        jobs.weekly_stream(jobs.landed(spark, landing, ev.schema), "ts", ["event_type"], "7 days", table, str(tmp_path / "cp"))
    want = sorted(map(tuple, jobs.weekly_counts(ev, "ts", ["event_type"]).collect()))
    assert sorted(map(tuple, table.read().collect())) == want


def test_weekly_stream_equals_batch(spark, tables, tmp_path):
    landing = str(tmp_path / "landing")
    tables.events.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(landing)
    stream = jobs.landed(spark, landing, spark.read.parquet(landing).schema)
    got = []
    query = (jobs.weekly_counts(stream, "ts", ["event_type"], "7 days").writeStream.outputMode("complete").trigger(availableNow=True)
             .option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(lambda df, _: got.append(sorted(map(tuple, df.collect())))).start())
    query.awaitTermination()
    assert got[-1] == sorted(map(tuple, jobs.weekly_counts(spark.read.parquet(landing), "ts", ["event_type"]).collect()))


def test_replacing_partitions_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([("d1", 1), ("d2", 2)], "day string, n int")
    replace_partitions(df, path, ["day"])
    replace_partitions(df.where("day = 'd2'").withColumn("n", F.lit(5)), path, ["day"])
    replace_partitions(df.where("day = 'd2'").withColumn("n", F.lit(5)), path, ["day"])
    assert sorted((r.day, r.n) for r in spark.read.parquet(path).collect()) == [("d1", 1), ("d2", 5)]


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark) == (spark.conf.get("spark.checkpoint.dir") or "").rstrip("/")
