"""Sharding by a two-pass external shuffle.

Pass one scatters records uniformly into buckets that fit into a task's memory, by a
seeded hash. Pass two puts each bucket into the order of a seeded Fisher-Yates shuffle
and writes it. The buckets one after another are the global order; it is dealt to the
shards in turn, so shard sizes in rows differ by one at most (law ``rows``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.columns import in_order, packed, with_occurrences
from fathomline.session import written

BUCKET_BYTES = 16 << 20
SHARDS = 8


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform permutation of ``range(n)`` by swaps from the end."""
    order = np.arange(n)
    picks = (rng.random(n) * np.arange(1, n + 1)).astype(np.int64)
    for i in range(n - 1, 0, -1):
        j = picks[i]
        order[i], order[j] = order[j], order[i]
    return order


def record_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text plus one; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def scattered(docs: DataFrame, seed: int, bucket_bytes: int) -> DataFrame:
    """rest and text of ``packed``, with bucket and key.

    The hash covers the whole row and its number among equal ones, so equal rows do not meet
    in one bucket, and files and partitions do not matter.
    """
    total = docs.agg(F.sum(record_bytes(F.col("text"))).alias("b")).first()["b"] or 0
    buckets = max(1, -(-total // bucket_bytes))
    rows = with_occurrences(packed(docs, "text"))
    key = F.xxhash64(F.lit(seed), "rest", F.coalesce("text", F.lit("")), "occurrence")
    return rows.select("rest", "text", key.alias("key")).withColumn("bucket", F.pmod("key", F.lit(buckets)))


def shuffled(docs: DataFrame, seed: int = 42, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """rest and text of ``packed`` with bucket and at, the place in the bucket's random order; written, bucket by bucket.

    The order follows from the seed and the rows alone.
    """
    rows = scattered(docs, seed, bucket_bytes)
    names = ["rest", "text"]

    def run(batches):
        """Rows come sorted by bucket; one bucket is in memory at a time."""
        held: list[pa.RecordBatch] = []
        bucket = None

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            order = fisher_yates(table.num_rows, np.random.default_rng([seed, bucket]))
            for batch in table.select(names).take(pa.array(order)).to_batches(max_chunksize=2_000):
                yield batch, bucket

        def out(pieces):
            at = 0
            for batch, b in pieces:
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, b)), pa.array(np.arange(at, at + n))], [*names, "bucket", "at"])
                at += n

        for batch in batches:
            ids = batch.column("bucket").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else []
            for at, end in zip(edges, [*edges[1:], len(ids)]):
                if ids[at] != bucket:
                    if held:
                        yield from out(flush())
                    bucket, held = int(ids[at]), []
                held.append(batch.slice(at, end - at))
        if held:
            yield from out(flush())

    ordered = rows.repartition("bucket").sortWithinPartitions("bucket", "key")
    return written(ordered.mapInArrow(run, f"rest {rows.schema['rest'].dataType.simpleString()}, text string, bucket bigint, at bigint"), "shuffled_buckets")


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = 42, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` with shard (from 0) and slot (gapless from 0) of a global random order.

    Null texts count one byte; repeated rows and null ids are dealt like any others. Columns
    named shard or slot are replaced, all others pass unchanged. Bucket sizes are summed in two levels, so no task sees
    more than the square root of their number and the groups of buckets.
    """
    docs = docs.drop("shard", "slot")
    rows = shuffled(docs, seed, bucket_bytes)
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).withColumn("_group", F.floor(F.sqrt(F.col("bucket").cast("double"))).cast("long"))
    groups = sizes.groupBy("_group").agg(F.sum("_n").alias("_g"))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("_base", F.coalesce(F.sum("_g").over(before), F.lit(0)))
    inside = Window.partitionBy("_group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(sizes.join(groups, "_group").select("bucket", (F.col("_base") + F.coalesce(F.sum("_n").over(inside), F.lit(0))).alias("_start")), "bucket_starts")
    place = F.col("_start") + F.col("at")
    dealt = rows.join(F.broadcast(starts) if starts.limit(100_001).count() <= 100_000 else starts, "bucket")
    return in_order(dealt.withColumns({"shard": F.pmod(place, F.lit(shards)).cast("int"), "slot": F.floor(place / shards).cast("long")}), docs.columns, "shard", "slot")
