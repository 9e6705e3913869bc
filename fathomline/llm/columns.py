"""Column expressions and small frame helpers shared by the operators."""

from __future__ import annotations

import pickle
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathomline.session import written

WORD = r"[^\x20\x09-\x0D]+"
# A derived table of at most this many rows may be broadcast; a larger one is shuffled.
BROADCAST_ROWS = 20_000
# Copies of a row that one task makes; more are dealt out.
COPIES_PER_TASK = 1_000


def words(text: Column) -> Column:
    """Words of a text: runs of anything but blanks and ASCII control spaces. Null: none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def small(df: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``bound`` rows, unchanged otherwise.

    The rows are counted up to the bound only. ``df`` should be cheap to read again.
    """
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) that depends on ``parts`` only: the first 52 bits of an MD5."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def sampled_ids(df: DataFrame, group: str, size: int) -> DataFrame:
    """(doc_id, group) of the ids with the smallest hashes of each group, at most ``size`` of them.

    Rows are counted by group first; only ids below the hash that leaves twice ``size``
    of them are ranked, so the task of a group stays small however many rows it has.
    """
    mark = F.xxhash64("doc_id")
    counts = small(written(df.groupBy(group).agg(F.count(F.lit(1)).alias("_rows")), "sample_counts"))
    share = F.lit(2.0 * size + 64) / F.col("_rows")
    near = df.select("doc_id", group).join(counts, group).where(mark / F.lit(2.0**64) + 0.5 <= share).select("doc_id", group).distinct()
    order = Window.partitionBy(group).orderBy(mark, "doc_id")
    return near.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= size).drop("_r")


def slices(sizes: list[int], limit: int):
    """Bounds of runs of rows whose sizes sum to ``limit`` at most, one row at least."""
    start = total = 0
    for k, size in enumerate(sizes):
        if k > start and total + size > limit:
            yield start, k
            start, total = k, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def packed(docs: DataFrame, *heavy: str) -> DataFrame:
    """One struct of all other columns beside the heavy ones, so that no name of the input can clash."""
    others = [c for c in docs.columns if c not in heavy]
    rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("none"))
    return docs.select(rest.alias("rest"), *[F.col(f"`{c}`") for c in heavy])


def in_order(df: DataFrame, columns: list[str], *added: str) -> DataFrame:
    """``columns`` as they were before ``packed(docs, "text")``, with the added ones."""
    return df.select(*[F.col("text") if c == "text" else F.col("rest")[c].alias(c) for c in columns], *added)


def with_occurrences(rows: DataFrame) -> DataFrame:
    """``rows`` of ``packed(docs, "text")`` with ``occurrence``, which numbers equal rows from 1.

    Without equal rows, which hashes tell, nothing moves. Else equal rows are counted, combined
    before the shuffle, and made again by their count; many copies of one row are made in
    tasks that each make as many as the square root of them.
    """
    same = rows.groupBy(F.xxhash64("rest").alias("a"), F.xxhash64("text").alias("b")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if same.isEmpty():
        return rows.withColumn("occurrence", F.lit(1).cast("long"))
    counted = rows.groupBy("rest", "text").agg(F.count(F.lit(1)).alias("n"))
    few = counted.where(F.col("n") <= COPIES_PER_TASK).select("rest", "text", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("occurrence"))
    step = F.ceil(F.sqrt(F.col("n").cast("double")))
    dealt = counted.where(F.col("n") > COPIES_PER_TASK).select("rest", "text", "n", step.alias("step"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / step))).alias("part"))
    first = F.col("part") * F.col("step")
    many = dealt.repartition(F.xxhash64("text"), "part").select("rest", "text", F.explode(F.sequence(first + 1, F.least("n", first + F.col("step")))).alias("occurrence"))
    return few.union(many)


def shipped(spark: SparkSession, value) -> Callable[[], object]:
    """A function that gives ``value`` on executors; its classes travel with it, so they need no copy of the package."""
    data = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(data.value)


def unpacked(df: DataFrame, others: list[str], *added: str) -> DataFrame:
    """The columns of ``packed`` again, with the added ones."""
    return df.select(*[F.col("rest")[c].alias(c) for c in others], *added)
