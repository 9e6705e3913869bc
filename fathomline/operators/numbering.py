"""Row numbers and running sums over groups of any size.

A plain window puts a whole group into one task. Here rows are sorted over all tasks by
(group, order): Spark samples the keys for the splitters, so tasks get equal shares however
the values are distributed and however large a group is. The place of a row in its
partition is fixed by writing the sorted rows once; only the sizes of (group, partition)
parts are summed up, at most one row per partition and group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.session import written


def _sorted_parts(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows with ``_part``, the partition of their range, and ``_at``, their place in it (places rise with the order)."""
    by = [*[F.col(k) for k in keys], *order]
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = written(ranged.withColumn("_at", F.monotonically_increasing_id()), "sorted_parts")
    return placed.withColumn("_part", F.shiftright("_at", 33))


def _before(parts: DataFrame, keys: list[str], total: Column) -> DataFrame:
    """Per (group, partition): its first place and the ``total`` of the group's earlier partitions."""
    sizes = parts.groupBy(*keys, "_part").agg(F.min("_at").alias("_first"), total.alias("_total"))
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).cast("long")).drop("_total")


def _joined(parts: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    """Null-safe on the keys: a NULL group is a group."""
    names = [*keys, "_part"]
    right = before.select(*[F.col(k).alias(f"_r_{k}") for k in names], "_first", "_before")
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in names]
    return parts.join(right, same, "inner").drop(*[f"_r_{k}" for k in names])


def row_numbers(df: DataFrame, keys: list[str], order: list[Column], alias: str = "rn") -> DataFrame:
    """``row_number()`` per ``keys`` in ``order``, from 1. The order should be total, else ties are numbered at random."""
    parts = _sorted_parts(df, keys, order)
    joined = _joined(parts, _before(parts, keys, F.count(F.lit(1))), keys)
    number = F.col("_at") - F.col("_first") + F.col("_before") + 1
    return joined.withColumn(alias, number).drop("_part", "_at", "_first", "_before")


def running_sums(df: DataFrame, keys: list[str], order: list[Column], value: Column, alias: str) -> DataFrame:
    """Sum of ``value`` over all earlier rows of the group, the row itself excluded."""
    parts = _sorted_parts(df.withColumn("_value", value), keys, order)
    joined = _joined(parts, _before(parts, keys, F.sum("_value")), keys)
    inside = Window.partitionBy(*keys, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    total = F.col("_before") + F.coalesce(F.sum("_value").over(inside), F.lit(0))
    return joined.withColumn(alias, total).drop("_part", "_at", "_first", "_before", "_value")
