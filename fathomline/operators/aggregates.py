"""Aggregates: profiles, votes, pivots, complete periods, medians, funnels."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.functions.binding import let


def distribution(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first."""
    out = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(column))
    return out if top is None else out.limit(top)


def num_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact p50, p95 and maximum of several columns, one row; NULLs skipped.

    A quantile sketch per column gives two bounds that enclose each place. Values below are
    only counted; values between them, a few in ten thousand, are counted one by one. The
    place of a share is that of the first value with as many rows up to it.
    """
    shares = {"p50": Decimal("0.5"), "p95": Decimal("0.95")}
    around = F.array(*[F.lit(float(s) + d) for s in shares.values() for d in (-AROUND, AROUND)])
    cuts = df.agg(F.struct(*[F.percentile_approx(c, around, SKETCH_ACCURACY).alias(f"v{i}") for i, c in enumerate(columns)])).scalar()
    wanted = [(i, c, j, name) for i, c in enumerate(columns) for j, name in enumerate(shares)]

    def bound(i, k):
        return F.get(cuts.getField(f"v{i}"), F.lit(k))

    told = df.agg(F.struct(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)], *[F.max(c).alias(f"max{i}") for i, c in enumerate(columns)],
        *[F.count_if(F.col(c) < bound(i, 2 * j)).alias(f"below{i}_{j}") for i, c, j, _ in wanted])).scalar()
    near = F.array_compact(F.array(*[F.when((F.col(c) >= bound(i, 2 * j)) & (F.col(c) <= bound(i, 2 * j + 1)), F.struct(
        F.lit(2 * i + j).alias("place"), *[(F.col(d) if d == c else F.lit(None).cast(df.schema[d].dataType)).alias(f"v{k}") for k, d in enumerate(columns)]))
        for i, c, j, _ in wanted]))
    values = [f"v{k}" for k in range(len(columns))]
    counts = df.select(F.explode(near).alias("e")).select("e.*").groupBy("place", *values).agg(F.count(F.lit(1)).alias("_c"))
    ranked = counts.withColumn("_upto", F.sum("_c").over(Window.partitionBy("place").orderBy(*values)))

    def first_at(i, j, name):
        rank = F.ceil(F.lit(shares[name]) * told.getField(f"n{i}")) - told.getField(f"below{i}_{j}")
        return F.min(F.when((F.col("place") == 2 * i + j) & (F.col("_upto") >= rank), F.col(f"v{i}"))).alias(f"{columns[i]}_{name}")

    picked = ranked.agg(*[first_at(i, j, name) for i, _, j, name in wanted])
    return picked.select(*[col for i, c in enumerate(columns) for col in (*[F.col(f"{c}_{name}") for name in shares], told.getField(f"max{i}").alias(f"{c}_max"))])


def value_counts(df: DataFrame, keys: list[str], value: str, weight: Column | None = None) -> DataFrame:
    """Votes per (key, value): the partial counts that votes, modes and strings are built from."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*keys, value).agg(n.alias("n"))


def mode_per_key(df: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    """Most frequent value, the smallest one on a tie."""
    counts = value_counts(df, keys, value)
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(alias))


def majority(df: DataFrame, keys: list[str], value: str, alias: str, weight: Column | None = None) -> DataFrame:
    """Value with the most (weighted) votes per key; an equal top gives NULL."""
    counts = value_counts(df.where(F.col(value).isNotNull()), keys, value, weight)
    top = counts.groupBy(*keys).agg(F.max("n").alias("_top"))
    leaders = counts.join(top, keys).where("n = _top").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_leaders"), F.min(value).alias("_value"))
    return leaders.select(*keys, F.when(F.col("_leaders") == 1, F.col("_value")).alias(alias))


def summary_string(df: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    """'type:n,…' per key, sorted; the list holds distinct values only."""
    counts = value_counts(df, keys, value)
    part = F.concat(F.col(value), F.lit(":"), F.col("n").cast("string"))
    return counts.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(part)), ",").alias(alias))


def pivot_with_totals(df: DataFrame, keys: list[str], column: str, values: list) -> DataFrame:
    """Counts per listed value, the row total and the number of non-empty cells."""
    wide = df.groupBy(*keys).pivot(column, values).count().fillna(0, [str(v) for v in values])
    cells = [F.col(f"`{v}`") for v in values]
    total = reduce(lambda a, b: a + b, cells)
    active = reduce(lambda a, b: a + b, [(c > 0).cast("int") for c in cells])
    return wide.withColumns({"total": total, "active": active.cast("long")})


def complete_quarters(monthly: DataFrame, keys: list[str], quarter: str, month: str, value: str) -> DataFrame:
    """Quarter sum only where all three months exist; the months present are told either way.
    ``monthly`` holds one row per key and month."""
    n = F.countDistinct(month)
    return monthly.groupBy(*keys, quarter).agg(
        n.alias("months_present"),
        F.when(n == 3, F.sum(F.col(value).cast("decimal(28,2)"))).cast("double").alias("quarter_total"))


def same_basis_growth(monthly: DataFrame, member: str, month: str, value: str) -> DataFrame:
    """Growth per month over the members present in both months. ``month`` is a serial number."""
    before = monthly.select(member, (F.col(month) + 1).alias(month), F.col(value).alias("_before"))
    both = monthly.join(before, [member, month])
    now = F.sum(F.col(value).cast("decimal(28,2)")).cast("double")
    was = F.sum(F.col("_before").cast("decimal(28,2)")).cast("double")
    return both.groupBy(month).agg(
        F.count(F.lit(1)).alias("n_members"), F.try_divide(now - was, was).alias("growth"))


# Accuracy of the quantile sketch, and how far around the middle its bounds are taken: twice its error.
SKETCH_ACCURACY = 10_000
AROUND = 2 / SKETCH_ACCURACY


def grouped_median(df: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    """Exact median per key for groups of any size and any distribution, NULLs skipped.

    A quantile sketch per group gives two bounds that enclose the middle. Values below are
    only counted; values between them, a few in ten thousand, are counted one by one and the
    middle one or two picked. Equal values are one row, so no task holds a large group.
    """
    solid = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    cuts = F.percentile_approx("_v", F.array(F.lit(0.5 - AROUND), F.lit(0.5 + AROUND)), SKETCH_ACCURACY)
    sketch = solid.groupBy(*keys).agg(cuts.alias("_cuts"), F.count(F.lit(1)).alias("_n"))
    low, high = F.col("_cuts")[0], F.col("_cuts")[1]
    bounds = sketch.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], low.alias("_low"), high.alias("_high"), "_n")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    near = solid.join(bounds, same).where("_v <= _high")
    # NULL stands for all values below the lower bound
    counts = near.groupBy(*keys, F.when(F.col("_v") >= F.col("_low"), F.col("_v")).alias("_value")).agg(F.count(F.lit(1)).alias("_c"), F.any_value("_n").alias("_n"))
    upto = F.sum("_c").over(Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_value")))
    ranked = counts.withColumn("_upto", upto).where("_value IS NOT NULL")
    hits = [(F.col("_upto") - F.col("_c") < rank) & (F.col("_upto") >= rank) for rank in (F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2))]
    share = hits[0].cast("int") + hits[1].cast("int")
    return ranked.where(share > 0).groupBy(*keys).agg((F.sum(F.col("_value") * share) / 2).alias(alias))


def unique_top(votes: dict[str, Column]) -> Column:
    """Name with the most votes inside one row; no votes or an equal top give NULL."""
    counted = F.filter(F.array(*[F.struct(n.cast("long").alias("n"), F.lit(name).alias("name")) for name, n in votes.items()]),
                       lambda v: v["n"] > 0)
    return let(F.reverse(F.array_sort(counted)), lambda v: F.when(
        (F.size(v) > 0) & ~F.coalesce(F.get(v, F.lit(0))["n"] == F.get(v, F.lit(1))["n"], F.lit(False)), F.get(v, F.lit(0))["name"]))


def month_funnel(stages: dict[str, DataFrame], month: str) -> DataFrame:
    """Counts per month of several stages side by side; a stage without the month counts 0.

    Stages are stacked and pivoted in one grouping instead of joined one by one.
    """
    stacked = reduce(DataFrame.unionByName, [
        df.groupBy(month).agg(F.count(F.lit(1)).alias("n")).withColumn("_stage", F.lit(name)) for name, df in stages.items()
    ])
    return stacked.groupBy(month).agg(*[
        F.coalesce(F.sum(F.when(F.col("_stage") == name, F.col("n"))), F.lit(0)).alias(name) for name in stages
    ])


def copy_stats(df: DataFrame, copy_key: list[str]) -> DataFrame:
    """Instances, distinct texts, repeats, most copies and the repeat rate, one row."""
    per = df.groupBy(*copy_key).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(
        F.sum("_n").alias("instances"), F.count(F.lit(1)).alias("distinct_texts"),
        F.sum(F.col("_n") - 1).alias("repeats"), F.max("_n").alias("max_copies"),
    ).withColumn("repeat_rate", F.round(F.try_divide(F.col("repeats"), F.col("instances")), 3))


def single_value(df: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """The value of keys that have exactly one distinct value."""
    return df.where(F.col(value).isNotNull()).groupBy(key).agg(
        F.min(value).alias(alias), F.max(value).alias("_max")).where(F.col(alias) == F.col("_max")).drop("_max")


def blank_share(df: DataFrame, period: Column, column: Column) -> DataFrame:
    """NULL and filled rows per period: shows when a column came or went."""
    return df.groupBy(period.alias("period")).agg(
        F.count_if(column.isNull()).alias("n_null"), F.count(column).alias("n_filled"))


def longest_run_ending(df: DataFrame, key: str, period: str, good: Column) -> DataFrame:
    """Length of the unbroken run of consecutive good periods that ends at each row.

    ``df`` holds one row per key and period, so the frames hold periods.
    """
    w = Window.partitionBy(key).orderBy(period)
    prev = F.lag(period).over(w)
    breaks = (~F.coalesce(good, F.lit(False)) | prev.isNull() | (F.col(period) - prev != 1)
              | ~F.coalesce(F.lag(good).over(w), F.lit(False)))
    marked = df.withColumn("_good", F.coalesce(good, F.lit(False))).withColumn("_break", breaks.cast("int"))
    island = F.sum("_break").over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = marked.withColumn("_island", island)
    run = F.row_number().over(Window.partitionBy(key, "_island").orderBy(period))
    return marked.withColumn("streak", F.when(F.col("_good"), run).otherwise(0)).drop("_good", "_break", "_island")
