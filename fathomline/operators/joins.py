"""Joins with a rule: suffix, prefix, interval, contained text, as-of, grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def left_enrich(facts: DataFrame, *dims: tuple[DataFrame, str | list[str]]) -> DataFrame:
    """Facts with several dimensions in sequence; rows without a match keep NULLs.

    No broadcast hints: Spark broadcasts a side whose size it has measured to be
    small and shuffles otherwise.
    """
    for dim, key in dims:
        facts = facts.join(dim, key, "left")
    return facts


def host_suffixes(host: Column) -> Column:
    """'a.b.example.com' → ['a.b.example.com', 'b.example.com', 'example.com', 'com']."""
    parts = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."),
    )


def longest_suffix_match(facts: DataFrame, row_key: str, domain: str, aliases: DataFrame, alias: str) -> DataFrame:
    """Left join on 'domain equals alias or ends with .alias', longest alias first.

    The suffixes of a domain are exploded (a handful per row), which turns the
    non-equi condition into a hash join.
    """
    cand = facts.select(row_key, F.explode(host_suffixes(F.col(domain))).alias(alias))
    hits = cand.join(aliases, alias)
    values = [c for c in aliases.columns if c != alias]
    best = hits.groupBy(row_key).agg(
        F.max(F.struct(F.length(alias).alias("len"), alias, *values)).alias("_m")
    ).select(row_key, *[F.col(f"_m.{c}").alias(c) for c in [alias, *values]])
    return facts.join(best, row_key, "left")


def prefix_lookup(facts: DataFrame, code: str, dim: DataFrame, prefix: str, value: str, length: int = 4) -> DataFrame:
    """First ``length`` characters (trimmed, upper case) looked up; the basis says how it went."""
    key = F.upper(F.substring(F.trim(code), 1, length))
    tagged = facts.withColumn(prefix, F.when(F.length(key) == length, key))
    basis = (
        F.when(F.col(prefix).isNull(), F.lit("too_short"))
        .when(F.col(value).isNull(), F.lit("unknown"))
        .otherwise(F.lit("prefix"))
    )
    return tagged.join(dim.select(prefix, value), prefix, "left").withColumn("basis", basis)


def in_window(facts: DataFrame, windows: DataFrame, key: str, at: str, start: str, end: str, how: str = "inner") -> DataFrame:
    """Rows joined to the closed window of their own key; the key carries the hash join."""
    w = windows.withColumnRenamed(key, "_wkey")
    cond = (F.col(key) == F.col("_wkey")) & F.col(at).between(F.col(start), F.col(end))
    return facts.join(w, cond, how).drop("_wkey")


def at_or_before(asked: DataFrame, facts: DataFrame, key: str, period: str, found: str = "found_period") -> DataFrame:
    """The asked period if facts hold it, else the latest earlier one of the key.

    Both sides are merged into one ordered run per key; the frames hold periods,
    so facts must be aggregated to one row per (key, period) before.
    """
    marks = asked.select(key, period).distinct().withColumn("_asked", F.lit(True))
    have = facts.select(key, period, F.struct(*facts.columns).alias("_fact"))
    run = have.join(marks, [key, period], "full_outer")
    w = Window.partitionBy(key).orderBy(period).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = run.withColumn("_hit", F.last("_fact", ignorenulls=True).over(w)).where("_asked")
    values = [c for c in facts.columns if c not in (key, period)]
    return run.select(key, period, F.col(f"_hit.{period}").alias(found), *[F.col(f"_hit.{v}").alias(v) for v in values])


def previous_value(df: DataFrame, keys: list[str], order: str, value: str, alias: str) -> DataFrame:
    """Latest non-NULL value of strictly earlier rows; gaps are skipped."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(alias, F.last(value, ignorenulls=True).over(w))


def carry_forward(grid: DataFrame, keys: list[str], period: str, present: Column, lookback: int) -> DataFrame:
    """Own period where present, else the nearest earlier one within ``lookback`` periods."""
    w = Window.partitionBy(*keys).orderBy(period).rangeBetween(-lookback, 0)
    return grid.withColumn("from_period", F.last(F.when(present, F.col(period)), ignorenulls=True).over(w))


def calendar(df: DataFrame, start: Column, end: Column, step: str, alias: str) -> DataFrame:
    """One row per step between the two scalar bounds, for grids that show empty cells."""
    spine = df.limit(1).select(F.explode(F.sequence(start, end, F.expr(f"INTERVAL {step}"))).alias(alias))
    return spine.withColumn(alias, F.to_date(alias))


def full_grid(left: DataFrame, right: DataFrame, keys: list[str], left_only: str, right_only: str,
              relation: str = "relation") -> DataFrame:
    """Full outer join of two cell tables; the relation is NULL where both sides exist."""
    a = left.withColumn("_l", F.lit(True))
    b = right.withColumn("_r", F.lit(True))
    rel = F.when(F.col("_r").isNull(), F.lit(left_only)).when(F.col("_l").isNull(), F.lit(right_only))
    return a.join(b, keys, "full_outer").withColumn(relation, rel).drop("_l", "_r")


def replace_tokens(rows: DataFrame, row_key: list[str], group: list[str], text: str, labels: DataFrame,
                   token: str = "token", label: str = "label") -> DataFrame:
    """'<P07>' in ``text`` replaced by the label of (group, token); unknown tokens stay."""
    used = rows.select(*row_key, F.explode(F.array_distinct(
        F.regexp_extract_all(text, F.lit(r"<([PG]\d{2,})>"), 1))).alias(token))
    known = used.join(labels.select(*group, token, label), [*group, token]).groupBy(*row_key).agg(
        F.array_sort(F.collect_list(F.struct(token, label))).alias("_map"))
    joined = rows.join(known, row_key, "left")
    swapped = F.aggregate(
        F.coalesce("_map", F.array().cast(f"array<struct<{token}:string,{label}:string>>")), F.col(text),
        lambda acc, m: F.replace(acc, F.concat(F.lit("<"), m[token], F.lit(">")), m[label]))
    return joined.withColumn(text, swapped).drop("_map")
