"""Merges of a batch into a table as DataFrame algebra.

Parquet tables take no MERGE statement, so each shape of merge is one full
outer join on the (null-safe) key followed by a per-column choice. Result rows
are the target rows plus at most the source rows; hot keys cannot arise since
both sides are unique on the key, which the source side enforces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_source(source: DataFrame, keys: list[str]) -> DataFrame:
    """Fail while running if the source holds a key twice, as a merge must."""
    values = [c for c in source.columns if c not in keys]
    grouped = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(F.lit(1).alias("_one"), *values)).alias("_row"))
    checked = F.when(
        F.col("_n") > 1, F.raise_error(F.lit(f"merge source repeats a key of {keys}"))
    ).otherwise(F.col("_row"))
    # the keys stay the grouping columns, so a join on them needs no second shuffle
    return grouped.select(*keys, checked.alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in source.columns])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def null_key(keys: list[str]) -> Column:
    """True when any key column is NULL."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def paired(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """Full outer join giving struct columns ``t`` and ``s`` (NULL where a side is missing)."""
    t = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys], F.struct(*target.columns).alias("t"))
    s = unique_source(source, keys).select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.struct(*source.columns).alias("s"))
    cond = F.lit(True)
    for k in keys:
        left, right = F.col(f"_t_{k}"), F.col(f"_s_{k}")
        cond = cond & (left.eqNullSafe(right) if null_safe else left == right)
    return t.join(s, cond, "full_outer").select("t", "s")


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    *,
    update_when: Column | None = None,
    protect: list[str] | None = None,
    insert_only: list[str] | None = None,
    on_update: dict[str, Column] | None = None,
    on_insert: dict[str, Column] | None = None,
    on_missing: dict[str, Column] | None = None,
    update: bool = True,
    null_safe: bool = False,
) -> DataFrame:
    """Upsert ``source`` into ``target``.

    ``update_when``  condition over ``t.*`` and ``s.*`` for a matched row
    ``protect``      columns kept on update and NULL on insert (human input)
    ``insert_only``  columns set on insert and kept on update (created_at)
    ``on_update`` / ``on_insert`` / ``on_missing``  columns set by expression for
    updated rows, new rows, and target rows that the source lacks
    """
    protect, insert_only = protect or [], insert_only or []
    on_update, on_insert, on_missing = on_update or {}, on_insert or {}, on_missing or {}
    has_t, has_s = F.col("t").isNotNull(), F.col("s").isNotNull()
    changed = F.lit(update) if update_when is None else F.coalesce(update_when, F.lit(False))
    source_cols = set(source.columns)
    out = []
    for field in target.schema.fields:
        c = field.name
        old = F.col(f"t.{c}")
        new = F.col(f"s.{c}") if c in source_cols else F.lit(None).cast(field.dataType)
        inserted = on_insert.get(c, F.lit(None).cast(field.dataType) if c in protect else new)
        if c in on_update:
            updated = on_update[c]
        elif c in protect or c in insert_only or c not in source_cols:
            updated = old
        else:
            updated = new
        value = (
            F.when(has_t & has_s & changed, updated)
            .when(has_t & has_s, old)
            .when(has_s, inserted)
            .otherwise(on_missing.get(c, old))
        )
        out.append(value.cast(field.dataType).alias(c))
    return paired(target, source, keys, null_safe).select(*out)


def insert_new(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Append source rows whose key the target does not hold; never touch stored rows."""
    fresh = source.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh)


def replace_batch(target: DataFrame, batch: DataFrame, batch_keys: list[str]) -> DataFrame:
    """Drop the target rows of the batch keys, then append the batch: reruns change nothing."""
    gone = batch.select(*batch_keys).distinct()
    return target.join(gone, batch_keys, "left_anti").unionByName(batch)


def delete_keys(target: DataFrame, victims: DataFrame, keys: list[str]) -> DataFrame:
    """Remove all rows whose null-safe key is listed."""
    v = victims.select(*[F.col(k).alias(f"_v_{k}") for k in keys]).distinct()
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_v_{k}"))
    return target.join(v, cond, "left_anti")


def supersede_append(
    target: DataFrame, batch: DataFrame, segment_keys: list[str], flag: str = "superseded"
) -> DataFrame:
    """Mark live rows of the batch's segments superseded, keep them, append the batch."""
    touched = batch.select(*segment_keys).distinct().withColumn("_hit", F.lit(True))
    marked = (
        target.join(touched, segment_keys, "left")
        .withColumn(flag, F.col(flag) | F.coalesce("_hit", F.lit(False)))
        .drop("_hit")
    )
    return marked.unionByName(batch)


def deactivate_missing(
    target: DataFrame, batch: DataFrame, keys: list[str], in_scope: Column, flag: str = "active"
) -> DataFrame:
    """Switch off in-scope rows that the new batch lacks; an empty batch switches nothing off."""
    have = batch.select(*keys).distinct().withColumn("_hit", F.lit(True))
    not_empty = batch.agg(F.count(F.lit(1)) > 0).scalar()
    return (
        target.join(have, keys, "left")
        .withColumn(flag, F.col(flag) & ~(in_scope & not_empty & F.col("_hit").isNull()))
        .drop("_hit")
    )


def differs(columns: list[str], left: str = "t", right: str = "s") -> Column:
    """True when any column differs, NULL-safe."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | ~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond


def soft_delete_merge(
    target: DataFrame, source: DataFrame, keys: list[str], compare: list[str], now: Column,
    active: str = "is_active", touched: str = "updated_at",
) -> DataFrame:
    """Dimension sync: change or return of a row updates it and its time stamp,
    a row missing from the source becomes inactive, a new row is added active."""
    src = source.select(*keys, *compare)
    was_active = F.col(f"t.{active}")
    return merge(
        target, src, keys,
        update_when=differs(compare) | ~was_active,
        on_update={active: F.lit(True), touched: now},
        on_insert={active: F.lit(True), touched: now},
        on_missing={active: F.lit(False), touched: F.when(was_active, now).otherwise(F.col(f"t.{touched}"))},
    )


def dimension_diff(target: DataFrame, source: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """How many rows a sync would insert, update, deactivate or leave."""
    action: Callable[[str], Column] = F.lit
    kind = (
        F.when(F.col("t").isNull(), action("insert"))
        .when(F.col("s").isNull(), action("deactivate"))
        .when(differs(compare), action("update"))
        .otherwise(action("same"))
    )
    return paired(target, source.select(*keys, *compare), keys).groupBy(kind.alias("action")).agg(
        F.count(F.lit(1)).alias("n")
    )
