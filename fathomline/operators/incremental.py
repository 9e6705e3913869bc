"""Batch increments against stored state."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.operators.keyed import pick_per_key


def newer_than(source: DataFrame, arrival: str, *stored: DataFrame, first: str = "1970-01-01") -> DataFrame:
    """Source rows that arrived after everything stored (kept and quarantined alike).

    The high-water mark is a scalar subquery, so the comparison reaches the scan.
    """
    seen = reduce(DataFrame.unionByName, [s.select(arrival) for s in stored])
    mark = seen.agg(F.coalesce(F.max(arrival), F.lit(first).cast(source.schema[arrival].dataType))).scalar()
    return source.where(F.col(arrival) > mark)


def with_stale_versions(due: DataFrame, source: DataFrame, stored: DataFrame, key: str, version_col: str,
                        version: str) -> DataFrame:
    """Add rows whose stored form came from another rule version; one row per key."""
    stale = stored.where(~F.col(version_col).eqNullSafe(F.lit(version))).select(key)
    return due.unionByName(source.join(stale, key, "left_semi")).dropDuplicates([key])


def forced_or_range(source: DataFrame, due: DataFrame, key: str, date_col: str, *, start: str | None = None,
                    end: str | None = None, force: list | None = None) -> DataFrame:
    """A closed date range replaces the increment; forced keys are always added."""
    batch = source.where(F.col(date_col).between(F.lit(start), F.lit(end))) if start and end else due
    if force:
        batch = batch.unionByName(source.where(F.col(key).isin(force)))
    return batch.dropDuplicates([key])


def state_due(source: DataFrame, state: DataFrame, key: list[str], source_time: str, state_time: str,
              version_col: str, version: Column) -> DataFrame:
    """Source rows whose state is missing, older, or of another version."""
    joined = source.join(state, key, "left")
    return joined.where(
        F.col(state_time).isNull() | (F.col(source_time) > F.col(state_time))
        | ~F.col(version_col).eqNullSafe(version)
    ).select(*source.columns)


def retry_queue(docs: DataFrame, attempts: DataFrame, key: str, *, parser: str, max_attempts: int,
                newest: list[Column], force: Column | None = None) -> DataFrame:
    """Work list with the number of attempts so far.

    Due: never tried, tried by another parser (restarts at 0), or last attempt not
    a success and fewer than ``max_attempts``. Forced rows are always due.
    """
    last = pick_per_key(attempts, [key], newest).select(key, "status", "attempt", "parser")
    joined = docs.join(last, key, "left")
    other = ~F.col("parser").eqNullSafe(F.lit(parser))
    tried = F.when(other, F.lit(0)).otherwise(F.col("attempt"))
    due = other | ((F.col("status") != "success") & (F.col("attempt") < max_attempts))
    if force is not None:
        due = due | force
    return joined.where(due).select(*docs.columns, tried.cast("int").alias("attempt"))


def pending_segments(segments: DataFrame, items: DataFrame, keys: list[str], version: str, *,
                     retry_failed: bool = True, forced: Column | None = None) -> DataFrame:
    """Extractable, non-duplicate segments without a live result of this version.

    A segment with any failed row counts as not done when failures are retried;
    forced segments come back always.
    """
    base = segments.where(F.col("extractable") & F.col("dup_of").isNull())
    live = items.where(~F.col("superseded") & (F.col("version") == version))
    if retry_failed:
        failed = live.where(F.col("status").startswith("failed")).select(*keys).distinct()
        live = live.join(failed, keys, "left_anti")
    due = base.join(live.select(*keys).distinct(), keys, "left_anti")
    if forced is not None:
        due = due.unionByName(base.where(forced)).dropDuplicates(keys)
    return due


def by_priority(parts: dict[str, DataFrame], keys: list[str], reason: str = "reason") -> DataFrame:
    """Union of reasons; a key keeps its most important one (first in the dict)."""
    tagged = [
        df.select(*keys).withColumn("_p", F.lit(i)).withColumn(reason, F.lit(name))
        for i, (name, df) in enumerate(parts.items())
    ]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy(*keys).agg(F.min(F.struct("_p", reason)).alias("_top"))
        .select(*keys, F.col(f"_top.{reason}").alias(reason))
    )


def group_digest(df: DataFrame, keys: list[str], row_hash: Column, extra: list[Column] | None = None) -> DataFrame:
    """Change digest of the rows of a key, free of order and of group size.

    A multiset hash of 256 bits: the four 64-bit words of each row's SHA-256 are summed
    modulo 2**64 each, which combines before the shuffle; a sorted list of all hashes would
    put a whole group into one task. A null row counts like an empty one.
    """
    whole = F.sha2(F.coalesce(row_hash, F.lit("")), 256)
    word = lambda k: F.conv(F.substring(whole, 16 * k + 1, 16), 16, 10).cast("decimal(38,0)")
    sums = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(word(k)).alias(f"_{k}") for k in range(4)])
    size = F.lit(str(2**64)).cast("decimal(38,0)")
    parts = [F.col("n_rows").cast("string"), *[(F.col(f"_{k}") % size).cast("string") for k in range(4)], *(extra or [])]
    return sums.select(*keys, "n_rows", F.sha2(F.concat_ws("|", *parts), 256).alias("digest"))


def sequence_gaps(batches: DataFrame, keys: list[str], seq: str, prev: str, complete: Column) -> DataFrame:
    """Batches that do not follow their predecessor, or are not complete yet."""
    before = F.lag(seq).over(Window.partitionBy(*keys).orderBy(seq))
    state = (
        F.when(~complete, F.lit("waiting"))
        .when(before.isNull(), F.lit("first"))
        .when(F.col(prev) == before, F.lit("ok"))
        .otherwise(F.lit("gap"))
    )
    return batches.withColumn("state", state)


def failed_attempts(work: DataFrame, error: Column, now: Column) -> DataFrame:
    """Result rows of work that produced nothing: failed, one attempt more, no payload."""
    return work.withColumns({
        "status": F.lit("failed"), "attempt": F.col("attempt") + 1, "error": error,
        "payload": F.lit(None).cast("string"), "parsed_at": now,
    })


def is_stale(generated_at: Column, now: Column, max_age_hours: int) -> Column:
    """Missing or older than the limit."""
    age = F.timestamp_diff("HOUR", generated_at, now)
    return generated_at.isNull() | (age >= max_age_hours)


def colliding_keys(df: DataFrame, coarse: list[str], value: str) -> DataFrame:
    """Values that fall together when only the coarse key is used."""
    pairs = df.select(*coarse, value).distinct()
    return pairs.groupBy(*coarse).agg(F.count(value).alias("n_values")).where("n_values > 1")
