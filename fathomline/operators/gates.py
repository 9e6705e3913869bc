"""Data quality gates: one aggregate per table, thresholds as rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_rows(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Named counts of bad rows from one pass: (check_name, n_bad, ok)."""
    row = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    return row.unpivot([], list(checks), "check_name", "n_bad").withColumn("ok", F.col("n_bad") == 0)


def unique_key(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Surplus rows of repeated keys, as a check row."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_bad")).select(
        F.lit(name).alias("check_name"), "n_bad", (F.col("n_bad") == 0).alias("ok"))


def table_checks(df: DataFrame, keys: list[str], unique: str, checks: dict[str, Column], refs: dict[str, tuple[str, DataFrame, str]] | None = None) -> DataFrame:
    """Key, row and reference checks of a table from one scan: (check_name, n_bad, ok).

    ``unique`` names the check of ``keys``; ``refs`` maps a check to (column, dimension, its
    key). Bad rows are counted per key first, so repeated keys and bad rows come from one grouping.
    """
    bad = dict(checks)
    for name, (column, dim, dim_key) in (refs or {}).items():
        found = dim.select(F.col(dim_key).alias(f"_r_{name}")).distinct()
        df = df.join(found, F.col(column) == F.col(f"_r_{name}"), "left")
        bad[name] = F.col(f"_r_{name}").isNull()
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in bad.items()])
    row = per.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(unique), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in bad])
    return row.unpivot([], [unique, *bad], "check_name", "n_bad").withColumn("ok", F.col("n_bad") == 0)


def dangling(df: DataFrame, key: str, dim: DataFrame, dim_key: str, name: str) -> DataFrame:
    """Rows whose reference does not resolve, as a check row."""
    refs = dim.select(F.col(dim_key).alias(key))
    return df.join(refs, key, "left_anti").agg(F.count(F.lit(1)).alias("n_bad")).select(
        F.lit(name).alias("check_name"), "n_bad", (F.col("n_bad") == 0).alias("ok"))


def all_checks(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def close_to(actual: Column, expected: Column, tol: float = 1e-6) -> Column:
    return F.abs(actual.cast("double") - expected.cast("double")) <= tol


def graded(rates: DataFrame, limits: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """One row of rates → (measure, value, verdict): above the second limit stops, above the first warns."""
    long = rates.unpivot([], list(limits), "measure", "value")
    warn = F.create_map(*[x for m, (w, _) in limits.items() for x in (F.lit(m), F.lit(w).cast("double"))])
    stop = F.create_map(*[x for m, (_, s) in limits.items() for x in (F.lit(m), F.lit(s).cast("double"))])
    m = F.col("measure")
    verdict = F.when(F.col("value") > F.try_element_at(stop, m), F.lit("stop")).when(
        F.col("value") > F.try_element_at(warn, m), F.lit("warn")).otherwise(F.lit("ok"))
    return long.withColumn("verdict", verdict)
