"""Picks per key: latest, first, top-n, priority, duplicates of the first arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.operators.skew import HOT_ROWS, attach_groups


def pick_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in ``order``.

    Spark limits each group before the shuffle (WindowGroupLimit), so at most
    ``n`` rows per key leave a task however large the key is.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def top_n_ranked(df: DataFrame, keys: list[str], order: list[Column], n: int, alias: str = "rank_no") -> DataFrame:
    """As :func:`pick_per_key`, keeping the position as a column."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(alias, F.row_number().over(w)).where(F.col(alias) <= n)


def latest_per_key(df: DataFrame, keys: list[str], *newest_first: str) -> DataFrame:
    """Newest row per key; ties are broken by the later columns, all descending."""
    return pick_per_key(df, keys, [F.col(c).desc() for c in newest_first])


def duplicate_of_first(
    df: DataFrame,
    hash_col: str,
    order: list[str],
    ref: list[str],
    pool: DataFrame | None = None,
    alias: str = "dup_of",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Point every later copy at the first arrival of its hash; NULL hashes stay out.

    ``pool`` holds rows stored earlier: rows of this batch replace their stored
    form, then the first arrival is sought over both. The first arrival is a
    minimum per hash (combined before the shuffle), and the join back spreads
    hashes with very many copies.
    """
    slim = [*dict.fromkeys([hash_col, *order, *ref])]
    seen = df.select(*slim)
    if pool is not None:
        kept = pool.join(df.select(*ref), ref, "left_anti").select(*slim)
        seen = seen.unionByName(kept)
    first = (
        seen.where(F.col(hash_col).isNotNull())
        .groupBy(hash_col)
        .agg(F.min(F.struct(*dict.fromkeys([*order, *ref]))).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .where(F.col("_copies") > 1)
    )
    first = first.select(hash_col, F.struct(*[F.col(f"_first.{r}") for r in ref]).alias("_primary"), "_copies")
    joined = attach_groups(df, first, [hash_col], "_copies", ref, hot_rows)
    own = F.struct(*ref)
    return joined.withColumn(alias, F.when(F.col("_primary") != own, F.col("_primary"))).drop("_primary", "_copies")
