"""Joins and groupings that stay balanced when one key holds most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is joined by broadcast. At most
# (total rows / HOT_ROWS) keys can be that large, which bounds the broadcast.
HOT_ROWS = 1_000_000
SPREAD = 512


def attach_groups(
    facts: DataFrame,
    groups: DataFrame,
    keys: list[str],
    count_col: str,
    row_key: list[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join ``facts`` with ``groups`` (one row per key), safe for hot keys.

    ``count_col`` of ``groups`` is the number of fact rows of the key. Hot keys
    are few by construction and are broadcast; their fact rows are spread over
    many partitions of the shuffle join that serves all other keys.
    """
    values = [c for c in groups.columns if c not in keys and c != count_col]
    packed = F.struct(*values, count_col)
    hot = groups.where(F.col(count_col) > hot_rows).select(*keys, packed.alias("_hot"))
    cold = groups.where(F.col(count_col) <= hot_rows).select(
        *keys, packed.alias("_cold"), F.lit(0).cast("long").alias("_spread")
    )
    # a NULL key has no group, so its rows need not meet anywhere
    alone = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)) | F.col("_hot").isNotNull()
    marked = facts.join(F.broadcast(hot), keys, "left").withColumn(
        "_spread",
        F.when(alone, F.pmod(F.xxhash64(*row_key), F.lit(SPREAD)) + 1).otherwise(F.lit(0).cast("long")),
    )
    joined = marked.join(cold, [*keys, "_spread"], "left")
    found = F.coalesce("_hot", "_cold")
    return joined.select(
        *facts.columns, *[found[v].alias(v) for v in values], found[count_col].alias(count_col)
    )
