"""Pages, samples and budgets over a total order. The limit is the feature here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def take_range(df: DataFrame, order: list[Column], from_no: int, to_no: int) -> DataFrame:
    """Rows number ``from_no`` … ``to_no`` of a total order."""
    if not 1 <= from_no <= to_no:
        raise ValueError(f"bad range {from_no}..{to_no}")
    return df.orderBy(*order).offset(from_no - 1).limit(to_no - from_no + 1)


def hash_sample(df: DataFrame, key: str, seed: int, n: int) -> DataFrame:
    """n rows in the order of a seeded hash: repeatable on any partitioning."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(h, F.col(key)).limit(n)


def budgeted(df: DataFrame, oldest_first: list[Column], budget: int) -> DataFrame:
    """The oldest rows up to the budget of one run."""
    return df.orderBy(*oldest_first).limit(budget)
