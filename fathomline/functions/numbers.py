"""Number helpers: exact money sums, guarded ratios, scales and thresholds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money_sum(col: str | Column) -> Column:
    """Order-independent sum of a money column, returned as double."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast("decimal(18,2)")).cast("double")


def count_where(cond: Column) -> Column:
    """Rows for which ``cond`` holds (NULL counts as not)."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def rate(cond: Column, digits: int = 3) -> Column:
    """Share of rows for which ``cond`` holds, rounded."""
    return F.round(F.avg(F.coalesce(cond, F.lit(False)).cast("int")), digits)


def pct_change(now: Column, before: Column) -> Column:
    """(now - before) / |before|, NULL when a part is missing or the base is 0."""
    return F.try_divide(now - before, F.abs(before))


def safe_ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num, den)


def money_scale(currency: Column, unit: Column) -> Column:
    """Divisor that brings an amount to the display unit of its currency.

    Fixed values: TWD, JPY, KRW, CNY and HKD are shown in 100 millions, USD and
    other currencies in millions; amounts already in thousands or millions need
    the smaller rest.
    """
    target = F.when(F.upper(currency).isin("TWD", "JPY", "KRW", "CNY", "HKD"), F.lit(1e8)).otherwise(F.lit(1e6))
    have = (
        F.when(F.lower(unit) == "million", F.lit(1e6))
        .when(F.lower(unit) == "thousand", F.lit(1e3))
        .otherwise(F.lit(1.0))
    )
    return target / have


def lamp(value: Column, red: Column, yellow: Column, low: Column) -> Column:
    """Traffic light of a stock level: above red, above yellow, below low, else green."""
    return (
        F.when(value.isNull(), F.lit("none"))
        .when(value > red, F.lit("red"))
        .when(value > yellow, F.lit("yellow"))
        .when(value < low, F.lit("low"))
        .otherwise(F.lit("green"))
    )
