"""Period windows. All frames run over one row per entity and period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.functions.numbers import pct_change
from fathomline.operators.keyed import pick_per_key


def year_over_year(df: DataFrame, key: str, period: str, value: str, periods: int) -> DataFrame:
    """Same period a year earlier found by its number, so a missing period stays missing; one row per key and period, read once."""
    year_ago = F.first(value).over(Window.partitionBy(key).orderBy(period).rangeBetween(-periods, -periods))
    return df.withColumn("year_ago", year_ago).withColumn("yoy", pct_change(F.col(value), F.col("year_ago")))


def last_n(df: DataFrame, key: str, period: str, n: int, until: int | None = None) -> DataFrame:
    """The n newest periods up to ``until``; gaps are not filled."""
    kept = df if until is None else df.where(F.col(period) <= until)
    return pick_per_key(kept, [key], [F.desc(period)], n)


def with_trend(df: DataFrame, key: str, period: str, value: str) -> DataFrame:
    """Three newest values strictly rising or falling, else flat; fewer than three give a dash."""
    w = Window.partitionBy(key).orderBy(period)
    now, one, two = F.col(value), F.lag(value, 1).over(w), F.lag(value, 2).over(w)
    trend = (
        F.when(now.isNull() | one.isNull() | two.isNull(), F.lit("—"))
        .when((now > one) & (one > two), F.lit("↑"))
        .when((now < one) & (one < two), F.lit("↓"))
        .otherwise(F.lit("→"))
    )
    return df.withColumn("trend", trend)


def quadrant(x: Column, y: Column, mid_x: Column, mid_y: Column) -> Column:
    """Position against two medians; a missing part gives NULL."""
    growth = F.when(x >= mid_x, F.lit("高成長")).otherwise(F.lit("低成長"))
    profit = F.when(y >= mid_y, F.lit("高獲利")).otherwise(F.lit("低獲利"))
    known = x.isNotNull() & y.isNotNull() & mid_x.isNotNull() & mid_y.isNotNull()
    return F.when(known, F.concat(growth, F.lit("・"), profit))
