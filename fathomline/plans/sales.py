"""Sales tables: newest filing, previous filing, year ends, quarters, aligned series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.numbers import pct_change
from fathomline.operators import joins as jn
from fathomline.operators.aggregates import complete_quarters
from fathomline.operators.keyed import latest_per_key


def newest_values(filings: DataFrame, keys: list[str], *newest_first: str) -> DataFrame:
    """One value per member and target period: the newest of all filings counts."""
    return latest_per_key(filings, keys, *newest_first)


def yearly_table(monthly: DataFrame, member: str, period: str, value: str, asked: int, lookback: int | None = 6) -> DataFrame:
    """Per member: the filing in use at ``asked`` (yyyymm) or within the months before, the
    filing before it, and the last filings of the two years before.

    ``monthly`` has one row per member and period. ``lookback`` None is the first
    version of the table: only members that filed in the asked month appear.
    """
    year = asked // 100
    floor = asked if lookback is None else _minus(asked, lookback)
    rows = jn.previous_value(monthly, [member], period, value, "_before")
    def last(cond: Column) -> Column:
        return F.max(F.when(cond, F.struct(F.col(period).alias("p"), F.col(value).alias("v"), F.col("_before").alias("b"))))

    def year_end(y: int) -> Column:
        return last(F.floor(F.col(period) / 100) == y)["v"]
    ytd = F.sum(F.when((F.floor(F.col(period) / 100) == year) & (F.col(period) <= asked), F.col(value).cast("decimal(28,2)"))).cast("double")
    agg = rows.groupBy(member).agg(
        last((F.col(period) <= asked) & (F.col(period) >= floor)).alias("cur"), year_end(year - 1).alias("year_end_1"),
        year_end(year - 2).alias("year_end_2"), ytd.alias("ytd"))
    return agg.where("cur IS NOT NULL").select(
        member, F.col("cur.p").alias("as_of"), F.col("cur.v").alias("current"), F.col("cur.b").alias("previous"), "year_end_1",
        "year_end_2", "ytd", F.try_divide("ytd", "year_end_1").alias("hit"), (F.col("cur.p") < asked).alias("carried"))


def _minus(period: int, months: int) -> int:
    serial = period // 100 * 12 + period % 100 - 1 - months
    return serial // 12 * 100 + serial % 12 + 1


def quarter_table(monthly: DataFrame, member: str, quarter: str, month: str, value: str) -> DataFrame:
    """Complete quarters with growth over the quarter before, and a total row per quarter
    that sums the complete members only."""
    q = complete_quarters(monthly, [member], quarter, month, value)
    total = q.groupBy(quarter).agg(
        F.sum(F.col("quarter_total").cast("decimal(28,2)")).cast("double").alias("quarter_total"),
        F.min("months_present").alias("months_present")).withColumn(member, F.lit(-1).cast(q.schema[member].dataType))
    rows = q.unionByName(total)
    before = rows.select(member, (F.col(quarter) + 1).alias(quarter), F.col("quarter_total").alias("_b"))
    return rows.join(before, [member, quarter], "left").withColumn("qoq", pct_change(F.col("quarter_total"), F.col("_b"))).drop("_b")


def aligned_series(monthly: DataFrame, member: str, serial: str, value: str, last: int, n: int) -> DataFrame:
    """The last ``n`` months for every member on one axis; a missing month stays NULL."""
    axis = F.explode(F.sequence(F.lit(last - n + 1), F.lit(last))).alias(serial)
    grid = monthly.select(member).distinct().select(member, axis)
    return grid.join(monthly.select(member, serial, value), [member, serial], "left")


def stale_members(members: DataFrame, last_filed: DataFrame, key: str, asked: int) -> DataFrame:
    """Members without a filing of the asked period, and the period they are carried from."""
    j = members.join(last_filed, key, "left")
    return j.where(F.col("last_period").isNull() | (F.col("last_period") < asked))


def tolerance(actual: Column, plan: Column, limit: float = 0.05) -> Column:
    """True when the sum leaves the plan by more than the tolerance; NULL without a plan."""
    return F.abs(F.try_divide(actual - plan, plan)) > limit
