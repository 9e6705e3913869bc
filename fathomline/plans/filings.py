"""Company filings: ratios, actuals, peers, durability, work planning, fact sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions import rules
from fathomline.functions.numbers import pct_change
from fathomline.operators import windows as wn

# Metrics with direction and the width of "close", quarter days, bands.
PEER_METRICS = {"revenue_yoy": (True, 1.0), "gross_margin": (True, 1.0), "operating_margin": (True, 1.0),
                "net_margin_parent": (True, 1.0), "inventory_days": (False, 5.0), "capex_to_revenue": (None, 1.0),
                "ocf_to_revenue": (True, 1.0), "debt_ratio": (False, 2.0)}
QUARTER_DAYS = 91.25
DEFAULT_BANDS = {"capex_to_revenue": (5, 20), "gross_margin": (15, 40), "inventory_days": (45, 120), "debt_ratio": (None, 60)}
OVERLAP = {"IT": "高", "車用": "高", "TV": "中", "手機": "低", "其他": "低"}


def ratio_metrics(quarterly: DataFrame, key: str, period: str) -> DataFrame:
    """revenue, cogs, inventory, ocf, capex per entity and quarter → ratio columns.

    The year before is found by the period key, so a missing quarter gives NULL.
    """
    y = wn.year_over_year(quarterly, key, period, "revenue", 4)
    rev, ocf, capex = F.col("revenue"), F.col("ocf"), F.abs("capex")
    return y.withColumns({
        "revenue_yoy": (F.try_divide(rev, F.col("year_ago")) - 1) * 100,
        "gross_margin": F.try_divide(rev - F.col("cogs"), rev) * 100,
        "inventory_days": F.try_divide(F.col("inventory"), F.col("cogs")) * QUARTER_DAYS,
        "capex_to_revenue": F.try_divide(capex, rev) * 100,
        "ocf_to_revenue": F.try_divide(ocf, rev) * 100,
        "ocf_to_capex": F.try_divide(ocf, capex),
        "fcf": ocf - capex,
    }).drop("year_ago", "yoy")


def delta_text(now: Column, before: Column, is_ratio: bool) -> Column:
    """Money changes in percent (text when the base is negative), ratios in points."""
    if is_ratio:
        return F.concat(F.format_number(now - before, 1), F.lit(" pt"))
    return F.when(before < 0, F.lit("from a negative base")).otherwise(
        F.concat(F.format_number(pct_change(now, before) * 100, 1), F.lit("%")))


def position(value: Column, median: Column, higher_is_better: bool | None, band: float) -> Column:
    """Better, close or worse than the median; metrics without direction have no position."""
    if higher_is_better is None:
        return F.lit(None).cast("string")
    d = value - median
    good = (d > 0) if higher_is_better else (d < 0)
    return F.when(F.abs(d) <= band, F.lit("接近")).when(good, F.lit("優")).when(d.isNotNull(), F.lit("劣"))


def grade(metric: str, value: Column, bands: dict[str, tuple] = DEFAULT_BANDS, trend: Column | None = None) -> Column:
    """g / w / b of a durability metric; NULL without a value."""
    lo, hi = bands.get(metric, (None, None))
    if metric == "growth_streak":
        chain = [("g", value >= 4), ("w", value >= 1), ("b", value.isNotNull())]
    elif metric == "capex_to_revenue":
        chain = [("w", (value > hi) | (value < lo)), ("g", value.isNotNull())]
    elif metric == "ocf_to_capex":
        chain = [("g", value >= 1.0), ("w", value >= 0.7), ("b", value.isNotNull())]
    elif metric == "fcf":
        chain = [("g", value > 0), ("b", value.isNotNull())]
    elif metric == "gross_margin":
        falling = (trend == "↓") if trend is not None else F.lit(False)
        chain = [("b", value < lo), ("w", value.isNotNull() & falling), ("g", value.isNotNull())]
    elif metric == "inventory_days":
        chain = [("w", value > hi), ("g", value.isNotNull())]
    else:
        chain = [("w", value >= hi), ("g", value.isNotNull())]
    return rules.decide(chain, None)


def work_plan(own: DataFrame, views: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """(key, period, digest) × views without an equal (key, period, view, digest) in the output."""
    wanted = own.join(views, key)
    return wanted.join(done.select(key, "period", "view_name", "digest"), [key, "period", "view_name", "digest"], "left_anti")


def kpi_cells(now: Column, before: Column) -> tuple[Column, Column]:
    """(growth, tone) of one figure."""
    growth = pct_change(now, before)
    return growth, rules.decide([("none", growth.isNull()), ("good", growth > 0), ("bad", growth < 0)], "flat")
