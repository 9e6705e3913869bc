"""Naming an intermediate value inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it.

    Without it a value used ten times is written out ten times in the plan, and
    nested uses multiply.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def fenced(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add expensive columns in a step of their own.

    The optimizer merges plain projections into a later one that calls Python, and
    then repeats the expressions at every use. A generator over one element keeps
    the step apart, and every value is computed once per row.
    """
    packed = F.struct(*[c.alias(n) for n, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.explode(F.array(packed)).alias("_fenced")).select(*kept, "_fenced.*")
