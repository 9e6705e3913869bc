"""Registration of queries with their check SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from fathomline import session
from fathomline.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under its own name.

    ``sql`` is the equivalent statement for the checking engine; leave it out
    when the operator cannot be said in SQL.
    """

    def register(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query registered twice: {key}")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            session.configure(spark)
            return fn(Tables(spark, sf_dir))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register
