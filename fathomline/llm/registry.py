"""Registration of the queries of this folder with their check SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from fathomline import session
from fathomline.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Settings of the library, and shuffle files deleted once their result is written.

    The operators write intermediate tables to the shared folder, so the shuffles behind
    them are not read again; a large job would otherwise keep them all until it ends. Their
    Python steps work on arrays, so they take Spark's own number of rows; the bytes of a
    batch stay bounded, as texts beside the model of a worker and the heap must fit.
    """
    session.configure(spark)
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    return spark


def query(sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under its own name; ``sql`` is the statement it must equal."""

    def register(fn: Callable[[Tables], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(Tables(spark, sf_dir))

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register
