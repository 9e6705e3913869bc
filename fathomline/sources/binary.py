"""Binary documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_binary(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """(path, length, content) of every file; the scheme prefix is stripped from the path."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.\-]*:/*", "/").alias("path"), "length", "content"
    )
