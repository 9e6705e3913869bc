"""Strict delimited files and inline seed text."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_strict_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The header must equal the declared names, a bad value fails the job, empty is NULL."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("dateFormat", "yyyy-MM-dd")
        .option("multiLine", False)
        .csv(path)
    )


def require_count(df: DataFrame, expected: DataFrame, expected_col: str) -> DataFrame:
    """One row (loaded, expected, ok); the job fails on it when the counts differ."""
    both = df.agg(F.count(F.lit(1)).alias("loaded"),
                  F.any_value(expected.select(expected_col).scalar()).alias("expected"))
    ok = F.when(F.col("loaded") == F.col("expected"), F.lit(True)).otherwise(
        F.raise_error(F.lit("loaded row count differs from the manifest"))
    )
    return both.withColumn("ok", ok.cast("boolean"))


def seed_rows(spark: SparkSession, text: str, columns: list[str]) -> DataFrame:
    """Inline seed text → rows: the header must match, values are trimmed, blank is NULL."""
    rows = list(csv.reader(io.StringIO(text.strip())))
    header = [h.strip() for h in rows[0]]
    if header != columns:
        raise ValueError(f"seed header {header} is not {columns}")
    data = [tuple(v.strip() or None for v in row) for row in rows[1:] if any(v.strip() for v in row)]
    return spark.createDataFrame(data, StructType([StructField(c, StringType(), True) for c in columns]))
