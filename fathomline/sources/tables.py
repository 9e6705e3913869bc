"""Named tables of one data folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """Lazy access to the parquet tables of a folder: ``Tables(spark, dir).orders``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def spread(self, name: str, key: str) -> DataFrame:
        """The table over all cores, for heavy work per row. Only a table with fewer
        file splits than cores is moved; larger ones are read as they are."""
        df = getattr(self, name)
        cores = self.spark.sparkContext.defaultParallelism
        return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def scan(df: DataFrame, columns: list[str], where: Column | None = None) -> DataFrame:
    """Filter first, then keep the needed columns, so both reach the scan."""
    kept = df if where is None else df.where(where)
    return kept.select(*columns)


def tagged_union(frames: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """Union of same-shaped frames, each row carrying the label it came from."""
    tagged = [df.withColumn(tag, F.lit(label)) for label, df in frames.items()]
    return reduce(DataFrame.unionByName, tagged)
