"""Training-data pipeline over ``documents``: five stages, each written and read again.

Every stage works on all rows its predecessor kept. All stages but the last return the
columns of ``documents``; the last adds the shard and the slot of each row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fathomline import session
from fathomline.llm import decontaminate, language_id, mixing, sharding, simhash
from fathomline.llm.queries import SEED, SOURCE_WEIGHTS
from fathomline.llm.registry import configure
from fathomline.sources.tables import Tables

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts without letters or far from every language go."""
    configure(spark)
    return language_id.confident(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    configure(spark)
    return simhash.deduplicated(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    configure(spark)
    return decontaminate.decontaminated(docs, Tables(spark, sf_dir).benchmark)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents so that sources reach their target weights, in random order."""
    configure(spark)
    return mixing.mixed(docs, SOURCE_WEIGHTS, 1.0, SEED).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with their shard and slot in a global random order."""
    configure(spark)
    return sharding.sharded(docs, seed=SEED)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", decontaminate_benchmark),
    ("source_mixing", mix_sources),
    ("sharding", shard),
]

# Language identification and fingerprints cannot be said in SQL; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read as the next one's input."""
    configure(spark)
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES[:-1]:
        docs = session.written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
