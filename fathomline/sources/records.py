"""The raw record layer and its typed parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def raw_records(df: DataFrame, batch_id: Column, seq: Column, record_type: Column, payload: Column,
                key: Column, path: Column, ingested_at: Column) -> DataFrame:
    """One raw row per delivered record; the payload text is stored unaltered."""
    return df.select(
        batch_id.alias("batch_id"), seq.alias("seq"), record_type.alias("record_type"), path.alias("batch_path"),
        key.alias("record_key"), F.sha2(payload, 256).alias("sha256"),
        F.octet_length(payload).cast("long").alias("bytes"), payload.alias("payload"),
        ingested_at.alias("ingested_at"),
    )


def typed(df: DataFrame, record_type: str, schema: StructType | str, payload: str = "payload") -> DataFrame:
    """Rows of one record type with ``payload`` parsed by a partial schema into ``p``:
    unknown keys are ignored, missing keys are NULL."""
    return df.where(F.col("record_type") == record_type).withColumn("p", F.from_json(payload, schema))
