"""Structured responses kept as JSON text → validated item rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.functions import jsons
from fathomline.functions import text as tx

# Vocabularies and limits.
STATEMENT_TYPES = ["fact", "plan", "request", "decision", "issue", "opinion", "definition"]
TOPIC_TAGS = ["demand", "allocation", "price", "cost", "product_plan", "spec", "schedule", "supply_chain",
              "capacity", "quality", "engineering", "commercial_relation", "terminology", "admin"]
MAX_ITEMS = 40
MAX_TAGS = 3
SPEAKERLESS_CAP = 0.7
RESPONSE = ("struct<items:array<struct<statement_type:string,summary:string,quote:string,topic_tags:array<string>,"
            "event_date:string,confidence:double,speaker_token:string>>,segment_note:string>")


def validated_items(responses: DataFrame, key: str) -> DataFrame:
    """(key, response, clean_text, segment_date) → one row per item, or one row that tells why there is none.

    Failed rows are kept with their status: bad JSON or missing fields, a quote
    that the text does not contain, an empty answer.
    """
    parsed = responses.withColumn("p", F.from_json(jsons.salvage(F.col("response")), RESPONSE))
    items = F.col("p.items")
    whole = F.when(items.isNull() | (F.size(items) > MAX_ITEMS), F.lit("failed_schema")).when(F.size(items) == 0, F.lit("empty"))
    rows = parsed.select(
        key, "clean_text", "segment_date", whole.alias("whole"), F.col("p.segment_note").alias("note"),
        F.posexplode_outer(F.when(whole.isNull(), items)).alias("pos", "it"))
    kind = F.lower(F.trim("it.statement_type"))
    vocab, tags_known = F.array(*[F.lit(s) for s in STATEMENT_TYPES]), F.array(*[F.lit(s) for s in TOPIC_TAGS])
    quote, summary = tx.blank_to_null(F.col("it.quote")), tx.blank_to_null(F.col("it.summary"))
    bad = ~F.coalesce(F.array_contains(vocab, kind), F.lit(False)) | summary.isNull() | quote.isNull()
    status = (
        F.coalesce(F.col("whole"), F.when(bad, F.lit("failed_schema"))
                   .when(~tx.quote_in_text(quote, F.col("clean_text")), F.lit("failed_quote")).otherwise(F.lit("ok"))))
    listed = F.array_distinct(F.transform(F.coalesce("it.topic_tags", F.array().cast("array<string>")), lambda x: F.lower(F.trim(x))))
    known = F.slice(F.filter(listed, lambda x: F.array_contains(tags_known, x)), 1, MAX_TAGS)
    free = F.filter(listed, lambda x: ~F.array_contains(tags_known, x))
    date = F.when(F.trim("it.event_date").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.trim("it.event_date").try_cast("date"))
    given = F.col("it.confidence")
    conf = F.when(given.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), given)))
    capped = F.when(tx.blank_to_null(F.col("it.speaker_token")).isNull(), F.when(
        conf.isNotNull(), F.least(conf, F.lit(SPEAKERLESS_CAP)))).otherwise(conf)
    return rows.select(
        key, (F.coalesce("pos", F.lit(0)) + 1).alias("item_no"), status.alias("extract_status"),
        F.when(F.array_contains(vocab, kind), kind).alias("statement_type"),
        F.coalesce(summary, F.col("note")).alias("summary"), F.array_join(known, "|").alias("topic_tags"),
        F.array_join(free, "|").alias("free_tags"), F.coalesce(date, F.col("segment_date")).alias("event_date"),
        F.when(date.isNull(), F.lit("fallback")).otherwise(F.lit("inline")).alias("date_basis"), capped.alias("confidence"))
