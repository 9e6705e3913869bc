"""JSON text: tolerant parses, number lists, salvage of damaged replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_text(c: Column, path: str) -> Column:
    return F.get_json_object(c, path)


def number_values(c: Column) -> Column:
    """Array of {value, unit} from a JSON list; bad JSON is empty, thousands separators
    are removed, booleans, objects and text without a number are skipped."""
    rows = F.from_json(c, "array<struct<value:string,unit:string>>")
    parsed = F.transform(
        F.coalesce(rows, F.from_json(F.lit("[]"), "array<struct<value:string,unit:string>>")),
        lambda r: F.struct(
            F.replace(r["value"], F.lit(","), F.lit("")).try_cast("double").alias("value"),
            F.lower(F.trim(F.coalesce(r["unit"], F.lit("")))).alias("unit")),
    )
    return F.filter(parsed, lambda r: r["value"].isNotNull())


def salvage(c: Column) -> Column:
    """Code fence stripped, first { to last } kept, trailing commas dropped; NULL without an object."""
    t = F.regexp_replace(F.trim(c), r"(?im)^```(?:json)?\s*|\s*```$", "")
    body = F.regexp_extract(t, r"(?s)(\{.*\})", 1)
    return F.nullif(F.regexp_replace(body, r",\s*([}\]])", "$1"), F.lit(""))
