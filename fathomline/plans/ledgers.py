"""Ledgers of topics: ids, evidence, counters and status, without a row-by-row pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions import text as tx
from fathomline.operators.numbering import row_numbers


def topic_plan(items: DataFrame, records: DataFrame, evidence: DataFrame, prefix: str, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """(targets, counters) of a run of reviewed items.

    items: item_key, dup_of, primary_id, dup_key, date, verified. The target is the
    named record if known, else the record of the primary, else the record the
    primary got in this run, else a new id numbered on from the largest one.
    Primaries are settled first, then same-text copies look theirs up. Evidence
    counts once per (record, item).
    """
    ids = records.select(F.col("record_id").alias("_known"))
    t = items.join(ids.withColumnRenamed("_known", "dup_of").withColumn("_k1", F.lit(True)), "dup_of", "left")
    t = t.join(ids.withColumnRenamed("_known", "primary_id").withColumn("_k2", F.lit(True)), "primary_id", "left")
    given = F.when(F.col("_k1"), F.col("dup_of")).when(F.col("_k2"), F.col("primary_id"))
    t = t.withColumn("given", given).drop("_k1", "_k2")
    primaries, copies = t.where(F.col("dup_key").isNull()), t.where(F.col("dup_key").isNotNull())
    settled = copies.join(primaries.select(F.col("item_key").alias("dup_key")), "dup_key", "left_semi")
    alone = copies.join(primaries.select(F.col("item_key").alias("dup_key")), "dup_key", "left_anti")
    fresh = primaries.where("given IS NULL").unionByName(alone.where("given IS NULL"))
    top = records.agg(F.coalesce(F.max(F.regexp_extract("record_id", r"(\d+)$", 1).cast("long")), F.lit(0))).scalar()
    numbered = row_numbers(fresh.select("item_key", *[o.alias(f"_o{i}") for i, o in enumerate(order)]), [], [F.col(f"_o{i}") for i in range(len(order))], "_n")
    new_ids = numbered.select("item_key", F.concat(F.lit(prefix), F.format_string("%06d", top + F.col("_n"))).alias("new_id"))
    firsts = primaries.unionByName(alone).join(new_ids, "item_key", "left").withColumn("target", F.coalesce("given", "new_id"))
    of_primary = firsts.select(F.col("item_key").alias("dup_key"), F.col("target").alias("_p"))
    seconds = settled.join(of_primary, "dup_key").withColumn("target", F.coalesce("given", "_p")).withColumn(
        "new_id", F.lit(None).cast("string")).drop("_p")
    targets = firsts.unionByName(seconds, allowMissingColumns=True).select("item_key", "target", "new_id", "date", "verified")
    seen = evidence.select(F.col("record_id").alias("target"), "item_key").distinct().withColumn("_seen", F.lit(True))
    targets = targets.join(seen, ["target", "item_key"], "left")
    action = (F.when(F.col("new_id").isNotNull(), F.lit("new")).when(F.col("_seen"), F.lit("evidence_exists"))
              .otherwise(F.lit("add_evidence")))
    targets = targets.withColumn("action", action).drop("_seen", "new_id")
    gained = targets.where("action <> 'evidence_exists'").groupBy(F.col("target").alias("record_id")).agg(
        F.count(F.lit(1)).alias("_gain"), F.max("date").alias("_last"), F.max("verified").alias("_any_y"))
    counters = records.join(gained, "record_id", "full_outer").select(
        "record_id", (F.coalesce("n_evidence", F.lit(0)) + F.coalesce("_gain", F.lit(0))).alias("n_evidence"),
        F.greatest("last_date", "_last").alias("last_date"),
        F.when(F.coalesce("status", F.lit("unreviewed")) == "unreviewed",
               F.when(F.coalesce("_any_y", F.lit(False)), F.lit("confirmed")).otherwise(F.lit("unreviewed"))).otherwise(
            F.col("status")).alias("status"))
    return targets, counters


def intel_plan(items: DataFrame, term: Column, order: list[str]) -> DataFrame:
    """Items grouped by (app, normalised term): the newest evidence gives the text, every
    primary counts once, copies never, one confirmed item makes the topic active."""
    keyed = items.withColumn("term_norm", tx.loose_key(term))
    newest = F.struct(*order)
    return keyed.groupBy("app", "term_norm").agg(
        F.min(newest).alias("_first"), F.max(F.struct("date", *order)).alias("_last"),
        F.count(F.when(F.col("dup_key").isNull(), F.lit(1))).alias("n_updates"), F.max("date").alias("last_date"),
        F.max(F.col("verified").cast("int")).alias("_y"),
    ).select("app", "term_norm", F.col(f"_first.{order[-1]}").alias("first_item"), F.col(f"_last.{order[-1]}").alias("shown_item"),
             "n_updates", "last_date", F.when(F.col("_y") == 1, F.lit("active")).otherwise(F.lit("unreviewed")).alias("status"))


def review_reasons(category: Column, differs: Column, confidence: Column, low: float = 0.6) -> Column:
    """Why a row still wants a look, joined by ';'."""
    return F.concat_ws(";", F.when(category.isin("semantic", "intel"), F.concat(F.lit("category:"), category)),
                       F.when(differs, F.lit("differs_from_prior")), F.when(confidence < low, F.lit("low_confidence")))
