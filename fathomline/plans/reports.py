"""Weekly ingestion report and news staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.dates import week_start
from fathomline.functions.rules import map_value
from fathomline.operators.incremental import newer_than


# Weight of a news source, 2 for all others.
SOURCE_WEIGHTS = {
    "DIGITIMES": 5, "TrendForce": 5, "The Elec": 5,
    "工商時報": 4, "經濟日報網": 4, "經濟日報": 4, "電子時報": 4, "CNBC": 4, "Reuters": 4, "Bloomberg": 4, "Nikkei": 4,
    "今周刊": 3, "資訊時報": 3, "時報資訊": 3, "面板新聞網": 3, "旺得富": 3, "中時新聞網": 3, "自由時報": 3,
    "聯合報": 2, "中央社": 2, "MoneyDJ": 2,
}
DEFAULT_WEIGHT = 2


def source_weight(source: Column, weights: dict[str, int] | None = None) -> Column:
    listed = {k: str(v) for k, v in (weights or SOURCE_WEIGHTS).items()}
    return map_value(source, listed, F.lit(str(DEFAULT_WEIGHT))).cast("int")


def weekly_report(df: DataFrame, source: str, at: str, sender: str, first_week: str, last_week: str) -> DataFrame:
    """Rows, senders and new senders per source and week, with zero for empty cells.

    Senders are reduced to one row per (source, sender, week) before any distinct
    count, so a source with most of the rows stays spread.
    """
    fine = df.groupBy(source, sender, week_start(F.col(at)).alias("week_start")).agg(F.count(F.lit(1)).alias("n"))
    first = fine.groupBy(source, sender).agg(F.min("week_start").alias("week_start")).groupBy(source, "week_start").agg(
        F.count(F.lit(1)).alias("new_senders"))
    cells = fine.groupBy(source, "week_start").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_senders"))
    spine = df.select(source).distinct().select(source, F.explode(F.sequence(
        F.lit(first_week).cast("date"), F.lit(last_week).cast("date"), F.expr("INTERVAL 7 DAYS"))).alias("week_start"))
    out = spine.join(cells, [source, "week_start"], "left").join(first, [source, "week_start"], "left")
    return out.fillna(0, ["n_rows", "n_senders", "new_senders"])


def stage_news(raw: DataFrame, stored: DataFrame, arrival: str, key: str, news_hash: Column) -> DataFrame:
    """New articles since the stored ones, hashed, one row per hash, unseen hashes only."""
    fresh = newer_than(raw, arrival, stored, first="-1").withColumn("news_hash", news_hash)
    first = fresh.groupBy("news_hash").agg(F.min(key).alias(key))
    return first.join(stored.select("news_hash"), "news_hash", "left_anti")
