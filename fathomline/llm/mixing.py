"""Mixing sources to target weights by Poisson replication.

Each source has a target weight. Its repetition rate is the mean number of copies of a
document that gives the source its share of the mixture. The number of copies is the
inverse of the Poisson distribution with that mean at a number in [0, 1) made from the
seed, the document id and the text, so it does not depend on the order of rows or on retries.
Documents are exploded by their count and the copies are put in the order of a second
seeded hash, which is a global shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.binding import let
from fathomline.llm.columns import in_order, packed, small, unit_hash, with_occurrences
from fathomline.session import written

# Bytes of the mixture in one partition, once there are more than the session's shuffle partitions.
ORDER_BYTES = 128 << 20


def poisson_inverse(u: Column, mean: Column) -> Column:
    """Smallest k with ``P(Poisson(mean) <= k) > u``; 0 for a mean of zero.

    The fold runs to ``mean + 12 sqrt(mean) + 24``, where the rest of the distribution
    is below the resolution of ``u``.
    """
    last = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")
    start = F.struct((-mean).alias("log"), F.exp(-mean).alias("cdf"), F.when(F.exp(-mean) > u, F.lit(0)).otherwise(F.lit(1)).alias("k"))

    def step(acc: Column, j: Column) -> Column:
        grown = let(acc["log"] + F.log(mean / j), lambda x: let(acc["cdf"] + F.exp(x), lambda c: F.struct(
            x.alias("log"), c.alias("cdf"), (acc["k"] + F.when(c > u, F.lit(0)).otherwise(F.lit(1))).alias("k"))))
        return F.when(acc["cdf"] > u, acc).otherwise(grown)

    return F.when(mean <= 0, F.lit(0)).otherwise(F.aggregate(F.sequence(F.lit(1), last), start, step)["k"])


def repetition_rates(docs: DataFrame, weights: dict[str, float], default: float, total_ratio: float = 1.0) -> DataFrame:
    """One row per source: its UTF-8 bytes, target share and mean number of copies.

    The mixture has ``total_ratio`` times the bytes of the input. A source that is not in
    ``weights`` (a null one too) has the weight ``default``. Weights are relative to all
    sources that have bytes.
    """
    sizes = docs.groupBy(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_source")).agg(
        F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).alias("n_bytes"))
    weight = F.lit(default)
    for name, value in weights.items():
        weight = F.when(F.col("_source") == name, F.lit(value)).otherwise(weight)
    weighed = written(sizes.withColumn("_weight", F.when(F.col("n_bytes") > 0, weight).otherwise(F.lit(0.0))), "source_sizes")
    total = weighed.agg(F.sum("_weight").alias("_all"), F.sum("n_bytes").alias("_bytes")).first()
    share = F.col("_weight") / F.lit(float(total["_all"] or 1.0))
    rate = F.when(F.col("n_bytes") > 0, F.lit(float(total["_bytes"] or 0) * total_ratio) * share / F.col("n_bytes")).otherwise(F.lit(0.0))
    return weighed.select("_source", "n_bytes", share.alias("share"), rate.alias("rate"))


def mixed(docs: DataFrame, weights: dict[str, float], default: float = 1.0, seed: int = 42, total_ratio: float = 1.0) -> DataFrame:
    """Copies of ``docs`` so that sources reach their target weights, in seeded random order.

    Adds copy (from 0), rate and order_key; partitions and the rows in them are in the order
    of order_key. ``docs`` needs doc_id, source and text; columns named like the three new
    ones are replaced, all others pass unchanged. A row is drawn by its id, its text and, among
    equal rows, its number, so rows with null or repeated ids are drawn each. A null source is a
    source of its own, one without bytes has the rate 0, null texts have none.
    """
    docs = docs.drop("copy", "rate", "order_key")
    table = repetition_rates(docs, weights, default, total_ratio)
    total = table.agg(F.sum(F.col("n_bytes") * F.col("rate"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(total // ORDER_BYTES) + 1)
    rows = with_occurrences(packed(docs, "text"))
    doc, text = F.col("rest")["doc_id"], F.coalesce("text", F.lit(""))
    drawn = rows.withColumn("_source", F.coalesce(F.col("rest")["source"].cast("string"), F.lit(""))).join(small(table.select("_source", "rate")), "_source")

    def drawn_by(*after: Column, name: str | None = None) -> Column:
        return unit_hash(F.lit(seed), *([F.lit(name)] if name else []), doc, *after, F.md5(text), F.col("occurrence"))

    counted = drawn.withColumn("n", poisson_inverse(drawn_by(), F.col("rate"))).where("n > 0")
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    keyed = copies.withColumn("order_key", drawn_by(F.col("copy"), name="order"))
    # The key is uniform, so its range is cut evenly without a look at the rows.
    dealt = keyed.repartitionById(parts, F.floor(F.col("order_key") * parts).cast("int")).sortWithinPartitions("order_key", doc, "copy")
    return in_order(dealt, docs.columns, "copy", "rate", "order_key")
