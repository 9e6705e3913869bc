"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short, documents may be long, so similarity of whole sets says little:
what counts is the share of an item's five-word shingles that a document contains.
Items are put into size classes (powers of two). The MinHash sketch of an item is its
smallest shingle hashes; their number follows from the class's largest size, so that an
item with containment of at least the threshold shares at least one sketch value: fewer
shingles may be missing than the sketch holds. So the search loses nothing. A document
looks up its shingle hashes among the sketch values of all classes: first by the value and
the smallest number of shingles that goes with it, then, where one is found, by the items
it is large enough for. Candidates are verified by exact shingle containment, as text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.binding import fenced, let
from fathomline.llm.columns import small
from fathomline.session import written

WIDTH = 5
CONTAINMENT = 0.8
WORDS = r"[\p{L}\p{N}]+"
# Sketch values (two numbers each) that may be broadcast to sort out shingles; more are joined by a shuffle.
FILTER_VALUES = 500_000


def norm_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits. Null: none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORDS), F.lit(0))


def shingles(w: Column, width: int = WIDTH) -> Column:
    """Word shingles as text; fewer words make one shingle, no words none."""
    n = F.size(w)
    return F.when(n == 0, F.array().cast("array<string>")).when(n <= width, F.array(F.array_join(w, " "))).otherwise(
        F.transform(F.sequence(F.lit(0), n - width), lambda i: F.concat_ws(" ", *[F.get(w, i + j) for j in range(width)])))


def _hashes(w: Column, width: int) -> Column:
    """Shingle hashes without building the shingle texts: a chained hash of the words."""
    n = F.size(w)
    whole = F.xxhash64(F.array_join(w, " "), F.lit(""))
    return F.when(n == 0, F.array().cast("array<bigint>")).when(n < width, F.array(whole)).otherwise(
        F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(width)])))


def needed(size: Column, containment: float) -> Column:
    """Shingles of an item that must be found."""
    return F.ceil(size * containment - 1e-9).cast("int")


def item_sketches(items: DataFrame, width: int, containment: float) -> DataFrame:
    """One row per item and sketch value: hash, size class, item size, all shingles of the item."""
    texts = fenced(items.select("item_id", "text"), {"_w": norm_words(F.col("text"))})
    sets = fenced(texts.select("item_id", "_w"), {
        "item_shingles": F.array_distinct(shingles(F.col("_w"), width)),
        "_h": F.array_distinct(_hashes(F.col("_w"), width))}).where(F.size("item_shingles") > 0)
    size = F.size("item_shingles")
    sized = sets.withColumn("n_item", size).withColumn("size_class", F.ceil(F.log2(size.cast("double"))).cast("int"))
    largest = F.pow(F.lit(2.0), F.col("size_class"))
    length = (F.floor(largest * (1 - containment) + 1e-9) + 1).cast("int")
    return sized.select("item_id", "n_item", "size_class", "item_shingles", F.explode(F.slice(F.array_sort("_h"), F.lit(1), length)).alias("_k"))


def contained_items(docs: DataFrame, items: DataFrame, width: int = WIDTH, containment: float = CONTAINMENT) -> DataFrame:
    """Pairs (doc_id, item_id) where the document contains at least ``containment`` of the item's shingles.

    Words are lower-cased runs of letters and digits. Null and empty texts match
    nothing; an item with fewer than ``width`` words is one shingle and matches only a
    document that consists of the same words. Repeated rows give one pair. A null
    doc_id or item_id is carried like any other value.
    """
    sketches = written(item_sketches(items, width, containment), "item_sketches")
    texts = fenced(docs.select("doc_id", "text"), {"_w": norm_words(F.col("text"))}).select("doc_id", "_w")
    hashed = fenced(texts, {"_h": _hashes(F.col("_w"), width)}).select("doc_id", F.size("_h").alias("_size"), F.explode("_h").alias("_k"))
    # The values of all classes with the smallest item that has them, numbers alone, sort out nearly all shingles before any is shuffled.
    values = sketches.groupBy("_k").agg(F.min(needed(F.col("n_item"), containment)).alias("_least"))
    near = hashed.join(small(written(values, "sketch_values"), FILTER_VALUES), "_k").where(F.col("_size") >= F.col("_least")).select("doc_id", "_size", "_k").distinct()
    found = near.join(sketches.select("item_id", "n_item", "_k"), "_k").where(F.col("_size") >= needed(F.col("n_item"), containment))
    pairs = written(found.select(F.col("doc_id").alias("_doc"), F.col("item_id").alias("_item")).distinct(), "candidate_pairs")

    # Exact step: each candidate pair asks for the item's shingles, as text, one row each; the documents of pairs are read again.
    sets = sketches.select("item_id", "n_item", "item_shingles").dropDuplicates(["item_id", "item_shingles"]).withColumn("_set", F.xxhash64("item_shingles"))
    item_rows = written(sets.select("item_id", "n_item", "_set", F.explode("item_shingles").alias("_shingle")), "item_shingles")
    wanted = pairs.join(item_rows, F.col("_item").eqNullSafe(F.col("item_id"))).select("_doc", "item_id", "n_item", "_set", "_shingle")
    doc_ids = pairs.select("_doc").distinct()
    own = docs.select("doc_id", "text").join(small(doc_ids), F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi")
    own = fenced(own.select("doc_id", F.xxhash64("text").alias("_text"), "text"), {"_w": norm_words(F.col("text"))}).select("doc_id", "_text", "_w")
    held = own.select("doc_id", "_text", F.explode(F.array_distinct(shingles(F.col("_w"), width))).alias("_own"))
    # only shingles of some item leave their document
    held = held.join(small(item_rows.select(F.col("_shingle").alias("_own")).distinct(), FILTER_VALUES // 8), "_own", "left_semi")
    shared = held.join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_own") == F.col("_shingle")))
    counts = shared.groupBy("doc_id", "_text", "item_id", "_set").agg(F.any_value("n_item").alias("n_item"), F.countDistinct("_own").alias("n_shared"))
    return counts.where(F.col("n_shared") >= needed(F.col("n_item"), containment)).groupBy("doc_id", "item_id").agg(
        F.max("n_item").cast("long").alias("n_item"), F.max("n_shared").cast("long").alias("n_shared"))


def decontaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH, containment: float = CONTAINMENT) -> DataFrame:
    """Rows of ``docs`` that contain no item. A document with a null id is judged by the pairs of the null id."""
    found = contained_items(docs, items, width, containment).select(F.col("doc_id").alias("_hit")).distinct()
    hits = small(written(found, "contaminated"))
    return docs.join(hits, docs["doc_id"].eqNullSafe(hits["_hit"]), "left_anti")
