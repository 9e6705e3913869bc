"""Batches and budgets over ordered rows."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.operators.numbering import row_numbers, running_sums

# Functions of this module run in Python workers: they travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Characters and rows of one batch, overhead per row, least room for a cut document.
BATCH_CHARS = 12_000
BATCH_ROWS = 12
ROW_OVERHEAD = 50
MIN_ROOM = 2_000
# Rows of a group that one task packs at a time.
BLOCK_ROWS = 8_192


def fixed_chunks(df: DataFrame, keys: list[str], order: list[Column], size: int) -> DataFrame:
    """Rows of a group in order, cut into chunks of ``size``; the group may have any size."""
    numbered = row_numbers(df, keys, order, "_rn")
    return numbered.withColumn("chunk_no", F.floor((F.col("_rn") - 1) / size)).drop("_rn")


def next_starts(chars: np.ndarray, max_chars: int, max_rows: int) -> np.ndarray:
    """For each row the row that starts the next batch, if a batch starts here: a search in the prefix sums."""
    sums = np.concatenate([[0], np.cumsum(chars)])
    rows = np.arange(len(chars))
    fits = np.searchsorted(sums, sums[:-1] + max_chars, side="right") - 1
    return np.clip(fits, rows + 1, rows + max_rows)


def block_outcomes(chars: np.ndarray, rows: int, max_chars: int, max_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """What a block does with each possible first start: the first start in the next block, and the number of starts.

    ``chars`` holds the block's ``rows`` and the first ones of the next block.
    """
    jump = next_starts(chars, max_chars, max_rows)
    leaves, count = np.arange(len(chars) + max_rows + 1) - rows, np.zeros(len(chars) + max_rows + 1, np.int64)
    for k in range(min(rows, len(chars)) - 1, -1, -1):
        leaves[k], count[k] = leaves[jump[k]], count[jump[k]] + 1
    return leaves[:max_rows], count[:max_rows]


def packed_batches(df: DataFrame, keys: list[str], row_key: str, order: list[Column], chars: Column, max_chars: int = BATCH_CHARS,
                   max_rows: int = BATCH_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Greedy batches of a whole group: a new one starts when characters or rows would exceed the budget.

    Where a batch starts depends on all earlier rows, but a batch has at most ``max_rows``
    rows, so all that a block of rows needs to know is which of its first ``max_rows`` rows
    starts a batch. Each block works out in parallel what follows from each of them; the
    outcomes of a group's blocks are then strung together (a few numbers per block, read as
    a stream), and each block marks its batches from its known start. Returns the keys,
    ``row_key`` and ``batch_no`` from 0. Null or negative characters count 0.
    """
    slim = df.select(*keys, row_key, F.greatest(F.coalesce(chars.cast("long"), F.lit(0)), F.lit(0)).alias("_chars"), *[o.alias(f"_o{i}") for i, o in enumerate(order)])
    numbered = row_numbers(slim, keys, [F.col(f"_o{i}") for i in range(len(order))], "_rn")
    block_rows = max(block_rows, max_rows)
    group = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(None).cast("int").alias("all"))
    rows = numbered.select(group.alias("group"), F.col(row_key).alias("row"), "_chars", F.floor((F.col("_rn") - 1) / block_rows).alias("block"),
                           ((F.col("_rn") - 1) % block_rows).cast("int").alias("place"))
    group_type, row_type = rows.schema["group"].dataType.simpleString(), rows.schema["row"].dataType.simpleString()
    # The first rows of a block also end the block before.
    ahead = rows.where((F.col("place") < max_rows) & (F.col("block") > 0)).select("group", F.lit(None).cast(row_type).alias("row"), "_chars", F.col("block") - 1, F.col("place") + block_rows)
    both = rows.union(ahead)

    def outcomes(key, table):
        table = table.sort_by("place")
        places, sizes = table.column("place").to_numpy(), table.column("_chars").to_numpy()
        leaves, count = block_outcomes(sizes, int((places < block_rows).sum()), max_chars, max_rows)
        return pa.table({"group": table.column("group").slice(0, 1), "block": table.column("block").slice(0, 1),
                         "leaves": pa.array([leaves.tolist()], pa.list_(pa.int32())), "starts": pa.array([count.tolist()], pa.list_(pa.int64()))})

    def strung(batches):
        """Blocks come sorted by group and number; only the open batch and its number are carried."""
        group = None
        start = before = 0
        for batch in batches:
            starts, befores = [], []
            for g, block, leaves, count in zip(*[batch.column(c).to_pylist() for c in ("group", "block", "leaves", "starts")]):
                if block == 0 or g != group:
                    group, start, before = g, 0, 0
                starts.append(start)
                befores.append(before)
                start, before = leaves[start], before + count[start]
            yield pa.RecordBatch.from_arrays([batch.column("group"), batch.column("block"), pa.array(starts, pa.int32()), pa.array(befores, pa.int64())], ["group", "block", "start", "before"])

    def marked(key, table):
        table = table.sort_by("place")
        places, sizes = table.column("place").to_numpy(), table.column("_chars").to_numpy()
        own = int((places < block_rows).sum())
        jump = next_starts(sizes, max_chars, max_rows)
        first = np.zeros(len(sizes) + max_rows + 1, np.int64)
        k = table.column("start")[0].as_py()
        while k < own:
            first[k] = 1
            k = int(jump[k])
        number = np.cumsum(first)[:own] + (table.column("before")[0].as_py() - 1)
        return pa.table({"group": table.column("group").slice(0, own), "row": table.column("row").slice(0, own), "batch_no": pa.array(number)})

    told = both.groupBy("group", "block").applyInArrow(outcomes, f"group {group_type}, block bigint, leaves array<int>, starts array<bigint>")
    chain = told.repartition("group").sortWithinPartitions("group", "block").mapInArrow(strung, f"group {group_type}, block bigint, start int, before bigint")
    known = chain.select(F.col("group").alias("_g"), F.col("block").alias("_b"), "start", "before")
    placed = both.join(known, F.col("group").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b"))).drop("_g", "_b")
    made = placed.groupBy("group", "block").applyInArrow(marked, f"group {group_type}, row {row_type}, batch_no bigint")
    return made.select(*[F.col("group")[k].alias(k) for k in keys], F.col("row").alias(row_key), "batch_no")


def budget_pack(df: DataFrame, keys: list[str], order: list[Column], chars: Column, max_doc: int, max_total: int, mark_chars: int = 0) -> DataFrame:
    """Documents packed in order into a total budget with a cap per document.

    ``taken`` is the number of characters used, 0 when less than ``MIN_ROOM`` is
    left. Until the budget runs out every document costs its capped length (plus
    the mark of a cut one), so the room left is a running sum over the earlier rows.
    """
    cost = F.least(chars, F.lit(max_doc)) + F.when(chars > max_doc, F.lit(mark_chars)).otherwise(F.lit(0))
    summed = running_sums(df, keys, order, cost.cast("long"), "used")
    room = F.least(F.lit(max_doc), F.lit(max_total) - F.col("used"))
    taken = F.when((chars > 0) & (room >= MIN_ROOM), F.least(chars, room)).otherwise(F.lit(0))
    return summed.withColumns({"taken": taken.cast("long"), "truncated": (taken > 0) & (chars > taken)}).drop("used")
