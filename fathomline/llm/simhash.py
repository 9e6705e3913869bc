"""SimHash near-duplicates through a byte-position inverted index with count filtering.

Fingerprints that differ in at most three bits differ in at most three of their eight
bytes, so at least five positional bytes are equal. Of the first four and the last four
bytes one half then has three equal ones: the index holds each distinct fingerprint under
the eight (three positions, values) lists of its halves, which loses no pair. Within a
list the equal positional bytes are tallied per pair, pairs below five are dropped, the
rest is verified by its differing bits.

Only links that join something are kept: a list gives a star for each of its connected
groups, never all pairs. A long list is cut into chunks and each pair of chunks is a task
unit of its own, so no task holds a whole list.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.columns import in_order, packed
from fathomline.llm.components import components
from fathomline.session import written

WIDTH = 3
MAX_BITS = 3
MIN_BYTES = 8 - MAX_BITS
CHUNK_ROWS = 2048
POSITIONS = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BLOCK = 65_536
LAST_ID = 2**63 - 1


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """Signed 64-bit fingerprint of a text's word shingles; 0 without words."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= width:
        grams: Iterator[bytes] = iter([b" ".join(words)])
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(width)]))
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        rows = hashes[at:at + BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, keep: list[str], width: int = WIDTH) -> DataFrame:
    """``keep`` columns and the fingerprint ``fp`` of every whole text."""

    def run(batches):
        for batch in batches:
            fps = pa.array([fingerprint(t.as_py(), width) for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], fps], [*keep, "fp"])

    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep) + ", fp bigint"
    return docs.select(*keep, "text").mapInArrow(run, schema)


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(255))


def index_rows(fps: DataFrame) -> DataFrame:
    """(list, fp): each fingerprint under the eight lists of three positional bytes."""
    fp = F.col("fp")
    lists = [F.lit(n << 24).cast("long") + _byte(fp, a) + _byte(fp, b) * 256 + _byte(fp, c) * 65536 for n, (a, b, c) in enumerate(POSITIONS)]
    return fps.select("fp", F.explode(F.array(*lists)).alias("list"))


def _stars(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, first member) of the connected groups among ``fps``."""
    rest, found = np.unique(fps), []
    while len(rest) > 1:
        seed, rest, queue = rest[0], rest[1:], [rest[0]]
        while queue and len(rest):
            differing = rest ^ queue.pop()
            tally = (differing.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            near = (tally >= MIN_BYTES) & (np.bitwise_count(differing) <= MAX_BITS)
            if near.any():
                queue.extend(rest[near])
                found.append((rest[near], np.full(int(near.sum()), seed)))
                rest = rest[~near]
    if not found:
        return fps[:0], fps[:0]
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect everything within three bits."""
    rows = written(index_rows(fps), "simhash_index")
    sizes = rows.groupBy("list").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    placed = rows.join(sizes, "list").withColumn("_chunks", F.ceil(F.col("_n") / CHUNK_ROWS).cast("long"))
    own = F.pmod(F.xxhash64("fp"), F.col("_chunks"))
    placed = placed.select("list", "fp", own.alias("_own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_chunks") - 1)).alias("_other"))
    units = placed.select("list", F.least("_own", "_other").alias("lo"), F.greatest("_own", "_other").alias("hi"), "fp")

    def run(batches):
        """Rows come sorted by unit; a unit may go on in the next batch."""
        held: list[np.ndarray] = []
        key = None

        def flush():
            a, b = _stars(np.concatenate(held))
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("list", "lo", "hi")], axis=1)
            fps_ = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            starts = np.flatnonzero(np.r_[True, (cols[1:] != cols[:-1]).any(axis=1)])
            for at, end in zip(starts, [*starts[1:], len(cols)]):
                unit = tuple(cols[at])
                if unit != key:
                    if key is not None and sum(map(len, held)) > 1:
                        yield flush()
                    key, held = unit, []
                held.append(fps_[at:end])
        if key is not None and sum(map(len, held)) > 1:
            yield flush()

    return units.repartition("list", "lo", "hi").sortWithinPartitions("list", "lo", "hi").mapInArrow(run, "a bigint, b bigint")


def grouped(prints: DataFrame) -> DataFrame:
    """(fp, root, component): the smallest fingerprint and the smallest document id of the fingerprint's group.

    Only the root tells groups apart: several may hold the same id, or null ids alone.

    ``prints`` needs doc_id and fp. A null doc_id counts as larger than all others.
    """
    doc = F.coalesce(F.col("doc_id"), F.lit(LAST_ID))
    classes = written(prints.groupBy("fp").agg(F.min(doc).alias("_first")), "simhash_classes")
    roots = components(links(classes.select("fp")))
    placed = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "_first", F.coalesce("root", "fp").alias("_root"))
    firsts = placed.groupBy("_root").agg(F.min("_first").alias("component"))
    return placed.select("fp", "_root").join(firsts, "_root").select("fp", F.col("_root").alias("root"), "component")


def simhash_components(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id of every row of ``docs`` (doc_id, text).

    Null and empty texts have the fingerprint 0, which links like any other. Repeated
    rows stay and get the same component. Other columns are ignored.
    """
    prints = written(fingerprints(docs.select("doc_id", "text"), ["doc_id"]), "simhash")
    groups = grouped(prints)
    return prints.join(groups, "fp").select("doc_id", "fp", F.nullif("component", F.lit(LAST_ID)).alias("component_id"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest doc_id.

    Of several rows with that id the one with the smallest text hash stays, once. Null and
    empty texts are one group; columns of any name pass unchanged.
    """
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    prints = written(fingerprints(docs.select("doc_id", mark.alias("_mark"), "text"), ["doc_id", "_mark"]), "simhash")
    groups = grouped(prints)
    doc = F.coalesce(F.col("doc_id"), F.lit(LAST_ID))
    heads = prints.join(groups, "fp").where(doc == F.col("component")).groupBy("root", F.col("component").alias("doc")).agg(F.min("_mark").alias("first"))
    keyed = packed(docs, "text").withColumns({"doc": F.coalesce(F.col("rest")["doc_id"], F.lit(LAST_ID)), "first": mark})
    kept = keyed.join(heads, ["doc", "first"], "left_semi")
    return in_order(kept.dropDuplicates(["doc", "first"]) if _repeats(prints) else kept, docs.columns)


def _repeats(prints: DataFrame) -> bool:
    """Whether some (doc_id, text hash) stands in more than one row."""
    return not prints.groupBy("doc_id", "_mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
