"""Whitening of embeddings: blockwise QR of the centred rows, then a bidiagonal qd solver.

Entries are set on a grid of whole numbers, so counts, sums and deviations are exact. The
fit list holds each distinct vector once. Every task reduces its centred rows to one
triangle by QR, block after block; triangles are reduced again in two levels, the first
with about as many tasks as the square root of the partitions. The last triangle has the
covariance's right singular vectors: Householder reflections make it bidiagonal, dqds finds
the squared singular values, twisted factorisations the directions (``bidiagonal``). No
covariance matrix is formed, so small directions keep their accuracy.

The driver holds one triangle, whose size follows the embedding's dimension only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.bidiagonal import leading_vectors
from fathomline.llm.columns import packed
from fathomline.session import written

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
# Scaled entries beyond this are no whole numbers any more; rows with one are dropped like those with an infinite entry.
LARGEST = 2.0**52
BLOCK_ROWS = 4096
NEW = ("n", "deviation", "whitened", "explained", "identity_error")


@dataclass
class Fit:
    """What the fit list gives: its size, its sums, the directions (rows), their values and the error of the whole."""

    rows: int
    sums: list[int]
    values: list[float]
    vectors: np.ndarray
    explained: list[float]
    identity_error: float = 0.0


def usable(embeddings: DataFrame, column: str) -> tuple[DataFrame, int]:
    """Rows with a whole vector of the usual dimension, the vector as doubles, and that dimension.

    Left out are null vectors and vectors with a null, non-finite or too large entry, and
    empty ones. Of several dimensions the most frequent counts, the larger of two alike.
    """
    entries = F.col(f"`{column}`").cast("array<double>")
    bad = F.exists(F.col("vector"), lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > F.lit(LARGEST / SCALE)))
    rows = packed(embeddings.withColumn(column, entries), column).withColumnRenamed(column, "vector").where(F.col("vector").isNotNull() & (F.size("vector") > 0) & ~bad)
    usual = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d = usual["d"] if usual else 0
    return rows.where(F.size("vector") == d), d


def on_grid(column: pa.Array, d: int) -> np.ndarray:
    """Whole numbers (rows x d) of a column of vectors."""
    return (np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE).astype(np.int64) + SHIFT).reshape(-1, d)


def packed_vectors(x: np.ndarray) -> pa.Array:
    """Each row as bytes: four a number where all of the row fit, else eight. Equal rows, and only those, have equal bytes."""
    narrow = (np.abs(x) < 2**31).all(axis=1)
    width = np.where(narrow, 4, 8) * x.shape[1]
    if narrow.all():
        data = x.astype("<i4").tobytes()
    else:
        data = b"".join(r.astype("<i4" if n else "<i8").tobytes() for r, n in zip(x, narrow))
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(width)]).astype(np.int32)), pa.py_buffer(data)])


def unpacked_vectors(column: pa.Array, d: int) -> np.ndarray:
    values = column.to_pylist()
    if all(len(v) == 4 * d for v in values):
        return np.frombuffer(b"".join(values), "<i4").astype(np.int64).reshape(-1, d)
    return np.array([np.frombuffer(v, "<i4" if len(v) == 4 * d else "<i8") for v in values], np.int64).reshape(-1, d)


def deviations(x: np.ndarray, rows: int, sums: list[int]) -> np.ndarray:
    """``rows * x - sums``, exact: machine numbers where they hold it, else Python's."""
    largest = max(int(np.abs(x).max(initial=0)) * rows, *[abs(s) for s in sums])
    if largest < 2**62:
        return x * rows - np.array(sums, np.int64)
    return x.astype(object) * rows - np.array(sums, object)


def centred(x: np.ndarray, rows: int, sums: list[int]) -> np.ndarray:
    return np.asarray(deviations(x, rows, sums) / rows, float)


def squared_length(dev: np.ndarray) -> pa.Array:
    """Sum of squares of each row, exact."""
    if dev.dtype != object and int(np.abs(dev).max(initial=0)) ** 2 * dev.shape[1] < 2**63:
        return pa.array((dev * dev).sum(axis=1)).cast(pa.decimal128(19)).cast(pa.decimal128(38))
    wide = [sum(int(v) ** 2 for v in row) for row in dev]
    return pa.array([Decimal(v) if v < 10**38 else None for v in wide], pa.decimal128(38))


def fit_list(rows: DataFrame, d: int) -> DataFrame:
    """Each distinct vector on the grid once, as bytes ``x``; a table of the shared folder."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([packed_vectors(on_grid(batch.column("vector"), d))], ["x"])

    return written(rows.select("vector").mapInArrow(run, "x binary").distinct(), "whitening_fit")


def exact_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and sum of each dimension. Halves of the numbers are summed, so a task's sums fit machine numbers."""

    def run(batches):
        count, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            x = unpacked_vectors(batch.column("x"), d)
            count += len(x)
            high += (x >> 31).sum(axis=0)
            low += (x & (2**31 - 1)).sum(axis=0)
        at = pa.array(np.arange(d + 1), pa.int32())
        yield pa.RecordBatch.from_arrays([at, pa.array([*high.tolist(), 0]), pa.array([*low.tolist(), count])], ["at", "high", "low"])

    parts = fit.mapInArrow(run, "at int, high bigint, low bigint").groupBy("at").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")])
    total = {r["at"]: (int(r["high"]) << 31) + int(r["low"]) for r in parts.collect()}
    return total.get(d, 0), [total.get(k, 0) for k in range(d)]


def triangle(fit: DataFrame, rows: int, sums: list[int]) -> np.ndarray:
    """Triangular factor of the centred fit list."""
    d = len(sums)

    def blocks(batches):
        made = np.zeros((0, d))
        for batch in batches:
            x = unpacked_vectors(batch.column("x"), d)
            for at in range(0, len(x), BLOCK_ROWS):
                made = np.linalg.qr(np.vstack([made, centred(x[at:at + BLOCK_ROWS], rows, sums)]), mode="r")
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([made.tobytes()], pa.binary())], ["part", "r"])

    def reduced(batches):
        made = np.zeros((0, d))
        for batch in batches:
            for r in batch.column("r"):
                made = np.linalg.qr(np.vstack([made, np.frombuffer(r.as_py()).reshape(-1, d)]), mode="r")
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([made.tobytes()], pa.binary())], ["part", "r"])

    shape = "part int, r binary"
    level = max(1, math.isqrt(fit.rdd.getNumPartitions()))
    made = fit.mapInArrow(blocks, shape).repartition(level, "part").mapInArrow(reduced, shape).repartition(1).mapInArrow(reduced, shape).first()
    found = np.frombuffer(made["r"]).reshape(-1, d)
    return np.vstack([found, np.zeros((d - len(found), d))])


def identity_error(fit: DataFrame, model: Fit) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(model.values)
    if not k:
        return 0.0
    directions, rows, sums = directions_of(model), model.rows, model.sums

    def run(batches):
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = centred(unpacked_vectors(batch.column("x"), len(sums)), rows, sums) @ directions
            total += np.vstack([w.T @ w, w.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], ["at", "value"])

    parts = fit.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((k + 1) * k)
    for r in parts:
        total[r["at"]] = r["value"]
    total = total.reshape(k + 1, k) / rows
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def directions_of(model: Fit) -> np.ndarray:
    """Columns that take a centred row to its whitened coordinates."""
    return (model.vectors / np.sqrt(model.values)[:, None]).T


def fitted(rows: DataFrame, d: int, limit: int = COMPONENTS) -> Fit:
    """Directions of the distinct vectors among ``rows``; none if they do not differ."""
    fit = fit_list(rows, d)
    count, sums = exact_sums(fit, d)
    if not count:
        return Fit(0, sums, [], np.zeros((0, d)), [])
    r = triangle(fit, count, sums)
    squares, vectors = leading_vectors(r, limit)
    values = squares / count
    trace = float((r * r).sum()) / count
    model = Fit(count, sums, values.tolist(), vectors, [float(v / trace) for v in values])
    model.identity_error = identity_error(fit, model)
    return model


def whitened(embeddings: DataFrame, column: str = "embedding", limit: int = COMPONENTS) -> DataFrame:
    """All other columns of the usable rows, and n, deviation, whitened, explained and identity_error.

    whitened holds the row's coordinates on the components, by falling share of the variance
    (explained); both are empty if all vectors are equal. deviation is exact, null from
    10**38 on. Repeated rows return each but count once in the fit; an empty table gives none.
    Vectors are dropped as ``usable`` says. Columns named like the new ones are replaced.
    """
    embeddings = embeddings.drop(*[c for c in NEW if c != column])
    others = [c for c in embeddings.columns if c != column]
    rows, d = usable(embeddings, column)
    model = fitted(rows, d, limit) if d else Fit(0, [], [], np.zeros((0, 0)), [])
    directions = directions_of(model) if model.values else np.zeros((d, 0))
    count, sums, k = model.rows, model.sums, len(model.values)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            dev = deviations(on_grid(batch.column("vector"), d), count, sums)
            w = np.asarray(dev / count, float) @ directions
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(w) + 1) * k, k or 1)[:len(w) + 1] if k else np.zeros(len(w) + 1), pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("rest"), squared_length(dev), lists], ["rest", "deviation", "whitened"])

    rest = rows.schema["rest"].dataType.simpleString()
    made = rows.mapInArrow(run, f"rest {rest}, deviation decimal(38,0), whitened array<double>")
    explained = F.array(*[F.lit(v) for v in model.explained]).cast("array<double>")
    return made.select(*[F.col("rest")[c].alias(c) for c in others], F.lit(count).cast("long").alias("n"), "deviation", "whitened",
                       explained.alias("explained"), F.lit(model.identity_error).alias("identity_error"))


def long_form(rows: DataFrame) -> DataFrame:
    """One row per row and component (from 1); deviation as a long, null where it is larger than one."""
    others = [c for c in rows.columns if c not in NEW]
    parts = rows.select(*others, "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"),
                        F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "part"), "identity_error")
    return parts.select(*others, (F.col("place") + 1).cast("int").alias("component"), "n", "deviation",
                        F.col("part")["whitened"].alias("whitened"), F.col("part")["explained"].alias("explained"), "identity_error")
