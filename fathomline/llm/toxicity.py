"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features are words and word beginnings of a vocabulary that is chosen by how much more
often they stand in toxic documents. Severity grades 1 to 3 of the toxic documents are
thirds of the number of strongly toxic words; documents that are not toxic have grade 0.
The regression has one weight vector for all grades and ordered thresholds:
``P(grade <= k) = sigmoid(threshold_k - weights . features)``. The severity of a
document is its expected grade, the sum of ``P(grade > k)``.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.columns import sampled_ids, shipped, small
from fathomline.llm.language_id import held_out
from fathomline.session import written

# Labelled documents of each kind used to fit (smallest hashes of their ids).
SAMPLE = 4000
VOCABULARY = 2048
LEAST_DOCUMENTS = 4
STRONG = 3.0
BEGINNING = 4
STEPS, RATE, DECAY = 300, 0.05, 2e-4
GRADES = 3
_SPLIT = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))


def terms(text: str | None) -> Counter:
    """Counts of the lower-cased words of a whole text and of their beginnings."""
    words = Counter((text or "").lower().encode("utf-8", "replace").translate(_SPLIT).split())
    heads: Counter = Counter()
    for w, n in words.items():
        if len(w) > BEGINNING:
            heads[w[:BEGINNING] + b"*"] += n
    words.update(heads)
    return words


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Vocabulary, shared weights and ordered thresholds."""

    def __init__(self, vocabulary: dict[bytes, int], weights: np.ndarray, thresholds: np.ndarray):
        self.vocabulary, self.weights, self.thresholds = vocabulary, weights, thresholds

    def over(self, text: str | None) -> np.ndarray:
        """``P(grade > k)`` for k = 0, 1, 2."""
        if not len(self.thresholds):
            return np.zeros(GRADES)
        found = terms(text)
        eta = sum(math.log1p(found[w]) * self.weights[self.vocabulary[w]] for w in sorted(found.keys() & self.vocabulary.keys()))
        return 1 - _sigmoid(self.thresholds - eta)


def train(rows: list[dict[int, float]], grades: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by full-batch Adam; thresholds are a first one plus positive steps."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.array([c for r in rows for c in r], np.int64)
    val = np.array([v for r in rows for v in r.values()])
    p = np.zeros(size + GRADES)
    p[size:] = [1.0, *[0.0] * (GRADES - 1)]
    first, second = np.zeros_like(p), np.zeros_like(p)
    n, order = len(rows), np.arange(GRADES)
    for step in range(1, STEPS + 1):
        eta = np.bincount(at, weights=val * p[col], minlength=n)
        theta = p[size] + np.r_[0, np.cumsum(np.exp(p[size + 1:]))]
        cum = np.c_[np.zeros(n), _sigmoid(theta[None, :] - eta[:, None]), np.ones(n)]
        mass = np.maximum(cum[np.arange(n), grades + 1] - cum[np.arange(n), grades], 1e-9)
        slope = cum * (1 - cum)
        up, down = slope[np.arange(n), grades + 1] / mass, slope[np.arange(n), grades] / mass
        d_eta = (up - down) / n
        d_theta = np.array([(-(up * (grades == k)) + down * (grades == k + 1)).sum() / n for k in order])
        grad = np.r_[np.bincount(col, weights=val * d_eta[at], minlength=size), d_theta.sum(), np.cumsum(d_theta[::-1])[::-1][1:] * np.exp(p[size + 1:])]
        grad[:size] += DECAY * p[:size]
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        p -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return p[:size], p[size] + np.r_[0, np.cumsum(np.exp(p[size + 1:]))]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Model from documents with a toxic label; several labels of one document count as toxic if one is.

    Vocabulary counts are aggregates over the sample; terms below the least number of
    documents are dropped before they leave the aggregate. Without toxic documents every
    text has severity 0.
    """
    marks = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_y"))
    marked = sampled_ids(docs.select("doc_id").join(marks, "doc_id"), "_y", sample)
    chosen = written(docs.select("doc_id", "text").join(small(written(marked, "toxic_sample"), 4 * sample), "doc_id"), "toxic_texts")

    def count(batches):
        seen = {0: Counter(), 1: Counter()}
        for batch in batches:
            for t, y in zip(batch.column("text").to_pylist(), batch.column("_y").to_pylist()):
                seen[int(y > 0)].update(terms(t).keys())
        for y, found in seen.items():
            items = list(found.items())
            for i in range(0, len(items), 50_000):
                part = items[i:i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in part], pa.binary()), pa.array([n * (y == 0) for _, n in part], pa.int64()), pa.array([n * y for _, n in part], pa.int64())], ["term", "clean", "toxic"])

    totals = chosen.groupBy((F.col("_y") > 0).alias("y")).count().collect()
    n_of = {r["y"]: r["count"] for r in totals}
    if not n_of.get(True) or not n_of.get(False):
        return Model({}, np.zeros(0), np.zeros(0))
    counts = chosen.select("text", "_y").mapInArrow(count, "term binary, clean bigint, toxic bigint").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (n_of[True] + 1)) - F.log((F.col("clean") + 0.5) / (n_of[False] + 1))
    evidence = odds * F.sqrt(F.col("toxic").cast("double"))
    picked = counts.where((F.col("toxic") >= LEAST_DOCUMENTS) & (odds > 0.7)).select("term", odds.alias("odds"), evidence.alias("e")).orderBy(F.desc("e"), "term").limit(VOCABULARY).collect()
    vocabulary = {bytes(r["term"]): i for i, r in enumerate(picked)}
    strong = {bytes(r["term"]) for r in picked if r["odds"] >= STRONG and not bytes(r["term"]).endswith(b"*")}

    def features(batches):
        for batch in batches:
            ids, vals, hits, ys = [], [], [], []
            for t, y in zip(batch.column("text").to_pylist(), batch.column("_y").to_pylist()):
                found = terms(t)
                known = sorted(vocabulary[w] for w in found.keys() & vocabulary.keys())
                names = {i: w for w, i in vocabulary.items()} if not ids else names
                ids.append(known)
                vals.append([math.log1p(found[names[i]]) for i in known])
                hits.append(sum(found[w] for w in found.keys() & strong))
                ys.append(int(y > 0))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.list_(pa.int32())), pa.array(vals, pa.list_(pa.float64())), pa.array(hits, pa.int64()), pa.array(ys, pa.int32())], ["ids", "vals", "hits", "y"])

    made = chosen.select("text", "_y").mapInArrow(features, "ids array<int>, vals array<double>, hits bigint, y int").collect()
    made.sort(key=lambda r: (r["y"], r["hits"], r["ids"], r["vals"]))
    hits = np.array([r["hits"] for r in made])
    toxic = np.array([r["y"] for r in made]) > 0
    low, high = np.quantile(hits[toxic], [1 / 3, 2 / 3])
    grades = np.where(toxic, 1 + (hits > low) + (hits > high), 0)
    weights, thresholds = train([dict(zip(r["ids"], r["vals"])) for r in made], grades, len(vocabulary))
    return Model(vocabulary, weights, thresholds)


def graded(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns with severity (0 to 3), p_toxic, grade and toxic (1 if p_toxic is 1/2 or more).

    A null or empty text has no features; its severity follows from the thresholds. Repeated
    rows are graded each; other columns than ``keep`` and text are ignored.
    """
    given = shipped(docs.sparkSession, model)

    def run(batches):
        model = given()
        for batch in batches:
            over = np.array([model.over(t) for t in batch.column("_text").to_pylist()]).reshape(-1, GRADES)
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in keep], pa.array(over.sum(axis=1)), pa.array(over[:, 0]),
                pa.array((over >= 0.5).sum(axis=1).astype(np.int32)), pa.array((over[:, 0] >= 0.5).astype(np.int32))], [*keep, "severity", "p_toxic", "grade", "toxic"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, f"{fields}, severity double, p_toxic double, grade int, toxic int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, severity, p_toxic, grade and toxic of every row; learns from rows not held out.

    Ids may be null or repeat; an empty table gives none. Columns beyond doc_id and text are ignored.
    """
    marked = docs.select("doc_id", "text", held_out(5, 0).alias("held_out"))
    model = fit(marked.where("NOT held_out").drop("held_out"), labels)
    return graded(marked, model, ["doc_id", "held_out"])
