"""Language identification by nearest centroids of normalised TF-IDF n-gram vectors.

A text becomes the TF-IDF weights of its byte trigrams (lower case, letters only, hashed
into a fixed number of bins), scaled to length one. Each language has several centroids,
found by spherical k-means on a bounded sample of its labelled texts. A text gets the
language of the centroid with the largest cosine; a text too far from it is rejected.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.columns import in_order, packed, sampled_ids, shipped, small
from fathomline.session import written

BINS = 8192
CENTROIDS = 4
# At most this many labelled texts of each language are used to fit (smallest hashes of their ids).
SAMPLE = 1500
# Share of a language's own texts that may lie below the limit of their centroid, and parts in which texts are held out for it.
REJECT_RATE = 0.005
FOLDS = 5
ROUNDS = 10
BLOCK = 1 << 20
_FOLD = bytes(32 if i < 65 or 90 < i < 97 or 122 < i < 128 else i for i in range(256))


def has_letter(text: str | None) -> bool:
    """Whether a text holds a character of a Unicode letter category."""
    return text is not None and any(map(str.isalpha, text))


def trigram_counts(text: str, bins: int = BINS) -> np.ndarray:
    """Counts of the hashed trigrams of a whole text; trigrams without letters count nowhere."""
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_FOLD) + b" ", np.uint8)
    out = np.zeros(bins, np.float32)
    for at in range(0, len(raw) - 2, BLOCK):
        b = raw[at:at + BLOCK + 2].astype(np.uint32)
        mixed = (b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA77) + b[2:] * np.uint32(0xC2B2AE3D))
        slot = (mixed ^ (mixed >> np.uint32(15))) % np.uint32(bins)
        out += np.bincount(slot[(b[:-2] != 32) | (b[1:-1] != 32)], minlength=bins)[:bins]
    return out


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """Unit vectors of texts, made row by row: nothing else of their size is held."""
    x = np.empty((len(texts), len(idf)), np.float32)
    for row, t in zip(x, texts):
        np.multiply(trigram_counts(t, len(idf)), idf, out=row)
        norm = np.sqrt(np.add.reduce(row * row))
        row /= norm if norm > 0 else 1
    return x


def _direction(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Unit mean of the ``rows`` (a mask) of ``x``, which are not copied."""
    mean = np.add.reduce(x, axis=0, where=rows[:, None]) / np.float32(rows.sum())
    return mean / max(np.linalg.norm(mean), 1e-12)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, rows: np.ndarray | None = None) -> np.ndarray:
    """Unit centroids of the ``rows`` (a mask) of ``x``; starts from the mean direction and then the farthest texts."""
    rows = np.ones(len(x), bool) if rows is None else rows
    centres = [_direction(x, rows)]
    for _ in range(min(k, int(rows.sum())) - 1):
        centres.append(x[np.argmin(np.where(rows, (x @ np.stack(centres).T).max(axis=1), np.inf))])
    c = np.stack(centres)
    for _ in range(rounds):
        nearest = np.where(rows, (x @ c.T).argmax(axis=1), -1)
        for j in range(len(c)):
            if (nearest == j).any():
                c[j] = _direction(x, nearest == j)
    return c


def reject_limits(texts: list[str], x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Smallest cosine accepted by each of the centroids ``c`` of the language of ``texts``.

    Each text is compared with centroids learned without it and without its copies. A limit is
    the cosine that all but ``REJECT_RATE`` of the texts nearest to its centroid reach. Where these
    are too few to tell, all texts of the language set it; without any held-out text there is no limit.
    """
    part = np.array([zlib.crc32(t.encode("utf-8", "replace")) % FOLDS for t in texts])
    reach, seen = np.zeros(len(x), np.float32), np.zeros(len(x), bool)
    for k in np.unique(part):
        out = part == k
        if not out.all():
            reach[out] = (x @ spherical_kmeans(x, len(c), rows=~out).T).max(axis=1)[out]
            seen |= out
    nearest, limits = (x @ c.T).argmax(axis=1), np.zeros(len(c))
    for j in range(len(c)):
        use = seen & (nearest == j)
        use = use if int(REJECT_RATE * (use.sum() + 1)) else seen
        if use.any():
            limits[j] = np.sort(reach[use])[max(1, int(REJECT_RATE * (use.sum() + 1))) - 1] - 1e-5
    return limits


class Model:
    """Centroids with their languages, reject limits and IDF weights."""

    def __init__(self, idf: np.ndarray, languages: list[str], centres: np.ndarray, limits: np.ndarray):
        self.idf, self.languages, self.centres, self.limits = idf, languages, centres, limits

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        names, scores, rejected = ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
        usable = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        for at in range(0, len(usable), 128):
            part = usable[at:at + 128]
            cosine = vectors([texts[i] for i in part], self.idf) @ self.centres.T
            for i, best, row in zip(part, cosine.argmax(axis=1), cosine):
                names[i] = self.languages[best]
                scores[i] = float(min(1.0, max(0.0, row[best])))
                rejected[i] = bool(row[best] < self.limits[best])
        return names, scores, rejected


def fit(labelled: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS, bins: int = BINS) -> Model:
    """Model from ``labelled`` (doc_id, text, lang non-null).

    The sample of a language is a bounded group, so one task per language clusters it.
    """
    picked = sampled_ids(labelled, "lang", sample)
    chosen = written(labelled.select("doc_id", "lang", "text").join(small(written(picked, "language_ids"), 1_000_000), ["doc_id", "lang"]), "language_sample")

    def frequencies(batches):
        df, n = np.zeros(bins, np.int64), 0
        for batch in batches:
            for t in batch.column("text").to_pylist():
                df += trigram_counts(t, bins) > 0
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, bins)), pa.array(np.r_[n, df])], ["bin", "df"])

    rows = chosen.where("text IS NOT NULL").select("text").mapInArrow(frequencies, "bin bigint, df bigint").groupBy("bin").agg(F.sum("df").alias("df")).collect()
    counts = np.zeros(bins + 1)
    for r in rows:
        counts[r["bin"] + 1] = r["df"]
    idf = (np.log((1 + counts[0]) / (1 + counts[1:])) + 1).astype(np.float32)

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        texts = [t for t in group["text"] if has_letter(t)]
        if not texts:
            return pd.DataFrame({"lang": pd.Series(dtype=object), "centre": pd.Series(dtype=object), "limit": pd.Series(dtype=float)})
        x = vectors(texts, idf)
        c = spherical_kmeans(x, centroids)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centre": [row.astype(np.float32).tobytes() for row in c], "limit": reject_limits(texts, x, c)})

    made = chosen.select("lang", "text").groupBy("lang").applyInPandas(cluster, "lang string, centre binary, limit double").orderBy("lang").collect()
    centres = np.stack([np.frombuffer(r["centre"], np.float32) for r in made]) if made else np.zeros((0, bins), np.float32)
    return Model(idf, [r["lang"] for r in made], centres, np.array([r["limit"] for r in made]))


def predicted(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns with lang_pred, score and rejected; languages come from the text alone.

    A null text or one without letters is ``und`` with score 0 and rejected.
    """
    given = shipped(docs.sparkSession, model)

    def run(batches):
        model = given()
        for batch in batches:
            names, scores, rejected = model.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                [*keep, "lang_pred", "score", "rejected"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, f"{fields}, lang_pred string, score double, rejected boolean")


def held_out(modulus: int, remainder: int) -> Column:
    """Rows kept from learning: CRC-32 of the id as text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) == remainder


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every row of ``docs``.

    Learns from rows that are not held out and have a language. Ids may be null or repeat,
    repeated rows are judged each; an empty table gives none. Other columns are ignored.
    """
    marked = docs.select("doc_id", "text", "lang", held_out(5, 0).alias("held_out"))
    model = fit(marked.where("NOT held_out AND lang IS NOT NULL"))
    return predicted(marked, model, ["doc_id", "held_out"])


def confident(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose language is not rejected: null texts, texts without letters and texts far from every language go.

    Repeated rows and null ids stay as they are; columns of any name pass unchanged.
    """
    model = fit(docs.select("doc_id", "text", "lang", held_out(5, 0).alias("held_out")).where("NOT held_out AND lang IS NOT NULL"))
    return in_order(predicted(packed(docs, "text"), model, ["rest", "text"]).where("NOT rejected"), docs.columns)
