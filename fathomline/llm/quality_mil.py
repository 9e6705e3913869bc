"""Quality score by attention-based multiple-instance learning.

A document is a bag of passages. Every passage of the whole text is encoded; gated
attention, learned from document labels alone, weighs the passages; the weighted
representation is scored. The passage figures are shares of character kinds, hashed
trigrams and the variety of four-byte strings.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.columns import sampled_ids, shipped, small
from fathomline.llm.language_id import held_out
from fathomline.session import written

PASSAGE = 512
# Documents of each label used to fit (smallest hashes of their ids), and passages of one of them.
SAMPLE = 2500
FIT_PASSAGES = 48
PASSED = 0.7
HIDDEN, GATE, TRIGRAMS, VARIETY = 24, 12, 48, 512
STEPS, RATE, DECAY = 250, 0.02, 1e-4
BLOCK = 2048
_KINDS = np.zeros(256, np.int64)
for _i in range(256):
    _c = chr(_i)
    _KINDS[_i] = (0 if _c == " " else 1 if _c == "\n" else 2 if "a" <= _c <= "z" else 3 if "A" <= _c <= "Z" else 4 if "0" <= _c <= "9" else 5 if _i >= 128
                  else 6 if _c in ".,;:" else 7 if _c in "!?" else 8 if _c in "#*$%&|<>" else 9 if _c in "{}[]()=+/\\_@" else 10)
KINDS = 11
FEATURES = KINDS + TRIGRAMS + 2


def passages(text: str | None) -> np.ndarray:
    """Figures of every passage of a whole text; a text without bytes is one empty passage."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    if not len(raw):
        return np.zeros((1, FEATURES), np.float32)
    return np.concatenate([_figures(raw[at:at + PASSAGE * BLOCK]) for at in range(0, len(raw), PASSAGE * BLOCK)])


def _figures(raw: np.ndarray) -> np.ndarray:
    n = -(-len(raw) // PASSAGE)
    own = np.arange(len(raw)) // PASSAGE
    size = np.bincount(own, minlength=n).astype(np.float32)[:, None]
    kinds = np.bincount(own * KINDS + _KINDS[raw], minlength=n * KINDS).reshape(n, KINDS) / size
    wide = raw.astype(np.uint32)
    tri = ((wide[:-2] * 31 + wide[1:-1]) * 31 + wide[2:]) * np.uint32(0x9E3779B1) >> np.uint32(8)
    grams = np.bincount(own[:-2] * TRIGRAMS + tri % np.uint32(TRIGRAMS), minlength=n * TRIGRAMS).reshape(n, TRIGRAMS) / size
    four = (tri[:-1] ^ (wide[3:] * np.uint32(0x85EBCA77))) % np.uint32(VARIETY)
    seen = np.zeros(n * VARIETY, bool)
    seen[own[:-3] * VARIETY + four] = True
    variety = seen.reshape(n, VARIETY).sum(axis=1, keepdims=True) / np.minimum(size, VARIETY)
    return np.concatenate([kinds, grams, variety, np.log1p(size) / 8], axis=1).astype(np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Encoder, gated attention and scorer; ``starts`` are the first passages of the bags."""

    SHAPES = {"e": (FEATURES, HIDDEN), "eb": (HIDDEN,), "v": (HIDDEN, GATE), "u": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,), "b": (1,)}

    def __init__(self, seed: int = 42):
        rng = np.random.default_rng(seed)
        self.p = {k: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32) if len(s) > 1 or k in "wc" else np.zeros(s, np.float32) for k, s in self.SHAPES.items()}
        self.mean, self.std = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict:
        p, sizes = self.p, np.diff(np.r_[starts, len(x)])
        bag = np.repeat(np.arange(len(starts)), sizes)
        z = np.clip((x - self.mean) / self.std, -8, 8)
        h = np.tanh(z @ p["e"] + p["eb"])
        t, s = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        a = (t * s) @ p["w"]
        a = np.exp(a - np.maximum.reduceat(a, starts)[bag])
        a /= np.add.reduceat(a, starts)[bag]
        m = np.add.reduceat(h * a[:, None], starts)
        return {"z": z, "h": h, "t": t, "s": s, "a": a, "m": m, "bag": bag, "y": _sigmoid(m @ p["c"] + p["b"])}

    def gradients(self, f: dict, starts: np.ndarray, target: np.ndarray) -> dict:
        p, n = self.p, len(target)
        d = ((f["y"] - target) / n).astype(np.float32)
        g = {"c": f["m"].T @ d, "b": np.array([d.sum()], np.float32)}
        dm = d[:, None] * p["c"]
        dmb = dm[f["bag"]]
        da = (dmb * f["h"]).sum(axis=1)
        da = f["a"] * (da - np.add.reduceat(f["a"] * da, starts)[f["bag"]])
        g["w"] = (f["t"] * f["s"]).T @ da
        dg = da[:, None] * p["w"]
        dt, ds = dg * f["s"] * (1 - f["t"] ** 2), dg * f["t"] * f["s"] * (1 - f["s"])
        g["v"], g["u"] = f["h"].T @ dt, f["h"].T @ ds
        dh = (dmb * f["a"][:, None] + dt @ p["v"].T + ds @ p["u"].T) * (1 - f["h"] ** 2)
        g["e"], g["eb"] = f["z"].T @ dh, dh.sum(axis=0)
        return g

    def train(self, bags: list[np.ndarray], target: np.ndarray) -> Model:
        """Full-batch Adam on the mean log loss."""
        x, starts = np.concatenate(bags), np.cumsum([0, *map(len, bags[:-1])])
        self.mean, self.std = x.mean(axis=0), x.std(axis=0) + 1e-3
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for step in range(1, STEPS + 1):
            g = self.gradients(self.forward(x, starts), starts, target)
            for k in self.p:
                grad = g[k] + DECAY * self.p[k]
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad**2
                self.p[k] = (self.p[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = []
        for at in range(0, len(texts), 64):
            bags = [passages(t) for t in texts[at:at + 64]]
            out.append(self.forward(np.concatenate(bags), np.cumsum([0, *map(len, bags[:-1])]))["y"])
        return np.concatenate(out) if out else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Model from documents with a label; a document with several labels takes the smallest.

    The sample is bounded, so it fits on the driver. Without both labels the model stays
    untrained and gives every text the score 1/2.
    """
    marks = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("int").alias("_y"))
    marked = sampled_ids(docs.select("doc_id").join(marks, "doc_id"), "_y", sample)
    chosen = docs.select("doc_id", "text").join(small(written(marked, "quality_sample"), 4 * sample), "doc_id")

    def run(batches):
        for batch in batches:
            for d, t, y in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "_y")]):
                x = passages(t)
                x = x[np.unique(np.linspace(0, len(x) - 1, FIT_PASSAGES).astype(int))]
                yield pa.RecordBatch.from_arrays([pa.array([d]), pa.array([x.tobytes()]), pa.array([y], pa.int32())], ["doc_id", "x", "y"])

    made = chosen.mapInArrow(run, "doc_id bigint, x binary, y int").collect()
    made.sort(key=lambda r: (r["doc_id"], r["x"]))
    model = Model()
    target = np.array([r["y"] for r in made], np.float32)
    if len(set(target)) < 2:
        model.p = {k: np.zeros_like(v) for k, v in model.p.items()}
        return model
    return model.train([np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES) for r in made], target)


def scored(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns, score and predicted; a null or empty text is one empty passage."""
    given = shipped(docs.sparkSession, model)

    def run(batches):
        model = given()
        for batch in batches:
            y = model.scores(batch.column("_text").to_pylist()).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(y), pa.array((y >= PASSED).astype(np.int32))], [*keep, "score", "predicted"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, f"{fields}, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; learns from rows that are not held out.

    Ids may be null or repeat, repeated rows are scored each; an empty table gives none.
    Columns beyond doc_id and text are ignored.
    """
    marked = docs.select("doc_id", "text", held_out(4, 2).alias("held_out"))
    model = fit(marked.where("NOT held_out").drop("held_out"), labels)
    return scored(marked, model, ["doc_id", "held_out"])
