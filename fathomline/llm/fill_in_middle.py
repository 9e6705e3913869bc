"""Fill-in-the-middle by displacement scatter.

Each text is cut into prefix, middle and suffix at two seeded places and its parts are put
in another order between sentinels. Over the bytes of a batch a part is a run that moves by
one distance. The cuts are found by a scan for the first bytes of code points; a difference
array holds, where a run starts, by how much its distance differs from that of the run
before; its cumulative sum is the distance of every byte, and numpy scatters the bytes to
their places. The inverse reads the sentinels of an output, builds the same distances and
gathers the bytes back.

Bytes are handled in blocks, so the arrays beside a text stay small at any length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.columns import packed, slices, unpacked

SENTINELS = ("<P>", "<S>", "<M>")
PLAIN_PERCENT = 10
SPM_PERCENT = 20
SLICE_BYTES = 8 << 20
BLOCK = 1 << 20
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ("plain", "psm", "spm")


def _blocks(total: int, block: int = BLOCK):
    return ((a, min(a + block, total)) for a in range(0, total, block))


def cut_places(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Byte places of ``cuts`` (rows x k, code points from the row's start, rising) in a batch of UTF-8 texts."""
    before, seen = np.zeros(len(offsets), np.int64), 0
    counts = []
    for a, b in _blocks(len(data), block):
        starts = np.flatnonzero((data[a:b] & 0xC0) != 0x80)
        rows = slice(*np.searchsorted(offsets, [a, b]))
        before[rows] = seen + np.searchsorted(starts, offsets[rows] - a)
        counts.append(seen)
        seen += len(starts)
    before[offsets == len(data)] = seen
    wanted = (before[:-1, None] + cuts).ravel()
    places = np.full(len(wanted), len(data), np.int64)
    for (a, b), first, last in zip(_blocks(len(data), block), counts, [*counts[1:], seen]):
        here = slice(*np.searchsorted(wanted, [first, last]))
        if here.start < here.stop:
            places[here] = a + np.flatnonzero((data[a:b] & 0xC0) != 0x80)[wanted[here] - first]
    return places.reshape(cuts.shape)


def moves(offsets: np.ndarray, places: np.ndarray, forms: np.ndarray, mark: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs and sentinels of a batch: run starts, run distances, output offsets, sentinel places (rows x P, S, M).

    ``offsets`` are those of the texts, ``places`` the two cuts of each, ``mark`` the bytes of a sentinel.
    """
    start, end = offsets[:-1], offsets[1:]
    first, second = places[:, 0], places[:, 1]
    plain = forms == PLAIN
    out = np.concatenate([[0], np.cumsum(end - start + np.where(plain, 0, 3 * mark))])
    at = out[:-1]
    prefix, suffix = first - start, end - second
    # Where each part starts in the output.
    prefix_at = np.where(plain, at, np.where(forms == PSM, at + mark, at + 2 * mark + suffix))
    suffix_at = np.where(plain, at + (second - start), np.where(forms == PSM, at + 2 * mark + prefix, at + mark))
    middle_at = np.where(plain, at + prefix, at + 3 * mark + prefix + suffix)
    runs = np.stack([start, first, second], axis=1).ravel()
    distances = np.stack([prefix_at - start, middle_at - first, suffix_at - second], axis=1).ravel()
    sentinels = np.stack([prefix_at - mark, suffix_at - mark, middle_at - mark], axis=1)
    return runs, distances, out, sentinels


def targets(runs: np.ndarray, distances: np.ndarray, total: int, block: int = BLOCK):
    """(start, end, output place of each byte) by block: the cumulative sum of the difference array."""
    steps = np.diff(distances, prepend=0)
    carried = 0
    for a, b in _blocks(total, block):
        here = slice(*np.searchsorted(runs, [a, b]))
        change = np.zeros(b - a, np.int64)
        np.add.at(change, runs[here] - a, steps[here])
        change[0] += carried
        shift = np.cumsum(change)
        carried = int(shift[-1])
        yield a, b, np.arange(a, b) + shift


def _text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a text column without nulls."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def _text_column(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def scattered(column: pa.Array, forms: np.ndarray, cuts: np.ndarray, sentinels: tuple[str, str, str], block: int = BLOCK) -> pa.Array:
    """Outputs of a batch of texts."""
    data, offsets = _text_buffers(column)
    marks = [np.frombuffer(s.encode(), np.uint8) for s in sentinels]
    runs, distances, out, places = moves(offsets, cut_places(data, offsets, cuts, block), forms, len(marks[0]))
    made = np.empty(out[-1], np.uint8)
    for a, b, target in targets(runs, distances, len(data), block):
        made[target] = data[a:b]
    for mark, at in zip(marks, places[forms != PLAIN].T):
        made[at[:, None] + np.arange(len(mark))] = mark
    return _text_column(made, out)


def gathered(column: pa.Array, forms: np.ndarray, sentinels: tuple[str, str, str], block: int = BLOCK) -> pa.Array:
    """Texts of a batch of outputs: the inverse of ``scattered``, from outputs and forms alone."""
    data, out = _text_buffers(column)
    raw, (p, s, m) = memoryview(data), [x.encode() for x in sentinels]
    mark = len(p)
    lengths = np.diff(out) - np.where(forms == PLAIN, 0, 3 * mark)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    places = np.repeat(offsets[:-1, None], 2, axis=1)
    for k in np.flatnonzero(forms != PLAIN).tolist():
        row = bytes(raw[out[k]:out[k + 1]])
        inner, last = row.index(s if forms[k] == PSM else p, mark), row.index(m)
        prefix = inner - mark if forms[k] == PSM else last - inner - mark
        places[k] += [prefix, prefix + len(row) - last - mark]
    runs, distances, _, _ = moves(offsets, places, forms, mark)
    made = np.empty(offsets[-1], np.uint8)
    for a, b, target in targets(runs, distances, len(made), block):
        made[a:b] = data[target]
    return _text_column(made, offsets)


def _draw(seed: int, doc_id: Column, group: int) -> Column:
    """The given 8-digit group of the id's hash, as an unsigned integer."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * group - 7, 8), 16, 10).cast("long")


def transformed(docs: DataFrame, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT, seed: int = 1,
                sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """All columns of ``docs`` but text, then n, form, prefix_chars, middle_chars and output.

    A null text is an empty one; empty texts and texts that contain a sentinel stay plain, so
    outputs can always be undone. The draw depends on the id and the seed alone: repeated
    rows are cut alike, null ids are drawn as the empty string. Columns named like the new
    ones are replaced. The sentinels (prefix, suffix, middle) must have equally many bytes,
    differ, and none may end as it or another one starts.
    """
    coded = [s.encode() for s in sentinels]
    borders = any(a[-k:] == b[:k] for a in coded for b in coded for k in range(1, len(b)))
    if len({*map(len, coded)}) != 1 or len({*coded}) != 3 or not coded[0] or borders:
        raise ValueError("sentinels must be three different strings of equal size that cannot overlap")
    docs = docs.drop("n", "form", "prefix_chars", "middle_chars", "output")
    others = [c for c in docs.columns if c != "text"]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = packed(docs.withColumn("text", text), "text")
    drawn = rows.withColumns({f"h{k}": _draw(seed, F.col("rest")["doc_id"], k) for k in range(1, 5)}).withColumn("n", F.char_length("text").cast("long"))
    marked = F.lit(False)
    for s in sentinels:
        marked = marked | F.contains("text", F.lit(s))
    form = F.when((F.col("n") == 0) | marked | (F.col("h3") % 100 >= 100 - plain_percent), "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    ends = [F.pmod(h, F.col("n") + 1) for h in ("h1", "h2")]
    cut = drawn.select("rest", "text", "n", form.alias("form"), F.least(*ends).alias("first"), F.greatest(*ends).alias("second"))

    def run(batches):
        for batch in batches:
            sizes = pc.binary_length(batch.column("text")).to_pylist()
            for a, b in slices(sizes, SLICE_BYTES):
                part = batch.slice(a, b - a)
                forms = np.array([FORMS.index(f) for f in part.column("form").to_pylist()])
                cuts = np.stack([part.column(c).to_numpy() for c in ("first", "second")], axis=1)
                made = scattered(part.column("text"), forms, cuts, sentinels)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("rest", "n", "form", "first", "second")], made], ["rest", "n", "form", "first", "second", "output"])

    rest = rows.schema["rest"].dataType.simpleString()
    made = cut.mapInArrow(run, f"rest {rest}, n bigint, form string, first bigint, second bigint, output string")
    told = F.col("form") != "plain"
    return made.select(*[F.col("rest")[c].alias(c) for c in others], "n", "form", F.when(told, F.col("first")).alias("prefix_chars"),
                       F.when(told, F.col("second") - F.col("first")).alias("middle_chars"), "output")


def restored(outputs: DataFrame, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """All columns of ``outputs`` and ``restored``, the text rebuilt from its output and form alone.

    A null output or form gives an empty text. A column named restored is replaced.
    """
    outputs = outputs.drop("restored")
    others = [c for c in outputs.columns if c != "output"]
    known = outputs.withColumn("output", F.when(F.col("form").isNotNull(), F.col("output")))
    rows = packed(known.withColumn("output", F.coalesce("output", F.lit(""))), "output").withColumn("form", F.when(F.length("output") > 0, F.col("rest")["form"]).otherwise("plain"))

    def run(batches):
        for batch in batches:
            sizes = pc.binary_length(batch.column("output")).to_pylist()
            for a, b in slices(sizes, SLICE_BYTES):
                part = batch.slice(a, b - a)
                forms = np.array([FORMS.index(f) for f in part.column("form").to_pylist()])
                made = gathered(part.column("output"), forms, sentinels)
                yield pa.RecordBatch.from_arrays([part.column("rest"), part.column("output"), made], ["rest", "output", "restored"])

    rest = rows.schema["rest"].dataType.simpleString()
    return unpacked(rows.mapInArrow(run, f"rest {rest}, output string, restored string"), others, "output", "restored")
