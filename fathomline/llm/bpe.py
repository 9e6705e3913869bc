"""Byte-level BPE of whole texts by tree concatenation.

A text longer than a leaf is halved until every part is a leaf. Leaves are rows of their
own, so the parts of one long text are encoded in parallel on many executors. Neighbours
are then joined in pairs, level by level, until one sequence of ids is left:

1. The text around a join is split into pieces again, from a boundary that the right
   neighbour cannot move up to a boundary that both scans share. The stretch doubles until
   there is one; beyond it both scans are in the same state and go on alike.
2. A piece that runs across the join is encoded from the tokens of its two parts: a window
   of tokens around the join is encoded anew and doubled until its first and its last token
   are those of the parts. Neighbouring tokens that no merge joins when they stand alone
   are joined by no merge in a longer piece either, so one equal token on each side proves
   that all tokens beyond the window stay as they are.

So the ids are exactly those of the library for the whole text, at any leaf size.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections import defaultdict
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.columns import packed, slices, unpacked

# Code points of a leaf; shorter texts are encoded in one go and are not moved.
LEAF_CHARS = 1 << 15
# Bytes of text handled at once.
SLICE_BYTES = 1 << 19
# Tokens on each side of a join that are encoded first.
WINDOW = 4
# Pieces whose tokens a task remembers; beyond that it starts anew.
KNOWN_PIECES = 200_000
# Latin letters up to here have the same classes in every Unicode version, so any pattern engine cuts them alike.
LAST_LATIN = 0x24F


def read_definition(path: str) -> str:
    """The tokenizer's definition, read on the driver and sent to the executors, which need no file.

    Only byte-level BPE over all bytes, without normaliser, dropout or affixes, with plain added tokens, is accepted.
    """
    with open(path, encoding="utf-8") as file:
        text = file.read()
    made = json.loads(text)
    model, split = made["model"], made["pre_tokenizer"] or {}
    plain = all(not t[k] for t in made["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    kind = (model["type"], split.get("type"), split.get("use_regex"), split.get("add_prefix_space"), made["normalizer"])
    if kind != ("BPE", "ByteLevel", True, False, None) or not plain or not set(byte_letters()) <= model["vocab"].keys() or any(
            model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        raise ValueError(f"not a plain byte-level BPE: {path}")
    return text


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 as it is, the rest from U+0100 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in printable}
    for b in range(256):
        letters.setdefault(b, chr(0x100 + len(letters) - len(printable)))
    return [letters[b] for b in range(256)]


def latin_pieces() -> tuple[re.Pattern, re.Pattern]:
    """(texts of printable Latin alone, the pieces of such a text).

    The pieces are those of byte-level BPE: contractions; letters, digits or other signs
    with at most one blank before them; white space without the blank that goes to the next.
    """
    named = {c: chr(c) for c in range(LAST_LATIN + 1)}
    letters, digits = ("".join(re.escape(v) for v in named.values() if unicodedata.category(v)[0] == kind) for kind in "LN")
    blank = r" \t\n\x0b\x0c\r\x85\xa0"
    return (re.compile(rf"[\t\n\r\x20-\x7e\xa1-{chr(LAST_LATIN)}]*"),
            re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{letters}]+| ?[{digits}]+| ?[^{blank}{letters}{digits}]+|[{blank}]+(?![^{blank}])|[{blank}]+"))


class Segment:
    """Token ids of a stretch of text; ``first`` marks the tokens that begin a piece."""

    def __init__(self, ids: np.ndarray, first: np.ndarray):
        self.ids, self.first = ids, first

    def __len__(self):
        return len(self.ids)

    def part(self, start: int, end: int) -> Segment:
        return Segment(self.ids[start:end], self.first[start:end])


def chained(parts: list[Segment]) -> Segment:
    return Segment(np.concatenate([p.ids for p in parts]), np.concatenate([p.first for p in parts]))


class Codec:
    """The library's tokenizer with the joins of neighbouring stretches."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merges = Tokenizer(self.tokenizer.model)  # the merges alone: no added tokens, no pieces
        letters = byte_letters()
        self.letters = dict(enumerate(letters))
        byte_of = {letter: b for b, letter in enumerate(letters)}
        self.added = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        size = self.tokenizer.get_vocab_size()
        self.bytes = [b""] * (max(size, *self.added) + 1 if self.added else size)
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes[i] = self.added[i].encode() if i in self.added else bytes(byte_of[c] for c in token)
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.latin, self.pieces = latin_pieces()
        self._forget()
        self.special = np.zeros(len(self.bytes), bool)
        self.special[list(self.added)] = True

    def cut(self, text: str, leaf_chars: int) -> list[str]:
        """``text`` in 2**k parts, none much over ``leaf_chars``; no cut goes through an added token's string."""
        parts = 1
        while len(text) > parts * leaf_chars:
            parts *= 2
        places = [0]
        for k in range(1, parts):
            at = max(k * len(text) // parts, places[-1])
            moved = True
            while moved:
                moved = False
                for content in self.added.values():
                    found = text.find(content, max(0, at - len(content) + 1), at + len(content) - 1)
                    if 0 <= found < at:
                        at, moved = found + len(content), True
            places.append(at)
        return [text[a:b] for a, b in zip(places, [*places[1:], len(text)])]

    def segments(self, texts: list[str]) -> list[Segment]:
        """Tokens of each text. Latin texts are cut here and each different piece is merged once; all others go to the library whole."""
        plain = [bool(self.latin.fullmatch(t)) and not any(c in t for c in self.added.values()) for t in texts]
        cut = [self.pieces.findall(t) for t, ok in zip(texts, plain) if ok]
        if len(self.known) > KNOWN_PIECES:
            self._forget()
        sizes, ids = self._tokens(list(chain.from_iterable(cut)))
        ends = np.cumsum(sizes)
        first = np.zeros(len(ids), bool)
        first[ends - sizes] = True
        stops = np.concatenate([[0], ends])[np.cumsum([0, *map(len, cut)])].tolist()
        made = (Segment(ids[a:b], first[a:b]) for a, b in zip(stops, stops[1:]))
        others = iter(self.tokenizer.encode_batch([t for t, ok in zip(texts, plain) if not ok], add_special_tokens=False))
        return [next(made) if ok else self._of_library(next(others)) for ok in plain]

    def _forget(self):
        """No piece is known: a new one gets the next number, by which its tokens lie in ``held`` from ``starts`` on."""
        self.known: dict[str, int] = defaultdict(count().__next__)
        self.starts, self.held = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _tokens(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of tokens of each piece, and all tokens. Different pieces that are not known are merged once, in one call.

        A piece begins where its bytes begin, so the lengths of the tokens tell whose they are.
        """
        before = len(self.known)
        number = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        if new := list(islice(reversed(self.known), len(self.known) - before))[::-1]:
            # Latin pieces hold no zero byte: it divides them while their bytes become letters
            spelled = "\0".join(new).encode().decode("latin-1").translate(self.letters).split(self.letters[0])
            ids = np.array(self.merges.encode_batch_fast([spelled], is_pretokenized=True, add_special_tokens=False)[0].ids, np.int32)
            ends = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(np.fromiter(map(len, spelled), np.int64, len(spelled))), "right")
            self.starts, self.held = np.concatenate([self.starts, len(self.held) + ends]), np.concatenate([self.held, ids])
        start, sizes = self.starts[number], np.diff(self.starts)[number]
        return sizes, self.held[np.arange(sizes.sum()) + np.repeat(start - np.cumsum(sizes) + sizes, sizes)]

    @staticmethod
    def _of_library(encoding) -> Segment:
        word = np.array(encoding.word_ids, np.int64)
        return Segment(np.array(encoding.ids, np.int32), np.concatenate([[True], word[1:] != word[:-1]]) if len(word) else np.zeros(0, bool))

    def raw(self, ids: np.ndarray) -> bytes:
        return b"".join([self.bytes[i] for i in ids.tolist()])

    def text(self, ids: list[int]) -> str:
        """Text of ids: their bytes, with U+FFFD for what forms no character."""
        return b"".join([self.bytes[i] for i in ids]).decode(errors="replace")

    def merged(self, data: bytes) -> np.ndarray:
        """Tokens of one piece, or of a part of one."""
        return np.array(self.merges.encode_batch_fast([data.decode("latin-1").translate(self.letters)], add_special_tokens=False)[0].ids, np.int32)

    def piece(self, data: bytes) -> Segment:
        ids = self.merged(data)
        return Segment(ids, np.arange(len(ids)) == 0)

    def across(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Tokens of a piece from the tokens of its two parts."""
        width = WINDOW
        while True:
            i, j = max(0, len(left) - width), min(len(right), width)
            made = self.merged(self.raw(left[i:]) + self.raw(right[:j]))
            if (i == 0 or made[0] == left[i]) and (j == len(right) or made[-1] == right[j - 1]):
                return np.concatenate([left[:i], made, right[j:]])
            width *= 2

    def joined(self, left: Segment, right: Segment) -> Segment:
        """Tokens of a text from those of its two parts, as if encoded in one go."""
        if not len(left) or not len(right) or self.special[left.ids[-1]] or self.special[right.ids[0]]:
            return chained([left, right])
        # Added tokens divide a text: nothing beyond the nearest one is touched by the join.
        barred = np.flatnonzero(self.special[left.ids])
        lowest = int(barred[-1]) + 1 if len(barred) else 0
        barred = np.flatnonzero(self.special[right.ids])
        highest = int(barred[0]) if len(barred) else len(right)
        left_starts = lowest + np.flatnonzero(left.first[lowest:])
        right_starts = np.append(np.flatnonzero(right.first[:highest]), highest)
        width = WINDOW
        while True:
            # At least four pieces before the join: the pieces before those cannot see its other side.
            lo = int(left_starts[-width]) if width < len(left_starts) else lowest
            hi = int(right_starts[width]) if width < len(right_starts) else highest
            data = self.raw(left.ids[lo:]) + self.raw(right.ids[:hi])
            join = int(self.lengths[left.ids[lo:]].sum())
            ends = np.cumsum([len(letters) for letters, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(data.decode())])
            right_ends = join + np.cumsum(self.lengths[right.ids[:hi]])[right_starts[1:][right_starts[1:] <= hi] - 1]
            sure = ends if hi == highest else ends[:-2]  # two pieces after it: it cannot see the end of the stretch
            shared = np.intersect1d(sure[sure > join], right_ends)
            if len(shared):
                break
            width *= 2
        stop = int(shared[0])
        made = [left.part(0, lo)]
        known = self._known(left.part(lo, len(left)), 0) | self._known(right.part(0, hi), join)
        start = 0
        for end in ends[ends <= stop].tolist():
            if (start, end) in known:
                made.append(known[start, end])
            elif start < join < end:
                halves = [known.get(part) or self.piece(data[slice(*part)]) for part in ((start, join), (join, end))]
                ids = self.across(halves[0].ids, halves[1].ids)
                made.append(Segment(ids, np.arange(len(ids)) == 0))
            else:
                made.append(self.piece(data[start:end]))
            start = end
        rest = int(right_starts[1:][np.searchsorted(right_ends, stop)])
        return chained([*made, right.part(rest, len(right))])

    def _known(self, segment: Segment, offset: int) -> dict[tuple[int, int], Segment]:
        """Pieces of a segment by their first byte and the byte after them."""
        at = np.append(np.flatnonzero(segment.first), len(segment)).tolist()
        places = offset + np.concatenate([[0], np.cumsum(self.lengths[segment.ids])])
        return {(int(places[a]), int(places[b])): segment.part(a, b) for a, b in zip(at, at[1:])}

    def tree(self, level: list[Segment]) -> Segment:
        """Neighbours joined in pairs until one segment is left."""
        while len(level) > 1:
            level = [self.joined(*level[k:k + 2]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
        return level[0]


def _ids_array(rows: list[np.ndarray] | list[list[int]]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate([np.asarray(r, np.int32) for r in rows]) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encoded(docs: DataFrame, definition: str, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """All columns of ``docs`` but text, and ``token_ids``, the ids of the whole text.

    A null text has no ids, like an empty one. Repeated rows are encoded each; ids and other
    columns may be null. A column named token_ids is replaced. Only texts of more than
    ``leaf_chars`` code points are shuffled: first their leaves, then the ids of the leaves,
    which meet in one task per text to be joined.
    """
    docs = docs.drop("token_ids")
    others = [c for c in docs.columns if c != "text"]
    rows = packed(docs.withColumn("text", F.coalesce("text", F.lit(""))), "text")
    rest = rows.schema["rest"].dataType.simpleString()
    shipped = docs.sparkSession.sparkContext.broadcast(definition)

    def whole(batches):
        codec = None
        for batch in batches:
            codec = codec or Codec(shipped.value)
            texts = batch.column("text")
            for a, b in slices(pc.binary_length(texts).to_pylist(), SLICE_BYTES):
                made = codec.segments(texts.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("rest").slice(a, b - a), _ids_array([s.ids for s in made])], ["rest", "token_ids"])

    def cut(batches):
        codec = Codec(shipped.value)
        for batch in batches:
            for k in range(batch.num_rows):
                parts = codec.cut(batch.column("text")[k].as_py(), leaf_chars)
                first = batch.column("rest").slice(k, 1)
                for at, (a, b) in enumerate(slices([len(p) for p in parts], SLICE_BYTES)):
                    carried = pa.concat_arrays([first, pa.nulls(b - a - 1, first.type)]) if at == 0 else pa.nulls(b - a, first.type)
                    keys = pa.array([batch.column("key")[k].as_py()] * (b - a), pa.int64())
                    yield pa.RecordBatch.from_arrays([keys, pa.array(range(a, b), pa.int32()), carried, pa.array(parts[a:b], pa.string())], ["key", "leaf", "rest", "part"])

    def leaves(batches):
        """Ids of each leaf; the complement of an id marks a token inside a piece."""
        codec = None
        for batch in batches:
            codec = codec or Codec(shipped.value)
            parts = batch.column("part")
            for a, b in slices(pc.binary_length(parts).to_pylist(), SLICE_BYTES):
                made = codec.segments(parts.slice(a, b - a).to_pylist())
                marked = _ids_array([np.where(s.first, s.ids, ~s.ids) for s in made])
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(a, b - a) for c in ("key", "leaf", "rest")], marked], ["key", "leaf", "rest", "marks"])

    def join(batches):
        """Leaves come sorted by text and place; one text is held at a time."""
        codec, key, held, carried = None, None, [], None
        for batch in batches:
            codec = codec or Codec(shipped.value)
            marks = batch.column("marks")
            for k, row in enumerate(batch.column("key").to_pylist()):
                if row != key:
                    if held:
                        yield pa.RecordBatch.from_arrays([carried, _ids_array([codec.tree(held).ids])], ["rest", "token_ids"])
                    key, held, carried = row, [], batch.column("rest").slice(k, 1)
                values = marks[k].values.to_numpy(zero_copy_only=False)
                held.append(Segment(np.where(values < 0, ~values, values).astype(np.int32), values >= 0))
        if held:
            yield pa.RecordBatch.from_arrays([carried, _ids_array([codec.tree(held).ids])], ["rest", "token_ids"])

    is_long = F.char_length("text") > leaf_chars
    short = rows.where(~is_long).mapInArrow(whole, f"rest {rest}, token_ids array<int>")
    halves = rows.where(is_long).select(F.monotonically_increasing_id().alias("key"), "rest", "text").mapInArrow(cut, f"key bigint, leaf int, rest {rest}, part string")
    marked = halves.repartition("key", "leaf").mapInArrow(leaves, f"key bigint, leaf int, rest {rest}, marks array<int>")
    long = marked.repartition("key").sortWithinPartitions("key", "leaf").mapInArrow(join, f"rest {rest}, token_ids array<int>")
    return unpacked(short.union(long), others, "token_ids")


def decoded(tokens: DataFrame, definition: str) -> DataFrame:
    """All columns of ``tokens`` and ``decoded``, the text of its ``token_ids``.

    Bytes that form no character are replaced as the library does; null or no ids give an
    empty text. A column named decoded is replaced.
    """
    tokens = tokens.drop("decoded")
    others = [c for c in tokens.columns if c != "token_ids"]
    rows = packed(tokens, "token_ids")
    rest = rows.schema["rest"].dataType.simpleString()
    shipped = tokens.sparkSession.sparkContext.broadcast(definition)

    def run(batches):
        codec = None
        for batch in batches:
            codec = codec or Codec(shipped.value)
            ids = batch.column("token_ids")
            sizes = np.nan_to_num(ids.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64).tolist()
            for a, b in slices(sizes, SLICE_BYTES):
                part = ids.slice(a, b - a)
                flat = part.flatten().to_numpy(zero_copy_only=False).tolist()
                ends = np.cumsum([0, *sizes[a:b]]).tolist()
                texts = [codec.text(flat[i:j]) for i, j in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("rest").slice(a, b - a), part, pa.array(texts, pa.string())], ["rest", "token_ids", "decoded"])

    return unpacked(rows.mapInArrow(run, f"rest {rest}, token_ids array<int>, decoded string"), others, "token_ids", "decoded")
