"""Removal of repeated byte strings by a hash-compared suffix sort.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts in a
document with a smaller id. Sorting every suffix of the corpus would move the corpus
many times over, so only suffixes that can repeat are sorted:

1. Anchors. Positions are picked by their content (the smallest hash of a short gram in
   every window), so equal strings have equal anchors and every string has one. Per
   anchor its gram hash and the hash of its whole context (all strings that hold it) are
   shuffled. A context that a smaller document has too is settled: all its strings are
   repeats. An anchor that no other document has is settled as well: none is.
2. Suffix sort. The strings left, not covered by a settled context and with a shared anchor,
   are cut out of the texts and meet by anchor. Their suffixes are merge-sorted; a comparison finds
   the common extension by binary search over prefix polynomial hashes. Neighbours with
   a common extension of ``LENGTH`` are the same string, checked byte by byte.
3. Removal. Settled contexts and repeated strings are applied to the texts.

Hashes of 64 bits decide in step 1, compared bytes in step 2. What one task receives for
an anchor is one row per context and chunk of documents: further equal contexts of a chunk
are settled there and dealt by text, and an anchor with many different contexts in a chunk
is dealt by context, then by string.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.session import written

LENGTH = 50
GRAM = 18
SPAN = LENGTH - GRAM + 1
CHUNK_BYTES = 8 << 20
# Document bytes for each bucket of anchors, and for each bucket of strings: a string needs more memory to sort.
BUCKET_BYTES = 12 << 20
STRING_BUCKET_BYTES = 2 << 20
# Document bytes for each group by which results travel back to the texts.
GROUP_BYTES = 8 << 20
BLOCK = 1 << 20
MANY_CONTEXTS = 64
KEPT_POWERS = BLOCK + 8 * LENGTH + 2
LAST_ID = 2**63 - 1
NOWHERE = np.zeros(0, np.int64)
UNSHARED, OPEN, OPEN_MANY, SETTLED, REPEATED = range(5)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(_BASE), -1, 2**64))
    out = []
    for b in (_BASE, inverse):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


_KEPT: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    """The powers for all but very long arrays, computed once in a task."""
    if not _KEPT:
        _KEPT[0] = _powers(KEPT_POWERS)
    return _KEPT[0]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(30))


class Prefix:
    """Prefix polynomial hashes of a byte array: the hash of any part in constant time."""

    def __init__(self, raw: np.ndarray):
        power, self.inverse = _kept_powers() if len(raw) < KEPT_POWERS else _powers(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        values = _BYTES[raw]
        values *= power[:len(raw)]
        np.cumsum(values, out=self.sums[1:])

    def part(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every window of ``width`` values."""
    n, size = len(x) - width + 1, 1
    while size * 2 <= width:
        x = pick(x[:len(x) - size], x[size:])
        size *= 2
    return pick(x[:n], x[width - size:width - size + n])


def _grams(p: Prefix, n: int) -> np.ndarray:
    m = n - GRAM + 1
    x = p.sums[GRAM:n + 1] - p.sums[:m]
    x *= p.inverse[:m]
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def _picked(grams: np.ndarray) -> np.ndarray:
    """Positions whose gram hash is the smallest of some window of ``SPAN`` grams."""
    lowest = _slide(grams, SPAN, np.minimum)
    edge = np.zeros(SPAN - 1, np.uint64)
    return np.flatnonzero(_slide(np.concatenate([edge, lowest, edge]), SPAN, np.maximum) == grams)


def anchors(raw: np.ndarray, contexts: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, gram hashes and (if asked for) context hashes of a whole text's anchors.

    A long text is worked through in blocks that overlap by more than a context.
    """
    n, margin = len(raw), 4 * LENGTH
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    out = []
    for core in range(0, n, BLOCK):
        low, high = max(0, core - margin), min(n, core + BLOCK + margin)
        if high - low < LENGTH:
            continue
        p = Prefix(raw[low:high])
        grams = _grams(p, high - low)
        at = _picked(grams)
        at = at[(at + low >= core) & (at + low < core + BLOCK)]
        if not contexts:
            out.append((at + low, grams[at], grams[:0]))
            continue
        left, right = np.minimum(at + low, SPAN - 1), np.minimum(n - low - at, LENGTH)
        shape = (left * 64 + right).astype(np.uint64)
        out.append((at + low, grams[at], _mix(p.part(at - left, at + right) + shape * np.uint64(0xD6E8FEB86659FD93))))
    return tuple(np.concatenate([o[i] for o in out]) for i in range(3))


def _squeeze(x: np.ndarray) -> bytes:
    """Compressed array, bytes of equal weight together."""
    planes = np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T) if len(x) else np.zeros(0, np.uint8)
    return zstandard.compress(planes.tobytes(), 1)


def _spread(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel() if len(planes) else np.zeros(0, kind)


def _squeeze_rows(row: np.ndarray) -> bytes:
    """Compressed row keys; nothing if all are 0, as where no id repeats."""
    return _squeeze(row) if row.any() else b""


def _spread_rows(data: bytes, n: int) -> np.ndarray:
    return _spread(data, np.int64) if data else np.zeros(n, np.int64)


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _by_context(doc: np.ndarray, context: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by gram, then by context, where a new context begins in it, and the smallest document of each row's context.

    Grams and contexts become ranks, so that one number orders both; rows of a context stay in any order.
    """
    rank = np.zeros(len(doc), np.int64)
    for x in (gram, context):
        order = np.argsort(x)
        step = np.zeros(len(x), np.int64)
        step[order[1:]] = x[order[1:]] != x[order[:-1]]
        step[order] = np.cumsum(step[order])
        rank = rank << 32 | step
    order = np.argsort(rank)
    new = np.ones(len(doc), bool)
    new[1:] = rank[order[1:]] != rank[order[:-1]]
    return order, new, np.minimum.reduceat(doc[order], np.flatnonzero(new))[np.cumsum(new) - 1]


def _pieces(key: np.ndarray) -> list[tuple[int, int]]:
    """Runs of equal values of a sorted array."""
    if not len(key):
        return []
    edges = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


def _chunks(batches, names: list[str]):
    """Lists of rows with about ``CHUNK_BYTES`` of text (the last column) each."""
    rows, size = [], 0
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in names]):
            rows.append(row)
            size += len(row[-1] or b"")
            if size >= CHUNK_BYTES:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


ANCHOR_ROWS = "bucket bigint, marks binary, grams binary, contexts binary, docs binary, rows binary, places binary"


def anchor_rows(batches, buckets: int):
    """Step 1, per chunk of documents: packed anchors for each bucket.

    Marks: 0 an anchor to be compared, 1 one whose context stands in a smaller document of the
    chunk, 2 one dealt by context, 3 the note that its gram has many contexts.
    """
    for rows in _chunks(batches, ["doc_id", "row", "raw"]):
        made = [(d, k, *anchors(np.frombuffer(zstandard.decompress(r), np.uint8))) for d, k, r in rows]
        doc, row = (np.repeat(np.array([m[i] for m in made], np.int64), [len(m[2]) for m in made]) for i in (0, 1))
        place, gram, context = (np.concatenate([m[i] for m in made]) for i in (2, 3, 4))
        if not len(doc):
            continue
        order, new, lowest = _by_context(doc, context, gram)
        doc, row, place, gram, context = doc[order], row[order], place[order].astype(np.uint32), gram[order], context[order]
        new_gram = np.r_[True, gram[1:] != gram[:-1]]
        group = np.cumsum(new_gram) - 1
        many = (np.bincount(group, weights=new) >= MANY_CONTEXTS)[group]
        mark = np.where(doc > lowest, 1, np.where(many, 2, 0)).astype(np.uint8)
        # what a chunk has settled is compared with nothing any more: it is dealt by its text, not by its gram
        bucket = np.where(mark == 1, _part(doc, row, buckets).astype(np.uint64), np.where(mark == 2, context, gram) % np.uint64(buckets))
        note = np.flatnonzero(new_gram & many)
        bucket = np.r_[bucket, gram[note] % np.uint64(buckets)]
        small = (np.r_[gram, gram[note]] // np.uint64(buckets)).astype(np.uint32)
        mark = np.r_[mark, np.full(len(note), 3, np.uint8)]
        order = np.lexsort((small, mark, bucket))
        for at, end in _pieces(bucket[order]):
            i = order[at:end]
            m, own = mark[i], i[i < len(doc)]
            g = small[i][m != 1]
            yield _batch({
                "bucket": pa.array([int(bucket[i[0]])]), "marks": pa.array([_squeeze(m)]), "grams": pa.array([_squeeze(np.diff(g, prepend=np.uint32(0)))]),
                "contexts": pa.array([context[i[(m == 0) | (m == 2)]].tobytes()]), "docs": pa.array([_squeeze(doc[own])]),
                "rows": pa.array([_squeeze_rows(row[own])]), "places": pa.array([_squeeze(place[own])])})


OUTCOME_ROWS = "part bigint, docs binary, rows binary, kinds binary, places binary"


def _part(doc: np.ndarray, row: np.ndarray, parts: int) -> np.ndarray:
    """Group of texts, by which what is known of them travels."""
    return (_mix(doc.astype(np.int64).view(np.uint64) ^ _mix(row.astype(np.int64).view(np.uint64))) % np.uint64(parts)).astype(np.int64)


def _outcomes(doc: np.ndarray, row: np.ndarray, kind: np.ndarray, place: np.ndarray, parts: int):
    """Packed (document, row key, kind, position), one row for each group of texts."""
    part = _part(doc, row, parts)
    order = np.lexsort((doc, part))
    for at, end in _pieces(part[order]):
        i = order[at:end]
        yield _batch({"part": pa.array(part[i[:1]]), "docs": pa.array([_squeeze(doc[i])]), "rows": pa.array([_squeeze_rows(row[i])]), "kinds": pa.array([_squeeze(kind[i].astype(np.uint8))]), "places": pa.array([_squeeze(place[i].astype(np.int64))])})


def _by_bucket(batches, names: list[str]):
    """All packed rows of one bucket at a time; rows come sorted by bucket."""
    held, bucket = [], None
    for batch in batches:
        for b, *row in zip(batch.column("bucket").to_pylist(), *[batch.column(c).to_pylist() for c in names]):
            if b != bucket:
                if held:
                    yield held
                bucket, held = b, []
            held.append(row)
    if held:
        yield held


def settle(batches, groups: int):
    """Step 1, per bucket: what is known of each anchor that other documents share."""
    for rows in _by_bucket(batches, ["marks", "grams", "contexts", "docs", "rows", "places"]):
        parts = []
        for marks, grams, contexts, docs, keys, places in rows:
            m = _spread(marks, np.uint8)
            g, c = np.zeros(len(m), np.uint32), np.zeros(len(m), np.uint64)
            d, k, p = np.full(len(m), LAST_ID, np.int64), np.zeros(len(m), np.int64), np.zeros(len(m), np.uint32)
            g[m != 1] = np.cumsum(_spread(grams, np.uint32), dtype=np.uint32)
            c[(m == 0) | (m == 2)] = np.frombuffer(contexts, np.uint64)
            d[m != 3], p[m != 3] = _spread(docs, np.int64), _spread(places, np.uint32)
            k[m != 3] = _spread_rows(keys, int((m != 3).sum()))
            parts.append((m, g, c, d, k, p))
        mark, gram, context, doc, row, place = (np.concatenate([x[i] for x in parts]) for i in range(6))
        del parts
        done = mark == 1
        yield from _outcomes(doc[done], row[done], np.full(int(done.sum()), SETTLED), place[done], groups)
        noted = np.unique(gram[mark == 3])
        use = np.flatnonzero((mark == 0) | (mark == 2))
        if not len(use):
            continue
        order, new, lowest = _by_context(doc[use], context[use], gram[use])
        order = use[order]
        mark, gram, context, doc, row, place = mark[order], gram[order], context[order], doc[order], row[order], place[order]
        new_gram = np.r_[True, gram[1:] != gram[:-1]]
        first = np.flatnonzero(new_gram)
        many = np.isin(gram[first], noted)[np.cumsum(new_gram) - 1] | (mark == 2)
        shared = (np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first))[np.cumsum(new_gram) - 1] | many
        kind = np.where(doc > lowest, SETTLED, np.where(many, OPEN_MANY, OPEN))
        yield from _outcomes(doc[shared], row[shared], kind[shared], place[shared], groups)


KNOWN_ROWS = ("part", "doc_id", "row", "raw", "docs", "rows", "kinds", "places")


def _by_text(batches):
    """(doc_id, row key, text, {kind: positions}, whether it is the first with these keys) of each row.

    Rows come sorted by group of texts: what is known of the group first, then its texts by document and row key.
    """
    part, packed, table, last, found = None, [], None, None, {}

    def known(d: int, k: int) -> dict:
        docs, rows, kinds, places = table
        low, high = np.searchsorted(docs, d), np.searchsorted(docs, d, "right")
        low, high = low + np.searchsorted(rows[low:high], k), low + np.searchsorted(rows[low:high], k, "right")
        if low == high:
            return {}
        mine, at = kinds[low:high], places[low:high]
        return {x: at[mine == x] for x in set(mine.tolist())}

    for batch in batches:
        for g, d, k, raw, docs, rows, kinds, places in zip(*[batch.column(c).to_pylist() for c in KNOWN_ROWS]):
            if g != part:
                part, packed, table, last = g, [], None, None
            if raw is None:
                of = _spread(docs, np.int64)
                packed.append((of, _spread_rows(rows, len(of)), _spread(kinds, np.uint8), _spread(places, np.int64)))
                continue
            if table is None:
                columns = [np.concatenate([p[i] for p in packed]) if packed else np.zeros(0, t) for i, t in enumerate((np.int64, np.int64, np.uint8, np.int64))]
                order = np.lexsort((columns[3], columns[1], columns[0]))
                table, packed = [c[order] for c in columns], []
            if first := (d, k) != last:
                last, found = (d, k), known(d, k)
            yield d, k, raw, found, first


def open_strings(n: int, at: np.ndarray, gram: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the strings that no settled context covers and whose own anchor is shared, with that anchor.

    The own anchor of a string is the smallest gram inside it, the first of equal ones; it
    follows from the string alone.
    """
    near = np.zeros(n + SPAN, bool)
    near[(at[(state == OPEN) | (state == OPEN_MANY)][:, None] - np.arange(SPAN)).ravel()] = True
    start = np.flatnonzero(near[:max(0, n - LENGTH + 1)])
    low, high = np.searchsorted(at, start), np.searchsorted(at, start + SPAN)
    settled = np.zeros(len(at) + 1, np.int64)
    np.cumsum(state == SETTLED, out=settled[1:])
    free = settled[high] == settled[low]
    start, low, high = start[free], low[free], high[free]
    own, step = low.copy(), 1
    while (more := np.flatnonzero(low + step < high)).size:
        better = more[gram[low[more] + step] < gram[own[more]]]
        own[better] = low[better] + step
        step += 1
    shared = state[own] != UNSHARED if len(own) else np.zeros(0, bool)
    return start[shared], own[shared]


STRING_ROWS = "bucket bigint, keys binary, docs binary, rows binary, places binary, sizes binary, offsets binary, texts binary"


def string_rows(batches, buckets: int):
    """Step 2, per chunk of documents: the open strings, packed for each bucket.

    Runs of strings with the same first anchor travel as one piece of text. Strings of an
    anchor with many contexts travel one by one under their own hash, once per chunk.
    """
    held, size = [], 0
    for doc, row, packed, known, new in _by_text(batches):
        if not known or not new:
            continue
        raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
        at, gram, _ = anchors(raw, contexts=False)
        state = np.full(len(at), UNSHARED)
        for kind in (OPEN, OPEN_MANY, SETTLED):
            state[np.searchsorted(at, known.get(kind, NOWHERE))] = kind
        start, first = open_strings(len(raw), at, gram, state)
        if not len(start):
            continue
        many = state[first] == OPEN_MANY
        cut = np.r_[True, (start[1:] != start[:-1] + 1) | (first[1:] != first[:-1]) | many[1:] | many[:-1]]
        begin = np.flatnonzero(cut)
        count = np.diff(np.r_[begin, len(start)])
        p = start[begin]
        key = gram[first[begin]]
        if many.any():
            single = p[many[begin]]
            key[many[begin]] = _mix(Prefix(raw).part(single, single + LENGTH))
        offset = np.where(many[begin], 0, at[first[begin]] - p)
        held.append((np.full(len(p), doc), np.full(len(p), row), p, count, offset, key, many[begin], [raw[a:a + LENGTH + c - 1].tobytes() for a, c in zip(p.tolist(), count.tolist())]))
        size += int(count.sum()) + LENGTH * len(p)
        if size >= CHUNK_BYTES // 2:
            yield from _pack_strings(held, buckets)
            held, size = [], 0
    if held:
        yield from _pack_strings(held, buckets)


def _pack_strings(held: list, buckets: int):
    doc, row, place, count, offset, key, many = (np.concatenate([h[i] for h in held]) for i in range(7))
    texts = [t for h in held for t in h[7]]
    # Of equal single strings of this chunk the smallest document's represents all; the others are repeats for certain.
    order = np.lexsort((place, doc, key, many))
    same = np.r_[False, many[order][1:] & (key[order][1:] == key[order][:-1])]
    leader = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    equal = np.array([texts[i] == texts[j] for i, j in zip(order[same].tolist(), leader[same].tolist())], bool)
    spare = np.zeros(len(doc), bool)
    spare[order[same]] = equal & (doc[order[same]] > doc[leader[same]])
    bucket = (key % np.uint64(buckets)).astype(np.int64)
    sizes = np.where(spare, 0, count)
    order = np.lexsort((key, bucket))
    for at, end in _pieces(bucket[order]):
        i = order[at:end]
        kept = [texts[j] for j in i.tolist() if not spare[j]]
        yield _batch({
            "bucket": pa.array([int(bucket[i[0]])]), "keys": pa.array([key[i].tobytes()]), "docs": pa.array([_squeeze(doc[i])]), "rows": pa.array([_squeeze_rows(row[i])]), "places": pa.array([_squeeze(place[i])]),
            "sizes": pa.array([_squeeze(sizes[i].astype(np.uint8))]), "offsets": pa.array([_squeeze(offset[i].astype(np.uint8))]),
            "texts": pa.array([zstandard.compress(b"".join(kept), 1)])})


def extension(p: Prefix, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common extension of the suffixes at ``a`` and ``b``, up to ``LENGTH``, by binary search over prefix hashes."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), LENGTH)
    for _ in range(LENGTH.bit_length()):
        mid = (low + high + 1) // 2
        equal = p.part(a, a + mid) == p.part(b, b + mid)
        low, high = np.where(equal, mid, low), np.where(equal, high, mid - 1)
    return low


def suffix_sort(raw: np.ndarray, p: Prefix, start: np.ndarray, group: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Order of the suffixes at ``start`` by group, then by their first ``LENGTH`` bytes.

    A bottom-up mergesort inside the groups. A merge places each suffix by binary search
    in the run it is merged with; all merges of a level go together. ``whole`` are the
    hashes of the first ``LENGTH`` bytes: where they are equal, no search is needed.
    """
    order = np.argsort(group, kind="stable")
    grouped = group[order]
    begin = np.flatnonzero(np.r_[True, grouped[1:] != grouped[:-1]]) if len(grouped) else np.zeros(0, np.int64)
    size = np.diff(np.r_[begin, len(grouped)])
    width = 1
    while (size > width).any():
        active = np.repeat(size > width, size)
        slot = np.flatnonzero(active)
        base, length = np.repeat(begin, size)[slot], np.repeat(size, size)[slot]
        inside = slot - base
        run = inside // width
        left = run % 2 == 0
        other = np.minimum((run + np.where(left, 1, -1)) * width, length)
        low, high = other.copy(), np.minimum(other + width, length)
        mine = start[order[slot]]
        while (todo := np.flatnonzero(low < high)).size:
            mid = (low[todo] + high[todo]) // 2
            there = order[base[todo] + mid]
            before = ~left[todo]
            differ = np.flatnonzero(whole[order[slot[todo]]] != whole[there])
            a, b = mine[todo[differ]], start[there[differ]]
            reach = np.minimum(extension(p, a, b), LENGTH - 1)
            before[differ] = raw[b + reach] < raw[a + reach]
            low[todo] = np.where(before, mid + 1, low[todo])
            high[todo] = np.where(before, high[todo], mid)
        new = base + (run - run % 2) * width + inside % width + (low - other)
        moved = order[slot].copy()
        order[new] = moved
        width *= 2
    return order


def _alike(key: np.ndarray) -> np.ndarray:
    """Whether another row has the same key."""
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    out = np.zeros(len(key), bool)
    out[order[1:]] = same
    out[order[:-1][same]] = True
    return out


def repeated_strings(batches, groups: int):
    """Step 2, per bucket: starts of strings that a smaller document holds too."""
    for rows in _by_bucket(batches, ["keys", "docs", "rows", "places", "sizes", "offsets", "texts"]):
        parts = [(np.frombuffer(k, np.uint64), _spread(d, np.int64), _spread_rows(n, len(k) // 8), _spread(w, np.int64), _spread(s, np.uint8), _spread(o, np.uint8)) for k, d, n, w, s, o, _ in rows]
        key, doc, row, place, count, offset = (np.concatenate([x[i] for x in parts]) for i in range(6))
        raw = np.frombuffer(b"".join(zstandard.decompress(r[6]) for r in rows), np.uint8)
        spare = count == 0
        yield from _outcomes(doc[spare], row[spare], np.full(int(spare.sum()), REPEATED), place[spare], groups)
        key, doc, row, place, count, offset = (x[~spare] for x in (key, doc, row, place, count.astype(np.int64), offset.astype(np.int64)))
        if not len(key):
            continue
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        start = np.repeat(np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1), count) + step
        doc, row, place = np.repeat(doc, count), np.repeat(row, count), np.repeat(place, count) + step
        group = _mix(np.repeat(key, count) + (np.repeat(offset, count) - step).astype(np.uint64) * _BASE)
        p = Prefix(raw)
        whole = p.part(start, start + LENGTH)
        # A string whose hash no other of its group has is no repeat; only the others are sorted.
        alike = _alike(group ^ _mix(whole))
        doc, row, place, start, group, whole = (x[alike] for x in (doc, row, place, start, group, whole))
        if not len(start):
            continue
        order = suffix_sort(raw, p, start, group, whole)
        a, b = order[:-1], order[1:]
        equal = np.zeros(len(a), bool)
        near = np.flatnonzero((group[a] == group[b]) & (whole[a] == whole[b]))
        view = np.lib.stride_tricks.sliding_window_view(raw, LENGTH)
        for at in range(0, len(near), 200_000):
            part = near[at:at + 200_000]
            equal[part] = (view[start[a[part]]] == view[start[b[part]]]).all(axis=1)
        new = np.r_[True, ~equal]
        lowest = np.minimum.reduceat(doc[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        hit = order[doc[order] > lowest]
        yield from _outcomes(doc[hit], row[hit], np.full(len(hit), REPEATED), place[hit], groups)


def covered(n: int, contexts: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """Bytes covered by settled contexts and repeated strings."""
    change = np.zeros(n + 1, np.int64)
    contexts, strings = contexts.astype(np.int64), strings.astype(np.int64)
    np.add.at(change, np.concatenate([np.maximum(0, contexts - SPAN + 1), strings]), 1)
    np.add.at(change, np.concatenate([np.minimum(contexts, n - LENGTH) + LENGTH, strings + LENGTH]), -1)
    return np.cumsum(change[:n]) > 0


REMOVED_ROWS = "doc_id bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"


def removals(batches):
    """Step 3: removed spans and the remaining bytes of every text."""
    docs, spans, kept, size = [], [], [], 0

    def out():
        shape = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return _batch({"doc_id": pa.array(docs, pa.int64()), "spans": pa.array(spans, shape), "kept": pa.array(kept, pa.binary())})

    for doc, _, packed, known, _ in _by_text(batches):
        raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
        docs.append(doc)
        if not known:
            spans.append([])
            kept.append(raw.tobytes())
        else:
            gone = covered(len(raw), known.get(SETTLED, NOWHERE), known.get(REPEATED, NOWHERE))
            edges = np.flatnonzero(np.diff(gone, prepend=False, append=False))
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])])
            kept.append(raw[~gone].tobytes())
        size += len(kept[-1])
        if size >= 8 << 20 or len(docs) >= 5_000:
            yield out()
            docs, spans, kept, size = [], [], [], 0
    if docs:
        yield out()


def packed_texts(docs: DataFrame, groups: int, repeated: bool) -> DataFrame:
    """(part, doc_id, row, raw): texts as compressed UTF-8 bytes, half the size in a shuffle. A null text is empty.

    The row key tells texts of the same id apart. It is a hash of the text, or 0 if no id is ``repeated``.
    """

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            raw = [squeeze.compress((t or "").encode("utf-8", "replace")) for t in batch.column("text").to_pylist()]
            part = _part(batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("row").to_numpy(zero_copy_only=False), groups)
            yield _batch({"part": pa.array(part), "doc_id": batch.column("doc_id"), "row": batch.column("row"), "raw": pa.array(raw, pa.binary())})

    row = F.xxhash64(F.coalesce("text", F.lit(""))) if repeated else F.lit(0).cast("bigint")
    return docs.select(F.coalesce(F.col("doc_id"), F.lit(LAST_ID)).cast("bigint").alias("doc_id"), row.alias("row"), "text").mapInArrow(
        run, "part bigint, doc_id bigint, row bigint, raw binary")


def without_repeats(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, string_bucket_bytes: int = STRING_BUCKET_BYTES) -> DataFrame:
    """doc_id, removed spans and remaining bytes (``kept``) of every row of ``docs`` (doc_id, text).

    Null and empty texts have no bytes. A null doc_id counts as larger than all others.
    Rows with the same id count as one document, so they never remove from each other,
    and each keeps its own result. Other columns are ignored.
    """
    total = docs.agg(F.sum(F.octet_length("text").cast("bigint")).alias("n")).first()["n"] or 0
    buckets, string_buckets = (max(1, -(-total // b)) for b in (bucket_bytes, string_bucket_bytes))
    groups = max(1, -(-total // GROUP_BYTES))
    repeated = not docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    texts = packed_texts(docs, groups, repeated)
    found = texts.mapInArrow(lambda b: anchor_rows(b, buckets), ANCHOR_ROWS)
    outcomes = written(found.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda b: settle(b, groups), OUTCOME_ROWS), "repeat_anchors")

    def with_texts(*known: DataFrame) -> DataFrame:
        rows = texts.withColumn("stage", F.lit(1))
        for k in known:
            rows = rows.unionByName(k.withColumn("stage", F.lit(0)), allowMissingColumns=True)
        return rows.repartition("part").sortWithinPartitions("part", "stage", "doc_id", "row").select(*KNOWN_ROWS)

    pieces = with_texts(outcomes).mapInArrow(lambda b: string_rows(b, string_buckets), STRING_ROWS)
    strings = written(pieces.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda b: repeated_strings(b, groups), OUTCOME_ROWS), "repeat_strings")
    made = with_texts(outcomes, strings).mapInArrow(removals, REMOVED_ROWS)
    return made.select(F.nullif("doc_id", F.lit(LAST_ID)).alias("doc_id"), "spans", "kept")
