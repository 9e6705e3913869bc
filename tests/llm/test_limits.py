"""What operators hold at once."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from tokenizers import Tokenizer

from fathomline.llm import bpe, language_id, registry, suffix_repeats


def test_language_fit_holds_its_vectors_once():
    """Unit vectors of all texts and little else: no copy for a part, a cluster or a norm."""
    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(300)]
    texts = [" ".join(words[i] for i in rng.integers(0, 300, 40)) for _ in range(400)]
    idf = (rng.random(language_id.BINS) + 1).astype(np.float32)
    plain = np.stack([language_id.trigram_counts(t) for t in texts]) * idf
    plain /= np.linalg.norm(plain, axis=1, keepdims=True)
    size = plain.nbytes
    tracemalloc.start()
    x = language_id.vectors(texts, idf)
    c = language_id.spherical_kmeans(x, language_id.CENTROIDS)
    language_id.reject_limits(texts, x, c)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(x, plain)
    assert most < 1.5 * size
    part = rng.random(400) < 0.6
    assert np.allclose(language_id.spherical_kmeans(x, 4, rows=part), language_id.spherical_kmeans(x[part], 4), atol=1e-5)


def test_batches_of_the_operators_are_bounded_in_bytes(spark):
    registry.configure(spark)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").startswith("4")


def test_new_pieces_go_to_the_library_in_one_call(monkeypatch):
    """Each different piece once, all of a slice in one sequence; tokens are those of the whole text, also after the memory starts anew."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, codec, calls = Tokenizer.from_file(path), bpe.Codec(bpe.read_definition(path)), []
    merges = codec.merges

    class Counted:
        def encode_batch_fast(self, rows, **options):
            calls.append(rows)
            return merges.encode_batch_fast(rows, **options)

    codec.merges = Counted()
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 30)
    rng = random.Random(3)
    words = ["the", "cat's", "né", "12", "?!", "a-b", "Ünder", "xqzv", "\n\n", "  "]
    for _ in range(20):
        texts = [" ".join(rng.choice(words) + rng.choice(["", str(rng.randrange(50))]) for _ in range(40)) for _ in range(5)] + [""]
        made = codec.segments(texts)
        assert [s.ids.tolist() for s in made] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert all(s.first.sum() == len(codec.pieces.findall(t)) for s, t in zip(made, texts))
    assert len(calls) <= 20 and all(len(rows) == 1 for rows in calls)


def test_only_strings_that_can_repeat_are_sorted(monkeypatch):
    """A string whose hash is alone in its group does not reach the sort; what is removed is what plain search finds."""
    rng = random.Random(7)
    common = [bytes(rng.choices(b"abcdefgh ", k=45)) for _ in range(6)]
    texts = [b"".join(bytes(rng.choices(b"xyz", k=rng.randrange(3, 9))) + rng.choice(common) for _ in range(8)) for _ in range(40)]
    texts += [texts[3][20:200] + b"!", b""]
    sorted_, plain = [], suffix_repeats.suffix_sort

    def watched(raw, p, start, group, whole):
        for key in zip(group.tolist(), whole.tolist()):
            sorted_.append(key)
        return plain(raw, p, start, group, whole)

    monkeypatch.setattr(suffix_repeats, "suffix_sort", watched)
    n = len(texts)
    zero = np.zeros(n, np.int64)
    rows = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(zero), pa.array([zstandard.compress(t) for t in texts])], ["doc_id", "row", "raw"])
    outcomes = list(suffix_repeats.settle(suffix_repeats.anchor_rows([rows], 1), 1))

    def with_texts(known):
        told = [(0, None, None, None, *(b.column(c)[0].as_py() for c in ("docs", "rows", "kinds", "places"))) for b in known]
        told += [(0, d, 0, zstandard.compress(t), None, None, None, None) for d, t in enumerate(texts)]
        kinds = [pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*told), kinds)], list(suffix_repeats.KNOWN_ROWS))

    pieces = list(suffix_repeats.string_rows(with_texts(outcomes), 1))
    strings = list(suffix_repeats.repeated_strings(pieces, 1))
    made = {r["doc_id"]: r["kept"] for b in suffix_repeats.removals(with_texts(outcomes + strings)) for r in b.to_pylist()}
    seen: set[bytes] = set()
    for d, t in enumerate(texts):
        mine = [t[i:i + 50] for i in range(len(t) - 49)]
        gone = {k for i, m in enumerate(mine) if m in seen for k in range(i, i + 50)}
        assert made[d] == bytes(b for i, b in enumerate(t) if i not in gone)
        seen.update(mine)
    assert sorted_ and min(Counter(sorted_).values()) > 1
