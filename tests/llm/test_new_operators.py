"""Encoding, fill-in-middle and whitening against the library, plain loops and exact arithmetic."""

from __future__ import annotations

import hashlib
import random
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fathomline.llm import bidiagonal, bpe, fill_in_middle, whitening

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", "the", "'", "s", "re", " ", "  ", "\n", "\t", "1", "23", "!", "?", "é", "ü", "漢", "😀", "<|endoftext|>", "<|endof", "text|>", "ing", "x", "'ll", "'S", "-", "_", " ", "\x1f"]


@pytest.fixture(scope="module")
def definition():
    return bpe.read_definition(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def words_of(rng, n):
    kind = rng.random()
    if kind < 0.25:
        return rng.choice(["a", "ab", "!", " é", "漢", "😀", "aab", "1", "' ", "'s", "\n", " "]) * n
    few = rng.sample(PARTS, 4) if kind < 0.5 else PARTS
    return "".join(rng.choice(few) for _ in range(n))


def test_joined_parts_are_the_encoding_of_the_whole(definition, library):
    codec, rng = bpe.Codec(definition), random.Random(11)
    for _ in range(400):
        text = words_of(rng, rng.choice([1, 5, 20, 60, 150]))
        parts = codec.cut(text, rng.choice([1, 2, 3, 7, 16, 40]))
        assert "".join(parts) == text
        made, want = codec.tree(codec.segments(parts)), library.encode(text, add_special_tokens=False)
        assert made.ids.tolist() == want.ids, text
        assert np.cumsum(made.first).tolist() == np.unique(want.word_ids, return_inverse=True)[1].__add__(1).tolist()


def test_latin_pieces_are_those_of_the_library(definition, library):
    codec, rng = bpe.Codec(definition), random.Random(2)
    letters = [chr(c) for c in [*range(0x20, 0x7F), *range(0xA1, 0x250)]] + list("\t\n\r") + [" "] * 80 + ["'"] * 8 + list("etaoinslr") * 8
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    assert [s.ids.tolist() for s in codec.segments(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_any_ids_are_decoded_as_the_library_does(definition, library):
    codec, rng = bpe.Codec(definition), random.Random(3)
    for _ in range(2000):
        ids = [rng.randrange(50257) if rng.random() < 0.5 else rng.randrange(256) for _ in range(rng.randint(0, 10))]
        assert codec.text(ids) == library.decode(ids, skip_special_tokens=False)


def test_encoding_of_a_table(spark, definition, library):
    rng = random.Random(6)
    texts = [None, "", " ", "a" * 5000, "<|endoftext|>" * 40, *[words_of(rng, 300) for _ in range(20)]]
    rows = [(None if k % 7 == 6 else k // 2, t, k, "x", [k]) for k, t in enumerate(texts)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, rest int, token_ids string, `key` array<int>").repartition(3)
    made = bpe.encoded(docs, definition, leaf_chars=64)
    assert sorted(made.columns) == ["doc_id", "key", "rest", "token_ids"]
    back = bpe.decoded(made, definition).collect()
    want = sorted((r[2], library.encode(r[1] or "", add_special_tokens=False).ids, r[1] or "") for r in rows)
    assert sorted((r.rest, r.token_ids, r.decoded) for r in back) == want
    assert all(r.key == [r.rest] for r in back)
    assert bpe.decoded(bpe.encoded(docs.where("1 = 0"), definition), definition).count() == 0
    numbers = spark.range(3).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"))
    assert [r.token_ids for r in bpe.encoded(numbers, definition).collect()] == [library.encode("one two").ids] * 3


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.read_definition(public_tokenizers.path("word_bpe_49k.json"))


def plain_forms(rows, sentinels=("<P>", "<S>", "<M>"), seed=1):
    p, s, m = sentinels
    for doc, text in rows:
        t = text or ""
        h = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
        a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
        if not t or any(x in t for x in sentinels) or h3 % 100 >= 90:
            yield doc, len(t), "plain", None, None, t, t
        else:
            spm = h4 % 100 < 20
            out = s + t[b:] + p + t[:a] + m + t[a:b] if spm else p + t[:a] + s + t[b:] + m + t[a:b]
            yield doc, len(t), "spm" if spm else "psm", a, b - a, out, t


def test_fill_in_middle_of_a_table(spark, monkeypatch):
    rng = random.Random(9)
    letters = ["a", "é", "漢", "😀", "<", "P", ">", " ", "\n", "S", "<P", "M>"]
    texts = [None, "", "a", "<P>", "x<M>y", "<<S", "😀" * 4000, *["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(150)]]
    rows = [(None if k % 11 == 5 else k - 3, t) for k, t in enumerate(texts)] * 2
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, n int, form string").withColumn("rest", F.lit(1))
    made = fill_in_middle.restored(fill_in_middle.transformed(docs.repartition(3)))
    got = sorted(map(str, made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored").collect()))
    assert [g.split("(", 1)[1] for g in got] == sorted(f"doc_id={i}, n={n}, form={f!r}, prefix_chars={p}, middle_chars={m}, output={o!r}, restored={t!r})" for i, n, f, p, m, o, t in plain_forms(rows))
    assert "rest" in made.columns and fill_in_middle.restored(fill_in_middle.transformed(docs.where("1 = 0"))).count() == 0
    half = fill_in_middle.restored(spark.createDataFrame([(None, "psm"), ("x", None), (None, None)], "output string, form string")).collect()
    assert [r.restored for r in half] == ["", "", ""]


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_blocks_of_any_size_scatter_alike(block):
    rng = random.Random(block)
    texts = ["".join(rng.choice("aé漢😀") for _ in range(rng.randint(0, 9))) for _ in range(40)]
    column = pa.array(["skipped", *texts]).slice(1)
    cuts = np.array([sorted(rng.randint(0, len(t)) for _ in range(2)) for t in texts])
    forms = np.array([rng.randrange(3) for _ in texts])
    got = fill_in_middle.scattered(column, forms, cuts, ("<P>", "<S>", "<M>"), block)
    want = [t if f == 0 else f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}" if f == 1 else f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}" for t, f, (a, b) in zip(texts, forms, cuts)]
    assert got.to_pylist() == want
    assert fill_in_middle.gathered(got, forms, ("<P>", "<S>", "<M>"), block).to_pylist() == texts


def test_sentinels_that_could_overlap_are_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for bad in (("<P>", "<S>", "<MM>"), ("ab", "cd", "ba"), ("aXa", "bXb", "cXc"), ("x", "x", "y")):
        with pytest.raises(ValueError):
            fill_in_middle.transformed(docs, sentinels=bad)


def spectrum(values, rng):
    d = len(values)
    left, right = (np.linalg.qr(rng.normal(size=(d, d)))[0] for _ in range(2))
    return np.linalg.qr(left @ np.diag(values) @ right, mode="r")


@pytest.mark.parametrize("name, values", [
    ("spread", np.linspace(1, 9, 24)), ("graded", [10.0**-k for k in range(12)]), ("equal", [2.0] * 3 + [1.0] * 9), ("near", [1 + 1e-13, 1.0, 1 - 1e-13] + [0.1] * 9),
    ("close", 1 + np.arange(12) * 1e-7), ("low rank", [3.0, 2.0, 1.0] + [0.0] * 9), ("one", [5.0]), ("none", [0.0] * 4)])
def test_leading_vectors(name, values):
    r = spectrum(np.array(values, float), np.random.default_rng(len(values)))
    squares, vectors = bidiagonal.leading_vectors(r, 8)
    true = np.sort(np.array(values, float))[::-1][:8]
    kept = int((true > 1e-13 * max(true[0], 1e-300)).sum())
    assert len(squares) == kept and np.allclose(squares, true[:kept] ** 2, rtol=1e-11 if name != "graded" else 1e-2, atol=1e-14 * true[0] ** 2)
    assert np.abs(vectors @ vectors.T - np.eye(kept)).max(initial=0) < 1e-9
    for s, v in zip(squares, vectors):
        assert np.linalg.norm(r.T @ (r @ v) - s * v) <= 1e-13 * max(true[0] ** 2, 1e-300)


def test_dqds_is_accurate_for_small_values():
    """A graded bidiagonal matrix: each singular value to high relative accuracy, found in exact arithmetic by sign counts."""
    a, b = [1.0, 1e-3, 1e-6, 1e-9], [0.5, 5e-4, 5e-7]
    got = bidiagonal.squared_values([x * x for x in a], [x * x for x in b])
    q, e = [Fraction(x) ** 2 for x in a], [Fraction(x) ** 2 for x in b]

    def below(at):  # eigenvalues of the Gram matrix below ``at``
        n, d = 0, q[0] - at
        for k in range(4):
            n += d < 0
            if k < 3:
                d = q[k + 1] + e[k] - at - q[k] * e[k] / d
        return n

    for k, value in enumerate(got):
        assert below(Fraction(value * (1 - 1e-13))) == 3 - k and below(Fraction(value * (1 + 1e-13))) == 4 - k


def test_whitening_against_exact_sums(spark):
    rng = np.random.default_rng(5)
    vectors = [(rng.normal(size=6) * [3, 2, 1, 0.5, 0.2, 0] + 9).astype(np.float32).tolist() for _ in range(70)]
    odd = [None, [], [1.0] * 5, [float("nan")] + [0.0] * 5, [float("inf")] + [0.0] * 5, [None] + [0.0] * 5, [1e30] + [0.0] * 5]
    rows = [(None if k % 13 == 12 else k // 3, v, k, 1.5) for k, v in enumerate([*vectors, *odd, *vectors[:40]])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int, rest double").repartition(4)
    made = whitening.whitened(table).collect()
    x = np.floor(np.array(vectors, np.float64) * 64).astype(np.int64) + 1_000_000
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centre = (distinct * n - sums) / n
    values, axes = np.linalg.eigh(centre.T @ centre / n)
    values, axes = values[::-1][:5], axes[:, ::-1][:, :5]
    assert len(made) == 110 and {r.n for r in made} == {n} and {len(r.whitened) for r in made} == {5}
    by = {r.rest: r for r in made}
    assert list(by) == [1.5] and np.allclose(made[0].explained, values / np.trace(centre.T @ centre / n), rtol=1e-10) and made[0].identity_error < 1e-10
    want = sorted((sum(int(v) ** 2 for v in row), tuple(np.round(np.abs(row / n @ axes / np.sqrt(values)), 8))) for row in (x[[*range(70), *range(40)]] * n - sums))
    got = sorted((int(r.deviation), tuple(np.round(np.abs(r.whitened), 8))) for r in made)
    assert [g[0] for g in got] == [w[0] for w in want] and np.allclose([g[1] for g in got], [w[1] for w in want], atol=1e-7)
    long = whitening.long_form(whitening.whitened(table.drop("n", "rest"), limit=2))
    assert long.count() == 220 and {r.component for r in long.collect()} == {1, 2}
    assert [f.dataType.simpleString() for f in long.schema] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]


def test_whitening_of_nothing_and_of_equal_vectors(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0, 2.0, 3.0])], "vec_id long, embedding array<double>")
    made = whitening.whitened(table).collect()
    assert [(r.n, int(r.deviation), r.whitened, r.explained) for r in made] == [(1, 0, [], [])] * 2
    assert whitening.long_form(whitening.whitened(table)).count() == 0
    empty = whitening.long_form(whitening.whitened(table.where("1 = 0")))
    assert empty.count() == 0 and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_exact_deviations_of_large_numbers(spark):
    big = 2.0**51 / 64
    table = spark.createDataFrame([(k, [big * s, float(k)]) for k, s in enumerate((1, -1, 0.5))], "vec_id long, embedding array<double>")
    x = [[int(big * 64 * s) + 1_000_000, 64 * k + 1_000_000] for k, s in enumerate((1, -1, 0.5))]
    sums = [sum(c) for c in zip(*x)]
    want = [sum((3 * v - s) ** 2 for v, s in zip(row, sums)) for row in x]
    made = sorted(whitening.whitened(table).collect(), key=lambda r: r.vec_id)
    assert [int(r.deviation) for r in made] == want and max(want) > 2**63
    assert {r.deviation for r in whitening.long_form(whitening.whitened(table)).collect() if r.vec_id == 0} == {None}
