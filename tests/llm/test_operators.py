"""Operators against brute force on small tables with nulls, empty and long texts, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from fathomline.llm import (columns, decontaminate, language_id, mixing, quality_mil, quality_rules, sharding, simhash, suffix_repeats, toxicity,
                            url_rules)
from fathomline.llm.components import components

SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint, copy int, shard int, _n int"


def rows(texts, ids=None):
    return [(i, t, "en" if t and "the" in t else "fr", f"s{k % 3}", len(t or ""), 7, 8, 9) for k, (i, t) in enumerate(zip(ids or range(len(texts)), texts))]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeéou") for _ in range(rng.randint(1, 7)))
    plain = [" ".join(word() for _ in range(rng.choice([0, 1, 2, 30, 120]))) for _ in range(40)]
    shared = " ".join(word() for _ in range(25))
    long = " ".join(word() for _ in range(6000))
    made = [None, "", " \n", "the", shared, shared, f"{plain[9]} {shared} {plain[10]}", f"the {shared}\n{shared}", long, long + " x", long[:3000] + "y" + long[3000:], *plain]
    return made + plain[:10] + [shared[:60], "a" * 400, "a" * 500]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(rows(texts), SHAPE).repartition(4)


def repeats_brute(pairs):
    seen, out = {}, []
    for i, t in sorted(pairs, key=lambda r: (r[0] is None, r[0])):
        b, gone = (t or "").encode(), set()
        key = float("inf") if i is None else i
        for p in range(len(b) - 49):
            if seen.setdefault(b[p:p + 50], key) < key:
                gone.update(range(p, p + 50))
        kept = bytes(c for p, c in enumerate(b) if p not in gone)
        out.append((i, len(gone), sum(1 for p in gone if p - 1 not in gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("ids", ["plain", "repeated"])
@pytest.mark.parametrize("many", [2, 64])
def test_suffix_repeats(spark, texts, ids, many, monkeypatch):
    monkeypatch.setattr(suffix_repeats, "MANY_CONTEXTS", many)
    monkeypatch.setattr(suffix_repeats, "CHUNK_BYTES", 20_000)
    numbers = list(range(len(texts))) if ids == "plain" else [None if k == 20 else k // 2 for k in range(len(texts))]
    table = spark.createDataFrame(rows(texts, numbers), SHAPE)
    made = suffix_repeats.without_repeats(table, 30_000, 10_000).collect()
    got = sorted([(r.doc_id, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in made], key=str)
    assert got == repeats_brute(zip(numbers, texts))


def test_suffix_repeats_between_single_and_repeated_ids(spark):
    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    same, other, partly = text(300), text(200), text(120)
    pairs = [(5, same), (9, same), (9, same), (9, other + same[:90]), (3, partly), (3, other), (12, text(40) + partly[:70] + text(40)), (13, other),
             (20, partly + same), (None, same), (None, other + partly), (None, text(80)), (None, None), (7, ""), (7, text(60) + same[100:220])]
    for n in range(4):
        table = spark.createDataFrame(rows([t for _, t in pairs], [i for i, _ in pairs]), SHAPE).repartition(n + 1)
        made = suffix_repeats.without_repeats(table, 300, 200).collect()
        got = sorted([(r.doc_id, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in made], key=str)
        assert got == repeats_brute(pairs)


def test_a_common_line_fills_no_bucket(monkeypatch):
    """A line in each third document: what its anchors add to one bucket follows the chunks, not the documents."""
    import numpy as np
    import pyarrow as pa
    import zstandard

    rng = random.Random(4)
    line = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(30))
    over = []
    for n in (1500, 6000):
        texts = [" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(20)) + ("\n" + line if k % 3 == 0 else "") for k in range(n)]
        batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([0] * n, pa.int64()), pa.array([zstandard.compress(t.encode()) for t in texts])], ["doc_id", "row", "raw"])
        sizes = np.zeros(64, np.int64)
        for made in suffix_repeats.anchor_rows([batch], 64):
            sizes[made.column("bucket")[0].as_py()] += len(suffix_repeats._spread(made.column("marks")[0].as_py(), np.uint8))
        over.append(int(sizes.max() - np.median(sizes)) / n)
    assert over[1] < 0.05 and over[1] < over[0] + 0.01


def simhash_brute(pairs):
    prints = []
    for i, t in pairs:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        grams = [b" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        prints.append((i, sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))))
    group = {i: i for i, _ in prints}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, x in prints:
        for b, y in prints:
            if (x ^ y).bit_count() <= 3:
                lo, hi = sorted((root(a), root(b)))
                group[hi] = lo
    return {i: (f, root(i)) for i, f in prints}


@pytest.mark.parametrize("chunk", [3, 2048])
def test_simhash_components(docs, texts, chunk, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK_ROWS", chunk)
    made = simhash.simhash_components(docs).collect()
    assert {r.doc_id: (r.fp % 2**64, r.component_id) for r in made} == simhash_brute(enumerate(texts))
    kept = simhash.deduplicated(docs.union(docs))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in simhash_brute(enumerate(texts)).values()})


def test_fingerprints_three_bits_apart_are_linked(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(30)]
    near = [b ^ sum(1 << k for k in rng.sample(range(64), n)) for b in base for n in (1, 2, 3)]
    signed = [f - 2**64 if f >= 2**63 else f for f in base + near]
    made = simhash.grouped(spark.createDataFrame([(k, f) for k, f in enumerate(signed)], "doc_id bigint, fp bigint")).collect()
    by = {r.fp: r.component for r in made}
    assert [by[f] for f in signed] == [*range(30), *[k // 3 for k in range(90)]]


def test_deduplicated_keeps_a_row_of_every_group(spark):
    rng = random.Random(8)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(40))
    first, second, other = text(), text(), text()
    pairs = [(None, text()) for _ in range(30)] + [(7, first), (7, second), (20, second), (20, second), (None, first), (3, other), (3, other), (None, other), (None, None), (4, "")]
    made = simhash.deduplicated(spark.createDataFrame(rows([t for _, t in pairs], [i for i, _ in pairs]), SHAPE).repartition(3))
    want = [(None, t) for _, t in pairs[:30]] + [(7, first), (7, second), (3, other), (4, "")]
    assert sorted(((r.doc_id, r.text) for r in made.collect()), key=str) == sorted(want, key=str)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (5, 5)], "a bigint, b bigint")
    assert {r.node: r.root for r in components(edges).collect()} == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


def test_decontamination(spark, docs, texts):
    items = [(1, texts[4].upper()), (2, " ".join(texts[4].split()[:20] + ["zz"] * 3)), (3, None), (4, ""), (5, "the"), (6, texts[8])]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    import regex
    sets = lambda t: {tuple(w[k:k + 5]) for w in [regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())] if w for k in range(max(1, len(w) - 4))}
    want = {(d, i, len(q), len(q & sets(t))) for d, t in enumerate(texts) for i, x in items for q in [sets(x)] if q and len(q & sets(t)) >= 0.8 * len(q)}
    assert {tuple(r) for r in decontaminate.contained_items(docs, table).collect()} == want and want
    left = decontaminate.decontaminated(docs, table)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == set(range(len(texts))) - {w[0] for w in want}


def test_quality_rules(spark):
    good = [(k, " ".join(f"word{k}x{j}" for j in range(60)), "en") for k in range(700)]
    bad = [(1000 + k, " ".join(f"word{k}x{j}###" for j in range(60)), "en") for k in range(50)]
    other = [(2000, "## " * 60 + "a b c", "fr"), (2001, None, None), (2002, "", "en")]
    labels = spark.createDataFrame([(k, 1) for k, _, _ in good], "doc_id bigint, quality int")
    table = spark.createDataFrame(good + bad + other, "doc_id bigint, text string, lang string").withColumn("n_words", F.lit("x"))
    made = {r.doc_id: r for r in quality_rules.quality_rules(table, labels).collect()}
    assert all(made[k].kept for k, _, _ in good) and not any(made[k].kept for k, _, _ in bad)
    assert made[2001].n_words == 0 and made[2001].base_failed and not made[2002].kept and made[2000].n_symbols == 120


def test_repeat_words(spark):
    table = spark.createDataFrame([(1, "a b c a b c d"), (2, "x x x x"), (3, "a b"), (4, "a b c d a b e")], "doc_id bigint, text string")
    assert {r.doc_id: r.n_repeat_words for r in quality_rules.features(table, ["doc_id"]).collect()} == {1: 6, 2: 4, 3: 0, 4: 0}


@pytest.mark.parametrize("risk, level", [(0.015, 0.01), (0.1, 0.05), (0.3, 0.2)])
def test_allowed_rejections_are_the_exact_tail(spark, risk, level):
    from fractions import Fraction
    from math import comb

    sizes = [1, 5, 29, 50, 304, 305, 400]
    made = spark.createDataFrame([(n,) for n in sizes], "n bigint").select("n", quality_rules.allowed_rejections(F.col("n"), risk, F.lit(level)).alias("k")).collect()
    p = Fraction(risk)
    for r in made:
        tail, k = Fraction(0), -1
        for j in range(r.n + 1):
            tail += comb(r.n, j) * p**j * (1 - p) ** (r.n - j)
            if tail > Fraction(level):
                break
            k = j
        assert r.k == k, r.n


def test_cutoffs_keep_their_promise_on_documents_not_used(spark):
    """Uniform scores: a cutoff rejects 1 - cut of all good documents, which may be over the risk in hardly any stratum."""
    rng = random.Random(21)
    labelled = [(f"s{k}", rng.random()) for k in range(60) for _ in range(900)] + [("few", rng.random()) for _ in range(200)] + [("fewer", rng.random()) for _ in range(250)]
    strata, common = quality_rules.certified_cutoffs(spark.createDataFrame(labelled, "stratum string, score double"), "stratum", 0.02, 0.05)
    by = {r.stratum: r for r in strata.collect()}
    assert all(by[f"s{k}"].group == f"s{k}" and 1 - by[f"s{k}"].cut <= 0.02 for k in range(60)) and max(1 - by[f"s{k}"].cut for k in range(60)) > 0.004
    small_scores = sorted((v for s, v in labelled if s.startswith("few")), reverse=True)
    assert by["few"].group is by["fewer"].group is None
    assert by["few"].cut == by["fewer"].cut == common.first().cut == small_scores[0]
    none, nothing = quality_rules.certified_cutoffs(spark.createDataFrame([("a", 0.5)] * 20, "stratum string, score double"), "stratum")
    assert [r.cut for r in none.collect()] == [None] and nothing.count() == 0


def test_cutoffs_act_and_rank_ties_alike(spark):
    """Scores tie at the cut; equal scores are kept or rejected together, and never more than allowed."""
    scores = [0.0] * 700 + [0.5] * 200 + [0.9] * 3
    strata, _ = quality_rules.certified_cutoffs(spark.createDataFrame([("en", v) for v in scores], "stratum string, score double"), "stratum", 0.02, 0.05)
    row = strata.first()
    assert row.group == "en" and row.cut == 0.5


def test_url_rules(spark):
    urls = ["http://A.Org/x", "http://example.org/es/1", "http://www.example.org/en/12?q", "http://b.com/fr/", "http://b.com/fr", "com/fr/", None, "http://notexample.org/es/1", "x://com/de/#a"]
    pages = spark.createDataFrame([(k, u, "r") for k, u in enumerate(urls)] * 2, "page_id bigint, url string, rule string")
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
    made = url_rules.judged_urls(pages, url_rules.rule_rows(spark, rules)).collect()
    want = ["org/", "example.org/es/", "example.org/en/1", "com/fr/", None, None, None, "org/", "com/de/"]
    assert len(made) == 18 and {r.page_id: r.rule for r in made} == dict(enumerate(want))
    assert {r.verdict for r in made if r.rule is None} == {"allow"}


@pytest.mark.parametrize("block", [1, 3, 50, 512])
def test_url_sweep_equals_every_rule_on_every_url(spark, block):
    """Nested and overlapping rules over a few hosts, one of them hot; names that begin alike; empty labels and paths."""
    rng = random.Random(block)
    hosts = ["com", "org", "organic", "a.com", "b.a.com", "ba.com", "x.org", "a..org", "com.org", ""]
    paths = ["", "/", "/a", "/a/", "/a/b", "/ab", "/a/b/c", "/é", "."]
    rules = [(rng.choice(["allow", "block"]), rng.choice(hosts[:-1]), rng.choice(paths)) for _ in range(25)] + [("block", None, "/"), ("allow", "org", None)]
    urls = [(k, f"x://{'A.com' if k % 3 == 0 else rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q', '#f'])}") for k in range(300)] + [(300, None), (301, "a.com/a")]
    parts = spark.createDataFrame(urls, "page_id long, url string").select("page_id", url_rules.url_host(F.col("url")).alias("host"), url_rules.url_path(F.col("url")).alias("path"))
    got = {(r.host, r.path): (r.rule, r.verdict) for r in url_rules.matched_urls(parts, url_rules.rule_rows(spark, rules), block).collect()}
    want = {}
    for r in parts.collect():
        fits = [(len(h + (p or "")), v == "block", h + (p or ""), v) for v, h, p in rules if h is not None and (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p or "")]
        if fits and r.host:
            want[r.host, r.path] = max(fits)[2:]
    assert got == want


def test_mixing_follows_the_weights(spark):
    table = spark.createDataFrame([(k, "x" * 10, "big" if k % 10 else "small", 5) for k in range(20_000)], "doc_id bigint, text string, source string, copy int")
    made = mixing.mixed(table, {"small": 3.0}, 1.0)
    count = {r.source: r["count"] for r in made.groupBy("source").count().collect()}
    assert count["small"] == pytest.approx(15_000, rel=0.03) and count["big"] == pytest.approx(5_000, rel=0.05)
    assert mixing.mixed(table.where("1 = 0"), {}).count() == 0
    assert made.select("doc_id", "copy").distinct().count() == made.count()


def test_sharding_is_a_permutation(spark, docs, texts):
    twice = docs.union(docs)
    made = sharding.sharded(twice, 8, bucket_bytes=20_000).collect()
    assert sorted(str(r.text) for r in made) == sorted(str(t) for t in texts * 2)
    slots = [sorted(r.slot for r in made if r.shard == s) for s in range(8)]
    assert all(s == list(range(len(s))) for s in slots) and max(map(len, slots)) - min(map(len, slots)) <= 1
    assert sharding.sharded(docs.where("1 = 0")).count() == 0


def test_language_id(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, "en"), (-2, "", "fr"), (-3, "12 ?!", None)], "doc_id bigint, text string, lang string")
    made = {r.doc_id: r for r in language_id.identified(table.select("doc_id", "text", "lang").union(odd)).collect()}
    assert [made[k].lang_pred for k in (-1, -2, -3)] == ["und"] * 3
    held = [(made[r.doc_id].lang_pred, r.lang) for r in table.collect() if made[r.doc_id].held_out]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert {r.lang_pred for r in language_id.identified(odd.where("1 = 0").union(odd.where("doc_id = -1"))).collect()} == {"und"}


def test_language_id_rejects_what_it_has_not_learned(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(2)
    salad = [" ".join("".join(rng.choice("qxzwvkjpbgh") for _ in range(rng.randint(2, 8))) for _ in range(60)) for _ in range(5)]
    odd = ["Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, che la diritta via era smarrita. Ahi quanto a dir qual era",
           "il gatto dorme sulla sedia vicino alla finestra aperta e sogna", "Vanha talo seisoo joen rannalla ja lapset juoksevat metsaan kun aurinko laskee",
           "Stary dom stoi nad rzeka i dzieci biegna do lasu kiedy zachodzi slonce", "Старый дом стоит у реки", "古い家は川のそばにある",
           "Een oude man zit aan de rivier en de kinderen rennen naar het bos wanneer de zon ondergaat en het wordt donker in der nacht",
           "the kadunu moresilo und velatipa the norisuke", "La la la la la la la", *salad]
    short = {r.doc_id: " ".join(r.text.split()[:12]) for r in table.where("text RLIKE '^[A-Z][a-z ,]{80}' AND crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0").collect()}
    more = [(-1 - k, t, None) for k, t in enumerate(odd)] + [(10**9 + k, t, None) for k, t in short.items()]
    made = {r.doc_id: r for r in language_id.identified(table.union(spark.createDataFrame(more, "doc_id bigint, text string, lang string"))).collect()}
    assert all(made[-1 - k].rejected for k in range(len(odd)))
    own = [r.rejected for k, r in made.items() if 0 <= k < 10**9 and r.held_out]
    assert sum(own) <= 0.03 * len(own)
    assert short and sum(made[10**9 + k].rejected for k in short) <= 0.1 * len(short)


def test_language_stage_keeps_clashing_columns(spark):
    made = spark.createDataFrame([(i, "the old house by the river", "en", 1.5, i % 2 == 0, "x") for i in range(40)] + [(90, None, "en", 2.5, False, "y")],
                                 "doc_id bigint, text string, lang string, score double, rejected boolean, lang_pred string")
    kept = language_id.confident(made)
    assert kept.columns == made.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(40))


def test_sampled_ids_are_the_smallest_hashes(spark):
    made = spark.range(5000).selectExpr("id AS doc_id", "id % 3 = 0 AS g").union(spark.range(300).selectExpr("7L", "false"))
    found = {(r["doc_id"], r["g"]) for r in columns.sampled_ids(made, "g", 40).collect()}
    every = made.distinct().withColumn("h", F.xxhash64("doc_id")).collect()
    want = {(r["doc_id"], g) for g in (True, False) for r in sorted((r for r in every if r["g"] == g), key=lambda r: r["h"])[:40]}
    assert found == want


def test_trained_scores(spark):
    sf_dir = "/root/testdata/sf0.01"
    table, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    truth = {r.doc_id: r for r in labels.collect()}
    odd = spark.createDataFrame([(-1, None), (-2, "")], "doc_id bigint, text string")
    made = {r.doc_id: r for r in quality_mil.quality_scores(table.select("doc_id", "text").union(odd), labels).collect()}
    held = [(made[k].predicted, t.quality) for k, t in truth.items() if made[k].held_out]
    assert sum(a == b for a, b in held) >= 0.9 * len(held) and 0 <= made[-1].score == made[-2].score <= 1
    tox = {r.doc_id: r for r in toxicity.toxicity(table.select("doc_id", "text").union(odd), labels).collect()}
    held = [(tox[k].toxic, t.toxic) for k, t in truth.items() if tox[k].held_out]
    assert sum(a == b for a, b in held) >= 0.9 * len(held) and tox[-1].toxic == 0
    assert {r.severity for r in toxicity.toxicity(odd, labels.where("1 = 0")).collect()} == {0.0}


BARE = """
import sys
sys.path.insert(0, {repo!r})
from fathomline.session import local_session
from fathomline.llm import bpe, fill_in_middle, language_id, quality_mil, sharding, simhash, suffix_repeats, toxicity, whitening
from fathomline.operators import packing
from fathomline.plans import mail
from pyspark.sql import functions as F
import public_tokenizers
spark = local_session("bare", "2", 2)
docs = spark.createDataFrame([(k, ("the old house by the river " if k % 2 else "la maison vieille et la rue ") * 12 + str(k), "en" if k % 2 else "fr") for k in range(60)], "doc_id long, text string, lang string")
labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
tokens = bpe.encoded(docs, bpe.read_definition(public_tokenizers.path("byte_bpe_50k.json")), 40)
vectors = docs.select(F.col("doc_id").alias("vec_id"), F.array(F.col("doc_id").cast("double"), F.rand(1)).alias("embedding"))
frames = [tokens, fill_in_middle.transformed(docs), language_id.identified(docs), language_id.confident(docs), quality_mil.quality_scores(docs, labels), sharding.sharded(docs),
          simhash.deduplicated(docs), suffix_repeats.without_repeats(docs), toxicity.toxicity(docs, labels), whitening.whitened(vectors),
          packing.packed_batches(docs, ["lang"], "doc_id", [F.col("doc_id")], F.length("text"))]
print("rows", [f.count() for f in frames])
"""


def test_operators_run_on_executors_without_the_package(tmp_path):
    """Another working folder and no PYTHONPATH: workers see nothing of this repository."""
    import os
    import pathlib
    import subprocess
    import sys

    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = BARE.format(repo=str(pathlib.Path(__file__).resolve().parents[2]))
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0 and "rows [60, 60, 60, 60, 60, 60, " in done.stdout, done.stderr[-3000:]


def test_order_follows_from_seed_and_rows_alone(spark):
    rows_ = [(None if k % 5 == 0 else k % 17, f"text {k % 23}" if k % 4 else None, "hot" if k % 3 else "cold") for k in range(400)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, source string")
    made = [sorted(str((r.doc_id, r.text, r.shard, r.slot)) for r in sharding.sharded(docs.repartition(n), 8, 42, 500).collect()) for n in (1, 5)]
    assert made[0] == made[1]
    drawn = [sorted(str((r.doc_id, r.text, r.copy, r.order_key)) for r in mixing.mixed(docs.repartition(n), {"hot": 2.0}).collect()) for n in (1, 5)]
    assert drawn[0] == drawn[1]
    keys = [r.order_key for r in mixing.mixed(docs, {"hot": 2.0}).collect()]
    assert keys == sorted(keys)


@pytest.mark.parametrize("limit", [3, 1000])
def test_equal_rows_are_numbered_in_any_number(spark, limit, monkeypatch):
    monkeypatch.setattr(columns, "COPIES_PER_TASK", limit)
    data = [(None, "a", 1.5)] * 50 + [(1, None, None)] * 7 + [(1, "b", None), (1, "c", None), (2, "b", 0.0)]
    rows_ = columns.with_occurrences(columns.packed(spark.createDataFrame(data, "doc_id long, text string, v double").repartition(5), "text")).collect()
    assert sorted(map(str, ((r.rest.doc_id, r.text, r.occurrence) for r in rows_))) == sorted(map(str, [
        *[(None, "a", k) for k in range(1, 51)], *[(1, None, k) for k in range(1, 8)], (1, "b", 1), (1, "c", 1), (2, "b", 1)]))


def test_mixing_draws_rows_of_null_ids_each(spark):
    docs = spark.createDataFrame([(None, "x" * 10, "a") for _ in range(2000)] + [(None, None, None)], "doc_id long, text string, source string")
    made = mixing.mixed(docs, {}, 1.0).collect()
    assert 1800 < len(made) < 2200 and len({(r.order_key, r.copy) for r in made}) == len(made)


def test_sharding_equals_a_plain_two_pass_shuffle(spark):
    """The same scatter by hash, then the same seeded swaps in a loop."""
    import numpy as np

    docs = spark.createDataFrame([(k, f"document {k} " * (k % 9)) for k in range(300)], "doc_id long, text string")
    assert {r.occurrence for r in columns.with_occurrences(columns.packed(docs, "text")).collect()} == {1}
    keyed = sharding.scattered(docs, 42, 800).select("rest.doc_id", "bucket", "key").collect()
    order = []
    for bucket in sorted({r.bucket for r in keyed}):
        part = [r.doc_id for r in sorted((r for r in keyed if r.bucket == bucket), key=lambda r: r.key)]
        picks = np.random.default_rng([42, bucket]).random(len(part))
        for i in range(len(part) - 1, 0, -1):
            j = int(picks[i] * (i + 1))
            part[i], part[j] = part[j], part[i]
        order += part
    got = {r.doc_id: (r.shard, r.slot) for r in sharding.sharded(docs, 8, 42, 800).collect()}
    assert got == {d: (n % 8, n // 8) for n, d in enumerate(order)}


CLASHING = ["_n", "_source", "_key", "_bucket", "_start", "_text", "_doc", "_first", "rest", "occurrence", "bucket", "key", "at", "score", "rejected", "lang_pred", "doc", "first", "n", "mark"]


def test_columns_of_any_name_pass_unchanged(spark):
    plain = spark.createDataFrame([(k, f"the old house number {k} by the river of town {k * 7}", "en", f"s{k % 2}", 40) for k in range(30)] + [(None, None, None, None, None)] * 2,
                                  "doc_id long, text string, lang string, source string, n_chars long")
    docs = plain.select("*", *[F.concat(F.lit(f"mine {c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHING])
    frames = {"language": language_id.confident(docs), "copies": simhash.deduplicated(docs), "mixing": mixing.mixed(docs, {}, 1.0, 42, 3.0).select(*docs.columns),
              "sharding": sharding.sharded(docs).select(*docs.columns)}
    for name, made in frames.items():
        rows_ = made.collect()
        assert made.columns == docs.columns and rows_, name
        assert all(r[c] == f"mine {c} {'none' if r.doc_id is None else r.doc_id}" for r in rows_ for c in CLASHING), name


def test_signs_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "² ½ ①  ３ ৪"), (2, "ª"), (3, "漢")] + [(10 + k, "the old house by the river", ) for k in range(20)], "doc_id long, text string").withColumn("lang", F.lit("en"))
    made = {r.doc_id: r.lang_pred for r in language_id.identified(docs).collect()}
    assert made[1] == "und" and made[2] == made[3] == made[10] == "en"


def test_empty_tables_give_empty_results(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages, items = spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "item_id long, text string")
    rules = url_rules.rule_rows(spark, [("allow", "org", "/")])
    frames = [quality_rules.quality_rules(docs, labels), suffix_repeats.without_repeats(docs), toxicity.toxicity(docs, labels), decontaminate.contained_items(docs, items),
              simhash.simhash_components(docs), url_rules.judged_urls(pages, rules), mixing.mixed(docs, {}), language_id.identified(docs), sharding.sharded(docs), quality_mil.quality_scores(docs, labels)]
    assert [f.count() for f in frames] == [0] * 10
    assert [f(spark, docs, "").columns for _, f in corpus_pipeline.STAGES[:2]] == [docs.columns] * 2


def test_ordinal_severity_and_gradient():
    """Ordered thresholds, expected grade as a direct sum, and the training direction against numeric differences."""
    import math

    import numpy as np

    rng = np.random.default_rng(1)
    data = [{int(c): 1.0 for c in rng.choice(6, 2, replace=False)} for _ in range(200)]
    grades = np.array([min(3, sum(c > 2 for c in r)) for r in data])
    weights, thresholds = toxicity.train(data, grades, 6)
    assert list(thresholds) == sorted(thresholds) and weights[5] > weights[0]
    vocabulary = {f"w{k}".encode(): k for k in range(6)}
    model = toxicity.Model(vocabulary, weights, thresholds)
    eta = math.log1p(1) * (weights[5] + weights[1])
    cumulative = [1 / (1 + math.exp(-(t - eta))) for t in thresholds]
    mass = np.diff([0, *cumulative, 1])
    assert model.over("w5 W1, unknown").sum() == pytest.approx(sum(k * p for k, p in enumerate(mass)))

    def loss(w):
        total = 0.0
        for r, g in zip(data, grades):
            c = [0, *[1 / (1 + math.exp(-(t - sum(w[k] for k in r)))) for t in thresholds], 1]
            total -= math.log(c[g + 1] - c[g])
        return total / len(data) + toxicity.DECAY / 2 * float(w @ w)

    step = [(loss(weights + 1e-4 * np.eye(6)[k]) - loss(weights - 1e-4 * np.eye(6)[k])) / 2e-4 for k in range(6)]
    assert np.abs(step).max() < 5e-3  # at the optimum the slope vanishes


def test_attention_gradient_equals_numeric_differences():
    import numpy as np

    rng = np.random.default_rng(2)
    model = quality_mil.Model()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, starts, target = rng.random((9, quality_mil.FEATURES)), np.array([0, 4, 5]), np.array([1.0, 0.0, 1.0])

    def loss():
        y = model.forward(x, starts)["y"]
        return float(-(target * np.log(y) + (1 - target) * np.log(1 - y)).mean())

    slope = model.gradients(model.forward(x, starts), starts, target)
    for name in model.SHAPES:
        at = tuple(0 for _ in model.p[name].shape)
        kept = model.p[name][at]
        model.p[name][at] = kept + 1e-5
        up = loss()
        model.p[name][at] = kept - 1e-5
        down = loss()
        model.p[name][at] = kept
        assert slope[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7), name
    weights = model.forward(x, starts)["a"]
    assert np.add.reduceat(weights, starts) == pytest.approx([1, 1, 1])


def test_pipeline_equals_its_stages_by_hand(spark, tmp_path):
    """Full rows of run(): ids, copies, shard and slot, from plain code on a small table."""
    import numpy as np

    rng = random.Random(12)
    base = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{base}/documents.parquet")
    benchmark = spark.read.parquet(f"{base}/benchmark.parquet")
    item = benchmark.where("length(text) > 60").first().text
    own = [r for r in source.where("n_chars < 1500").collect()]
    extra = [(10_000, own[0].text, "en", "src1", 9), (10_001, None, "en", "src1", 0), (10_002, "12 ² ?", "fr", "src2", 6), (10_003, f"{own[1].text} {item}", "de", "src3", 5)]
    table = spark.createDataFrame([tuple(r) for r in own] + extra, source.schema)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    made = sorted((r.doc_id, r.shard, r.slot) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())

    rows_ = [tuple(r) for r in own] + extra
    model = language_id.fit(spark.createDataFrame(rows_, source.schema).where(~language_id.held_out(5, 0) & F.col("lang").isNotNull()))
    rejected = model.predict([r[1] for r in rows_])[2]
    rows_ = [r for r, no in zip(rows_, rejected) if not no]
    heads = {g for _, g in simhash_brute([(r[0], r[1]) for r in rows_]).values()}
    rows_ = [r for r in rows_ if r[0] in heads]
    import regex
    sets = lambda t: {tuple(w[k:k + 5]) for w in [regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())] if w for k in range(max(1, len(w) - 4))}
    items = [sets(r.text) for r in benchmark.collect()]
    rows_ = [r for r in rows_ if not any(q and len(q & sets(r[1])) >= 0.8 * len(q) - 1e-9 for q in items)]
    assert 10_003 not in {r[0] for r in rows_} and 10_000 not in {r[0] for r in rows_} and len(rows_) > 20

    def unit(*parts):
        return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 2**52

    from math import exp
    from fathomline.llm.queries import SEED, SOURCE_WEIGHTS
    size = {}
    for r in rows_:
        size[r[3]] = size.get(r[3], 0) + len((r[1] or "").encode())
    weight = {s: SOURCE_WEIGHTS.get(s, 1.0) if n else 0.0 for s, n in size.items()}
    copies = []
    for r in rows_:
        rate = sum(size.values()) * weight[r[3]] / sum(weight.values()) / size[r[3]] if size[r[3]] else 0.0
        k, p, cdf = 0, exp(-rate), exp(-rate)
        while cdf <= unit(SEED, r[0], hashlib.md5((r[1] or "").encode()).hexdigest(), 1):
            k += 1
            p *= rate / k
            cdf += p
        copies += [r] * (k if rate else 0)
    assert sorted(r[0] for r in copies) == [m[0] for m in made]
    mixed_ = spark.createDataFrame(copies, source.schema)
    want = sorted((r.doc_id, r.shard, r.slot) for r in sharding.sharded(mixed_, seed=SEED).collect())
    assert made == want
    assert [sorted(m[2] for m in made if m[1] == s) for s in range(8)] == [list(range(len([1 for m in made if m[1] == s]))) for s in range(8)]


def test_pipeline_stages(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("copy", F.lit(1)).withColumn("slot", F.lit("x"))
    current = table.unionByName(table.limit(5))
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, current, sf_dir)
        if name != "sharding":
            assert made.columns == current.columns, name
        current = made
    pairs = [(r.doc_id, r.text) for r in table.collect()]
    want = {c for _, c in simhash_brute(pairs).values()}
    dirty = {r.doc_id for r in decontaminate.contained_items(table, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in current.collect()} <= want - dirty
    empty = corpus_pipeline.STAGES[1][1](spark, table.where("1 = 0"), sf_dir)
    assert empty.count() == 0 and columns.BROADCAST_ROWS > 0
