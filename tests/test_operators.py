"""Operators on small hand-made rows, against brute force where the order matters."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fathomline.operators import aggregates as ag
from fathomline.operators import incremental as inc
from fathomline.operators import joins as jn
from fathomline.operators import gates, keyed, matching, numbering, packing
from fathomline.operators import upsert as up
from fathomline.operators.skew import attach_groups
from fathomline.sources import contracts, delimited
from fathomline.sources.sinks import SnapshotTable


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_merge_protects_human_columns_and_keeps_created(spark):
    t = spark.createDataFrame([(1, "a", "human", "old"), (2, "b", None, "old")], "k int, m string, h string, c string")
    s = spark.createDataFrame([(1, "A", "x", "new"), (3, "C", "x", "new")], "k int, m string, h string, c string")
    out = up.merge(t, s, ["k"], protect=["h"], insert_only=["c"])
    assert rows(out.fillna("-"), "k", "m", "h", "c") == [(1, "A", "human", "old"), (2, "b", "-", "old"), (3, "C", "-", "new")]


def test_merge_is_idempotent_and_rejects_repeated_source_keys(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    once = up.merge(t, s, ["k"])
    assert rows(up.merge(once, s, ["k"]), "k", "v") == rows(once, "k", "v")
    with pytest.raises(PySparkException, match="repeats a key"):
        up.merge(t, s.union(s), ["k"]).collect()


def test_merge_with_null_keys(spark):
    t = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    s = spark.createDataFrame([(None, 9)], "k string, v int")
    assert sorted(r.v for r in up.merge(t, s, ["k"], null_safe=True).collect()) == [2, 9]
    assert sorted(r.v for r in up.merge(t, s, ["k"]).collect()) == [1, 2, 9]


def test_soft_delete_and_return(spark):
    day = dt.date(2024, 1, 1)
    t = spark.createDataFrame([(1, "a", True, day), (2, "b", True, day), (3, "c", False, day)], "k int, v string, is_active boolean, updated_at date")
    s = spark.createDataFrame([(1, "a"), (3, "c")], "k int, v string")
    out = up.soft_delete_merge(t, s, ["k"], ["v"], F.lit("2024-02-01").cast("date"))
    later = dt.date(2024, 2, 1)
    assert rows(out, "k", "is_active", "updated_at") == [(1, True, day), (2, False, later), (3, True, later)]


def test_empty_batch_deactivates_nothing(spark):
    t = spark.createDataFrame([(1, True), (2, True)], "k int, active boolean")
    none = t.where("k > 9")
    assert rows(up.deactivate_missing(t, none, ["k"], F.lit(True)), "k", "active") == [(1, True), (2, True)]
    assert rows(up.deactivate_missing(t, t.where("k = 1"), ["k"], F.lit(True)), "k", "active") == [(1, True), (2, False)]


def test_duplicates_with_hot_hash_equal_the_plain_path(spark):
    data = [(i, "hot" if i % 3 == 0 else f"h{i % 7}" if i % 5 else None) for i in range(200)]
    df = spark.createDataFrame(data, "id long, h string")
    first = {}
    for i, h in data:
        if h is not None:
            first.setdefault(h, i)
    want = sorted((i, first[h] if h is not None and first[h] != i else -1) for i, h in data)
    for hot_rows in (1, 20, 1_000_000):
        out = keyed.duplicate_of_first(df, "h", ["id"], ["id"], hot_rows=hot_rows)
        got = sorted((r.id, r.dup_of.id if r.dup_of else -1) for r in out.collect())
        assert got == want


def test_duplicate_pool_prefers_this_batch_over_its_stored_form(spark):
    batch = spark.createDataFrame([(5, "x"), (9, "y")], "id long, h string")
    stored = spark.createDataFrame([(1, "x"), (5, "z"), (7, "z")], "id long, h string")
    out = keyed.duplicate_of_first(batch, "h", ["id"], ["id"], pool=stored)
    assert sorted((r.id, r.dup_of.id if r.dup_of else None) for r in out.collect()) == [(5, 1), (9, None)]


def test_attach_groups_splits_hot_and_cold(spark):
    facts = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 99), ("c", 100)], "k string, id int")
    groups = spark.createDataFrame([("a", 50, "A"), ("b", 1, "B")], "k string, n long, v string")
    for hot in (10, 1000):
        out = attach_groups(facts, groups, ["k"], "n", ["id"], hot_rows=hot)
        got = {(r.k, r.v) for r in out.collect()}
        assert got == {("a", "A"), ("b", "B"), ("c", None)} and out.count() == 52


def test_numbers_and_sums_equal_one_window(spark):
    rng = random.Random(3)
    data = [(rng.choice(["x", "y", None]), i, rng.randint(1, 9)) for i in range(300)]
    df = spark.createDataFrame(data, "g string, id int, v int")
    num = numbering.row_numbers(df, ["g"], [F.col("id")], "rn")
    run = numbering.running_sums(df, ["g"], [F.col("id")], F.col("v"), "before")
    want_n, want_s, seen, total = {}, {}, {}, {}
    for g, i, v in data:
        seen[g] = seen.get(g, 0) + 1
        want_n[i], want_s[i] = seen[g], total.get(g, 0)
        total[g] = total.get(g, 0) + v
    assert {r.id: r.rn for r in num.collect()} == want_n
    assert {r.id: r.before for r in run.collect()} == want_s


def greedy(sizes, max_chars, max_rows):
    n, chars, batch, out = 0, 0, 0, []
    for c in sizes:
        if n and (chars + c > max_chars or n >= max_rows):
            n, chars, batch = 0, 0, batch + 1
        n, chars = n + 1, chars + c
        out.append(batch)
    return out


@pytest.mark.parametrize("block", [1, 7, 64, 8192])
def test_packed_batches_equal_the_greedy_loop(spark, block):
    rng = random.Random(block)
    data = [(g, i, rng.choice([0, 5, 10, 150, 399, 400, 1000, 1500])) for i, g in enumerate(rng.choices(["s", "t", None], [8, 2, 1], k=700))]
    out = packing.packed_batches(spark.createDataFrame(data, "s string, id int, c int"), ["s"], "id", [F.col("id")], F.col("c"), 1000, 5, block)
    want = {}
    for g in ("s", "t", None):
        rows = [r for r in data if r[0] == g]
        want |= {i: (g, b) for (_, i, _), b in zip(rows, greedy([c for _, _, c in rows], 1000, 5))}
    assert {r.id: (r.s, r.batch_no) for r in out.collect()} == want


def test_packed_batches_of_a_large_group_without_keys(spark):
    df = spark.range(1_000_000).select("id", (F.pmod(F.xxhash64("id"), F.lit(3000)) - 5).alias("c"))
    made = packing.packed_batches(df.repartition(7), [], "id", [F.col("id")], F.col("c")).orderBy("id").toArrow().column("batch_no").to_pylist()
    assert made == greedy([max(0, r.c) for r in df.orderBy("id").collect()], packing.BATCH_CHARS, packing.BATCH_ROWS)
    assert packing.packed_batches(df.where("id < 0"), [], "id", [F.col("id")], F.col("c")).count() == 0


def test_numbers_of_values_in_a_small_part_of_their_range(spark):
    """Nine tenths of the rows lie in a thousandth of the range: the parts are equal all the same."""
    df = spark.range(40_000).select("id", F.when(F.col("id") % 10 == 0, F.col("id") * 1000).otherwise(F.col("id") % 37).cast("double").alias("v"))
    got = {r.id: r.rn for r in numbering.row_numbers(df, [], [F.col("v"), F.col("id")], "rn").collect()}
    want = {r.id: k + 1 for k, r in enumerate(sorted(df.collect(), key=lambda r: (r.v, r.id)))}
    assert got == want
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = sorted(r["count"] for r in numbering._sorted_parts(df, [], [F.col("v"), F.col("id")]).groupBy("_part").count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and sizes[-1] < 2 * 40_000 / 8


def test_budget_pack_equals_the_loop(spark):
    rng = random.Random(8)
    data = [("s", i, rng.choice([0, 30, 2500, 9000, 4000])) for i in range(60)]
    out = packing.budget_pack(spark.createDataFrame(data, "s string, id int, c int"), ["s"], [F.col("id")], F.col("c"),
                              5000, 30000, mark_chars=12)
    want, used = {}, 0
    for _, i, c in data:
        room = min(5000, 30000 - used)
        if c == 0 or room < 2000:
            want[i] = 0
            continue
        want[i] = min(c, room)
        used += want[i] + (12 if c > room else 0)
    assert {r.id: r.taken for r in out.collect()} == want


def test_longest_suffix_wins(spark):
    facts = spark.createDataFrame([(1, "mail.corp.example.com"), (2, "example.com"), (3, "notexample.com")], "id int, dom string")
    aliases = spark.createDataFrame([("example.com", "ex"), ("corp.example.com", "corp")], "alias string, company string")
    out = jn.longest_suffix_match(facts, "id", "dom", aliases, "alias").fillna("-")
    assert rows(out, "id", "company") == [(1, "corp"), (2, "ex"), (3, "-")]


def test_as_of_uses_the_last_period_before(spark):
    facts = spark.createDataFrame([("a", 1, 10), ("a", 4, 40)], "k string, q int, v int")
    asked = spark.createDataFrame([("a", 0), ("a", 1), ("a", 3), ("a", 9)], "k string, q int")
    out = jn.at_or_before(asked, facts, "k", "q")
    assert sorted((r.q, r.found_period, r.v) for r in out.where("found_period is not null").collect()) == [(1, 1, 10), (3, 1, 10), (9, 4, 40)]
    assert out.count() == 4


def test_votes_and_ties(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "x"), (2, "y"), (3, None)], "k int, v string")
    assert sorted((r.k, r.w) for r in ag.majority(df, ["k"], "v", "w").fillna("-").collect()) == [(1, "x"), (2, "-")]


def test_grouped_median_of_any_distribution(spark):
    """Even and odd groups, ties, NULLs, a NULL group, and a group with nine tenths of its values in a thousandth of its range."""
    rng = random.Random(9)
    data = [("even", float(v)) for v in range(10)] + [("odd", 3.0), ("odd", -1.0), ("odd", 7.5), ("tie", 2.0), ("tie", 2.0), ("none", None), (None, 4.0), (None, 8.0)]
    data += [("dense", rng.random() * 1000 if k % 10 == 0 else 500 + rng.random()) for k in range(60_001)]
    data += [("same", 5.0)] * 30_000 + [("same", 6.0)] * 30_000
    df = spark.createDataFrame(data, "g string, v double").repartition(8)
    got = {r.g: r.m for r in ag.grouped_median(df, ["g"], "v", "m").collect()}
    want = {}
    for g in {g for g, _ in data}:
        values = [v for h, v in data if h == g and v is not None]
        if values:
            want[g] = statistics.median(values)
    assert got == want


def test_digest_tells_swapped_doubled_and_exchanged_rows(spark):
    base = [("x", "a"), ("x", "b"), ("y", "c")]

    def digests(rows):
        return {r.k: r.digest for r in inc.group_digest(spark.createDataFrame(rows, "k string, h string"), ["k"], F.col("h")).collect()}

    first = digests(base)
    assert digests(base[::-1]) == first
    assert digests([("x", "b"), ("x", "a"), ("y", "c")])["x"] == first["x"]
    others = [digests(rows)["x"] for rows in ([("x", "a"), ("x", "c"), ("y", "b")], [*base, ("x", "a")], [("x", "a"), ("x", "a")], [("x", "ab"), ("x", "")], [("x", "a")])]
    assert len({first["x"], *others}) == 6


def test_table_checks_count_per_row_and_key(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (2, "z", None), (3, None, 9)], "k int, s string, r int")
    dim = spark.createDataFrame([(5,), (6,), (6,)], "id int")
    made = gates.table_checks(df, ["k"], "unique", {"listed": ~F.col("s").isin("a", "b")}, {"resolves": ("r", dim, "id")})
    assert rows(made, "check_name", "n_bad", "ok") == [("listed", 1, False), ("resolves", 2, False), ("unique", 1, False)]
    empty = gates.table_checks(df.where("false"), ["k"], "unique", {"listed": F.lit(True)})
    assert rows(empty, "check_name", "n_bad", "ok") == [("listed", 0, True), ("unique", 0, True)]


def test_streak_breaks_at_gaps(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", 2, True), ("a", 4, True), ("a", 5, False), ("a", 6, True)], "k string, p int, good boolean")
    assert rows(ag.longest_run_ending(df, "k", "p", F.col("good")), "p", "streak") == [(1, 1), (2, 2), (4, 1), (5, 0), (6, 1)]


def test_retry_queue(spark):
    docs = spark.createDataFrame([(i,) for i in range(1, 6)], "doc int")
    tries = spark.createDataFrame([(2, "success", 1, "p", 1), (3, "failed", 2, "p", 1), (4, "failed", 3, "p", 1), (5, "success", 2, "old", 1)],
                                  "doc int, status string, attempt int, parser string, at int")
    out = inc.retry_queue(docs, tries, "doc", parser="p", max_attempts=3, newest=[F.desc("at")])
    assert rows(out, "doc", "attempt") == [(1, 0), (3, 2), (5, 0)]


def test_alias_match_short_and_long(spark):
    names = spark.createDataFrame([(1, "Acme VD, Utopia"), (2, "DVD maker"), (3, "team vd"), (4, "ACME"), (5, None)], "id int, raw string")
    aliases = spark.createDataFrame([("Acme", "acme"), ("Acme VD", "acme_vd"), ("VD", "vd")], "alias string, entity string")
    for hot in (1, 1000):
        out = matching.alias_match(names, "raw", "id", aliases, "alias", "entity", hot_rows=hot)
        assert rows(out.fillna("-"), "id", "entity") == [(1, "acme_vd"), (2, "-"), (3, "vd"), (4, "acme"), (5, "-")]


def test_number_leaks_need_boundaries_and_units(spark):
    text = spark.createDataFrame([("a", "we ship 10K in 2010"), ("b", "price US$7 now"), ("c", "about 10.5 and 400 dppm")], "cell string, t string")
    items = spark.createDataFrame([("a", "10", "k"), ("b", "7", "US$"), ("c", "10", ""), ("c", "400", "ppm")], "cell string, value string, unit string")
    assert rows(matching.leaked_cells(text, items, ["cell"], "t"), "cell") == [("a",), ("b",)]


def test_number_leaks_with_units_of_any_length(spark):
    text = spark.createDataFrame([("a", "about 1,200  panels per calendar quarter"), ("b", "70 thousand panels per calendar month"), ("c", "m2 7 in all")],
                                 "cell string, t string")
    items = spark.createDataFrame([("a", "1200", "Panels per calendar quarter"), ("b", "70", "thousand panels per calendar quarter"), ("c", "7", "m2")],
                                  "cell string, value string, unit string")
    assert rows(matching.leaked_cells(text, items, ["cell"], "t"), "cell") == [("a",), ("c",)]


def test_number_leaks_of_a_source_with_a_third_of_the_rows(spark):
    """Every text against all items of its source; one source and one value are hot."""
    docs = spark.range(6_000).select(F.col("id").alias("doc"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 500)).alias("cell"),
                                     F.concat(F.lit("all of 7 kg, then "), "id", F.lit(" pcs. and m2 "), F.col("id") % 90).alias("t"))
    items = spark.createDataFrame([("hot", "7", "KG", 1), ("hot", "3", "pcs", 2), ("hot", "45", "m2", 3), ("hot", "60", "", 4), ("s1", "1", "pcs", 5), ("s1", "7", "g", 6), (None, "7", "kg", 7)],
                                  "cell string, value string, unit string, item int")
    got = sorted((r.item, r.doc) for r in matching.shown_items(docs, ["doc"], items, ["cell"], "t").collect())
    hot = range(0, 6_000, 3)
    want = [(1, d) for d in hot] + [(2, 3)] + [(3, d) for d in hot if d % 90 == 45] + [(4, d) for d in hot if d % 90 == 60 or d == 60] + [(5, 1)]
    assert got == sorted(want)


def test_number_leaks_skip_full_stops(spark):
    """A full stop makes no candidate rows unless an item is points alone; what is found is the same."""
    docs = spark.range(200).select(F.col("id").alias("doc"), F.lit("a").alias("cell"), F.concat(F.repeat(F.lit("Some words. And more... "), F.lit(30)), F.lit("5 kg. x .75 and 1.5. "), "id").alias("t"))
    items = spark.createDataFrame([("a", "5", "kg"), ("a", ".75", ""), ("a", "1.5.", ""), ("a", "1.5", ""), ("a", "17", "")], "cell string, value string, unit string")
    dots = spark.createDataFrame([("a", "...", ""), ("a", ".", "and"), ("b", "..", "")], "cell string, value string, unit string")
    got = matching.shown_items(docs, ["doc"], items, ["cell"], "t")
    assert rows(got.groupBy("value").count(), "value", "count") == [(".75", 200), ("1.5.", 200), ("17", 1), ("5", 200)]
    assert rows(matching.shown_items(docs, ["doc"], items.union(dots), ["cell"], "t").groupBy("value").count(), "value", "count") == [
        (".", 200), ("...", 200), (".75", 200), ("1.5.", 200), ("17", 1), ("5", 200)]
    plan = got._jdf.queryExecution().analyzed().toString()
    assert r"\p{Nd}[\p{Nd}.]*+" in plan


def test_snapshots_ignore_unfinished_writes(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.write(spark.range(3))
    (tmp_path / "t" / "v2").mkdir()
    assert table.read().count() == 3
    assert table.update(lambda cur: cur.union(spark.range(2))).count() == 5
    assert table.versions()[-1] == 2


def test_strict_csv_refuses_a_wrong_header(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text("a,b\n1,2024-01-02\n,\n")
    good = contracts.manifest_schema([("a", "INT"), ("b", "DATE")])
    assert [(r.a, r.b) for r in delimited.read_strict_csv(spark, str(path), good).collect()] == [(1, dt.date(2024, 1, 2)), (None, None)]
    with pytest.raises(Exception, match="header does not conform"):
        delimited.read_strict_csv(spark, str(path), contracts.manifest_schema([("a", "INT"), ("c", "DATE")])).collect()
    with pytest.raises(ValueError):
        contracts.manifest_schema([("a", "BLOB")])


def test_seed_rows_and_view_specs(spark):
    seeds = delimited.seed_rows(spark, "id,name\n 1 , x\n2,\n", ["id", "name"])
    assert [(r.id, r.name) for r in seeds.collect()] == [("1", "x"), ("2", None)]
    with pytest.raises(ValueError):
        delimited.seed_rows(spark, "id\n1", ["key"])
    assert contracts.view_from_spec(seeds, [("upper(name)", "n")]).columns == ["n"]
    with pytest.raises(ValueError):
        contracts.view_from_spec(seeds, [("id", "n"), ("name", "n")])


def test_num_profile_is_exact_with_a_small_sketch(spark):
    """Places of shares are those of the sorted values, with NULLs, ties and columns of several types."""
    values = [(i * 7919 % 60_013, None if i % 3 == 0 else i % 50, i / 7) for i in range(60_013)]
    df = spark.createDataFrame(values, "a long, b int, c double").repartition(8)
    out = ag.num_profile(df, ["a", "b", "c"])
    got = out.first()
    for k, c in enumerate("abc"):
        solid = sorted(v[k] for v in values if v[k] is not None)
        assert [got[f"{c}_p50"], got[f"{c}_p95"], got[f"{c}_max"]] == [solid[-(-len(solid) // 2) - 1], solid[-(-len(solid) * 19 // 20) - 1], solid[-1]]
    assert [t for _, t in out.dtypes] == ["bigint"] * 3 + ["int"] * 3 + ["double"] * 3
    assert ag.num_profile(df.where("a < 0"), ["a"]).collect() == [(None, None, None)]
