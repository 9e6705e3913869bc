"""Text functions on fixtures, and against a plain loop over the test documents."""

from __future__ import annotations

import datetime as dt
import random
import re
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fathomline.functions import dates, jsons, markup
from fathomline.functions import segments as sg
from fathomline.functions import text as tx
from fathomline.plans import labels, mail


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "t string").select(fn(F.col("t")).alias("o")).first().o


def flattened(text):
    """The rule, line by line."""
    out, run = [], []

    def close():
        solid = [x.strip() for x in run if x.strip()]
        if len(solid) >= 8:
            out.append(" | ".join(solid))
            if not run[-1].strip():
                out.append("")
        else:
            out.extend(run)
        run.clear()

    for ln in text.split("\n"):
        s = ln.strip()
        if (s and len(s) <= 20) or (not s and run):
            run.append(ln)
        else:
            close()
            out.append(ln)
    close()
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", "\n".join(out))).strip()


def test_flatten_equals_the_loop_on_all_documents(tables):
    src = tables.documents.select("doc_id", F.regexp_replace("text", r"[.,] ", "\n").alias("t"))
    got = src.select("doc_id", "t", tx.flatten_short_lines(F.col("t")).alias("f")).collect()
    assert any(r.f != r.t for r in got)
    assert all(r.f == flattened(r.t) for r in got)


def test_flatten_keeps_a_blank_line_after_the_run(spark):
    text = "\n".join([f"c{i}" for i in range(8)]) + "\n\nA long sentence that is not a short line at all."
    assert one(spark, text, tx.flatten_short_lines) == flattened(text)


MAIL = ("FYI\n\n-----\n**From:** Wang, Amy <amy.wang@x.example.com> **Sent:** Monday, March 4, 2024 3:05 PM\n"
        "**To:** Bob Li <bob@y.example.com>; Team PM\nsecond line\n\nHello Bob\nFrom: nobody special\nFrom: Bob Li\nSent: 2024年3月3日 下午 1:02\n"
        "Subject: RE: plan\nBody of Bob")


def test_header_blocks(spark):
    got = one(spark, MAIL, sg.header_blocks)
    assert [MAIL[b.start:].split("\n")[0] for b in got] == ["**From:** Wang, Amy <amy.wang@x.example.com> **Sent:** Monday, March 4, 2024 3:05 PM", "From: Bob Li"]
    want = ["Wang, Amy <amy.wang@x.example.com>", "Monday, March 4, 2024 3:05 PM", "Bob Li <bob@y.example.com>; Team PM second line", None]
    assert [got[0].fields[k] for k in ("from", "sent", "to", "subject")] == want
    assert got[1].fields["subject"] == "RE: plan" and MAIL[got[1].stop:] == "\nBody of Bob"
    assert [one(spark, t, sg.header_blocks) for t in (None, "", "From: nobody")] == [[], [], []]


THREAD = ("Please read on.\n\n**From:** Ada Moor 莫阿達 <ada.moor@ours.example.com>\n**Sent:** Tuesday, May 7, 2024 9:30 AM\n**To:** Stone, Kit <kit.stone@buyer.example.net>\n"
          "**Cc:** PANEL PM <panel_pm@buyer.example.net>\n**Subject:** RE: plan for Kit Stone\n\nDear Kit,\nAda Moor and STONE, KIT agreed; ask amoor or 0411111.\nAda 莫阿達\n"
          "other.person@else.example.org\n\n  -----Original Appointment-----  \n\n**From:** Stone, Kit <kit.stone@buyer.example.net>\n**Sent:** Friday, May 3, 2024 4:00 PM\n**To:** Ada Moor 莫阿達\n"
          "**Subject:** plan\n**When:** 2024年5月13日 下午 03:30\n**Where:** Room 8\n\nA will to move. Kit   Kit Stone")


def test_segments_start_at_their_line_or_the_ruler_above(spark):
    df = spark.createDataFrame([(1, THREAD, dt.date(2024, 5, 8))], "pk_seq long, t string, d date")
    segs = df.select(sg.mail_segments("t", "d").alias("s"), sg.mail_facts(F.col("t")).alias("f")).first()
    assert [s.segment_no for s in segs.s] == [0, 1, 2] and "".join(s.raw for s in segs.s) == THREAD
    assert [THREAD[s.start:].strip()[:8] for s in segs.s] == ["Please r", "**From:*", "-----Ori"]
    assert segs.s[2].body == "\n\nA will to move. Kit   Kit Stone" and segs.s[2].fields["where"] == "Room 8"
    assert segs.f.has_headers and segs.f.when == "2024年5月13日 下午 03:30" and segs.f.where == "Room 8"


@pytest.mark.parametrize("item, day, want", [
    ("9月3日", dt.date(2024, 10, 1), dt.date(2024, 9, 3)), ("12/28", dt.date(2024, 1, 5), dt.date(2023, 12, 28)), ("2022/1/2", dt.date(2024, 1, 5), dt.date(2022, 1, 2)),
    ("13/40", dt.date(2024, 1, 5), None), ("a\nb\n5/5", dt.date(2024, 6, 1), dt.date(2024, 5, 5)), ("a\nb\nc\n5/5", dt.date(2024, 6, 1), None), ("5/5", None, None)])
def test_minutes_take_the_date_of_the_item_line_above(spark, item, day, want):
    text = f"Sirs,\nT430QVN04.5 first\n item :\n\n\n{item}\n  M270DAN07.D\nsecond T550QVN10.F"
    df = spark.createDataFrame([(text, day)], "t string, d date")
    got = df.select(sg.mail_segments("t", "d").alias("s")).first().s
    assert [(s.kind, s.raw[:6].strip()) for s in got] == [("minutes", "Sirs,"), ("minutes", "T430QV"), ("minutes", "M270")]
    assert [s.item_date for s in got] == [None, None, want]
    whole = df.select(sg.mail_segments(F.lit("no mark"), "d").alias("s"), sg.mail_segments(F.lit(" \n"), "d").alias("b")).first()
    assert [(s.segment_no, s.kind, s.raw) for s in whole.s] == [(0, "whole", "no mark")] and whole.b == []


def test_marks_take_time_in_proportion():
    part = "**From:** A B <a@b.example.com> **Sent:** Monday, March 4, 2024 3:05 PM body of the mail"
    for end in (" ", "\n"):
        seconds = []
        for n in (8_000, 16_000):
            begun = time.perf_counter()
            assert len(sg.Marks((part + end) * n).segments(None)) == n
            seconds.append(time.perf_counter() - begun)
        assert seconds[0] < 2 and seconds[1] < 5 * seconds[0] + 0.2
    begun = time.perf_counter()
    markup.elements(b"<a " * 20_000)
    markup.mail_text("<td <!-" * 20_000)
    assert time.perf_counter() - begun < 2


def test_every_form_of_a_name_is_masked(spark):
    """Name as shown, parts, 'last, first', account, number, addresses, first name before the token; nothing is left."""
    mails = spark.createDataFrame([(1, dt.date(2024, 5, 8), "plan", THREAD, "莫阿達", "0411111", "amoor", "x@far.example.org; Lee, Ann")],
                                  "pk_seq long, mail_date date, subject_clean string, body_display string, sender_name string, emp_id string, account string, mail_to string")
    parts = mail.participants(mails)
    forms = {(e.name, e.token) for e in mail.name_book(parts).first().entries}
    assert {("莫阿達", "<P01>"), ("Moor, Ada", "<P01>"), ("Ada Moor", "<P01>"), ("amoor", "<P01>"), ("0411111", ""), ("kit.stone@buyer.example.net", "<P04>"),
            ("Stone, Kit", "<P04>"), ("Kit Stone", "<P04>"), ("panel_pm@buyer.example.net", "<G01>")} <= forms
    out = {r.segment_no: r for r in mail.clean_segments(mail.segment_rows(mails), parts).collect()}
    assert sorted(out) == [1, 2] and {r.names_left for r in out.values()} == {0}
    assert out[1].clean_text == ("<P01>:\nSent: 2024-05-07 09:30\nSubject: RE: plan for <P04>\n\nDear Kit,\n<P01> and <P04> agreed; ask <P01> or .\n<P01>\n[email]")
    assert out[2].clean_text == "<P04>:\nSent: 2024-05-03 16:00\nSubject: plan\n\nA will to move. <P04>" and out[2].segment_date == dt.date(2024, 5, 3)
    assert out[1].n_masked == 1 and out[1].parties == ["buyer.example.net", "else.example.org", "ours.example.com"] and out[2].content_type == "appointment"


def test_names_are_found_as_one_alternation_finds_them():
    """Against a pattern of all names, longest first, over random texts of nested and overlapping names."""
    rng = random.Random(4)
    for _ in range(300):
        names = list({"".join(rng.choice("abA é,") for _ in range(rng.randint(2, 5))).strip() for _ in range(6)} - {""})
        text = "".join(rng.choice("abA é,.1") for _ in range(60))

        def form(n):
            if not n.isascii():
                return re.escape(n)
            body = f"(?<![A-Za-z0-9]){re.escape(n)}(?![A-Za-z0-9])"
            return f"(?i:{body})" if re.search("[ ,@]", n) else body

        pattern = re.compile("|".join(form(n) for n in sorted(names, key=lambda n: (-len(n), n))))
        assert sg.NameBook([(n, "#") for n in names]).hits(text) == [m.span() for m in pattern.finditer(text)]


@pytest.mark.parametrize("text, want", [
    ("Monday, March 4, 2024 3:05 PM", dt.datetime(2024, 3, 4, 15, 5)), ("March 4, 2024 12:10 AM", dt.datetime(2024, 3, 4, 0, 10)),
    ("March 4, 2024", dt.datetime(2024, 3, 4)), ("2024年3月3日 (週日) 下午 1:02", dt.datetime(2024, 3, 3, 13, 2)), ("2024年3月3日", dt.datetime(2024, 3, 3)),
    ("February 31, 2024", None), ("someday", None), ("", None)])
def test_mail_datetime(spark, text, want):
    assert one(spark, text, dates.mail_datetime) == want


@pytest.mark.parametrize("zone", ["UTC", "Asia/Taipei", "America/New_York"])
def test_iso_text_is_independent_of_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        secs = [one(spark, t, lambda c: F.unix_timestamp(dates.iso_to_utc(c))) for t in ("2024-01-01T00:00:00Z", "2024-01-01T08:00:00+08:00", "2024-01-01T08:00:00", " ")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert secs == [1704067200, 1704067200, 1704067200, None]


def test_mask_dictionary_longest_first_whole_words(spark):
    text = "Amy Wang and amy wang met Will; I will call willing 王小明. Amy stays, P01 too."
    book = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("token")) for n, t in
                     (("Amy Wang", "<P01>"), ("Will", "<P02>"), ("王小明", "<P03>"), ("P01", "<P09>"), ("A", "<P08>"))])
    assert one(spark, text, lambda c: sg.mask_dictionary(c, book)) == "<P01> and <P01> met <P02>; I will call willing <P03>. Amy stays, <P09> too."


def test_tokens_are_shared_by_any_key(spark):
    e = [("e:a", "n:amy", "person"), (None, "n:team", "group"), ("e:b", None, "person"), (None, "n:amy", "person"), ("e:c", "n:amy", "person"), ("e:c", None, "person")]
    df = spark.createDataFrame([(e,)], "e array<struct<key1:string,key2:string,kind:string>>")
    assert df.select(sg.assign_tokens(F.col("e")).alias("t")).first().t == ["P01", "G01", "P02", "P01", "P01", "P01"]


@pytest.mark.parametrize("quote, text, want", [
    ("plan  is fine", "the plan is\nfine", True), ("ＰＬＡＮ is", "plan is", True), ("the price … is up", "the price today is up", True),
    ("is up … the price", "the price today is up", False), ("**Price**", "a price", True), ("ab … the price", "the price", True), ("  ", "x", False), ("!!", "x", False)])
def test_quote_levels(spark, quote, text, want):
    df = spark.createDataFrame([(quote, text)], "q string, t string")
    assert df.select(tx.quote_in_text(F.col("q"), F.col("t")).alias("o")).first().o is want


def test_recipients_and_display_names(spark):
    got = one(spark, "'Lee, Ann' <Ann.Lee@X.example.com>; Team PM; bob@y.example.com; IMCEAEX-1@z.example.com; ;", tx.split_recipients)
    assert [(r.display, r.email) for r in got] == [("Lee, Ann", "ann.lee@x.example.com"), ("Team PM", None), ("bob", "bob@y.example.com"), ("", None)]
    names = {n: one(spark, n, tx.parse_display_name) for n in ("Alex 王小明", "Lee, Ann", "SALES", "Anna PM", "Élan")}
    assert [(v.name_zh, v.name_en, v.kind) for v in names.values()] == [
        ("王小明", "Alex", "person"), (None, "Ann Lee", "person"), (None, "SALES", "group"), (None, "Anna PM", "group"), (None, "Élan", "person")]


def test_disclaimer_cuts_to_the_end_of_its_paragraph(spark):
    text = "keep me\nThis email contains information\ndrop me\n\n__________\n\nnext"
    assert one(spark, text, tx.drop_disclaimers) == "keep me\n\nnext"


def test_html_plain_survives_open_comments(spark):
    html = "<head><title>x</title></head><p>one\ntwo</p><table><tr><td><p>a</p></td><td>b</td></tr></table>&amp;<!--[if gte mso 9]> junk"
    assert one(spark, html, tx.html_plain) == "one two\n\n| a | b |\n\n&"


def test_html_plain_ends_a_style_block_with_an_open_comment(spark):
    assert one(spark, "<style><!-- p{} </style><p>Body stays</p>", tx.html_plain) == "Body stays"
    assert one(spark, "<!-- <style> --><p>a</p><title>b", tx.html_plain) == "a"


def test_tokens_keep_underscores(spark):
    assert one(spark, "Foo_bar foo b-ar", tx.tokens) == ["foo_bar", "foo", "ar"]


def test_elements_with_quotes_in_plain_values():
    raw = b"<p title=Bob's>one</p><p>two</p><p>it's three</p><p title='a>b' alt=\"c>d\">four</p><p title=\"open>five</p>"
    assert [e[1] for e in markup.elements(raw)] == ["one", "two", "it's three", "four", "five"]


def test_attributes_are_told_apart():
    raw = (b"<table><tr><td title='colspan=3' colspan = 2>a</td><td>b</td></tr><tr><td>1</td><td>2</td><td>3</td></tr></table>"
           b"<p title='page-break-before: always'>x</p><p STYLE=\"page-break-before: always\">y</p>")
    assert markup.elements(raw) == [("table", "| a |  | b |\n|---|---|---|\n| 1 | 2 | 3 |", 0), ("text", "x", 0), ("text", "y", 1)]


def test_display_clean(spark):
    text = "Hi &amp; bye ![x](cid:1)\nNormal\n<!--\nbig style mso-bidi here\n[site](https://x.example.com) \\*\n12\nend"
    assert one(spark, text, tx.clean_display) == "Hi & bye\nsite *\nend"


def test_elements_of_a_wrapped_filing():
    raw = ("<DOCUMENT><TYPE>EX-99<TEXT><html><head><title>t</title><style>x</style></head><body><h2>Top</h2><p>a b<br>c</p><ul><li>one</li></ul>"
           "<div style='page-break-before: always'></div><table><tr><th></th><th colspan=2>Q1</th></tr><tr><td>Rev</td><td>$</td><td>12</td></tr>"
           "<tr><td>Loss</td><td>(</td><td>3</td><td>)</td></tr><tr><td></td></tr></table><p>tail</TEXT></DOCUMENT>").encode()
    assert markup.elements(raw) == [
        ("section_header", "## Top", 0), ("text", "a b", 0), ("text", "c", 0), ("text", "- one", 0),
        ("table", "| Q1 |  |\n|---|---|\n| Rev | $12 |\n| Loss | (3) |".replace("| Q1 |  |", "|  | Q1 |"), 1), ("text", "tail", 1)]
    assert markup.elements(b"") == [] and markup.elements("caf\xe9".encode("cp1252")) == [("text", "café", 0)]


def test_parse_status_of_an_empty_page(spark):
    docs = spark.createDataFrame([(1, "<p>x</p>"), (2, "<script>y</script>")], "id long, html string")
    pay = markup.payloads(markup.element_rows(docs, "id", "html"), "id")
    got = {r.id: (r.status, r.element_count) for r in markup.parse_results(pay, "id").collect()}
    assert got == {1: ("success", 1), 2: ("partial", 0)}


def test_json_salvage_and_numbers(spark):
    assert one(spark, 'x ```json\n{"a": [1,],}\n```', jsons.salvage) == '{"a": [1]}'
    assert one(spark, "none", jsons.salvage) is None
    got = one(spark, '[{"value":"1,200","unit":" K "},{"value":true},{"value":3.5},{"value":{"x":1}}]', jsons.number_values)
    assert [(r.value, r.unit) for r in got] == [(1200.0, "k"), (3.5, "")]
    assert one(spark, "{bad", jsons.number_values) == []


def test_facets_and_relevance(spark):
    rows = [("price", ["price"]), ("schedule", ["schedule", "spec", "quality"]), ("admin", ["admin", "quality"]), ("admin", ["admin"])]
    df = spark.createDataFrame(rows, "p string, tags array<string>")
    facet, basis = labels.assign_facet(F.col("tags"), F.col("p"), {"price": "price", "spec": "tech", "quality": "other"}, {"schedule": "spec"})
    rel = labels.relevance(F.col("tags"), F.lit("request"), F.lit("auto"), F.lit(False), {"price": "always", "spec": "spec_statement", "quality": "quality_request_or_customer"})
    got = [tuple(r) for r in df.select(facet, basis, rel).collect()]
    assert got == [("price", "rule_primary", "always:price"), ("tech", "rule_secondary", "quality_request_or_customer:quality"),
                   ("other", "rule_secondary", "quality_request_or_customer:quality"), (None, "unresolved", "never")]


def test_windows_skip_missing_months(spark):
    d = dt.date
    cut = spark.createDataFrame([("TV", d(2024, 1, 1), d(2024, 1, 20)), ("TV", d(2024, 2, 1), None), ("TV", d(2024, 3, 1), d(2024, 3, 22))],
                                "app string, month_start date, cutoff date")
    got = {r.month_start.month: (r.window_start, r.window_end, r.basis) for r in labels.period_windows(cut).collect()}
    assert got == {1: (d(2023, 12, 26), d(2024, 1, 20), "submitted_at"), 2: (d(2024, 1, 21), d(2024, 2, 25), "fixed_day"), 3: (d(2024, 1, 21), d(2024, 3, 22), "submitted_at")}


def test_pages_reach_the_extraction_in_small_batches(spark, monkeypatch):
    """3,000 pages of one partition are never one batch; all are read."""
    from fathomline import session

    session.configure(spark)
    seen = spark.sparkContext.accumulator(0)
    plain = pd.DataFrame

    def counted(rows, columns):
        seen.add(1)
        return plain(rows, columns=columns)

    monkeypatch.setattr(markup, "pd", type("P", (), {"DataFrame": staticmethod(counted)}))
    pages = spark.range(0, 3_000, 1, 1).select(F.col("id").alias("page_id"), F.lit("<p>some text</p>").alias("html"))
    assert markup.payloads(markup.element_rows(pages, "page_id", "html"), "page_id").count() == 3_000
    assert seen.value >= 3
