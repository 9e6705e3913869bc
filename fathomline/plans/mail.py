"""Mail jobs: clean rows, quarantine, participants, segments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions import dates as dt
from fathomline.functions import rules
from fathomline.functions import segments as sg
from fathomline.functions import text as tx
from fathomline.functions.binding import fenced, let
from fathomline.operators import joins as jn
from fathomline.operators.keyed import duplicate_of_first
from fathomline.plans import hints

BODY_FIELDS = ["mail_body_md", "mail_without_fw", "mail_body"]
HTML_FIELD = "mail_body_html"
SKIP_RULES = [("from_unparsed", "emp_id IS NULL")]
MODEL = rf"\b({sg.MODEL})"


def choose_body(df: DataFrame, fields: list[str], html: str | None = None) -> DataFrame:
    """First text field of 150 characters or more after cleaning, then the HTML form, else the longest, else none."""
    names = list(fields)
    cleaned = {f: tx.clean_display(F.coalesce(f, F.lit(""))) for f in fields}
    df = fenced(df, {f"_c_{f}": c for f, c in cleaned.items()})
    if html:
        # the HTML form is only read where no text field is long enough
        names.append(html)
        short = F.greatest(*[F.length(f"_c_{f}") for f in fields], F.lit(0)) < tx.MIN_BODY_CHARS
        df = fenced(df, {"_plain": tx.html_display(F.when(short, F.col(html)))})
        df = fenced(df, {f"_c_{html}": tx.clean_text(F.col("_plain"))})
    enough = rules.decide([(f, F.length(f"_c_{f}") >= tx.MIN_BODY_CHARS) for f in names], None)
    # the earlier field wins an equal length
    longest = F.array_max(F.array(*[
        F.struct(F.length(f"_c_{f}").alias("n"), F.lit(-i).alias("i"), F.lit(f).alias("f")) for i, f in enumerate(names)]))
    chosen = F.coalesce(enough, F.when(longest["n"] > 0, longest["f"]), F.lit("none"))
    df = df.withColumn("body_source_field", chosen)
    display, raw = F.lit(""), F.lit(None).cast("string")
    for f in names:
        display = F.when(F.col("body_source_field") == f, F.col(f"_c_{f}")).otherwise(display)
        raw = F.when(F.col("body_source_field") == f, F.col(f)).otherwise(raw)
    return df.withColumns({"body_display": display, "raw_len": F.length(F.coalesce(raw, F.lit("")))})


def body_conflict(df: DataFrame, fields: list[str], parties: dict[str, str]) -> Column:
    """Chosen body and another one differ (Jaccard under 0.3) and name disjoint, non-empty parties."""
    def facts(c):
        return F.struct(c.alias("text"), tx.tokens(c).alias("tokens"), tx.dictionary_hits(c, parties).alias("parties"))

    def clash(own):
        def against(f):
            return let(facts(F.col(f"_c_{f}")), lambda other: (
                (other["text"] != "") & (F.col("body_source_field") != f) & (F.size(other["parties"]) > 0)
                & ~F.arrays_overlap(own["parties"], other["parties"])
                & (tx.jaccard(own["tokens"], other["tokens"]) < 0.3)))

        hits = [F.coalesce(against(f), F.lit(False)) for f in fields]
        return (F.size(own["parties"]) > 0) & reduce(lambda a, b: a | b, hits)

    return let(facts(F.col("body_display")), clash)


def clean_rows(src: DataFrame, parties: dict[str, str] | None = None, version: str = "0.2") -> DataFrame:
    """Source mails → typed mail rows. The HTML body stands in where the text fields are too short; When and Where may stand anywhere."""
    df = choose_body(src, BODY_FIELDS, HTML_FIELD if HTML_FIELD in src.columns else None)
    conflict = body_conflict(df, BODY_FIELDS, parties) if parties else F.lit(False)
    df = fenced(df, {"_s": tx.parse_sender(F.col("mail_from")), "body_conflict": conflict})
    # not fenced: a job that reads none of the facts is spared their Python worker
    df = df.withColumn("_facts", sg.mail_facts(F.col("body_display")))
    display = F.col("body_display")
    return df.select(
        "pk_seq", "mail_date", "mail_from", "mail_to", F.col("mail_subject").alias("subject_raw"),
        tx.subject_clean(F.col("mail_subject")).alias("subject_clean"), F.col("_s.emp_id").alias("emp_id"),
        F.col("_s.name").alias("sender_name"), F.col("_s.account").alias("account"), F.col("_s.unit_code").alias("dept_code"),
        "body_source_field", "body_conflict", display.alias("body_display"), "raw_len", F.length(display).alias("display_len"),
        F.col("_facts.has_headers").alias("has_headers"), dt.mail_datetime(F.col("_facts.when")).alias("meeting_when"), F.col("_facts.where").alias("meeting_where"),
        (F.length(display) > tx.OVERSIZE_CHARS).alias("oversize"), tx.normal_hash(display).alias("body_hash"),
        F.lit(version).alias("cleaner_version"))


def split_quarantine(mails: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined); the detail shows the shape of the sender, never the name."""
    kept, skipped = rules.split_by_rules(mails, SKIP_RULES)
    detail = F.concat(F.lit("mail_from="), F.coalesce(tx.shape(F.col("sender_name")), F.lit("<null>")),
                      F.lit(" len="), F.coalesce(F.length("sender_name"), F.lit(0)).cast("string"))
    return kept, skipped.select("pk_seq", "mail_date", "skip_reason", detail.alias("skip_detail"), "cleaner_version")


def participants(mails: DataFrame) -> DataFrame:
    """Sender, top recipients and header recipients → rows with tokens shared by the same person."""
    staged = fenced(mails.select("pk_seq", "body_display", "sender_name", "emp_id", "account", "mail_to"), {"_blocks": sg.header_blocks(F.col("body_display"))})

    def listed(col, role, no):
        return F.transform(tx.split_recipients(F.coalesce(col, F.lit(""))), lambda r: F.struct(
            no.cast("int").alias("segment_no"), F.lit(role).alias("role"), r["display"].alias("display"), r["email"].alias("email")))

    own = F.when(F.col("sender_name").isNotNull(), F.array(F.struct(
        F.lit(0).alias("segment_no"), F.lit("forwarder").alias("role"), F.col("sender_name").alias("display"),
        F.lit(None).cast("string").alias("email")))).otherwise(
        F.array().cast("array<struct<segment_no:int,role:string,display:string,email:string>>"))
    in_blocks = F.flatten(F.transform(F.col("_blocks"), lambda b, i: F.concat(*[
        listed(b["fields"][key], key, i + 1) for key in ("from", "to", "cc", "bcc")])))
    entries = F.concat(own, listed(F.col("mail_to"), "to", F.lit(0)), in_blocks)
    staged = fenced(staged.select("pk_seq", "sender_name", "emp_id", "account", "mail_to", "_blocks"), {"_entries": entries})
    # employee number and account are known of the forwarder only
    own_id = lambda e, c: F.when(e["role"] == "forwarder", F.col(c))
    named = F.transform(F.col("_entries"), lambda e: F.struct(
        e["segment_no"].alias("segment_no"), e["role"].alias("role"), e["email"].alias("email"), e["display"].alias("display"),
        tx.parse_display_name(e["display"]).alias("n"), own_id(e, "emp_id").alias("emp_id"), own_id(e, "account").alias("account")))
    keyed = F.transform(F.col("e"), lambda e: F.struct(
        F.when(e["email"].isNotNull(), F.concat(F.lit("e:"), e["email"])).alias("key1"),
        F.when(e["n"]["name_zh"].isNotNull(), F.concat(F.lit("z:"), tx.loose_key(e["n"]["name_zh"]))).when(
            e["n"]["name_en"].isNotNull(), F.concat(F.lit("n:"), tx.loose_key(e["n"]["name_en"]))).alias("key2"),
        e["n"]["kind"].alias("kind")))
    rows = fenced(fenced(staged.select("pk_seq", "emp_id", "account", "_entries"), {"e": named}), {"k": keyed}).select(
        "pk_seq", "e", sg.assign_tokens(F.col("k")).alias("tokens"))
    flat = rows.select("pk_seq", F.posexplode(F.arrays_zip("e", "tokens")).alias("pos", "z")).select(
        "pk_seq", "pos", F.col("z.e.segment_no").alias("segment_no"), F.col("z.tokens").alias("token"), F.col("z.e.role").alias("role"),
        F.col("z.e.n.kind").alias("kind"), F.col("z.e.display").alias("display_name"), F.col("z.e.n.name_zh").alias("name_zh"),
        F.col("z.e.n.name_en").alias("name_en"), F.col("z.e.email").alias("email"), F.col("z.e.emp_id").alias("emp_id"), F.col("z.e.account").alias("account"),
        F.substring_index("z.e.email", "@", -1).alias("email_domain"))
    first = flat.groupBy("pk_seq", "segment_no", "token", "role").agg(F.min_by(F.struct(*flat.columns), "pos").alias("r"))
    return first.select("r.*")


def resolve_side(parts: DataFrame, aliases: DataFrame) -> DataFrame:
    """Domain suffix lookup → side and company; the forwarder is always internal.
    ``aliases`` has alias, company and side."""
    doms = parts.where(F.col("email_domain").isNotNull()).select("email_domain").distinct()
    found = jn.longest_suffix_match(doms, "email_domain", "email_domain", aliases, "alias").select("email_domain", "company", "side")
    joined = parts.join(found, "email_domain", "left")
    forwarder = F.col("role") == "forwarder"
    side = F.when(forwarder, F.lit("internal")).when(F.col("side").isin("internal", "customer", "third_party"), F.col("side")).otherwise(
        F.lit("unknown"))
    company = F.when(forwarder, F.lit("internal")).when(F.col("side") == "ignore", F.lit(None)).otherwise(F.col("company"))
    return joined.withColumns({"company": company, "side": side})


def segment_rows(mails: DataFrame) -> DataFrame:
    """Mail rows → segments in document order: by header blocks with the ruler above them, else by line-start model numbers.

    The date is the Sent of the block, or that of the last ITEM line above, else the mail's.
    """
    df = fenced(mails.select("pk_seq", "mail_date", "subject_clean", "body_display"), {"_segs": sg.mail_segments(F.col("body_display"), F.col("mail_date"))})
    seg = df.select("pk_seq", "mail_date", "subject_clean", F.size("_segs").alias("n_segments"), F.explode("_segs").alias("s"))
    seg = fenced(seg, {"_sent": dt.mail_datetime(F.col("s.fields.sent"))})
    told = F.coalesce(F.to_date("_sent"), F.col("s.item_date"))
    return seg.select(
        "pk_seq", F.col("s.segment_no").alias("segment_no"), "subject_clean", F.col("s.kind").alias("kind"), F.col("s.start").alias("display_start"),
        F.length("s.raw").alias("raw_len"), F.col("s.raw").alias("raw_text"), F.col("s.body").alias("body_text"), F.col("s.fields").alias("fields"),
        F.col("s.has_header").alias("has_header"), F.coalesce(told, F.col("mail_date")).alias("segment_date"), told.isNull().alias("date_inferred"),
        F.col("_sent").alias("sent_at"), "n_segments")


def name_book(parts: DataFrame) -> DataFrame:
    """Per mail: every form of its people's names with their tokens, first names, and the sender of each header.

    Forms are the name as shown, the parts in either script, 'last, first' and the address;
    of the forwarder also account and employee number (which is dropped, not replaced). A
    group gives its address only. The participants of a mail bound the arrays.
    """
    token = F.concat(F.lit("<"), "token", F.lit(">"))
    english = F.split(tx.squeeze(F.col("name_en")), " ")
    words = F.size(english)
    turned = F.when(words >= 2, F.concat(F.element_at(english, -1), F.lit(", "), F.array_join(F.slice(english, F.lit(1), F.greatest(words - 1, F.lit(0))), " ")))
    person = F.transform(F.array("display_name", "name_zh", "name_en", turned, "account", "email"), lambda n: F.struct(tx.squeeze(n).alias("name"), token.alias("token")))
    number = F.array(F.struct(F.coalesce("emp_id", F.lit("")).alias("name"), F.lit("").alias("token")))
    group = F.array(F.struct(F.coalesce("email", F.lit("")).alias("name"), token.alias("token")))
    forms = F.when(F.col("kind") == "group", group).otherwise(F.concat(person, number))
    first = F.regexp_replace(F.element_at(english, 1), "^,+|,+$", "")
    first_form = F.when((F.col("kind") != "group") & (F.length(first) >= 2) & first.rlike(r"^\p{ASCII}+$"), F.struct(first.alias("first"), token.alias("token")))
    return parts.groupBy("pk_seq").agg(
        F.array_sort(F.array_distinct(F.filter(F.flatten(F.collect_list(forms)), lambda e: e["name"] != ""))).alias("entries"),
        F.array_sort(F.collect_set(first_form)).alias("firsts"),
        F.collect_set(F.when(F.col("role") == "from", F.struct("segment_no", token.alias("token")))).alias("froms"),
        F.collect_set(F.when(F.col("email_domain").isNotNull(), F.struct("segment_no", F.lower("email_domain").alias("domain")))).alias("domains"))


def clean_segments(segs: DataFrame, parts: DataFrame, attachments: Column | None = None, customers: list[str] | None = None,
                   defaults: Column | None = None) -> DataFrame:
    """Header rewrite, masking by the mail's own participants, layout clean, kind, parties, hints and hash.

    ``n_masked`` counts addresses that no participant has, ``names_left`` names still found
    after masking; the latter is a hard gate and must be 0. ``customers`` are the names that
    a hint may give, ``defaults`` the product lines of a mail's customer.
    """
    df = segs.join(name_book(parts), "pk_seq", "left")
    no_names, no_firsts = F.array().cast("array<struct<name:string,token:string>>"), F.array().cast("array<struct<first:string,token:string>>")
    here = F.when(F.col("has_header"), F.col("segment_no")).otherwise(F.lit(0))
    df = fenced(df, {
        "entries": F.coalesce("entries", no_names), "firsts": F.coalesce("firsts", no_firsts),
        "from_token": F.array_min(F.transform(F.filter("froms", lambda f: f["segment_no"] == F.col("segment_no")), lambda f: f["token"])),
        "_domains": F.transform(F.filter("domains", lambda d: d["segment_no"] == here), lambda d: d["domain"])})
    df = df.withColumns({"_body": sg.mask_dictionary(F.col("body_text"), F.col("entries")),
                         "_subject": sg.mask_dictionary(F.col("fields.subject"), F.col("entries")), "_from": sg.mask_dictionary(F.col("fields.from"), F.col("entries"))})
    who = F.coalesce("from_token", F.nullif("_from", F.lit("")), F.lit("<unknown>"))
    head = F.concat_ws("\n", F.concat(who, F.lit(":")), F.concat(F.lit("Sent: "), F.date_format("sent_at", "yyyy-MM-dd HH:mm")),
                       F.concat(F.lit("Subject: "), F.nullif("_subject", F.lit(""))))
    whole = F.when(F.col("has_header"), F.concat(head, F.lit("\n\n"), F.col("_body"))).otherwise(F.col("_body"))
    df = fenced(df, {"_whole": whole})
    safe = sg.fold_first_names(tx.mask_email(F.col("_whole")), F.col("firsts"))
    df = fenced(df, {"clean_text": tx.flatten_short_lines(tx.drop_junk_rows(tx.mask_urls(safe)))})
    out = fenced(df, {"n_masked": tx.count_emails(F.col("_whole")), "names_left": sg.names_left(F.col("clean_text"), F.col("entries"))})
    attached = attachments if attachments is not None else F.lit(0)
    models = F.size(F.array_distinct(F.regexp_extract_all("clean_text", F.lit(MODEL), F.lit(1))))
    kind = sg.content_kind(F.col("clean_text"), F.col("has_header"), F.col("fields.when").isNotNull(), attached,
                           models, F.col("clean_text").rlike(rf"(?m)^[ \t]*{sg.ITEM}[ \t]*$"))
    anonymous = F.regexp_replace("clean_text", r"<([PG])\d{2,}>", "<$1>")
    found = F.transform(F.regexp_extract_all("raw_text", F.lit(tx.EMAIL_DOMAIN), F.lit(1)), F.lower)
    parties = F.array_sort(F.array_distinct(F.concat(F.coalesce("_domains", F.array().cast("array<string>")), found)))
    customer = hints.weighted_hint(F.col("clean_text"), F.coalesce("subject_clean", F.lit("")), customers) if customers else F.lit(None).cast("string")
    line = hints.app_hint(F.col("clean_text"), F.coalesce("subject_clean", F.lit("")), defaults if defaults is not None else F.array().cast("array<string>"))
    # a short note above the first boundary is not kept
    kept = out.where((F.col("n_segments") == 1) | (F.col("segment_no") > 0) | (F.length("clean_text") >= tx.MIN_BODY_CHARS))
    return kept.select(
        "pk_seq", "segment_no", "subject_clean", "segment_date", "date_inferred", "raw_len", F.length("clean_text").alias("clean_len"),
        "clean_text", kind.alias("content_type"), parties.alias("parties"), customer.alias("customer_hint"), line.alias("app_hint"), "n_masked", "names_left",
        F.when(F.length("clean_text") >= tx.MIN_BODY_CHARS, F.sha1(tx.loose_key(tx.nfkc(anonymous)))).alias("content_hash"))


def with_duplicates(segs: DataFrame, pool: DataFrame | None = None) -> DataFrame:
    """First arrival of a content hash is the primary of all later segments."""
    return duplicate_of_first(segs, "content_hash", ["pk_seq", "segment_no"], ["pk_seq", "segment_no"], pool=pool)
