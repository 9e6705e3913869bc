"""Composite jobs: ingest, weekly report, mails, labels, ledgers, sales, filings, news."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from fathomline.catalog.c01_sources import events_raw
from fathomline.catalog.c04_joins import CUSTOMER_QUARTERS_SQL, customer_quarters
from fathomline.catalog.derive import mails
from fathomline.catalog.registry import query
from fathomline.functions import dates as dt
from fathomline.functions import rules
from fathomline.functions import text as tx
from fathomline.functions.numbers import count_where, money_sum, pct_change
from fathomline.operators import aggregates as ag
from fathomline.operators import incremental as inc
from fathomline.operators import joins as jn
from fathomline.operators import keyed
from fathomline.operators import windows as wn
from fathomline.plans import filings, labels, ledgers, mail, reports, sales
from fathomline.session import written
from fathomline.sources import records


def msum(c):
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


@query("""
WITH e AS (SELECT event_type, user_id, event_id, CAST(props->>'$.k' AS INT) AS k FROM events),
l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id DESC) = 1),
f AS (SELECT user_id, event_id, unnest(['annual', 'quarterly']) AS kind, k FROM e WHERE event_type = 'purchase'),
fl AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY user_id, kind ORDER BY event_id DESC) = 1)
SELECT event_type AS layer, CAST(user_id AS VARCHAR) AS entity_key, event_id AS seq, k FROM l WHERE event_type <> 'purchase'
UNION ALL SELECT 'purchase', user_id || ':' || kind, event_id, k FROM fl
""")
def layered_ingest(t):
    """Typed transforms of one raw layer, each with its own key; the newest sequence wins."""
    raw = events_raw(t)
    parts = []
    for kind in ("signup", "click", "view", "error"):
        p = records.typed(raw, kind, "k INT").select(F.lit(kind).alias("layer"), F.col("record_key").cast("string").alias("entity_key"), "seq", F.col("p.k").alias("k"))
        parts.append(keyed.latest_per_key(p, ["layer", "entity_key"], "seq"))
    fin = records.typed(raw, "purchase", "k INT").select("record_key", "seq", F.col("p.k").alias("k"), F.explode(F.array(F.lit("annual"), F.lit("quarterly"))).alias("kind"))
    fin = fin.select(F.lit("purchase").alias("layer"), F.concat_ws(":", "record_key", "kind").alias("entity_key"), "seq", "k")
    parts.append(keyed.latest_per_key(fin, ["layer", "entity_key"], "seq"))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("""
WITH w AS (SELECT CAST(unnest(range(DATE '2023-12-25', DATE '2024-02-12', INTERVAL 7 DAY)) AS DATE) AS week_start),
s AS (SELECT DISTINCT event_type FROM events),
c AS (SELECT event_type, CAST(date_trunc('week', ts) AS DATE) AS week_start, COUNT(*) AS n_rows, COUNT(DISTINCT user_id) AS n_senders FROM events GROUP BY 1, 2),
f AS (SELECT event_type, user_id, MIN(CAST(date_trunc('week', ts) AS DATE)) AS week_start FROM events GROUP BY 1, 2),
g AS (SELECT event_type, week_start, COUNT(*) AS new_senders FROM f GROUP BY 1, 2)
SELECT event_type, week_start, COALESCE(n_rows, 0) AS n_rows, COALESCE(n_senders, 0) AS n_senders, COALESCE(new_senders, 0) AS new_senders
FROM s CROSS JOIN w LEFT JOIN c USING (event_type, week_start) LEFT JOIN g USING (event_type, week_start)
""")
def weekly_report(t):
    return reports.weekly_report(t.events, "event_type", "ts", "user_id", "2023-12-25", "2024-02-05")


@query("""
WITH h AS (SELECT *, COUNT(*) OVER (PARTITION BY sha1(text)) AS copies FROM documents)
SELECT lang, COUNT(*) AS n_docs, quantile_disc(length(text), 0.5) AS len_p50, MAX(length(text)) AS len_max, COUNT(*) FILTER (length(text) < 150) AS n_short,
  COUNT(*) FILTER (text LIKE '%@%') AS n_mail, COUNT(*) FILTER (regexp_matches(text, '(?i)licen[sc]e')) AS n_license, COUNT(*) FILTER (copies > 1) AS n_in_copies,
  COUNT(DISTINCT source) AS n_sources, round(AVG(CAST(copies > 1 AS INT)), 3) AS copy_rate FROM h GROUP BY 1
""")
def text_profile(t):
    """Feature columns once, then one grouping; copies are counted per hash first, the middle length from counts per length."""
    d = t.documents.select("doc_id", "lang", "source", F.length("text").alias("n"), F.sha1("text").alias("h"), F.col("text").contains("@").alias("m"),
                           F.col("text").rlike("(?i)licen[sc]e").alias("lic"))
    fine = d.groupBy("h", "lang", "source").agg(F.count(F.lit(1)).alias("k"), F.any_value("n").alias("n"), F.any_value("m").alias("m"), F.any_value("lic").alias("lic"))
    # a hash has one row per language and source
    sized = fine.withColumn("copies", F.sum("k").over(Window.partitionBy("h"))).groupBy("lang", "source", "n").agg(
        F.sum("k").alias("k"), F.sum(F.when(F.col("m"), F.col("k")).otherwise(0)).alias("mails"), F.sum(F.when(F.col("lic"), F.col("k")).otherwise(0)).alias("licenses"),
        F.sum(F.when(F.col("copies") > 1, F.col("k")).otherwise(0)).alias("in_copies"))
    of_lang = Window.partitionBy("lang")
    upto, total = F.sum("k").over(of_lang.orderBy("n").rangeBetween(Window.unboundedPreceding, 0)), F.sum("k").over(of_lang)
    f = sized.withColumn("middle", F.when(upto >= F.ceil(total / 2), F.col("n")))
    return f.groupBy("lang").agg(
        F.sum("k").alias("n_docs"), F.max("n").cast("long").alias("len_max"), F.sum(F.when(F.col("n") < 150, F.col("k")).otherwise(0)).alias("n_short"),
        F.sum("mails").alias("n_mail"), F.sum("licenses").alias("n_license"), F.sum("in_copies").alias("n_in_copies"), F.countDistinct("source").alias("n_sources"),
        F.min("middle").cast("long").alias("len_p50"),
    ).withColumn("copy_rate", F.round(F.col("n_in_copies") / F.col("n_docs"), 3))


MAIL_ALIASES = [("mail.example.com", "mailco", "customer"), ("example.com", "exco", "third_party"), ("example.org", "ours", "ignore")]


@query()
def mail_chain(t):
    """Clean mails, quarantine, duplicates, sender unit, participants with side."""
    clean = written(mail.clean_rows(mails(t)), "mails")
    kept, skipped = mail.split_quarantine(clean)
    dim = t.spark.createDataFrame([("ML0A", "pm"), ("ML1A", "sales"), ("ML2A", "sales")], "prefix string, unit string")
    unit = jn.prefix_lookup(kept.select("pk_seq", "dept_code", "body_hash", "body_source_field"), "dept_code", dim, "prefix", "unit")
    dup = keyed.duplicate_of_first(unit, "body_hash", ["pk_seq"], ["pk_seq"])
    aliases = t.spark.createDataFrame(MAIL_ALIASES, "alias string, company string, side string")
    sides = mail.resolve_side(mail.participants(kept), aliases).groupBy("pk_seq").agg(
        F.count(F.lit(1)).alias("n_people"), count_where(F.col("side") == "customer").alias("n_customer"))
    good = dup.join(sides, "pk_seq", "left").select("pk_seq", F.lit("kept").alias("state"), "body_source_field", F.coalesce("unit", F.lit("unknown")).alias("unit"), "basis",
                                                    F.col("dup_of.pk_seq").alias("dup_of_pk"), "n_people", "n_customer")
    return good.unionByName(skipped.select("pk_seq", F.col("skip_reason").alias("state"), F.col("skip_detail").alias("basis")), allowMissingColumns=True)


@query()
def segment_chain(t):
    """Segments with masked text, kind, hash and the first arrival of each copy."""
    kept, _ = mail.split_quarantine(written(mail.clean_rows(mails(t)), "mails"))
    parts = written(mail.participants(kept), "participants")
    segs = written(mail.clean_segments(mail.segment_rows(kept), parts), "segments")
    out = mail.with_duplicates(segs)
    return out.select("pk_seq", "segment_no", "content_type", "clean_len", "segment_date", "date_inferred",
                      F.col("dup_of.pk_seq").alias("dup_pk"), F.col("dup_of.segment_no").alias("dup_segment"))


@query("""
WITH i AS (SELECT conv_id, turn, role, sha1(conv_id || '|' || lower(text[1:1])) AS item_key FROM conversations),
o AS (SELECT conv_id, item_key, MIN(turn) AS old_turn FROM i WHERE role = 'user' GROUP BY 1, 2)
SELECT i.conv_id, i.turn, o.old_turn AS supersedes_turn FROM i LEFT JOIN o USING (conv_id, item_key) WHERE role <> 'user'
""")
def supersedes(t):
    """A new item (conversation, turn) points at the smallest old turn with the same stable key in its conversation."""
    i = t.conversations.select("conv_id", "role", "turn", F.sha1(F.concat(F.col("conv_id").cast("string"), F.lit("|"), F.lower(F.substring("text", 1, 1)))).alias("item_key"))
    old = i.where("role = 'user'").groupBy("conv_id", "item_key").agg(F.min("turn").alias("supersedes_turn"))
    return i.where("role <> 'user'").join(old, ["conv_id", "item_key"], "left").select("conv_id", "turn", "supersedes_turn")


@query("""
WITH i AS (SELECT l_orderkey AS mail, l_linenumber AS seg, l_partkey AS item, CASE WHEN l_quantity > 25 AND l_returnflag <> 'R' THEN l_suppkey END AS party, MAX(CASE WHEN l_tax > 0.04 THEN l_suppkey END) OVER (PARTITION BY l_orderkey, l_linenumber) AS hint FROM lineitem),
s AS (SELECT DISTINCT mail, party FROM i WHERE party IS NOT NULL),
a AS (SELECT i.*, s.party IS NOT NULL AS supported FROM i LEFT JOIN s ON s.mail = i.mail AND s.party = i.hint),
b AS (SELECT *, COALESCE(party, CASE WHEN supported THEN hint END) AS p2 FROM a),
u AS (SELECT mail, MIN(p2) AS only_one FROM b WHERE p2 IS NOT NULL GROUP BY 1 HAVING COUNT(DISTINCT p2) = 1),
c AS (SELECT CASE WHEN party IS NOT NULL THEN 'own' WHEN p2 IS NOT NULL THEN 'segment_hint' WHEN only_one IS NOT NULL THEN 'mail_party' END AS basis, COALESCE(p2, only_one) AS final FROM b LEFT JOIN u USING (mail))
SELECT basis, COUNT(*) AS n, COUNT(DISTINCT final) AS n_parties, CAST(SUM(final) AS BIGINT) AS checksum FROM c GROUP BY 1
""")
def party_fill(t):
    """Unsupported fills reverted; then the segment hint if the mail names that party, then the only party of the mail."""
    i = t.lineitem.select(F.col("l_orderkey").alias("mail"), F.col("l_linenumber").alias("seg"), "l_suppkey", "l_tax",
                          F.when((F.col("l_quantity") > 25) & (F.col("l_returnflag") != "R"), F.col("l_suppkey")).alias("party"))
    # the lines of one mail bound the windows, so one read and one shuffle serve all steps
    of_mail, of_segment = Window.partitionBy("mail"), Window.partitionBy("mail", "seg")
    hinted = i.withColumns({"hint": F.max(F.when(F.col("l_tax") > 0.04, F.col("l_suppkey"))).over(of_segment), "named": F.collect_set("party").over(of_mail)})
    b = hinted.withColumn("p2", F.coalesce("party", F.when(F.array_contains("named", F.col("hint")), F.col("hint"))))
    lowest, highest = F.min("p2").over(of_mail), F.max("p2").over(of_mail)
    c = b.withColumn("only_one", F.when(lowest == highest, lowest)).select(
        rules.decide([("own", F.col("party").isNotNull()), ("segment_hint", F.col("p2").isNotNull()), ("mail_party", F.col("only_one").isNotNull())], None).alias("basis"),
        F.coalesce("p2", "only_one").alias("final"))
    counts = c.groupBy("basis", "final").agg(F.count(F.lit(1)).alias("k"))
    return counts.groupBy("basis").agg(F.sum("k").alias("n"), F.count("final").alias("n_parties"), F.sum(F.col("final") * F.col("k")).alias("checksum"))


APPS = ["TV", "NB", "MNT"]
FACET_OF = {"price": "price", "demand": "market_outlook", "spec": "product_tech", "quality": "other"}
FOLLOW_OF = {"schedule": "spec"}
RULE_OF = {"price": "always", "spec": "spec_statement", "capacity": "capacity_timeref", "quality": "quality_request_or_customer"}


def label_items(t, start, end):
    """Order lines as extracted items of their order's customer, of the orders of a range of days."""
    day = F.to_date("o_orderdate")
    o = t.orders.where(day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus", "o_orderpriority", day.alias("event_date"))
    kept = t.lineitem.join(o.select("l_orderkey"), "l_orderkey", "left_semi")
    l = kept.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("flag"), F.max("l_linestatus").alias("line"), F.max("l_quantity").alias("qty"))
    tag1 = rules.map_value(F.col("flag"), {"A": "price", "N": "schedule", "R": "admin"})
    tag2 = rules.map_value(F.col("line"), {"O": "spec", "F": "quality"})
    return l.join(o, "l_orderkey").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("item_id"), F.concat_ws("-", "l_orderkey", "line").alias("item_key"),
        F.lit("pm").alias("unit"), F.when(F.col("qty") > 5, F.col("o_custkey")).alias("customer"),
        rules.map_value(F.col("o_orderstatus"), {"F": "TV", "O": "ALL"}).alias("app"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("plan")).when(F.col("o_orderpriority") == "2-HIGH", F.lit("request")).otherwise(F.lit("fact")).alias("statement_type"),
        tag1.alias("topic_tag_primary"), F.array(tag1, tag2).alias("topic_tags"), F.lit("customer").alias("speaker_side"), "event_date",
        F.lit("[]").alias("time_refs"), F.lit("ok").alias("extract_status"), F.lit(False).alias("superseded"))


_LABEL_SQL = """
l AS (SELECT l_orderkey, l_linenumber, MAX(l_returnflag) AS flag, MAX(l_linestatus) AS line, MAX(l_quantity) AS qty FROM lineitem GROUP BY 1, 2),
i AS (SELECT l_orderkey || '-' || l_linenumber AS item_id, l_orderkey || '-' || line AS item_key, CASE WHEN qty > 5 THEN o_custkey END AS customer,
  CASE o_orderstatus WHEN 'F' THEN 'TV' WHEN 'O' THEN 'ALL' END AS app, o_orderpriority AS prio, flag, line, CAST(o_orderdate AS DATE) AS event_date
  FROM l JOIN orders ON o_orderkey = l_orderkey WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-04-30'),
v AS (SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY item_key ORDER BY item_id) = 1),
x AS (SELECT v.*, CASE WHEN app = 'TV' THEN 'neutral' WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'customer_default' ELSE 'unresolved' END AS app_basis,
  unnest(CASE WHEN app = 'TV' THEN ['TV'] WHEN c_mktsegment = 'BUILDING' THEN ['NB', 'MNT'] WHEN c_mktsegment = 'MACHINERY' THEN ['NB'] ELSE ['app_unresolved'] END) AS app_name
  FROM v LEFT JOIN customer ON c_custkey = customer)
"""


@query("WITH " + _LABEL_SQL + """,
w AS (SELECT * FROM (VALUES ('TV', DATE '1997-03-05', DATE '1997-04-03'), ('NB', DATE '1997-03-10', DATE '1997-04-20'), ('MNT', DATE '1997-03-01', DATE '1997-03-31'), ('app_unresolved', DATE '1997-03-01', DATE '1997-04-20')) w(app_name, ws, we)),
y AS (SELECT x.*, CASE WHEN customer IS NULL THEN NULL WHEN c_nationkey < 20 THEN 'brand' || c_nationkey ELSE CAST(customer AS VARCHAR) END AS brand,
  CASE WHEN customer IS NULL THEN 'none' WHEN c_nationkey < 20 THEN 'sb_brand' ELSE 'customer_fallback' END AS brand_basis FROM x JOIN w USING (app_name) LEFT JOIN customer ON c_custkey = customer WHERE event_date BETWEEN ws AND we)
SELECT item_id, app_name, app_basis, brand, brand_basis, COALESCE(brand IN ('brand1', 'brand2', 'brand3') AND app_name = 'TV', false) AS brand_in_sb,
  CASE WHEN flag = 'A' THEN 'price' WHEN line = 'O' THEN 'product_tech' ELSE 'other' END AS facet, CASE WHEN flag = 'A' THEN 'rule_primary' ELSE 'rule_secondary' END AS facet_basis,
  CASE WHEN flag = 'A' THEN 'always:price' WHEN line = 'O' AND prio = '1-URGENT' THEN 'spec_statement:spec' WHEN line = 'F' THEN 'quality_request_or_customer:quality' ELSE 'no_rule' END AS relevance_basis,
  (flag = 'A' OR (line = 'O' AND prio = '1-URGENT') OR line = 'F') AND app_name <> 'app_unresolved' AS sb_relevant FROM y
""")
def label_chain(t):
    ents = t.customer.select(F.col("c_custkey").alias("entity_id"), F.when(F.col("c_mktsegment") == "BUILDING", F.array(F.lit("NB"), F.lit("MNT"))).when(
        F.col("c_mktsegment") == "MACHINERY", F.array(F.lit("NB"))).otherwise(labels.empty_strings()).alias("app_default"), F.lit(True).alias("is_active"))
    aliases = t.customer.where("c_nationkey < 20").select(F.col("c_custkey").alias("entity_id"), F.concat(F.lit("brand"), "c_nationkey").alias("alias"), F.lit(True).alias("is_active"))
    brands = t.nation.where("n_nationkey BETWEEN 1 AND 3").select(F.lit("TV").alias("app_name"), F.concat(F.lit("brand"), "n_nationkey").alias("brand"))
    windows = t.spark.sql("SELECT app_name, CAST(ws AS DATE) AS window_start, CAST(we AS DATE) AS window_end FROM VALUES ('TV', '1997-03-05', '1997-04-03'), ('NB', '1997-03-10', '1997-04-20'), "
                          "('MNT', '1997-03-01', '1997-03-31'), ('app_unresolved', '1997-03-01', '1997-04-20') AS w(app_name, ws, we)")
    out = labels.label_chain(label_items(t, "1997-03-01", "1997-04-30"), ents, aliases, brands, windows, FACET_OF, FOLLOW_OF, RULE_OF, unit="pm", apps=APPS, start="1997-03-01", end="1997-04-30", version="0.2")
    return out.select("item_id", "app_name", "app_basis", F.col("brand").cast("string").alias("brand"), "brand_basis", "brand_in_sb", "facet", "facet_basis", "relevance_basis", "sb_relevant")


@query("""
SELECT o_orderkey, unnest(CASE WHEN o_orderstatus = 'F' THEN ['TV'] WHEN c_mktsegment = 'BUILDING' THEN ['NB', 'MNT'] ELSE ['app_unresolved'] END) AS app_name,
  CASE WHEN o_orderstatus = 'F' THEN 'neutral' WHEN c_mktsegment = 'BUILDING' THEN 'customer_default' ELSE 'unresolved' END AS app_basis FROM orders JOIN customer ON c_custkey = o_custkey
""")
def expand_default(t):
    ents = t.customer.select(F.col("c_custkey").alias("entity_id"), F.when(F.col("c_mktsegment") == "BUILDING", F.array(F.lit("NB"), F.lit("MNT"))).alias("app_default"), F.lit(True).alias("is_active"))
    items = t.orders.select("o_orderkey", F.col("o_custkey").alias("customer"), rules.map_value(F.col("o_orderstatus"), {"F": "TV", "O": "ALL"}).alias("app"))
    return labels.expand_app(items, ents, APPS).select("o_orderkey", "app_name", "app_basis")


@query("""
WITH c AS (SELECT o_orderpriority AS app, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, CAST(MAX(o_orderdate) FILTER (o_totalprice > 480000) AS DATE) AS cutoff FROM orders GROUP BY 1, 2),
p AS (SELECT *, last_value(cutoff IGNORE NULLS) OVER (PARTITION BY app ORDER BY month_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM c),
w AS (SELECT app, month_start, COALESCE(CAST(prev + INTERVAL 1 DAY AS DATE), CAST(month_start - INTERVAL 1 MONTH + INTERVAL 25 DAY AS DATE)) AS window_start, COALESCE(cutoff, CAST(month_start + INTERVAL 24 DAY AS DATE)) AS window_end,
  CASE WHEN cutoff IS NULL THEN 'fixed_day' ELSE 'submitted_at' END AS basis FROM p)
SELECT * FROM w UNION ALL SELECT 'app_unresolved', month_start, MIN(window_start), MAX(window_end), 'unresolved_span' FROM w GROUP BY month_start
""")
def period_windows(t):
    cut = t.orders.groupBy(F.col("o_orderpriority").alias("app"), F.to_date(F.trunc("o_orderdate", "month")).alias("month_start")).agg(
        F.to_date(F.max(F.when(F.col("o_totalprice") > 480000, F.col("o_orderdate")))).alias("cutoff"))
    return labels.with_unresolved_span(labels.period_windows(cut))


def doc_tags(t):
    """Topic tags of a document by its language and by words in its text."""
    primary = rules.map_value(F.col("lang"), {"en": "schedule", "de": "price", "fr": "admin", "es": "demand"})
    tags = F.filter(F.array(primary, F.when(F.col("text").rlike("(?i)licen[sc]e"), F.lit("spec")), F.when(F.col("text").contains("@"), F.lit("quality"))), lambda x: x.isNotNull())
    return t.documents.select("doc_id", "n_chars", primary.alias("topic_tag_primary"), tags.alias("tags"))


_TAGS_SQL = "d AS (SELECT doc_id, lang, n_chars, regexp_matches(text, '(?i)licen[sc]e') AS lic, contains(text, '@') AS mail FROM documents)"


@query("WITH " + _TAGS_SQL + """
SELECT doc_id, CASE WHEN lang = 'de' THEN 'price' WHEN lang = 'es' THEN 'market_outlook' WHEN lic THEN 'product_tech' WHEN mail THEN 'other' END AS facet,
  CASE WHEN lang IN ('de', 'es') THEN 'rule_primary' WHEN lic OR mail THEN 'rule_secondary' ELSE 'unresolved' END AS basis FROM d
""")
def facet_map(t):
    facet, basis = labels.assign_facet(F.col("tags"), F.col("topic_tag_primary"), FACET_OF, FOLLOW_OF)
    return doc_tags(t).select("doc_id", facet.alias("facet"), basis.alias("basis"))


@query("WITH " + _TAGS_SQL + """
SELECT doc_id, CASE WHEN lang = 'de' THEN 'always:price' WHEN lic AND n_chars > 2000 THEN 'spec_statement:spec' WHEN mail AND n_chars < 1000 THEN 'quality_request_or_customer:quality'
  WHEN lic OR mail THEN 'no_rule' ELSE 'never' END AS relevance FROM d
""")
def relevance_rules(t):
    statement = F.when(F.col("n_chars") > 2000, F.lit("plan")).otherwise(F.lit("fact"))
    side = F.when(F.col("n_chars") < 1000, F.lit("customer")).otherwise(F.lit("unknown"))
    return doc_tags(t).select("doc_id", labels.relevance(F.col("tags"), statement, side, F.lit(False), RULE_OF).alias("relevance"))


def meeting_cells(t):
    """Cells of the item side: brand × month × priority, with counts and the top level."""
    return t.orders.groupBy(F.col("o_custkey").alias("brand"), dt.month_key(F.col("o_orderdate")).alias("month")).agg(
        F.count(F.lit(1)).alias("n_items"), F.min("o_orderpriority").alias("top_level"))


def filed_cells(t):
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("brand"))
    per = t.lineitem.where("l_returnflag = 'R'").groupBy("l_orderkey", dt.month_key(F.col("l_shipdate")).alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return per.join(o, "l_orderkey").groupBy("brand", "month").agg(F.sum("n").alias("n_filed"))


_GRID_SQL = """
m AS (SELECT o_custkey AS brand, strftime(o_orderdate, '%Y-%m') AS month, COUNT(*) AS n_items, MIN(o_orderpriority) AS top_level FROM orders GROUP BY 1, 2),
f AS (SELECT o_custkey AS brand, strftime(l_shipdate, '%Y-%m') AS month, COUNT(*) AS n_filed FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' GROUP BY 1, 2),
g AS (SELECT brand, month, n_items, top_level, n_filed, CASE WHEN n_filed IS NULL THEN 'meeting_only' WHEN n_items IS NULL THEN 'sb_only' END AS relation FROM m FULL OUTER JOIN f USING (brand, month))
"""


@query("WITH " + _GRID_SQL + " SELECT brand, month, COALESCE(n_items, 0) AS n_items, top_level, COALESCE(n_filed, 0) AS n_filed, relation FROM g")
def reconcile_grid(t):
    return jn.full_grid(meeting_cells(t), filed_cells(t), ["brand", "month"], "meeting_only", "sb_only").fillna(0, ["n_items", "n_filed"])


@query("WITH " + _GRID_SQL + """, s AS (SELECT month, COUNT(*) AS cells, COUNT(*) FILTER (relation = 'sb_only') AS sb_only, COUNT(*) FILTER (relation IS NULL) AS open_cells FROM g GROUP BY 1)
SELECT *, cells > 0 AS hard_ok, open_cells / cells <= 0.2 AS soft_ok, CASE WHEN cells = 0 THEN 'stop' WHEN open_cells / cells > 0.2 THEN 'warn' ELSE 'ok' END AS verdict FROM s
""")
def cell_gates(t):
    g = jn.full_grid(meeting_cells(t), filed_cells(t), ["brand", "month"], "meeting_only", "sb_only")
    s = g.groupBy("month").agg(F.count(F.lit(1)).alias("cells"), count_where(F.col("relation") == "sb_only").alias("sb_only"),
                               F.count_if(F.col("relation").isNull()).alias("open_cells"))
    share = F.try_divide("open_cells", "cells")
    return s.withColumns({"hard_ok": F.col("cells") > 0, "soft_ok": share <= 0.2,
                          "verdict": rules.decide([("stop", F.col("cells") == 0), ("warn", share > 0.2)], "ok")})


@query("WITH " + _GRID_SQL + " SELECT brand, month, relation, CASE WHEN relation IS NOT NULL THEN 'rule' END AS relation_basis, CAST(NULL AS VARCHAR) AS rationale FROM g")
def rule_cells(t):
    j = meeting_cells(t).withColumn("_m", F.lit(True)).join(filed_cells(t).withColumn("_f", F.lit(True)), ["brand", "month"], "full_outer")
    rel = labels.rule_relation(F.col("_m").isNotNull(), F.col("_f").isNotNull())
    return j.select("brand", "month", rel.alias("relation"), F.when(rel.isNotNull(), F.lit("rule")).alias("relation_basis"), F.lit(None).cast("string").alias("rationale"))


def ledger_items(t):
    """Reviewed documents as items: copies name their primary by the stable key."""
    d = t.documents.select("doc_id", F.sha1("text").alias("h"), "n_chars", "lang")
    dup = keyed.duplicate_of_first(d, "h", ["doc_id"], ["doc_id"]).join(t.labels, "doc_id", "left")
    return dup.select(F.col("doc_id").alias("item_key"), F.when((F.col("lang") == "de"), F.lit("SEM-000001")).when(F.col("lang") == "fr", F.lit("SEM-000099")).alias("dup_of"),
                      F.when(F.col("n_chars") > 9000, F.lit("SEM-000002")).alias("primary_id"), F.col("dup_of.doc_id").alias("dup_key"),
                      F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 28).cast("int")).alias("date"), (F.coalesce("quality", F.lit(0)) == 1).alias("verified"), "lang", "n_chars")


_LEDGER_SQL = """
i AS (SELECT d.doc_id AS item_key, lang, n_chars, CASE WHEN lang = 'de' THEN 'SEM-000001' WHEN n_chars > 9000 THEN 'SEM-000002' END AS given,
  NULLIF(MIN(d.doc_id) OVER (PARTITION BY sha1(text)), d.doc_id) AS dup_key, COALESCE(quality, 0) = 1 AS verified, DATE '2024-01-01' + CAST(d.doc_id % 28 AS INTEGER) AS date FROM documents d LEFT JOIN labels USING (doc_id)),
n AS (SELECT item_key, 'SEM-' || format('{:06d}', 2 + row_number() OVER (ORDER BY item_key)) AS new_id FROM i WHERE given IS NULL AND dup_key IS NULL),
p AS (SELECT i.*, COALESCE(given, new_id) AS t0, new_id FROM i LEFT JOIN n USING (item_key)),
r AS (SELECT p.item_key, COALESCE(p.given, p.new_id, q.t0) AS target, p.new_id, p.verified, p.date FROM p LEFT JOIN p q ON q.item_key = p.dup_key)
"""


def _records(t):
    rec = t.spark.createDataFrame([("SEM-000001", 3, "unreviewed"), ("SEM-000002", 1, "retired")], "record_id string, n_evidence long, status string")
    return rec.withColumn("last_date", F.lit("2024-01-05").cast("date"))


@query("WITH " + _LEDGER_SQL + """
SELECT item_key, target, CASE WHEN new_id IS NOT NULL THEN 'new' WHEN target = 'SEM-000001' AND item_key IN (SELECT doc_id FROM documents WHERE lang = 'de' AND n_chars < 600) THEN 'evidence_exists' ELSE 'add_evidence' END AS action FROM r
""")
def ledger_merge(t):
    """Targets of all reviewed items against a ledger of two records and its evidence."""
    items = ledger_items(t)
    evidence = t.documents.where("lang = 'de' AND n_chars < 600").select(F.lit("SEM-000001").alias("record_id"), F.col("doc_id").alias("item_key"))
    targets, _ = ledgers.topic_plan(items, _records(t), evidence, "SEM-", [F.col("item_key")])
    return targets.select("item_key", "target", "action")


@query("WITH " + _LEDGER_SQL + r""",
d AS (SELECT i.item_key, i.lang AS app, lower(regexp_replace(string_split(text, ' ')[1], '[\p{P}\p{Z}\p{C}]', '', 'g')) AS term_norm, date, i.dup_key, verified FROM i JOIN documents ON doc_id = item_key)
SELECT app, term_norm, MIN(item_key) AS first_item, arg_max(item_key, CAST(strftime(date, '%Y%m%d') AS BIGINT) * 1000000000 + item_key) AS shown_item, COUNT(*) FILTER (dup_key IS NULL) AS n_updates, MAX(date) AS last_date,
  CASE WHEN bool_or(verified) THEN 'active' ELSE 'unreviewed' END AS status FROM d GROUP BY 1, 2
""")
def intel_merge(t):
    words = t.documents.select(F.col("doc_id").alias("item_key"), F.substring_index(F.substring_index("text", " ", 1), "\n", -1).alias("_w"), F.substring_index("text", " ", 1).alias("term"))
    items = ledger_items(t).withColumnRenamed("lang", "app").join(words, "item_key")
    return ledgers.intel_plan(items, F.col("term"), ["item_key"])


@query("""
SELECT d.doc_id, array_to_string(list_filter([CASE WHEN lang IN ('en', 'de') THEN 'category:' || CASE lang WHEN 'en' THEN 'semantic' ELSE 'intel' END END,
  CASE WHEN quality = 0 THEN 'differs_from_prior' END, CASE WHEN n_chars / 5000 < 0.6 THEN 'low_confidence' END], lambda x: x IS NOT NULL), ';') AS reasons
FROM documents d JOIN labels USING (doc_id) WHERE lang IN ('en', 'de') OR quality = 0 OR n_chars / 5000 < 0.6
""")
def review_list(t):
    cat = rules.map_value(F.col("lang"), {"en": "semantic", "de": "intel"}, F.lit("event"))
    j = t.labels.join(t.documents.select("doc_id", "lang", "n_chars"), "doc_id")
    r = j.select("doc_id", ledgers.review_reasons(cat, F.col("quality") == 0, F.col("n_chars") / 5000).alias("reasons"))
    return r.where("reasons <> ''")


@query("""
SELECT o_custkey, year(MAX(o_orderdate)) || '-Q' || quarter(MAX(o_orderdate)) AS as_of, 2001 * 4 + 2 - (year(MAX(o_orderdate)) * 4 + quarter(MAX(o_orderdate)) - 1) AS age
FROM orders GROUP BY 1 HAVING 2001 * 4 + 2 - (year(MAX(o_orderdate)) * 4 + quarter(MAX(o_orderdate)) - 1) > 2
""")
def retire_candidates(t):
    last = t.orders.groupBy("o_custkey").agg(dt.quarter_key(F.max("o_orderdate")).alias("as_of"))
    aged = last.withColumn("age", (F.lit(2001 * 4 + 2) - dt.quarter_index_of_text(F.col("as_of"))).cast("long"))
    return aged.where("age > 2")


@query("""
WITH u AS (SELECT DISTINCT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS app, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT month, app, COUNT(*) AS items, COUNT(DISTINCT o_custkey) AS customers, MIN(d) AS first_day, MAX(d) AS last_day FROM u GROUP BY 1, 2
""")
def month_pack(t):
    """Items per month with duplicates removed, counts per app and customer."""
    u = t.orders.groupBy("o_custkey", dt.month_key(F.col("o_orderdate")).alias("month"), F.col("o_orderpriority").alias("app"), F.to_date("o_orderdate").alias("d")).agg(F.lit(1).alias("one"))
    c = u.groupBy("month", "app", "o_custkey").agg(F.count("one").alias("n"), F.min("d").alias("d1"), F.max("d").alias("d2"))
    return c.groupBy("month", "app").agg(F.sum("n").alias("items"), F.count(F.lit(1)).alias("customers"), F.min("d1").alias("first_day"), F.max("d2").alias("last_day"))


@query("""
WITH d AS (SELECT doc_id, n_chars, lang, doc_id > MIN(doc_id) OVER (PARTITION BY sha1(text)) AS dup FROM documents)
SELECT 'documents' AS stage, COUNT(*) AS n FROM d UNION ALL SELECT 'long enough', COUNT(*) FROM d WHERE n_chars >= 150 UNION ALL SELECT 'not a copy', COUNT(*) FROM d WHERE n_chars >= 150 AND NOT dup
UNION ALL SELECT 'reviewed', COUNT(*) FROM d JOIN labels USING (doc_id) WHERE n_chars >= 150 AND NOT dup UNION ALL SELECT 'listed', COUNT(*) FROM d JOIN labels USING (doc_id) WHERE n_chars >= 150 AND NOT dup AND quality = 1
""")
def digest_funnel(t):
    """Stage counts from raw to listed, from one pass over the flags."""
    d = t.documents.select("doc_id", "n_chars", F.sha1("text").alias("h"))
    f = keyed.duplicate_of_first(d, "h", ["doc_id"], ["doc_id"]).join(t.labels, "doc_id", "left")
    long, first = F.col("n_chars") >= 150, F.col("dup_of").isNull()
    stages = {"documents": F.lit(True), "long enough": long, "not a copy": long & first, "reviewed": long & first & F.col("quality").isNotNull(),
              "listed": long & first & (F.col("quality") == 1)}
    row = f.agg(*[count_where(c).alias(s) for s, c in stages.items()])
    return row.unpivot([], list(stages), "stage", "n")


def customer_months(t):
    """Newest filing per customer and month (yyyymm)."""
    o = t.orders.select("o_custkey", dt.period_int(F.col("o_orderdate")).alias("period"), F.col("o_totalprice").alias("value"), "o_orderdate", "o_orderkey")
    return sales.newest_values(o, ["o_custkey", "period"], "o_orderdate", "o_orderkey").select("o_custkey", "period", "value")


_MONTHS_SQL = """cm AS (SELECT o_custkey, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS period, o_totalprice AS value FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, strftime(o_orderdate, '%Y%m') ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""


def _yearly_sql(floor):
    return "WITH " + _MONTHS_SQL + f""", b AS (SELECT *, lag(value) OVER (PARTITION BY o_custkey ORDER BY period) AS before FROM cm),
c AS (SELECT o_custkey, MAX(period) AS as_of, arg_max(value, period) AS current, arg_max(COALESCE(before, -1), period) AS previous FROM b WHERE period BETWEEN {floor} AND 200006 GROUP BY 1),
y AS (SELECT o_custkey, arg_max(value, period) FILTER (period // 100 = 1999) AS year_end_1, arg_max(value, period) FILTER (period // 100 = 1998) AS year_end_2,
  CAST(SUM(CASE WHEN period // 100 = 2000 AND period <= 200006 THEN CAST(value AS DECIMAL(28,2)) END) AS DOUBLE) AS ytd FROM cm GROUP BY 1)
SELECT o_custkey, as_of, current, NULLIF(previous, -1) AS previous, year_end_1, year_end_2, ytd, ytd / year_end_1 AS hit, as_of < 200006 AS carried FROM c JOIN y USING (o_custkey)"""


@query(_yearly_sql(199912))
def yearly_table(t):
    return sales.yearly_table(customer_months(t), "o_custkey", "period", "value", 200006)


@query(_yearly_sql(200006))
def sales_v1(t):
    """First version: a member that has not filed this month disappears."""
    return sales.yearly_table(customer_months(t), "o_custkey", "period", "value", 200006, lookback=None)


def nation_months(t):
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    per = t.orders.groupBy("o_custkey", dt.month_serial(F.col("o_orderdate")).alias("mon")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v"))
    return per.join(c, "o_custkey").groupBy("c_nationkey", "mon").agg(F.sum("v").cast("double").alias("value"))


_NATION_MONTHS = """nm AS (SELECT c_nationkey, CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INTEGER) AS mon, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)"""


@query("WITH " + _NATION_MONTHS + """, q AS (SELECT c_nationkey, CAST(mon // 3 AS INTEGER) AS q, COUNT(*) AS months_present, CASE WHEN COUNT(*) = 3 THEN CAST(SUM(CAST(value AS DECIMAL(28,2))) AS DOUBLE) END AS quarter_total FROM nm GROUP BY 1, 2),
a AS (SELECT * FROM q UNION ALL SELECT -1, q, MIN(months_present), CAST(SUM(CAST(quarter_total AS DECIMAL(28,2))) AS DOUBLE) FROM q GROUP BY 2)
SELECT a.c_nationkey, a.q, a.months_present, a.quarter_total, (a.quarter_total - b.quarter_total) / NULLIF(abs(b.quarter_total), 0) AS qoq FROM a LEFT JOIN a b ON a.c_nationkey = b.c_nationkey AND b.q = a.q - 1
""")
def quarter_table(t):
    m = nation_months(t).withColumn("q", F.floor(F.col("mon") / 3).cast("int"))
    return sales.quarter_table(m, "c_nationkey", "q", "mon", "value")


@query("WITH " + _MONTHS_SQL + """, s AS (SELECT o_custkey, (period // 100) * 12 + period % 100 - 1 AS mon, value FROM cm), k AS (SELECT DISTINCT o_custkey FROM s), a AS (SELECT unnest(range(2000 * 12 - 12, 2000 * 12 + 6)) AS mon)
SELECT o_custkey, CAST(mon AS INTEGER) AS mon, value, mon >= 2000 * 12 + 3 AS forecast FROM k CROSS JOIN a LEFT JOIN s USING (o_custkey, mon)
""")
def aligned_series(t):
    """Eighteen months per member on one axis with gaps kept, forecast from the current month on."""
    m = customer_months(t).select("o_custkey", (F.floor(F.col("period") / 100) * 12 + F.col("period") % 100 - 1).cast("int").alias("mon"), "value")
    return sales.aligned_series(m, "o_custkey", "mon", "value", 2000 * 12 + 5, 18).withColumn("forecast", F.col("mon") >= 2000 * 12 + 3)


@query("""
WITH f AS (SELECT o_custkey, MAX(CAST(strftime(o_orderdate, '%Y%m') AS INTEGER)) AS last_period FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-01' GROUP BY 1)
SELECT c_custkey, last_period FROM customer LEFT JOIN f ON o_custkey = c_custkey WHERE last_period IS NULL OR last_period < 200106
""")
def stale_members(t):
    last = t.orders.where("o_orderdate < TIMESTAMP_NTZ'2001-07-01'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(dt.period_int(F.col("o_orderdate"))).alias("last_period"))
    return sales.stale_members(t.customer.select("c_custkey"), last, "c_custkey", 200106)


@query("""
WITH p AS (SELECT o_custkey, year(o_orderdate) AS yr, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS plan FROM orders GROUP BY 1, 2),
l AS (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM lineitem GROUP BY 1),
a AS (SELECT o_custkey, year(o_orderdate) AS yr, CAST(SUM(v) AS DOUBLE) AS actual FROM l JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2)
SELECT o_custkey, yr, plan, actual, abs((actual - plan) / plan) > 0.05 AS off FROM p LEFT JOIN a USING (o_custkey, yr)
""")
def tolerance_check(t):
    o = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").cast("long").alias("yr"), "o_totalprice")
    plan = o.groupBy("o_custkey", "yr").agg(money_sum("o_totalprice").alias("plan"))
    l = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("v"))
    actual = l.join(o, "o_orderkey").groupBy("o_custkey", "yr").agg(F.sum("v").cast("double").alias("actual"))
    return plan.join(actual, ["o_custkey", "yr"], "left").withColumn("off", sales.tolerance(F.col("actual"), F.col("plan")))


@query("WITH " + CUSTOMER_QUARTERS_SQL + """, asked AS (SELECT DISTINCT o_custkey FROM cq), b AS (SELECT o_custkey, MAX(q) AS q FROM cq WHERE q <= 1999 * 4 + 3 GROUP BY 1)
SELECT b.o_custkey, b.q, b.q < 1999 * 4 + 3 AS fallback, n.revenue, p.revenue AS year_ago, (n.revenue - p.revenue) / abs(p.revenue) AS delta, n.n_orders - p.n_orders AS points
FROM b JOIN cq n ON n.o_custkey = b.o_custkey AND n.q = b.q LEFT JOIN cq p ON p.o_custkey = b.o_custkey AND p.q = b.q - 4
""")
def actuals_vs_prior(t):
    """Base quarter (or the last one before), same quarter a year earlier, change of money and of points."""
    cq = customer_quarters(t)
    base = wn.last_n(cq, "o_custkey", "q", 1, until=1999 * 4 + 3)
    y = wn.year_over_year(base.select("o_custkey", "q", "revenue", "n_orders").withColumn("k", F.lit(1)).drop("k"), "o_custkey", "q", "revenue", 4).drop("year_ago", "yoy")
    prior = cq.select("o_custkey", (F.col("q") + 4).alias("q"), F.col("revenue").alias("year_ago"), F.col("n_orders").alias("_p"))
    j = y.join(prior, ["o_custkey", "q"], "left")
    return j.select("o_custkey", "q", (F.col("q") < 1999 * 4 + 3).alias("fallback"), "revenue", "year_ago", pct_change(F.col("revenue"), F.col("year_ago")).alias("delta"),
                    (F.col("n_orders") - F.col("_p")).alias("points"))


def supplier_financials(t):
    """Statement lines per supplier and quarter, from its order lines."""
    def part(cond, value="l_extendedprice"):
        return F.sum(F.when(cond, F.col(value).cast("decimal(18,2)"))).cast("double")
    true = F.lit(True)
    return t.lineitem.groupBy("l_suppkey", dt.quarter_index(F.col("l_shipdate")).alias("q")).agg(
        part(true).alias("revenue"), part(F.col("l_returnflag") == "A").alias("cogs"), part(F.col("l_linestatus") == "O").alias("inventory"),
        part(F.col("l_returnflag") == "N").alias("ocf"), part(F.col("l_discount") > 0.08).alias("capex"))


_FIN_SQL = """
fin AS (SELECT l_suppkey, CAST(year(l_shipdate) * 4 + quarter(l_shipdate) - 1 AS INTEGER) AS q, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
  CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_returnflag = 'A') AS DOUBLE) AS cogs, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_linestatus = 'O') AS DOUBLE) AS inventory,
  CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_returnflag = 'N') AS DOUBLE) AS ocf, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_discount > 0.08) AS DOUBLE) AS capex FROM lineitem GROUP BY 1, 2),
m AS (SELECT a.*, (a.revenue / b.revenue - 1) * 100 AS revenue_yoy, (a.revenue - a.cogs) / a.revenue * 100 AS gross_margin, a.inventory / a.cogs * 91.25 AS inventory_days, abs(a.capex) / a.revenue * 100 AS capex_to_revenue,
  a.ocf / a.revenue * 100 AS ocf_to_revenue, a.ocf / abs(a.capex) AS ocf_to_capex, a.ocf - abs(a.capex) AS fcf FROM fin a LEFT JOIN fin b ON a.l_suppkey = b.l_suppkey AND b.q = a.q - 4)
"""
_RATIOS = "revenue_yoy, gross_margin, inventory_days, capex_to_revenue, ocf_to_revenue, ocf_to_capex, fcf"


@query("WITH " + _FIN_SQL + f" SELECT l_suppkey, q, {_RATIOS} FROM m")
def ratio_metrics(t):
    return filings.ratio_metrics(supplier_financials(t), "l_suppkey", "q").select("l_suppkey", "q", *_RATIOS.split(", "))


@query("WITH " + _FIN_SQL + """, x AS (SELECT * FROM m WHERE q = 1999 * 4 + 1), g AS (SELECT s_nationkey, median(revenue_yoy) AS med_yoy, median(inventory_days) AS med_days FROM x JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1)
SELECT l_suppkey, revenue_yoy, med_yoy, revenue_yoy - med_yoy AS gap, CASE WHEN abs(revenue_yoy - med_yoy) <= 1.0 THEN '接近' WHEN revenue_yoy > med_yoy THEN '優' WHEN revenue_yoy < med_yoy THEN '劣' END AS pos_yoy,
  CASE WHEN abs(inventory_days - med_days) <= 5.0 THEN '接近' WHEN inventory_days < med_days THEN '優' WHEN inventory_days > med_days THEN '劣' END AS pos_days FROM x JOIN supplier ON s_suppkey = l_suppkey JOIN g USING (s_nationkey)
""")
def peer_scorecard(t):
    """Every supplier against the median of its nation in one quarter."""
    nat = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    x = filings.ratio_metrics(supplier_financials(t), "l_suppkey", "q").where(F.col("q") == 1999 * 4 + 1).join(nat, "l_suppkey")
    yoy = ag.grouped_median(x, ["s_nationkey"], "revenue_yoy", "med_yoy")
    days = ag.grouped_median(x, ["s_nationkey"], "inventory_days", "med_days")
    j = jn.left_enrich(x, (yoy, "s_nationkey"), (days, "s_nationkey"))
    up, down = filings.PEER_METRICS["revenue_yoy"], filings.PEER_METRICS["inventory_days"]
    return j.select("l_suppkey", "revenue_yoy", "med_yoy", (F.col("revenue_yoy") - F.col("med_yoy")).alias("gap"),
                    filings.position(F.col("revenue_yoy"), F.col("med_yoy"), *up).alias("pos_yoy"), filings.position(F.col("inventory_days"), F.col("med_days"), *down).alias("pos_days"))


@query("WITH " + _FIN_SQL + """
SELECT l_suppkey, q, CASE WHEN capex_to_revenue > 20 OR capex_to_revenue < 5 THEN 'w' WHEN capex_to_revenue IS NOT NULL THEN 'g' END AS capex_grade, CASE WHEN ocf_to_capex >= 1 THEN 'g' WHEN ocf_to_capex >= 0.7 THEN 'w' WHEN ocf_to_capex IS NOT NULL THEN 'b' END AS cover_grade,
  CASE WHEN fcf > 0 THEN 'g' WHEN fcf IS NOT NULL THEN 'b' END AS fcf_grade, CASE WHEN gross_margin < 15 THEN 'b' WHEN gross_margin IS NOT NULL THEN 'g' END AS margin_grade, CASE WHEN inventory_days > 120 THEN 'w' WHEN inventory_days IS NOT NULL THEN 'g' END AS days_grade FROM m
""")
def durability_grades(t):
    m = filings.ratio_metrics(supplier_financials(t), "l_suppkey", "q")
    cols = {"capex_grade": "capex_to_revenue", "cover_grade": "ocf_to_capex", "fcf_grade": "fcf", "margin_grade": "gross_margin", "days_grade": "inventory_days"}
    return m.select("l_suppkey", "q", *[filings.grade(c, F.col(c)).alias(a) for a, c in cols.items()])


@query("""
WITH b AS (SELECT p_partkey, CASE WHEN p_name LIKE '%ring%' THEN 'IT' WHEN p_name LIKE '%bolt%' THEN 'TV' ELSE '其他' END AS bucket FROM part),
r AS (SELECT bucket, COUNT(*) AS n_lines FROM lineitem JOIN b ON p_partkey = l_partkey WHERE l_returnflag = 'R' GROUP BY 1),
o AS (SELECT bucket, COUNT(*) AS n_own FROM b WHERE bucket <> 'TV' GROUP BY 1)
SELECT r.bucket, n_lines, n_own, CASE r.bucket WHEN 'IT' THEN '高' WHEN 'TV' THEN '中' ELSE '低' END AS overlap FROM r LEFT JOIN o USING (bucket)
""")
def segment_overlap(t):
    name = F.col("p_name")
    b = t.part.select(F.col("p_partkey").alias("l_partkey"), rules.decide([("IT", name.contains("ring")), ("TV", name.contains("bolt"))], "其他").alias("bucket"))
    per = t.lineitem.where("l_returnflag = 'R'").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    rival = per.join(b, "l_partkey").groupBy("bucket").agg(F.sum("n").alias("n_lines"))
    own = b.where("bucket <> 'TV'").groupBy("bucket").agg(F.count(F.lit(1)).alias("n_own"))
    return rival.join(own, "bucket", "left").withColumn("overlap", rules.map_value(F.col("bucket"), filings.OVERLAP))


@query("WITH " + _FIN_SQL + " SELECT l_suppkey, bool_or(capex IS NOT NULL) AS has_capex, bool_or(revenue_yoy IS NOT NULL) AS has_yoy, bool_or(inventory_days > 1000) AS has_slow FROM m GROUP BY 1")
def availability(t):
    m = filings.ratio_metrics(supplier_financials(t), "l_suppkey", "q")
    return m.groupBy("l_suppkey").agg(F.max(F.col("capex").isNotNull()).alias("has_capex"), F.max(F.col("revenue_yoy").isNotNull()).alias("has_yoy"),
                                      F.max(F.col("inventory_days") > 1000).alias("has_slow"))


@query("WITH " + CUSTOMER_QUARTERS_SQL + """
SELECT a.o_custkey, a.q, a.revenue, (a.revenue - b.revenue) / abs(b.revenue) AS growth, CASE WHEN b.revenue IS NULL THEN 'none' WHEN a.revenue > b.revenue THEN 'good' WHEN a.revenue < b.revenue THEN 'bad' ELSE 'flat' END AS tone
FROM cq a LEFT JOIN cq b ON b.o_custkey = a.o_custkey AND b.q = a.q - 4
""")
def kpi_cells(t):
    y = wn.year_over_year(customer_quarters(t), "o_custkey", "q", "revenue", 4)
    growth, tone = filings.kpi_cells(F.col("revenue"), F.col("year_ago"))
    return y.select("o_custkey", "q", "revenue", growth.alias("growth"), tone.alias("tone"))


@query("""
WITH p AS (SELECT o_custkey, year(MAX(o_orderdate)) || '-Q' || quarter(MAX(o_orderdate)) AS period, COUNT(*) AS n FROM orders GROUP BY 1),
v AS (SELECT c_custkey AS o_custkey, unnest(CASE WHEN c_mktsegment = 'BUILDING' THEN ['supplier', 'peer'] ELSE ['supplier'] END) AS view_name FROM customer)
SELECT o_custkey, period, view_name FROM p JOIN v USING (o_custkey) JOIN customer ON c_custkey = o_custkey WHERE NOT (view_name = 'supplier' AND c_acctbal >= 0)
""")
def report_worklist(t):
    """Newest own period × views; reports with an equal digest are done already."""
    last = t.orders.groupBy("o_custkey").agg(dt.quarter_key(F.max("o_orderdate")).alias("period"))
    dig = inc.group_digest(t.orders.select("o_custkey", F.concat_ws(":", "o_orderkey", "o_orderstatus").alias("h")), ["o_custkey"], F.col("h"))
    own = last.join(dig.select("o_custkey", "digest"), "o_custkey")
    views = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.explode(F.when(F.col("c_mktsegment") == "BUILDING", F.array(F.lit("supplier"), F.lit("peer"))).otherwise(
        F.array(F.lit("supplier")))).alias("view_name"))
    paid = t.customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("o_custkey"))
    done = own.join(paid, "o_custkey", "left_semi").withColumn("view_name", F.lit("supplier"))
    return filings.work_plan(own, views, done, "o_custkey").select("o_custkey", "period", "view_name")


@query(r"""
WITH h AS (SELECT doc_id, sha256(lower(regexp_replace(string_split(text, chr(10))[1], '\s+', '', 'g')) || '|') AS news_hash, lang FROM documents)
SELECT news_hash, MIN(doc_id) AS doc_id FROM h WHERE doc_id > (SELECT MAX(doc_id) FROM h WHERE lang = 'de' AND doc_id < 500) AND news_hash NOT IN (SELECT news_hash FROM h WHERE lang = 'de' AND doc_id < 500) GROUP BY 1
""")
def news_staging(t):
    """Increment after the stored articles, keys, hash, one row per hash, unseen hashes only."""
    h = F.sha2(F.concat(tx.title_key(F.substring_index("text", "\n", 1)), F.lit("|")), 256)
    stored = t.documents.where("lang = 'de' AND doc_id < 500").select("doc_id", h.alias("news_hash"))
    return reports.stage_news(t.documents.select("doc_id", "text"), stored, "doc_id", "doc_id", h)


@query("""
SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-26' AND DATE '2024-01-28' AND event_type = 'purchase'
""")
def recent_days(t):
    today = F.lit("2024-01-29").cast("date")
    day = F.to_date("ts")
    return t.events.where((F.col("event_type") == "purchase") & day.between(F.date_sub(today, 3), F.date_sub(today, 1))).select("event_id", day.alias("day"))


@query("""
WITH s AS (SELECT year(l_shipdate) AS yr, l_returnflag || l_linestatus AS section, MAX(l_quantity) AS top, COUNT(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT yr, section, n, row_number() OVER (PARTITION BY yr ORDER BY top DESC, n DESC, section) AS pos FROM s
""")
def section_order(t):
    """Sections by their most important row, then by size."""
    s = t.lineitem.groupBy(F.year("l_shipdate").cast("long").alias("yr"), F.concat("l_returnflag", "l_linestatus").alias("section")).agg(F.max("l_quantity").alias("top"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("yr").orderBy(F.desc("top"), F.desc("n"), F.asc("section"))
    return s.select("yr", "section", "n", F.row_number().over(w).cast("long").alias("pos"))


@query("WITH " + _FIN_SQL + """,
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY q DESC) AS rn FROM m)
SELECT l_suppkey, MAX(q) FILTER (rn = 1) AS q, MAX(revenue) FILTER (rn = 1) AS revenue, MAX(revenue_yoy) FILTER (rn = 1) AS revenue_yoy, MAX(inventory_days) FILTER (rn = 1) AS inventory_days,
  bool_or(capex IS NOT NULL) AS capex, bool_or(ocf IS NOT NULL) AS ocf, CAST(COUNT(*) FILTER (rn <= 5) AS INTEGER) AS n_series, MIN(q) FILTER (rn <= 5) AS series_from,
  string_agg(q || ':' || CAST(CAST(revenue AS DECIMAL(18,2)) AS VARCHAR), ' ' ORDER BY q) FILTER (rn <= 5) AS series FROM r GROUP BY 1
""")
def fact_set(t):
    """Series, actuals, KPI and availability of one entity in one struct, at the newest quarter."""
    m = filings.ratio_metrics(supplier_financials(t), "l_suppkey", "q")
    series = wn.last_n(m, "l_suppkey", "q", 5).groupBy("l_suppkey").agg(F.array_sort(F.collect_list(F.struct("q", "revenue", "gross_margin"))).alias("series"))
    base = wn.last_n(m, "l_suppkey", "q", 1).select("l_suppkey", F.struct("q", "revenue", "revenue_yoy", "inventory_days").alias("actuals"))
    avail = m.groupBy("l_suppkey").agg(F.struct(F.max(F.col("capex").isNotNull()).alias("capex"), F.max(F.col("ocf").isNotNull()).alias("ocf")).alias("indicators"))
    j = jn.left_enrich(base, (series, "l_suppkey"), (avail, "l_suppkey"))
    facts = j.select("l_suppkey", F.struct("actuals", "series", "indicators").alias("facts"))
    shown = F.transform("facts.series", lambda s: F.concat(s["q"].cast("string"), F.lit(":"), s["revenue"].cast("decimal(18,2)").cast("string")))
    return facts.select("l_suppkey", "facts.actuals.*", "facts.indicators.*", F.size("facts.series").alias("n_series"), F.col("facts.series")[0]["q"].alias("series_from"),
                        F.array_join(shown, " ").alias("series"))
