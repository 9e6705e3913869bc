"""Projections, filters and rule lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from fathomline.catalog.registry import query
from fathomline.functions import dates as dt
from fathomline.functions import rules
from fathomline.functions import text as tx
from fathomline.operators.upsert import null_key


@query("SELECT p_partkey, p_name, p_type FROM part WHERE lower(p_name) LIKE '%ring%' AND lower(p_type) LIKE '%econ%'")
def keyword_filter(t):
    return rules.contains_all(t.part, {"p_name": "Ring", "p_type": "ECON", "p_brand": ""}).select(
        "p_partkey", "p_name", "p_type")


@query("""
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-05-01' AND o_orderdate < TIMESTAMP '1996-06-01'
""")
def date_range(t):
    return rules.half_open_days(t.orders, "o_orderdate", "1996-05-01", "1996-05-31").select("o_orderkey", "o_orderdate")


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-05-01' AND DATE '1996-05-31'
""")
def date_between(t):
    return t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day")).where(
        F.col("day").between("1996-05-01", "1996-05-31"))


@query("""
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_returnflag = 'N' AND l_linestatus <> 'F' AND l_shipdate IS NOT NULL
  AND CAST(l_shipdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-06-30'
""")
def valid_items(t):
    """Status fine, not superseded, dated, inside the span."""
    return t.lineitem.where(
        (F.col("l_returnflag") == "N") & (F.col("l_linestatus") != "F") & F.col("l_shipdate").isNotNull()
        & F.to_date("l_shipdate").between("1997-01-01", "1997-06-30")
    ).select("l_orderkey", "l_linenumber", "l_shipdate")


@query("""
SELECT p_partkey, p_brand, p_type FROM part
WHERE NOT regexp_matches(p_brand, '^Brand#[0-9]$') OR p_type NOT IN ('ECONOMY', 'SMALL', 'LARGE')
""")
def format_filter(t):
    """Badly formed codes, and types outside the allowed list; NULL counts as bad."""
    return t.part.where(
        rules.bad_format("p_brand", "^Brand#[0-9]$") | rules.not_allowed("p_type", ["ECONOMY", "SMALL", "LARGE"])
    ).select("p_partkey", "p_brand", "p_type")


@query("""
SELECT o_orderkey, COALESCE(NULLIF(o_orderpriority, '4-NOT SPECIFIED'), 'unknown') AS unit FROM orders
WHERE NOT COALESCE(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'F' END, false)
""")
def null_default_filter(t):
    is_test = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F")
    unit = F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED"))
    return t.orders.where(~F.coalesce(is_test, F.lit(False))).select(
        "o_orderkey", F.coalesce(unit, F.lit("unknown")).alias("unit"))


QUARANTINE_RULES = [
    ("no_text", "n_chars < 20"),
    ("unknown_source", "source IN ('src1', 'src2')"),
    ("oversize", "n_chars > 12000"),
]


@query("""
SELECT doc_id, CASE WHEN n_chars < 20 THEN 'no_text' WHEN source IN ('src1', 'src2') THEN 'unknown_source'
                    WHEN n_chars > 12000 THEN 'oversize' END AS skip_reason, n_chars
FROM documents WHERE n_chars < 20 OR source IN ('src1', 'src2') OR n_chars > 12000
""")
def quarantine_split(t):
    kept, skipped = rules.split_by_rules(t.documents, QUARANTINE_RULES)
    return skipped.select("doc_id", "skip_reason", "n_chars")


@query("""
WITH h AS (SELECT doc_id, lang, doc_id > MIN(doc_id) OVER (PARTITION BY sha1(text)) AS is_dup FROM documents)
SELECT CASE WHEN is_dup THEN 'duplicate' WHEN lang = 'en' THEN 'rule' ELSE 'model' END AS route, COUNT(*) AS n
FROM h GROUP BY 1
""")
def route_split(t):
    """Duplicates first, then rules, the rest to the model."""
    from fathomline.operators.keyed import duplicate_of_first

    docs = t.documents.select("doc_id", "lang", F.sha1("text").alias("h"))
    tagged = duplicate_of_first(docs, "h", ["doc_id"], ["doc_id"])
    routes = rules.split_routes(tagged, {"duplicate": F.col("dup_of").isNotNull(), "rule": F.col("lang") == "en"},
                                "model")
    parts = [df.agg(F.count(F.lit(1)).alias("n")).withColumn("route", F.lit(r)) for r, df in routes.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("""
SELECT doc_id, CASE WHEN n_chars < 150 THEN 'noise'
  WHEN n_chars < 300 AND text LIKE '%License%' THEN 'attachment_only'
  WHEN regexp_matches(text, '(^|\\n)Copyright') OR len(regexp_extract_all(text, '[0-9]{3}')) >= 3 THEN 'inline_minutes'
  WHEN len(string_split(text, chr(10))) >= 10 AND n_chars >= 300 THEN 'thread_reply' ELSE 'unclassified' END AS content_type
FROM documents
""")
def content_type(t):
    text = F.col("text")
    return t.documents.select("doc_id", rules.decide([
        ("noise", F.length(text) < tx.MIN_BODY_CHARS),
        ("attachment_only", (F.length(text) < tx.SHORT_TEXT_CHARS) & text.contains("License")),
        ("inline_minutes", text.rlike(r"(?m)^Copyright") | (tx.count_matches(text, r"[0-9]{3}") >= 3)),
        ("thread_reply", (F.size(F.split(text, "\n")) >= 10) & (F.length(text) >= tx.SHORT_TEXT_CHARS)),
    ], "unclassified").alias("content_type"))


@query("""
SELECT doc_id, CASE lang WHEN 'en' THEN 'knowledge' WHEN 'de' THEN 'intel' ELSE 'event' END AS category FROM documents
""")
def rule_category(t):
    return t.documents.select("doc_id", rules.map_value(
        F.col("lang"), {"en": "knowledge", "de": "intel"}, F.lit("event")).alias("category"))


@query(r"""
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 OR text LIKE '%@%' THEN text ELSE '  ' END AS sender FROM documents)
SELECT doc_id, CASE WHEN trim(sender) = '' THEN '(blank)'
  WHEN regexp_matches(sender, '[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+')
  THEN lower(regexp_extract(sender, '[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+'))
  ELSE sha1(trim(sender)) END AS sender_key FROM d
""")
def sender_key(t):
    """Blank to a placeholder, else the first address, else the whole text (shown hashed here)."""
    sender = F.when((F.col("doc_id") % 2 == 0) | F.col("text").contains("@"), F.col("text")).otherwise(F.lit("  "))
    key = tx.sender_key(F.col("sender"))
    return t.documents.withColumn("sender", sender).select(
        "doc_id", F.when(key == F.trim("sender"), F.sha1(key)).otherwise(key).alias("sender_key"))


@query("""
SELECT o_orderkey, year(o_orderdate) * 100 + month(o_orderdate) AS period,
       CAST(strftime(o_orderdate - INTERVAL 5 MONTH, '%Y%m') AS BIGINT) AS period_minus_5 FROM orders
""")
def period_int(t):
    p = dt.period_int(F.col("o_orderdate"))
    return t.orders.select("o_orderkey", p.cast("long").alias("period"),
                           dt.period_minus(p, 5).cast("long").alias("period_minus_5"))


@query("SELECT c_custkey FROM customer WHERE NULLIF(c_nationkey, 3) IS NULL OR NULLIF(c_mktsegment, 'BUILDING') IS NULL")
def null_keys(t):
    c = t.customer.withColumns({"c_nationkey": F.nullif("c_nationkey", F.lit(3)),
                                "c_mktsegment": F.nullif("c_mktsegment", F.lit("BUILDING"))})
    return c.where(null_key(["c_nationkey", "c_mktsegment"])).select("c_custkey")


@query("""
SELECT doc_id, CASE WHEN source = 'src1' THEN '{"engine":"native"}'
   WHEN lang = 'en' THEN '{"mode":"table","version":"2"}' ELSE '{"mode":"text","version":"2"}' END AS option_key
FROM documents
""")
def parse_option_key(t):
    """File ending first, then the document kind; the key is JSON with sorted names."""
    name = F.concat("doc_id", F.when(F.col("source") == "src1", F.lit(".HTM")).otherwise(F.lit(".pdf")))
    return t.documents.select("doc_id", rules.parse_options(
        name, F.col("lang"), {"en": {"version": "2", "mode": "table"}}, {"version": "2", "mode": "text"}
    ).alias("option_key"))


@query("""
WITH v AS (SELECT c_custkey, unnest(CASE WHEN c_nationkey = 7 THEN ['own'] WHEN c_mktsegment = 'BUILDING' THEN ['customer', 'peer']
   WHEN c_mktsegment = 'MACHINERY' THEN ['supplier', 'peer'] ELSE ['customer'] END) AS view_name FROM customer)
SELECT * FROM v WHERE view_name IN ('peer', 'own', 'customer')
""")
def view_routing(t):
    """Views by category, replaced by a per-entity override, cut to the requested ones."""
    views = rules.routed_views(
        F.col("c_mktsegment"), {"BUILDING": ["customer", "peer"], "MACHINERY": ["supplier", "peer"]}, ["customer"],
        F.when(F.col("c_nationkey") == 7, F.array(F.lit("own"))), ["peer", "own", "customer"])
    return t.customer.select("c_custkey", F.explode(views).alias("view_name"))
