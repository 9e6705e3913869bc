"""Window functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fathomline.catalog.c01_sources import events_raw
from fathomline.catalog.c04_joins import CUSTOMER_QUARTERS_SQL, customer_quarters
from fathomline.catalog.registry import query
from fathomline.functions import dates as dt
from fathomline.functions import text as tx
from fathomline.functions.numbers import money_sum
from fathomline.operators import aggregates as ag
from fathomline.operators import joins as jn
from fathomline.operators import keyed, numbering
from fathomline.operators import windows as wn


@query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def latest_per_key(t):
    o = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return keyed.latest_per_key(o, ["o_custkey"], "o_orderdate", "o_orderkey").drop("o_orderdate")


@query("""
SELECT event_type AS path, sha256(props) AS sha, MAX(ts) AS parsed_at, arg_max(event_id, ts) AS event_id FROM events GROUP BY 1, 2
""")
def latest_per_doc(t):
    e = events_raw(t).select(F.col("record_type").alias("path"), F.col("sha256").alias("sha"),
                             F.col("ingested_at").alias("parsed_at"), F.col("seq").alias("event_id"))
    return keyed.latest_per_key(e, ["path", "sha"], "parsed_at", "event_id")


@query("""
SELECT source, doc_id, len(string_split(text, chr(10))) AS n_items FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY len(string_split(text, chr(10))) DESC, doc_id DESC) = 1
""")
def richest_per_key(t):
    d = t.documents.select("source", "doc_id", F.size(F.split("text", "\n")).cast("long").alias("n_items"))
    return keyed.latest_per_key(d, ["source"], "n_items", "doc_id")


@query("""
SELECT user_id, event_id, CAST(ts AS DATE) AS day, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_id DESC) = 1
""")
def latest_per_account(t):
    e = t.events.select("user_id", "event_id", F.to_date("ts").alias("day"), "event_type")
    return keyed.latest_per_key(e, ["user_id"], "day", "event_id")


@query("""
SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_returnflag
  ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC) = 1
""")
def latest_cell(t):
    l = t.lineitem.select("l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    return keyed.latest_per_key(l, ["l_suppkey", "l_returnflag"], "l_shipdate", "l_orderkey", "l_linenumber",
                                "l_quantity").drop("l_shipdate")


@query("""
SELECT o_custkey, CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS target_month, o_totalprice AS value FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, strftime(o_orderdate, '%Y%m') ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def latest_value(t):
    o = t.orders.select("o_custkey", dt.period_int(F.col("o_orderdate")).cast("long").alias("target_month"),
                        F.col("o_totalprice").alias("value"), "o_orderdate", "o_orderkey")
    return keyed.latest_per_key(o, ["o_custkey", "target_month"], "o_orderdate", "o_orderkey").select(
        "o_custkey", "target_month", "value")


@query("""
SELECT l_partkey, MIN(l_orderkey) AS item_id FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1
""")
def min_id(t):
    l = t.lineitem.where("l_returnflag <> 'R'").select("l_partkey", F.col("l_orderkey").alias("item_id"))
    return keyed.pick_per_key(l, ["l_partkey"], [F.asc("item_id")])


@query("""
WITH h AS (SELECT doc_id, CASE WHEN length(text) >= 150 THEN sha1(text) END AS h FROM documents)
SELECT doc_id, CASE WHEN h IS NOT NULL AND MIN(doc_id) OVER (PARTITION BY h) <> doc_id THEN MIN(doc_id) OVER (PARTITION BY h) END AS dup_of_pk FROM h
""")
def dup_of_doc(t):
    """German documents arrive as this batch, the others are stored; the pool is both."""
    d = t.documents.select("doc_id", "lang", F.when(F.length("text") >= 150, F.sha1("text")).alias("h"))
    tagged = [keyed.duplicate_of_first(d.where(c), "h", ["doc_id"], ["doc_id"], pool=d) for c in ("lang = 'de'", "lang <> 'de'")]
    return tagged[0].unionByName(tagged[1]).select("doc_id", F.col("dup_of.doc_id").alias("dup_of_pk"))


@query("""
WITH h AS (SELECT conv_id, turn, sha1(lower(regexp_replace(string_split(text, chr(10))[1], '[^a-zA-Z]', '', 'g'))) AS h FROM conversations),
f AS (SELECT h, MIN(conv_id * 4294967296 + turn) AS first FROM h GROUP BY 1)
SELECT conv_id, turn, CASE WHEN first <> conv_id * 4294967296 + turn THEN (first // 4294967296) || '-' || (first % 4294967296) END AS dup_of FROM h JOIN f USING (h)
""")
def dup_of_segment(t):
    first_line = F.regexp_replace(F.substring_index("text", "\n", 1), "[^a-zA-Z]", "")
    seg = t.conversations.select("conv_id", "turn", F.sha1(F.lower(first_line)).alias("content_hash"))
    return keyed.duplicate_of_first(seg, "content_hash", ["conv_id", "turn"], ["conv_id", "turn"]).select(
        "conv_id", "turn", F.concat_ws("-", "dup_of.conv_id", "dup_of.turn").alias("d")).select(
        "conv_id", "turn", F.nullif("d", F.lit("")).alias("dup_of"))


@query(r"""
WITH q AS (SELECT doc_id, lang, lower(regexp_replace(string_split(text, chr(10))[1], '[\p{P}\p{Z}\p{C}]', '', 'g')) AS norm FROM documents)
SELECT doc_id, CASE WHEN length(norm) >= 20 AND MIN(doc_id) OVER (PARTITION BY lang, norm) <> doc_id THEN MIN(doc_id) OVER (PARTITION BY lang, norm) END AS dup_key FROM q
""")
def dup_key(t):
    """First quote of the same (unit, normalised text); short quotes never count as copies."""
    norm = tx.loose_key(F.substring_index("text", "\n", 1))
    q = t.documents.select("doc_id", "lang", norm.alias("norm")).select(
        "doc_id", F.when(F.length("norm") >= tx.MIN_QUOTE_CHARS, F.sha1(F.concat_ws("|", "lang", "norm"))).alias("h"))
    return keyed.duplicate_of_first(q, "h", ["doc_id"], ["doc_id"], alias="dup").select(
        "doc_id", F.col("dup.doc_id").alias("dup_key"))


@query("""
WITH p AS (SELECT o_orderstatus AS app, strftime(o_orderdate, '%Y-%m') AS month, MAX(CAST(o_orderdate AS DATE)) AS cutoff FROM orders GROUP BY 1, 2)
SELECT app, month, cutoff, lag(cutoff) OVER (PARTITION BY app ORDER BY month) AS prev_cutoff FROM p
""")
def prev_cutoff_lag(t):
    p = t.orders.groupBy(F.col("o_orderstatus").alias("app"), dt.month_key(F.col("o_orderdate")).alias("month")).agg(
        F.max(F.to_date("o_orderdate")).alias("cutoff"))
    return p.withColumn("prev_cutoff", F.lag("cutoff").over(Window.partitionBy("app").orderBy("month")))


@query("""
WITH c AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS brand, MIN(CAST(o_orderdate AS DATE)) FILTER (o_orderstatus = 'F') AS win_start FROM orders GROUP BY 1, 2, 3)
SELECT o_custkey, month, brand, COALESCE(win_start, MIN(win_start) OVER (PARTITION BY o_custkey, month)) AS win_start FROM c
""")
def group_fill(t):
    """A cell without its own bound takes the smallest one of its group."""
    cells = t.orders.groupBy("o_custkey", dt.month_key(F.col("o_orderdate")).alias("month"),
                             F.col("o_orderpriority").alias("brand")).agg(
        F.min(F.when(F.col("o_orderstatus") == "F", F.to_date("o_orderdate"))).alias("own"))
    w = Window.partitionBy("o_custkey", "month")
    return cells.select("o_custkey", "month", "brand", F.coalesce("own", F.min("own").over(w)).alias("win_start"))


@query("""
SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS INTEGER) AS rank_no
FROM lineitem QUALIFY rank_no <= 3
""")
def topn_per_group(t):
    l = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")
    return keyed.top_n_ranked(l, ["l_suppkey"], [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")], 3)


@query("""
SELECT user_id, arg_min(event_type, CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 ELSE 3 END * 1000000000::BIGINT + event_id) AS reason,
  arg_min(event_id, CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 ELSE 3 END * 1000000000::BIGINT + event_id) AS event_id FROM events GROUP BY 1
""")
def priority_pick(t):
    from fathomline.functions.rules import ordinal_rank

    rank = F.coalesce(ordinal_rank(F.col("event_type"), ["error", "purchase", "signup"]), F.lit(9))
    e = t.events.select("user_id", F.col("event_type").alias("reason"), "event_id", rank.alias("p"))
    return keyed.pick_per_key(e, ["user_id"], [F.asc("p"), F.asc("event_id")]).drop("p")


@query("WITH " + CUSTOMER_QUARTERS_SQL + """
SELECT a.o_custkey, a.q, a.revenue, b.revenue AS year_ago, (a.revenue - b.revenue) / abs(b.revenue) AS yoy
FROM cq a LEFT JOIN cq b ON a.o_custkey = b.o_custkey AND b.q = a.q - 4
""")
def yoy_by_key(t):
    return wn.year_over_year(customer_quarters(t), "o_custkey", "q", "revenue", 4).select(
        "o_custkey", "q", "revenue", "year_ago", "yoy")


@query("WITH " + CUSTOMER_QUARTERS_SQL + """
SELECT o_custkey, q, revenue FROM cq WHERE q <= 1999 * 4 + 3 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY q DESC) <= 5
""")
def last_n_periods(t):
    return wn.last_n(customer_quarters(t), "o_custkey", "q", 5, until=1999 * 4 + 3).select("o_custkey", "q", "revenue")


@query("WITH " + CUSTOMER_QUARTERS_SQL + """,
l AS (SELECT o_custkey, q, revenue AS a, lag(revenue) OVER w AS b, lag(revenue, 2) OVER w AS c FROM cq WINDOW w AS (PARTITION BY o_custkey ORDER BY q))
SELECT o_custkey, q, CASE WHEN b IS NULL OR c IS NULL THEN '—' WHEN a > b AND b > c THEN '↑' WHEN a < b AND b < c THEN '↓' ELSE '→' END AS trend FROM l
""")
def trend_arrow(t):
    return wn.with_trend(customer_quarters(t), "o_custkey", "q", "revenue").select("o_custkey", "q", "trend")


@query("WITH RECURSIVE " + CUSTOMER_QUARTERS_SQL + """,
y AS (SELECT a.o_custkey, a.q, COALESCE((a.revenue - b.revenue) > 0, false) AS good FROM cq a LEFT JOIN cq b ON a.o_custkey = b.o_custkey AND b.q = a.q - 4)
SELECT y.o_custkey, y.q, CASE WHEN NOT y.good THEN CAST(0 AS BIGINT) ELSE y.q - COALESCE((SELECT MAX(g.x) FROM (
    SELECT p.o_custkey, p.q AS x FROM y p WHERE NOT p.good UNION ALL
    SELECT p.o_custkey, p.q - 1 FROM y p WHERE NOT EXISTS (SELECT 1 FROM y z WHERE z.o_custkey = p.o_custkey AND z.q = p.q - 1)) g
  WHERE g.o_custkey = y.o_custkey AND g.x < y.q), 0) END AS streak FROM y
""")
def growth_streak(t):
    """Consecutive quarters with growth over the year before, ending at each quarter."""
    y = wn.year_over_year(customer_quarters(t), "o_custkey", "q", "revenue", 4)
    return ag.longest_run_ending(y, "o_custkey", "q", F.col("yoy") > 0).select("o_custkey", "q", F.col("streak").cast("long").alias("streak"))


@query("""
WITH s AS (SELECT conv_id, COUNT(*) FILTER (role = 'user') AS used FROM conversations GROUP BY 1)
SELECT c.conv_id, c.turn, used + row_number() OVER (PARTITION BY c.conv_id ORDER BY c.turn) AS serial FROM conversations c JOIN s USING (conv_id) WHERE c.role <> 'user'
""")
def serial_continue(t):
    """New rows of a conversation are numbered after its stored ones."""
    stored = t.conversations.where("role = 'user'").select("conv_id", F.col("turn").alias("t"))
    offsets = stored.groupBy("conv_id").agg(F.count(F.lit(1)).alias("used"))
    fresh = t.conversations.where("role <> 'user'").select("conv_id", "turn")
    numbered = numbering.row_numbers(fresh, ["conv_id"], [F.col("turn")], "n")
    return numbered.join(offsets, "conv_id").select("conv_id", "turn", (F.col("used") + F.col("n")).alias("serial"))


@query("""
WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents WHERE lang <> 'en')
SELECT doc_id, 'T' || format('{:06d}', (SELECT COUNT(*) FROM documents WHERE lang = 'en') + rn) AS ledger_id FROM n
""")
def ledger_ids(t):
    """New topics numbered on from the stored maximum in a global order, without one global sort task."""
    base = t.documents.where("lang = 'en'").agg(F.count(F.lit(1))).scalar()
    new = t.documents.where("lang <> 'en'").select("doc_id")
    numbered = numbering.row_numbers(new, [], [F.col("doc_id")], "n")
    return numbered.select("doc_id", F.concat(F.lit("T"), F.format_string("%06d", base + F.col("n"))).alias("ledger_id"))


@query("""
WITH r AS (SELECT p_brand, p_type, AVG(p_size) AS plan FROM part WHERE p_size < 45 OR p_brand <> 'Brand#3' GROUP BY 1, 2),
v AS (SELECT p_type, p_brand, CASE WHEN plan > 24 THEN plan END AS plan FROM r)
SELECT p_type, p_brand, row_number() OVER (PARTITION BY p_type ORDER BY plan DESC NULLS LAST, p_brand) AS rank_no FROM v
""")
def rank_brands(t):
    r = t.part.where("p_size < 45 OR p_brand <> 'Brand#3'").groupBy("p_type", "p_brand").agg(F.avg("p_size").alias("a"))
    v = r.select("p_type", "p_brand", F.when(F.col("a") > 24, F.col("a")).alias("plan"))
    w = Window.partitionBy("p_type").orderBy(F.desc_nulls_last("plan"), F.asc("p_brand"))
    return v.select("p_type", "p_brand", F.row_number().over(w).cast("long").alias("rank_no"))


@query("""
WITH m AS (SELECT o_custkey, COUNT(*) AS x, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y FROM orders GROUP BY 1),
j AS (SELECT c_custkey, c_nationkey, x, y FROM customer JOIN m ON o_custkey = c_custkey),
k AS (SELECT *, median(x) OVER (PARTITION BY c_nationkey) AS mx, median(y) OVER (PARTITION BY c_nationkey) AS my FROM j)
SELECT c_custkey, CASE WHEN x >= mx THEN '高成長・' ELSE '低成長・' END || CASE WHEN y >= my THEN '高獲利' ELSE '低獲利' END AS quadrant FROM k
""")
def quadrant(t):
    m = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).cast("double").alias("x"), money_sum("o_totalprice").alias("y"))
    j = t.customer.select("c_custkey", "c_nationkey").join(m, "c_custkey")
    mx = ag.grouped_median(j, ["c_nationkey"], "x", "mx")
    my = ag.grouped_median(j, ["c_nationkey"], "y", "my")
    return jn.left_enrich(j, (mx, "c_nationkey"), (my, "c_nationkey")).select(
        "c_custkey", wn.quadrant(F.col("x"), F.col("y"), F.col("mx"), F.col("my")).alias("quadrant"))
