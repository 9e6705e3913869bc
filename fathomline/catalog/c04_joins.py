"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.catalog.registry import query
from fathomline.functions import dates as dt
from fathomline.functions import text as tx
from fathomline.functions.numbers import money_sum
from fathomline.operators import joins as jn
from fathomline.operators.keyed import duplicate_of_first, pick_per_key


@query("""
SELECT o_orderkey, c_name, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")
def left_enrich(t):
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    n = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    r = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return jn.left_enrich(t.orders.select("o_orderkey", "o_custkey"), (c, "o_custkey"), (n, "c_nationkey"),
                          (r, "n_regionkey")).select("o_orderkey", "c_name", "n_name", "r_name")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag = 'R' AND o_orderstatus = 'F'
""")
def inner_join(t):
    o = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    return t.lineitem.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_quantity").join(
        o, "l_orderkey")


@query("""
WITH m AS (SELECT o_custkey AS c_custkey, COUNT(*) AS n_this FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '2001-06' GROUP BY 1),
l AS (SELECT o_custkey AS c_custkey, MAX(strftime(o_orderdate, '%Y-%m')) AS last_period FROM orders
      WHERE o_orderdate < TIMESTAMP '2001-06-01' GROUP BY 1)
SELECT c_custkey, CASE WHEN n_this > 0 THEN 'submitted' WHEN last_period IS NULL THEN 'never' ELSE 'missing' END AS status,
       last_period FROM customer LEFT JOIN m USING (c_custkey) LEFT JOIN l USING (c_custkey)
""")
def roster_status(t):
    """Roster with this month's filing and the last one before."""
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderdate",
                        dt.month_key(F.col("o_orderdate")).alias("period"))
    this = o.where("period = '2001-06'").groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n_this"))
    last = o.where("period < '2001-06'").groupBy("c_custkey").agg(F.max("period").alias("last_period"))
    status = F.when(F.col("n_this") > 0, F.lit("submitted")).when(F.col("last_period").isNull(), F.lit("never")).otherwise(
        F.lit("missing"))
    return t.customer.select("c_custkey").join(this, ["c_custkey"], "left").join(last, ["c_custkey"], "left").select(
        "c_custkey", status.alias("status"), "last_period")


@query("""
WITH a AS (SELECT year(o_orderdate) AS yr, o_orderstatus AS flag, COUNT(*) AS n_a FROM orders GROUP BY 1, 2),
b AS (SELECT year(l_shipdate) AS yr, l_returnflag AS flag, COUNT(*) AS n_b FROM lineitem GROUP BY 1, 2)
SELECT COALESCE(a.yr, b.yr) AS yr, COALESCE(a.flag, b.flag) AS flag,
       CASE WHEN b.yr IS NULL THEN 'meeting_only' WHEN a.yr IS NULL THEN 'sb_only' END AS relation,
       COALESCE(n_a, 0) AS n_a, COALESCE(n_b, 0) AS n_b
FROM a FULL OUTER JOIN b ON a.yr = b.yr AND replace(a.flag, 'F', 'R') = b.flag
""")
def grid_full_outer(t):
    a = t.orders.groupBy(F.year("o_orderdate").cast("long").alias("yr"), F.col("o_orderstatus").alias("a_flag")).agg(
        F.count(F.lit(1)).alias("n_a")).withColumn("key", F.replace("a_flag", F.lit("F"), F.lit("R")))
    b = t.lineitem.groupBy(F.year("l_shipdate").cast("long").alias("yr"), F.col("l_returnflag").alias("key")).agg(
        F.count(F.lit(1)).alias("n_b"))
    g = jn.full_grid(a, b, ["yr", "key"], "meeting_only", "sb_only")
    return g.select("yr", F.coalesce("a_flag", "key").alias("flag"), "relation",
                    F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_b", F.lit(0)).alias("n_b"))


@query("SELECT c_custkey, c_name FROM customer SEMI JOIN orders ON c_custkey = o_custkey AND o_orderdate >= TIMESTAMP '2001-06-01'")
def semi_join(t):
    recent = t.orders.where("o_orderdate >= TIMESTAMP_NTZ'2001-06-01'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(recent, "c_custkey", "left_semi")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def in_subquery(t):
    view = {"customer": t.customer, "orders": t.orders}
    return t.spark.sql(
        "SELECT c_custkey FROM {customer} WHERE c_custkey IN (SELECT o_custkey FROM {orders} WHERE o_totalprice > 450000)",
        **view)


@query("SELECT c_custkey, c_name FROM customer ANTI JOIN orders ON c_custkey = o_custkey AND o_orderdate >= TIMESTAMP '2000-06-01'")
def anti_join(t):
    recent = t.orders.where("o_orderdate >= TIMESTAMP_NTZ'2000-06-01'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(recent, "c_custkey", "left_anti")


@query("SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def broadcast_lookup(t):
    """A 25-row dimension: Spark measures it and broadcasts it, and would shuffle a grown one."""
    n = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return t.customer.join(n, "c_nationkey", "left").select("c_custkey", "n_name")


@query("""
WITH dim AS (SELECT upper(p_brand[1:7]) AS prefix, MIN(p_brand) AS unit FROM part WHERE p_brand <> 'Brand#2' GROUP BY 1)
SELECT p_partkey, prefix, unit, CASE WHEN length(trim(p_brand)) < 7 THEN 'too_short' WHEN unit IS NULL THEN 'unknown'
  ELSE 'prefix' END AS basis
FROM (SELECT p_partkey, p_brand, CASE WHEN length(trim(b)) >= 7 THEN upper(trim(b)[1:7]) END AS prefix
      FROM (SELECT *, CASE WHEN p_size = 1 THEN 'Br' ELSE ' ' || p_brand END AS b FROM part)) x
LEFT JOIN dim USING (prefix)
""".replace("CASE WHEN length(trim(p_brand)) < 7", "CASE WHEN prefix IS NULL"))
def prefix_lookup(t):
    dim = t.part.where("p_brand <> 'Brand#2'").groupBy(F.upper(F.substring("p_brand", 1, 7)).alias("prefix")).agg(
        F.min("p_brand").alias("unit"))
    code = F.when(F.col("p_size") == 1, F.lit("Br")).otherwise(F.concat(F.lit(" "), "p_brand"))
    return jn.prefix_lookup(t.part.select("p_partkey", code.alias("code")), "code", dim, "prefix", "unit", 7).select(
        "p_partkey", "prefix", "unit", "basis")


def _page_aliases(t):
    """Hosts below blog. and all two-part domains serve as company aliases."""
    host = F.lower(F.parse_url("url", F.lit("HOST")))
    hosts = t.pages.select(host.alias("h"))
    return hosts.where("h LIKE 'blog.%'").select(F.col("h").alias("alias")).union(
        hosts.where("h NOT LIKE '%.org'").select(F.substring_index("h", ".", -2))).distinct().withColumn(
        "company", F.concat(F.lit("c:"), "alias"))


@query("""
WITH h AS (SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS host FROM pages),
a AS (SELECT host AS alias FROM h WHERE host LIKE 'blog.%' UNION
      SELECT regexp_extract(host, '[^.]+\\.[^.]+$') FROM h WHERE host NOT LIKE '%.org'),
m AS (SELECT page_id, host, alias, row_number() OVER (PARTITION BY page_id ORDER BY length(alias) DESC NULLS LAST, alias DESC) AS rn
      FROM h LEFT JOIN a ON host = alias OR ends_with(host, '.' || alias))
SELECT page_id, host AS domain, alias, 'c:' || alias AS company FROM m WHERE rn = 1
""")
def domain_suffix_join(t):
    facts = t.pages.select("page_id", F.lower(F.parse_url("url", F.lit("HOST"))).alias("domain"))
    return jn.longest_suffix_match(facts, "page_id", "domain", _page_aliases(t), "alias").select(
        "page_id", "domain", "alias", "company")


@query("""
WITH w AS (SELECT user_id AS uid, MIN(ts) + INTERVAL 3 DAY AS w_start, MIN(ts) + INTERVAL 10 DAY AS w_end FROM events GROUP BY 1)
SELECT event_id, user_id, w_start FROM events JOIN w ON user_id = uid AND ts BETWEEN w_start AND w_end
""")
def interval_join(t):
    w = t.events.groupBy("user_id").agg(F.min("ts").alias("m")).select(
        "user_id", (F.col("m") + F.expr("INTERVAL 3 DAYS")).alias("w_start"),
        (F.col("m") + F.expr("INTERVAL 10 DAYS")).alias("w_end"))
    return jn.in_window(t.events.select("event_id", "user_id", "ts"), w, "user_id", "ts", "w_start", "w_end").select(
        "event_id", "user_id", "w_start")


@query("""
WITH a AS (SELECT source, lang, MIN(regexp_extract(text, '^[^ ]+')) AS alias FROM documents GROUP BY 1, 2)
SELECT d.doc_id, a.alias FROM documents d JOIN a ON a.source = d.source AND a.lang = d.lang
WHERE contains(lower(d.text), lower(a.alias))
""")
def contains_join(t):
    """Alias text contained in the document, joined on the hint the document carries."""
    first = F.regexp_extract("text", "^[^ ]+", 0)
    aliases = t.documents.groupBy("source", "lang").agg(F.min(first).alias("alias"))
    return t.documents.join(aliases, ["source", "lang"]).where(
        F.contains(F.lower("text"), F.lower("alias"))).select("doc_id", "alias")


@query("""
WITH c AS (SELECT c_custkey, c_mktsegment AS path, NULLIF(c_nationkey, 3) AS sha FROM customer),
s AS (SELECT 'BUILDING' AS path, NULLIF(s_nationkey, 3) AS sha, COUNT(*) AS n_suppliers FROM supplier GROUP BY 1, 2)
SELECT c_custkey, n_suppliers FROM c JOIN s ON c.path = s.path AND c.sha IS NOT DISTINCT FROM s.sha
""")
def nullsafe_join(t):
    c = t.customer.select("c_custkey", F.col("c_mktsegment").alias("path"), F.nullif("c_nationkey", F.lit(3)).alias("sha"))
    s = t.supplier.groupBy(F.lit("BUILDING").alias("s_path"), F.nullif("s_nationkey", F.lit(3)).alias("s_sha")).agg(
        F.count(F.lit(1)).alias("n_suppliers"))
    return c.join(s, (F.col("path") == F.col("s_path")) & F.col("sha").eqNullSafe(F.col("s_sha"))).select(
        "c_custkey", "n_suppliers")


def customer_quarters(t):
    """One row per customer and quarter: the grain all period operators work on."""
    return t.orders.groupBy("o_custkey", dt.quarter_index(F.col("o_orderdate")).alias("q")).agg(
        money_sum("o_totalprice").alias("revenue"), F.count(F.lit(1)).alias("n_orders"))


CUSTOMER_QUARTERS_SQL = """
cq AS (SELECT o_custkey, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS INTEGER) AS q,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, COUNT(*) AS n_orders FROM orders GROUP BY 1, 2)
"""


@query("WITH " + CUSTOMER_QUARTERS_SQL + """,
asked AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) * 4 + 3 AS INTEGER) AS q FROM orders)
SELECT a.o_custkey, a.q, arg_max(cq.q, cq.q) AS found_q, arg_max(cq.revenue, cq.q) AS revenue, MAX(cq.q) <> a.q AS fallback
FROM asked a JOIN cq ON cq.o_custkey = a.o_custkey AND cq.q <= a.q GROUP BY 1, 2
""")
def asof_quarter(t):
    asked = t.orders.select("o_custkey", (F.year("o_orderdate") * 4 + 3).alias("q"))
    hit = jn.at_or_before(asked, customer_quarters(t), "o_custkey", "q", "found_q")
    return hit.select("o_custkey", "q", "found_q", "revenue", (F.col("found_q") != F.col("q")).alias("fallback"))


@query("""
WITH f AS (SELECT DISTINCT o_custkey, CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS period FROM orders)
SELECT f.o_custkey, f.period, (SELECT MAX(p.period) FROM f p WHERE p.o_custkey = f.o_custkey AND p.period < f.period) AS prior_period
FROM f
""")
def prior_filing(t):
    f = t.orders.select("o_custkey", dt.period_int(F.col("o_orderdate")).cast("long").alias("period")).distinct()
    return jn.previous_value(f, ["o_custkey"], "period", "period", "prior_period")


@query("""
WITH f AS (SELECT o_custkey, CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS period,
  CAST(MAX(o_orderdate) FILTER (o_orderstatus = 'F') AS DATE) AS cutoff FROM orders GROUP BY 1, 2)
SELECT f.o_custkey, f.period, f.cutoff,
  (SELECT arg_max(p.cutoff, p.period) FROM f p WHERE p.o_custkey = f.o_custkey AND p.period < f.period AND p.cutoff IS NOT NULL) AS prev_cutoff
FROM f
""")
def prev_cutoff(t):
    f = t.orders.groupBy("o_custkey", dt.period_int(F.col("o_orderdate")).cast("long").alias("period")).agg(
        F.to_date(F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")))).alias("cutoff"))
    return jn.previous_value(f, ["o_custkey"], "period", "cutoff", "prev_cutoff")


@query("""
WITH p AS (SELECT DISTINCT l_suppkey, CAST(year(l_shipdate) * 4 + quarter(l_shipdate) - 1 AS INTEGER) AS q, l_returnflag AS doc_class
           FROM lineitem WHERE l_quantity < 20),
s AS (SELECT DISTINCT l_suppkey, q FROM p), g AS (SELECT l_suppkey, q, doc_class FROM s, (VALUES ('A'), ('N'), ('R')) c(doc_class))
SELECT g.l_suppkey, g.q, g.doc_class, MAX(p.q) AS from_q
FROM g LEFT JOIN p ON p.l_suppkey = g.l_suppkey AND p.doc_class = g.doc_class AND p.q BETWEEN g.q - 2 AND g.q GROUP BY 1, 2, 3
""")
def carry_forward(t):
    """A missing document class is taken from the nearest of the two quarters before."""
    have = t.lineitem.where("l_quantity < 20").select(
        "l_suppkey", dt.quarter_index(F.col("l_shipdate")).alias("q"), F.col("l_returnflag").alias("doc_class")).distinct()
    classes = F.array(*[F.lit(c) for c in "ANR"])
    grid = have.groupBy("l_suppkey", "q").agg(F.collect_set("doc_class").alias("have")).select(
        "l_suppkey", "q", "have", F.explode(classes).alias("doc_class"))
    return jn.carry_forward(grid, ["l_suppkey", "doc_class"], "q", F.array_contains("have", F.col("doc_class")), 2).select(
        "l_suppkey", "q", "doc_class", F.col("from_period").alias("from_q"))


@query("""
WITH w AS (SELECT CAST(unnest(range(DATE '2023-12-25', DATE '2024-02-12', INTERVAL 7 DAY)) AS DATE) AS week_start),
k AS (SELECT DISTINCT event_type FROM events),
c AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2)
SELECT w.week_start, k.event_type, COALESCE(n, 0) AS n FROM w CROSS JOIN k LEFT JOIN c USING (week_start, event_type)
""")
def calendar_zero_fill(t):
    """All weeks around the data for every source; a missing cell counts zero."""
    counts = t.events.groupBy(dt.week_start(F.col("ts")).alias("week_start"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    spine = t.events.select("event_type").distinct().select("event_type", F.explode(F.sequence(
        F.lit("2023-12-25").cast("date"), F.lit("2024-02-05").cast("date"), F.expr("INTERVAL 7 DAYS"))).alias("week_start"))
    return spine.join(counts, ["event_type", "week_start"], "left").fillna(0, ["n"])


@query("""
WITH a AS (SELECT *, row_number() OVER (PARTITION BY user_id, ts >= TIMESTAMP '2024-01-22' ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT n.user_id, o.event_type AS before_type, n.event_type AS now_type FROM a n JOIN a o ON n.user_id = o.user_id
WHERE n.rn = 1 AND o.rn = 1 AND n.ts >= TIMESTAMP '2024-01-22' AND o.ts < TIMESTAMP '2024-01-22' AND n.event_type <> o.event_type
""")
def state_change(t):
    """Last state of the period against the last state before it, changed keys only."""
    cut = F.col("ts") >= F.lit("2024-01-22").cast("timestamp_ntz")
    last = t.events.groupBy("user_id").agg(
        F.max(F.when(~cut, F.struct("ts", "event_id", "event_type"))).alias("b"),
        F.max(F.when(cut, F.struct("ts", "event_id", "event_type"))).alias("n"))
    return last.select("user_id", F.col("b.event_type").alias("before_type"), F.col("n.event_type").alias("now_type")).where(
        "before_type <> now_type")


@query("""
WITH m AS (SELECT DISTINCT o_custkey, strftime(o_orderdate, '%Y-%m') AS p FROM orders)
SELECT o_custkey, 'new' AS change FROM m WHERE p = '1995-06' AND o_custkey NOT IN (SELECT o_custkey FROM m WHERE p < '1995-06')
UNION ALL
SELECT o_custkey, 'stopped' FROM m WHERE p = '1995-05' AND o_custkey NOT IN (SELECT o_custkey FROM m WHERE p = '1995-06')
""")
def new_stopped(t):
    """In this month and never before; in the month before and not in this one."""
    m = t.orders.select("o_custkey", dt.month_key(F.col("o_orderdate")).alias("p")).distinct()
    now = m.where("p = '1995-06'").select("o_custkey")
    new = now.join(m.where("p < '1995-06'").select("o_custkey"), "o_custkey", "left_anti").withColumn("change", F.lit("new"))
    stopped = m.where("p = '1995-05'").select("o_custkey").join(now, "o_custkey", "left_anti").withColumn(
        "change", F.lit("stopped"))
    return new.unionByName(stopped)


@query("""
WITH d AS (SELECT doc_id, MIN(doc_id) OVER (PARTITION BY sha1(text)) AS primary_id FROM documents)
SELECT d.doc_id, d.primary_id, l.quality AS quality, 'copied' AS basis
FROM d JOIN labels l ON l.doc_id = d.primary_id WHERE d.doc_id <> d.primary_id
""")
def copy_from_primary(t):
    """Duplicates take the classification of their primary; an unclassified primary yields no row."""
    docs = t.documents.select("doc_id", F.sha1("text").alias("h"))
    dups = duplicate_of_first(docs, "h", ["doc_id"], ["doc_id"]).where("dup_of IS NOT NULL").select(
        "doc_id", F.col("dup_of.doc_id").alias("primary_id"))
    cls = t.labels.select(F.col("doc_id").alias("primary_id"), "quality")
    return dups.join(cls, "primary_id").select("doc_id", "primary_id", "quality", F.lit("copied").alias("basis"))


@query("""
WITH o AS (SELECT o_custkey, COUNT(*) AS n_orders, MAX(CAST(o_orderdate AS DATE)) AS last_order FROM orders GROUP BY 1),
l AS (SELECT o_custkey, COUNT(*) AS n_lines, COUNT(*) FILTER (l_returnflag = 'R') AS n_returns
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
SELECT c_custkey, COALESCE(n_orders, 0) AS n_orders, last_order, COALESCE(n_lines, 0) AS n_lines, COALESCE(n_returns, 0) AS n_returns
FROM customer LEFT JOIN o ON o.o_custkey = c_custkey LEFT JOIN l ON l.o_custkey = c_custkey
""")
def entity_index(t):
    """Entity with aggregates of several child tables; lines are counted per order before the join."""
    o = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.max(F.to_date("o_orderdate")).alias("last_order"))
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("r"))
    l = per_order.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey")),
                       "l_orderkey").groupBy("c_custkey").agg(F.sum("n").alias("n_lines"), F.sum("r").alias("n_returns"))
    return jn.left_enrich(t.customer.select("c_custkey"), (o, "c_custkey"), (l, "c_custkey")).fillna(
        0, ["n_orders", "n_lines", "n_returns"])


@query("""
SELECT c.conv_id, c.turn, f.turn AS speaker_turn, length(f.text) AS speaker_chars FROM conversations c LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS rn FROM conversations) f
ON f.conv_id = c.conv_id AND f.role = c.role AND f.rn = 1
""")
def first_row_join(t):
    """One row per (conversation, speaker), then joined to every turn of the speaker."""
    first = pick_per_key(t.conversations, ["conv_id", "role"], [F.col("turn")]).select(
        "conv_id", "role", F.col("turn").alias("speaker_turn"), F.length("text").cast("long").alias("speaker_chars"))
    return t.conversations.select("conv_id", "turn", "role").join(first, ["conv_id", "role"], "left").drop("role")


@query("""
WITH a AS (SELECT DISTINCT o_orderstatus AS app, strftime(o_orderdate, '%Y-%m') AS p FROM orders WHERE o_orderpriority = '1-URGENT'),
b AS (SELECT DISTINCT CASE l_linestatus WHEN 'O' THEN 'O' ELSE 'F' END AS app, strftime(l_shipdate, '%Y-%m') AS p FROM lineitem WHERE l_quantity > 40),
c AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS p FROM orders WHERE o_totalprice > 480000)
SELECT app, MAX(p) AS latest_common FROM a JOIN b USING (app, p) JOIN c USING (p) GROUP BY 1
""")
def period_intersection(t):
    a = t.orders.where("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderstatus").alias("app"), dt.month_key(F.col("o_orderdate")).alias("p")).distinct()
    b = t.lineitem.where("l_quantity > 40").select(
        F.when(F.col("l_linestatus") == "O", F.lit("O")).otherwise(F.lit("F")).alias("app"),
        dt.month_key(F.col("l_shipdate")).alias("p")).distinct()
    c = t.orders.where("o_totalprice > 480000").select(dt.month_key(F.col("o_orderdate")).alias("p")).distinct()
    return a.join(b, ["app", "p"]).join(c, "p").groupBy("app").agg(F.max("p").alias("latest_common"))


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n, CAST(SUM(l_quantity) AS BIGINT) AS qty FROM lineitem GROUP BY 1, 2),
a AS (SELECT l_orderkey, string_agg(l_linenumber || ':' || n || ':' || qty, ',' ORDER BY l_linenumber) AS items FROM l GROUP BY 1)
SELECT o_orderkey, items FROM orders LEFT JOIN a ON l_orderkey = o_orderkey
""")
def children_array(t):
    """Children folded to an array on the parent; copies of a line number are summed first,
    so the array grows with the line numbers and not with the rows of a hot order."""
    lines = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("long").alias("qty"))
    arr = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "n", "qty"))).alias("a"))
    text = F.array_join(F.transform("a", lambda x: F.concat_ws(":", x["l_linenumber"], x["n"], x["qty"])), ",")
    return t.orders.select("o_orderkey").join(arr, "o_orderkey", "left").select("o_orderkey", text.alias("items"))


@query(r"""
SELECT conv_id, turn, CASE role WHEN 'user' THEN '[USER]' WHEN 'assistant' THEN '[ASSISTANT]' ELSE '<P03>' END
  || ' said ' || turn || CASE WHEN role = 'assistant' THEN ' to ' || CASE WHEN EXISTS
     (SELECT 1 FROM conversations u WHERE u.conv_id = c.conv_id AND u.role = 'user') THEN '[USER]' ELSE '<P01>' END ELSE '' END AS line
FROM conversations c
""")
def token_resolve(t):
    """Participant tokens in a line become labels of the same conversation; unknown ones stay."""
    token = F.when(F.col("role") == "user", F.lit("P01")).when(F.col("role") == "assistant", F.lit("P02")).otherwise(F.lit("P03"))
    line = F.concat(F.lit("<"), token, F.lit("> said "), F.col("turn").cast("string"),
                    F.when(F.col("role") == "assistant", F.lit(" to <P01>")).otherwise(F.lit("")))
    labels = t.conversations.where("role <> 'system'").select(
        "conv_id", token.alias("token"), F.concat(F.lit("["), F.upper("role"), F.lit("]")).alias("label")).distinct()
    rows = t.conversations.select("conv_id", "turn", line.alias("line"))
    return jn.replace_tokens(rows, ["conv_id", "turn"], ["conv_id"], "line", labels)


@query("WITH " + CUSTOMER_QUARTERS_SQL + """,
newest AS (SELECT o_custkey, MAX(q) AS q, arg_max(revenue, q) AS revenue, COUNT(*) AS n_facts FROM cq GROUP BY 1),
peers AS (SELECT c_nationkey, q, COUNT(*) AS n_peers, CAST(SUM(CAST(revenue AS DECIMAL(28,2))) AS DOUBLE) AS peer_revenue
          FROM cq JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)
SELECT c_custkey, n.q, n.revenue, n.n_facts, o_orderkey AS newest_order, n_peers, peer_revenue
FROM customer c LEFT JOIN newest n ON n.o_custkey = c_custkey
LEFT JOIN (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) o ON o.o_custkey = c_custkey
LEFT JOIN peers p ON p.c_nationkey = c.c_nationkey AND p.q = n.q
""")
def bundle_join(t):
    """Newest facts, newest document and the peers of the same period for every entity."""
    cq = customer_quarters(t)
    newest = cq.groupBy("o_custkey").agg(F.max(F.struct("q", "revenue")).alias("m"), F.count(F.lit(1)).alias("n_facts")).select(
        F.col("o_custkey").alias("c_custkey"), F.col("m.q").alias("q"), F.col("m.revenue").alias("revenue"), "n_facts")
    doc = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max(F.struct("o_orderdate", "o_orderkey")).alias("m")).select("c_custkey", F.col("m.o_orderkey").alias("newest_order"))
    nation = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    peers = cq.join(nation, "o_custkey").groupBy("c_nationkey", "q").agg(
        F.count(F.lit(1)).alias("n_peers"), F.sum(F.col("revenue").cast("decimal(28,2)")).cast("double").alias("peer_revenue"))
    return jn.left_enrich(t.customer.select("c_custkey", "c_nationkey"), (newest, "c_custkey"), (doc, "c_custkey"),
                          (peers, ["c_nationkey", "q"])).drop("c_nationkey")


@query("""
SELECT DISTINCT lower(trim(c_mktsegment)) AS alias, n_nationkey AS entity_id, r_name AS app_default
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON r_regionkey = n_regionkey WHERE r_name <> 'ASIA'
""")
def hint_refs(t):
    """Aliases of active entities, distinct, with the default list of each entity."""
    active = t.nation.join(t.region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("app_default")),
                           "n_regionkey").where("app_default <> 'ASIA'").select(
        F.col("n_nationkey").alias("entity_id"), "app_default")
    alias = t.customer.select(tx.alias_norm(F.col("c_mktsegment")).alias("alias"), F.col("c_nationkey").alias("entity_id"))
    return alias.distinct().join(active, "entity_id")


@query("""
SELECT d.doc_id, d.lang, l.quality AS prior_category, CASE WHEN l.doc_id IS NULL THEN 'none' WHEN toxic = 1 THEN 'reviewed' ELSE 'rule' END AS basis,
       d.n_chars >= 150 AS extractable, CASE WHEN d.n_chars > 5000 THEN 3 WHEN d.n_chars > 1000 THEN 2 ELSE 1 END AS weight
FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def candidate_view(t):
    weight = F.when(F.col("n_chars") > 5000, F.lit(3)).when(F.col("n_chars") > 1000, F.lit(2)).otherwise(F.lit(1))
    basis = F.when(F.col("quality").isNull(), F.lit("none")).when(F.col("toxic") == 1, F.lit("reviewed")).otherwise(F.lit("rule"))
    return t.documents.select("doc_id", "lang", "n_chars").join(t.labels, "doc_id", "left").select(
        "doc_id", "lang", F.col("quality").alias("prior_category"), basis.alias("basis"),
        (F.col("n_chars") >= 150).alias("extractable"), weight.alias("weight"))


@query("""
WITH i AS (SELECT l_orderkey, l_linenumber, MAX(l_shipdate) AS shipped, bool_or(l_returnflag <> 'R') AS ok FROM lineitem GROUP BY 1, 2)
SELECT o_orderkey, l_linenumber, o_orderpriority AS facet, CAST(shipped AS DATE) AS event_date, COALESCE(ok, false) AS item_still_valid
FROM orders LEFT JOIN i ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'
""")
def lens_view(t):
    """Active labels with the columns of their item and whether the item still counts."""
    items = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber").agg(
        F.to_date(F.max("l_shipdate")).alias("event_date"), F.max((F.col("l_returnflag") != "R").cast("int")).alias("ok"))
    active = t.orders.where("o_orderstatus <> 'P'").select("o_orderkey", F.col("o_orderpriority").alias("facet"))
    return active.join(items, "o_orderkey", "left").select(
        "o_orderkey", "l_linenumber", "facet", "event_date", (F.coalesce("ok", F.lit(0)) == 1).alias("item_still_valid"))
