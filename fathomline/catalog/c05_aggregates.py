"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.catalog.c04_joins import CUSTOMER_QUARTERS_SQL, customer_quarters
from fathomline.catalog.registry import query
from fathomline.functions import dates as dt
from fathomline.functions import rules
from fathomline.functions import text as tx
from fathomline.functions.numbers import count_where, money_sum, pct_change, rate
from fathomline.operators import aggregates as ag
from fathomline.operators.keyed import latest_per_key, top_n_ranked
from fathomline.plans import hints


def msum(c):
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


PRIORITIES = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]


@query("SELECT o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")
def distribution(t):
    return ag.distribution(t.orders, "o_orderpriority", 3)


@query("""
SELECT o_orderstatus, COUNT(DISTINCT o_custkey) AS n_customers, COUNT(DISTINCT (o_custkey, CAST(o_orderdate AS DATE))) AS n_days
FROM orders GROUP BY 1
""")
def count_distinct(t):
    """Pairs first: both counts come from one distinct set, without the row doubling of two distinct counts."""
    pairs = t.orders.groupBy("o_orderstatus", "o_custkey", F.to_date("o_orderdate")).agg(F.lit(1).alias("one"))
    per_customer = pairs.groupBy("o_orderstatus", "o_custkey").agg(F.count("one").alias("days"))
    return per_customer.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_customers"), F.sum("days").alias("n_days"))


@query("""
SELECT l_linestatus, COUNT(*) FILTER (l_returnflag = 'R') AS n_returned, COUNT(*) FILTER (l_discount > 0.05 AND l_tax < 0.03) AS n_deals
FROM lineitem GROUP BY 1
""")
def cond_count(t):
    return t.lineitem.groupBy("l_linestatus").agg(
        count_where(F.col("l_returnflag") == "R").alias("n_returned"),
        count_where((F.col("l_discount") > 0.05) & (F.col("l_tax") < 0.03)).alias("n_deals"))


@query("""
SELECT l_linestatus, round(AVG(CAST(l_returnflag = 'R' AS INT)), 3) AS return_rate, round(AVG(CAST(l_quantity > 40 AS INT)), 3) AS bulk_rate
FROM lineitem GROUP BY 1
""")
def rates(t):
    return t.lineitem.groupBy("l_linestatus").agg(
        rate(F.col("l_returnflag") == "R").alias("return_rate"), rate(F.col("l_quantity") > 40).alias("bulk_rate"))


@query("""
SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS first_seen, MAX(CAST(o_orderdate AS DATE)) AS last_seen, COUNT(*) AS n
FROM orders GROUP BY 1
""")
def first_last(t):
    day = F.to_date("o_orderdate")
    return t.orders.groupBy("o_custkey").agg(
        F.min(day).alias("first_seen"), F.max(day).alias("last_seen"), F.count(F.lit(1)).alias("n"))


@query("""
SELECT quantile_disc(l_quantity, 0.5) AS l_quantity_p50, quantile_disc(l_quantity, 0.95) AS l_quantity_p95, MAX(l_quantity) AS l_quantity_max,
       quantile_disc(l_extendedprice, 0.5) AS l_extendedprice_p50, quantile_disc(l_extendedprice, 0.95) AS l_extendedprice_p95,
       MAX(l_extendedprice) AS l_extendedprice_max FROM lineitem
""")
def num_profile(t):
    return ag.num_profile(t.lineitem, ["l_quantity", "l_extendedprice"])


@query("""
SELECT lang, quantile_disc(length(regexp_replace(text, '\\s+', ' ', 'g')) / greatest(length(text), 1), 0.5) AS ratio_p50 FROM documents GROUP BY 1
""")
def ratio_p50(t):
    clean = F.length(F.regexp_replace("text", r"\s+", " "))
    return t.documents.groupBy("lang").agg(
        F.percentile_approx(clean / F.greatest(F.length("text"), F.lit(1)), 0.5, 100_000).alias("ratio_p50"))


@query("""
WITH c AS (SELECT l_suppkey, l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem GROUP BY 1, 2, 3)
SELECT l_suppkey, string_agg(l_returnflag || l_linestatus || ':' || n, ',' ORDER BY l_returnflag, l_linestatus) AS items FROM c GROUP BY 1
""")
def cell_items(t):
    """Items of a cell as an array of structs, folded from counted item kinds."""
    kinds = t.lineitem.groupBy("l_suppkey", "l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    arr = F.array_sort(F.collect_list(F.struct("l_returnflag", "l_linestatus", "n")))
    cells = kinds.groupBy("l_suppkey").agg(arr.alias("a"))
    return cells.select("l_suppkey", F.array_join(F.transform("a", lambda x: F.concat(
        x["l_returnflag"], x["l_linestatus"], F.lit(":"), x["n"].cast("string"))), ",").alias("items"))


@query("SELECT o_custkey, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1")
def collect_sorted(t):
    return t.orders.groupBy("o_custkey").agg(
        F.array_join(F.array_sort(F.collect_set("o_orderpriority")), "|").alias("priorities"))


@query("""
WITH c AS (SELECT o_custkey, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_custkey, o_orderpriority AS top_priority FROM c QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) = 1
""")
def mode_value(t):
    return ag.mode_per_key(t.orders, ["o_custkey"], "o_orderpriority", "top_priority")


@query("""
WITH c AS (SELECT o_custkey, o_orderstatus || ':' || COUNT(*) AS p FROM orders GROUP BY o_custkey, o_orderstatus)
SELECT o_custkey, string_agg(p, ',' ORDER BY p) AS summary FROM c GROUP BY 1
""")
def agg_string(t):
    return ag.summary_string(t.orders, ["o_custkey"], "o_orderstatus", "summary")


@query("SELECT o_custkey, MIN(o_orderpriority) AS worst FROM orders GROUP BY 1")
def ordinal_max(t):
    """Highest level through its rank: S0 < S1 < S2, here LOW < … < URGENT."""
    rank = t.orders.select("o_custkey", rules.ordinal_rank(F.col("o_orderpriority"), PRIORITIES).alias("r"))
    return rank.groupBy("o_custkey").agg(F.max("r").alias("r")).select(
        "o_custkey", rules.ordinal_value(F.col("r"), PRIORITIES).alias("worst"))


@query("""
WITH e AS (SELECT user_id, strftime(date_trunc('week', ts), '%m%d') AS w FROM events)
SELECT user_id, COUNT(*) FILTER (w = '0101') AS "0101", COUNT(*) FILTER (w = '0108') AS "0108", COUNT(*) FILTER (w = '0115') AS "0115",
  COUNT(*) FILTER (w = '0122') AS "0122", COUNT(*) FILTER (w = '0129') AS "0129", COUNT(*) AS total, COUNT(DISTINCT w) AS active
FROM e GROUP BY 1
""")
def pivot_matrix(t):
    weeks = ["0101", "0108", "0115", "0122", "0129"]
    e = t.events.select("user_id", F.date_format(F.date_trunc("week", "ts"), "MMdd").alias("w"))
    return ag.pivot_with_totals(e, ["user_id"], "w", weeks)


@query("""
SELECT l_suppkey, MAX(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_extendedprice END) AS top_returned,
       MAX(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN l_extendedprice END) AS top_open FROM lineitem GROUP BY 1
""")
def cond_pivot(t):
    def top(flag, status):
        return F.max(F.when((F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status), F.col("l_extendedprice")))
    return t.lineitem.groupBy("l_suppkey").agg(top("R", "F").alias("top_returned"), top("N", "O").alias("top_open"))


@query("""
SELECT c_custkey, 'name' AS facet, c_name AS text FROM customer
UNION ALL SELECT c_custkey, 'segment', NULLIF(c_mktsegment, 'BUILDING') FROM customer
""")
def unpivot_text(t):
    wide = t.customer.select("c_custkey", F.col("c_name").alias("name"),
                             tx.blank_to_null(F.replace("c_mktsegment", F.lit("BUILDING"), F.lit("  "))).alias("segment"))
    return wide.unpivot(["c_custkey"], ["name", "segment"], "facet", "text")


@query(f"""
WITH l AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, strftime(o_orderdate, '%Y-%m') ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT o_custkey, {msum('o_totalprice')} AS plan_total, COUNT(*) AS n_months FROM l GROUP BY 1
""")
def latest_sum(t):
    """Newest version of every month, then the sum."""
    m = t.orders.withColumn("m", dt.month_key(F.col("o_orderdate")))
    latest = latest_per_key(m, ["o_custkey", "m"], "o_orderdate", "o_orderkey")
    return latest.groupBy("o_custkey").agg(money_sum("o_totalprice").alias("plan_total"), F.count(F.lit(1)).alias("n_months"))


@query(f"""
SELECT o_custkey, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS INTEGER) AS q, COUNT(DISTINCT month(o_orderdate)) AS months_present,
  CASE WHEN COUNT(DISTINCT month(o_orderdate)) = 3 THEN {msum('o_totalprice')} END AS quarter_total FROM orders GROUP BY 1, 2
""")
def complete_quarter(t):
    monthly = t.orders.groupBy("o_custkey", dt.quarter_index(F.col("o_orderdate")).alias("q"),
                               F.month("o_orderdate").alias("m")).agg(money_sum("o_totalprice").alias("v"))
    return ag.complete_quarters(monthly, ["o_custkey"], "q", "m", "v")


@query("""
SELECT o_custkey, CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS filled FROM orders GROUP BY 1
""")
def null_sum(t):
    """All parts missing gives NULL, not 0."""
    return t.orders.groupBy("o_custkey").agg(
        money_sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("filled"))


@query("""
WITH s AS (SELECT l_returnflag AS brand, CAST(SUM(CASE WHEN year(l_shipdate) = 1998 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS cur,
  CAST(SUM(CASE WHEN year(l_shipdate) = 1997 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS prev FROM lineitem GROUP BY 1),
a AS (SELECT brand, cur, prev FROM s UNION ALL SELECT 'TOTAL', CAST(SUM(CAST(cur AS DECIMAL(28,2))) AS DOUBLE), CAST(SUM(CAST(prev AS DECIMAL(28,2))) AS DOUBLE) FROM s)
SELECT brand, cur, prev, (cur - prev) / abs(prev) AS yoy, cur / prev AS hit FROM a
""")
def ratio_of_sums(t):
    """The total row divides summed parts; it does not average the ratios."""
    def year(y):
        return money_sum(F.when(F.year("l_shipdate") == y, F.col("l_extendedprice")))
    s = t.lineitem.groupBy(F.col("l_returnflag").alias("brand")).agg(year(1998).alias("cur"), year(1997).alias("prev"))
    total = s.agg(*[F.sum(F.col(c).cast("decimal(28,2)")).cast("double").alias(c) for c in ("cur", "prev")]).withColumn(
        "brand", F.lit("TOTAL"))
    return s.unionByName(total).withColumns({
        "yoy": pct_change(F.col("cur"), F.col("prev")), "hit": F.try_divide(F.col("cur"), F.col("prev"))})


@query("""
WITH m AS (SELECT o_custkey, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS mon, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY 1, 2),
s AS (SELECT a.mon, COUNT(*) AS n_members, CAST(SUM(a.v) AS DOUBLE) AS now, CAST(SUM(b.v) AS DOUBLE) AS was FROM m a JOIN m b
  ON a.o_custkey = b.o_custkey AND a.mon = b.mon + 1 GROUP BY 1)
SELECT mon, n_members, (now - was) / was AS growth FROM s
""")
def same_basis_mom(t):
    m = t.orders.groupBy("o_custkey", dt.month_serial(F.col("o_orderdate")).cast("long").alias("mon")).agg(
        money_sum("o_totalprice").alias("v"))
    return ag.same_basis_growth(m, "o_custkey", "mon", "v")


@query("WITH " + CUSTOMER_QUARTERS_SQL + """
SELECT n_name, q, median(revenue) AS median_revenue FROM cq JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2
""")
def peer_median(t):
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    peers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey").join(nation, "c_nationkey")
    cq = customer_quarters(t).join(peers, "o_custkey")
    return ag.grouped_median(cq, ["n_name", "q"], "revenue", "median_revenue")


@query("""
WITH o AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, COUNT(*) AS mails, COUNT(*) FILTER (o_orderstatus = 'P') AS skipped FROM orders GROUP BY 1),
l AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, COUNT(*) AS items, COUNT(*) FILTER (l_returnflag = 'R') AS returned FROM lineitem GROUP BY 1)
SELECT month, COALESCE(mails, 0) AS mails, COALESCE(skipped, 0) AS skipped, COALESCE(items, 0) AS items, COALESCE(returned, 0) AS returned
FROM o FULL OUTER JOIN l USING (month)
""")
def month_funnel(t):
    o = t.orders.select(dt.month_key(F.col("o_orderdate")).alias("month"), "o_orderstatus")
    l = t.lineitem.select(dt.month_key(F.col("l_shipdate")).alias("month"), "l_returnflag")
    return ag.month_funnel({"mails": o, "skipped": o.where("o_orderstatus = 'P'"), "items": l,
                            "returned": l.where("l_returnflag = 'R'")}, "month")


@query("""
WITH c AS (SELECT COUNT(*) AS n FROM documents GROUP BY md5(text))
SELECT CAST(SUM(n) AS BIGINT) AS instances, COUNT(*) AS distinct_texts, CAST(SUM(n - 1) AS BIGINT) AS repeats, MAX(n) AS max_copies,
       round(SUM(n - 1) / SUM(n), 3) AS repeat_rate FROM c
""")
def dup_stats(t):
    return ag.copy_stats(t.documents.select(F.md5("text").alias("h")), ["h"])


@query("SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1")
def dup_keys(t):
    from fathomline.operators.upsert import duplicate_keys

    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
WITH c AS (SELECT l_orderkey, l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY n DESC) AS rk FROM c)
SELECT l_orderkey, CASE WHEN COUNT(*) = 1 THEN MIN(l_returnflag) END AS winner FROM r WHERE rk = 1 GROUP BY 1
""")
def majority_vote(t):
    return ag.majority(t.lineitem, ["l_orderkey"], "l_returnflag", "winner")


VOTE_WORDS = ["the", "der", "que", "pour", "license"]


@query("""
WITH v AS (SELECT doc_id, w, len(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x = w))
  + 3 * len(list_filter(regexp_split_to_array(lower(string_split(text, chr(10))[1]), '[^\\p{L}\\p{N}]+'), lambda x: x = w)) AS score
  FROM documents, (VALUES ('the'), ('der'), ('que'), ('pour'), ('license')) x(w)),
r AS (SELECT *, rank() OVER (PARTITION BY doc_id ORDER BY score DESC) AS rk FROM v)
SELECT doc_id, CASE WHEN COUNT(*) = 1 THEN MIN(w) END AS winner FROM r WHERE rk = 1 GROUP BY 1
""")
def weighted_vote(t):
    """A hit in the body counts 1, in the subject (first line) 3; an equal top gives NULL."""
    hint = hints.weighted_hint(F.lower("text"), F.lower(F.substring_index("text", "\n", 1)), VOTE_WORDS)
    return t.documents.select("doc_id", hint.alias("winner"))


@query("""
SELECT l_orderkey, MIN(l_suppkey) AS party FROM lineitem GROUP BY 1 HAVING COUNT(DISTINCT l_suppkey) = 1
""")
def single_party(t):
    return ag.single_value(t.lineitem, "l_orderkey", "l_suppkey", "party")


@query("""
WITH c AS (SELECT c_mktsegment AS grp, o_orderpriority AS topic, COUNT(*) AS n, COUNT(DISTINCT o_custkey) AS u, MIN(CAST(o_orderdate AS DATE)) AS d1,
  MAX(CAST(o_orderdate AS DATE)) AS d2, COUNT(*) FILTER (o_orderstatus = 'F') AS f FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
t AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY n DESC, topic) AS rn FROM c),
m AS (SELECT c_mktsegment AS grp, COUNT(DISTINCT o_custkey) AS members FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1)
SELECT grp, CAST(SUM(n) AS BIGINT) AS n_items, MIN(d1) AS first_day, MAX(d2) AS last_day, CAST(SUM(f) AS BIGINT) AS n_f, any_value(members) AS members,
  string_agg(topic || ':' || n, ',' ORDER BY rn) FILTER (rn <= 3) AS top_topics FROM t JOIN m USING (grp) GROUP BY 1
""")
def group_profile(t):
    """Items, members, span, top-3 topics and flagged items per group, from one pre-aggregation
    at the (group, topic, member) grain."""
    seg = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("grp"))
    fine = t.orders.groupBy("o_custkey", F.col("o_orderpriority").alias("topic")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.to_date("o_orderdate")).alias("d1"), F.max(F.to_date("o_orderdate")).alias("d2"),
        F.count_if(F.col("o_orderstatus") == "F").alias("f")).join(seg, "o_custkey")
    topics = fine.groupBy("grp", "topic").agg(F.sum("n").alias("n"), F.min("d1").alias("d1"), F.max("d2").alias("d2"),
                                              F.sum("f").alias("f"))
    members = fine.groupBy("grp", "o_custkey").agg(F.lit(1).alias("one")).groupBy("grp").agg(F.count("one").alias("members"))
    top = top_n_ranked(topics, ["grp"], [F.desc("n"), F.asc("topic")], 3, "rn").groupBy("grp").agg(
        F.array_sort(F.collect_list(F.struct("rn", F.concat("topic", F.lit(":"), F.col("n").cast("string")).alias("s")))).alias("a"))
    totals = topics.groupBy("grp").agg(F.sum("n").alias("n_items"), F.min("d1").alias("first_day"),
                                       F.max("d2").alias("last_day"), F.sum("f").alias("n_f"))
    return totals.join(members, "grp").join(top, "grp").withColumn(
        "top_topics", F.array_join(F.transform("a", lambda x: x["s"]), ",")).drop("a")


@query("""
WITH b AS (SELECT o_orderstatus AS app, strftime(o_orderdate, '%Y-%m') AS month, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS brands,
   MIN(CAST(o_orderdate AS DATE)) AS first_submit, MAX(CAST(o_orderdate AS DATE)) AS last_submit, COUNT(*) AS n_rows FROM orders GROUP BY 1, 2),
s AS (SELECT CASE l_linestatus WHEN 'O' THEN 'O' ELSE 'F' END AS app, strftime(l_shipdate, '%Y-%m') AS month, COUNT(*) AS n_text FROM lineitem GROUP BY 1, 2)
SELECT app, month, brands, first_submit, last_submit, COALESCE(n_rows, 0) AS n_rows, n_text IS NOT NULL AS has_summary FROM b FULL OUTER JOIN s USING (app, month)
""")
def period_state(t):
    day = F.to_date("o_orderdate")
    b = t.orders.groupBy(F.col("o_orderstatus").alias("app"), dt.month_key(F.col("o_orderdate")).alias("month")).agg(
        F.array_join(F.array_sort(F.collect_set("o_orderpriority")), "|").alias("brands"), F.min(day).alias("first_submit"),
        F.max(day).alias("last_submit"), F.count(F.lit(1)).alias("n_rows"))
    s = t.lineitem.select(F.when(F.col("l_linestatus") == "O", F.lit("O")).otherwise(F.lit("F")).alias("app"),
                          dt.month_key(F.col("l_shipdate")).alias("month")).groupBy("app", "month").agg(
        F.lit(True).alias("has_summary"))
    return b.join(s, ["app", "month"], "full_outer").fillna(0, ["n_rows"]).withColumn(
        "has_summary", F.coalesce("has_summary", F.lit(False)))


@query("SELECT p_brand, MIN(p_name) AS alias FROM part GROUP BY 1")
def min_alias(t):
    return t.part.groupBy("p_brand").agg(F.min("p_name").alias("alias"))


@query("""
SELECT d.source, MAX(quality) = 1 AS has_y, MAX(quality) = 0 AS all_n, COUNT(*) AS n_votes FROM labels JOIN documents d USING (doc_id) GROUP BY 1
""")
def flag_rollup(t):
    src = t.documents.select("doc_id", "source")
    return t.labels.join(src, "doc_id").groupBy("source").agg(
        (F.max("quality") == 1).alias("has_y"), (F.max("quality") == 0).alias("all_n"), F.count(F.lit(1)).alias("n_votes"))


@query("""
WITH f AS (SELECT o_custkey, MAX(CAST(strftime(o_orderdate, '%Y%m') AS BIGINT)) AS last_period, bool_or(strftime(o_orderdate, '%Y%m') = '200106') AS filed
  FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-01' GROUP BY 1)
SELECT c_custkey, COALESCE(filed, false) AS filed, last_period,
  CASE WHEN filed THEN 'filed' WHEN last_period IS NULL THEN 'no submission' ELSE 'last ' || last_period END AS note
FROM customer LEFT JOIN f ON o_custkey = c_custkey
""")
def filing_completeness(t):
    period = dt.period_int(F.col("o_orderdate")).cast("long")
    f = t.orders.where("o_orderdate < TIMESTAMP_NTZ'2001-07-01'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max(period).alias("last_period"))
    filed = F.coalesce(F.col("last_period") == 200106, F.lit(False))
    note = F.when(filed, F.lit("filed")).when(F.col("last_period").isNull(), F.lit("no submission")).otherwise(
        F.concat(F.lit("last "), F.col("last_period").cast("string")))
    return t.customer.select("c_custkey").join(f, "c_custkey", "left").select(
        "c_custkey", filed.alias("filed"), "last_period", note.alias("note"))


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS period, COUNT(*) FILTER (event_type = 'error') AS n_null, COUNT(*) FILTER (event_type <> 'error') AS n_filled
FROM events GROUP BY 1
""")
def null_timeline(t):
    return ag.blank_share(t.events, F.date_format("ts", "yyyy-MM-dd"), F.nullif("event_type", F.lit("error")))


@query("SELECT CAST(0 AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS pct, CAST(NULL AS DOUBLE) AS top FROM (SELECT COUNT(*) FROM orders WHERE o_totalprice < 0)")
def safe_rates(t):
    """One row even without input; 0/0 is NULL."""
    empty = t.orders.where("o_totalprice < 0")
    n, f = F.count(F.lit(1)), F.count_if(F.col("o_orderstatus") == "F")
    return empty.agg(n.alias("n"), F.try_divide(f, n).alias("pct"), F.max("o_totalprice").alias("top"))


@query("""
SELECT strftime(l_shipdate, '%Y-%m') AS month, l_linestatus AS app, COUNT(*) AS cells, COUNT(*) FILTER (l_returnflag = 'A') AS both_sides,
  COUNT(*) FILTER (l_returnflag = 'N') AS one_side, COUNT(*) FILTER (l_returnflag = 'R' AND l_discount < 0.05) AS pending,
  COUNT(*) FILTER (l_returnflag = 'R' AND l_discount >= 0.05) AS reviewed, MIN(CAST(l_shipdate AS DATE)) AS win_start,
  MAX(CAST(l_shipdate AS DATE)) AS win_end, string_agg(DISTINCT l_returnflag, '|' ORDER BY l_returnflag) AS brands FROM lineitem GROUP BY 1, 2
""")
def cell_summary(t):
    flag, day = F.col("l_returnflag"), F.to_date("l_shipdate")
    return t.lineitem.groupBy(dt.month_key(F.col("l_shipdate")).alias("month"), F.col("l_linestatus").alias("app")).agg(
        F.count(F.lit(1)).alias("cells"), count_where(flag == "A").alias("both_sides"), count_where(flag == "N").alias("one_side"),
        count_where((flag == "R") & (F.col("l_discount") < 0.05)).alias("pending"),
        count_where((flag == "R") & (F.col("l_discount") >= 0.05)).alias("reviewed"), F.min(day).alias("win_start"),
        F.max(day).alias("win_end"), F.array_join(F.array_sort(F.collect_set(flag)), "|").alias("brands"))
