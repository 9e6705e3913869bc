"""Orders, limits, picks and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fathomline.catalog.c01_sources import _DIMENSION_SQL, _customer_dimension
from fathomline.catalog.registry import query
from fathomline.functions import dates as dt
from fathomline.functions import rules
from fathomline.operators import picks
from fathomline.operators import upsert as up
from fathomline.operators.keyed import pick_per_key, top_n_ranked
from fathomline.operators.numbering import row_numbers


@query("""
SELECT o_orderkey, o_orderdate, row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderdate, o_orderkey) AS no FROM orders
""")
def total_order(t):
    """Numbers in a total order per year; every tie is broken by the key."""
    o = t.orders.select("o_orderkey", "o_orderdate", F.year("o_orderdate").alias("y"))
    return row_numbers(o, ["y"], [F.col("o_orderdate"), F.col("o_orderkey")], "no").drop("y")


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 50 OFFSET 100")
def page_rows(t):
    return picks.take_range(t.orders.select("o_orderkey", "o_orderdate"),
                            [F.col("o_orderdate"), F.col("o_orderkey")], 101, 150)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_k(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("""
WITH r AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '5-LOW' THEN 3 ELSE 9 END AS relation_rank FROM orders)
SELECT o_orderkey, relation_rank, row_number() OVER (ORDER BY relation_rank, o_orderkey) AS no FROM r
""")
def enum_order(t):
    """Every order with its place in the given order of the values; unknown ones last."""
    rank = F.coalesce(rules.ordinal_rank(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH", "5-LOW"]), F.lit(9)).cast("int")
    o = t.orders.select("o_orderkey", rank.alias("relation_rank"))
    return row_numbers(o, [], [F.col("relation_rank"), F.col("o_orderkey")], "no")


@query("""
WITH c AS (SELECT c_custkey, NULLIF(c_mktsegment, 'HOUSEHOLD') AS alias FROM customer)
SELECT c_custkey, alias, row_number() OVER (ORDER BY length(alias) DESC NULLS LAST, c_custkey DESC) AS no FROM c
""")
def nulls_last(t):
    """Every customer with its place: longest alias first, no alias last."""
    c = t.customer.select("c_custkey", F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("alias"))
    return row_numbers(c, [], [F.desc_nulls_last(F.length("alias")), F.desc("c_custkey")], "no")


@query("SELECT doc_id, lang FROM documents ORDER BY md5('7|' || doc_id), doc_id LIMIT 25")
def hash_sample(t):
    """Seeded sample that any run and any partitioning repeats."""
    return picks.hash_sample(t.documents.select("doc_id", "lang"), "doc_id", 7, 25)


@query("""
WITH d AS (SELECT d.doc_id, d.lang, string_split(text, chr(10))[1] AS summary, COALESCE(l.toxic, 0) AS urgent, COALESCE(l.quality, 0) AS conf
           FROM documents d LEFT JOIN labels l USING (doc_id)),
u AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY lang, sha1(summary) ORDER BY urgent DESC, conf DESC, doc_id DESC) = 1)
SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY urgent DESC, conf DESC, doc_id DESC) AS rank_no FROM u QUALIFY rank_no <= 5
""")
def highlights(t):
    """Most telling rows per group, one per identical summary."""
    d = t.documents.select("doc_id", "lang", F.sha1(F.substring_index("text", "\n", 1)).alias("summary")).join(
        t.labels, "doc_id", "left").fillna(0, ["toxic", "quality"])
    order = [F.desc("toxic"), F.desc("quality"), F.desc("doc_id")]
    unique = pick_per_key(d, ["lang", "summary"], order)
    return top_n_ranked(unique, ["lang"], order, 5).select("lang", "doc_id", F.col("rank_no").cast("long").alias("rank_no"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderdate, o_orderkey LIMIT 400")
def batch_cap(t):
    """Oldest pending rows up to the budget of one run; the rest stays pending."""
    return picks.budgeted(t.orders.where("o_orderstatus = 'P'"), [F.col("o_orderdate"), F.col("o_orderkey")], 400).select("o_orderkey")


@query("""
WITH g AS (SELECT c_mktsegment AS app, c_nationkey AS grp, COUNT(*) AS n FROM customer GROUP BY 1, 2)
SELECT app, grp, n, row_number() OVER (PARTITION BY app ORDER BY n DESC, grp) AS pos,
       CASE app WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 ELSE 9 END AS app_rank FROM g
""")
def group_order(t):
    """Fixed order of apps with unknown ones last; inside an app by size, then name."""
    g = t.customer.groupBy(F.col("c_mktsegment").alias("app"), F.col("c_nationkey").alias("grp")).agg(F.count(F.lit(1)).alias("n"))
    pos = F.row_number().over(Window.partitionBy("app").orderBy(F.desc("n"), F.asc("grp")))
    rank = F.coalesce(rules.ordinal_rank(F.col("app"), ["BUILDING", "MACHINERY"]), F.lit(9))
    return g.withColumns({"pos": pos.cast("long"), "app_rank": rank.cast("int")})


@query("""
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day, array_to_string(list_filter([CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' END,
  CASE WHEN o_totalprice > 400000 THEN 'large' END, CASE WHEN o_orderstatus = 'P' THEN 'open' END], lambda x: x IS NOT NULL), ';') AS reasons
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) <= 2
""")
def timeline_pick(t):
    early = pick_per_key(t.orders, ["o_custkey"], [F.asc("o_orderdate"), F.asc("o_orderkey")], 2)
    reasons = F.concat_ws(";", F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("urgent")),
                          F.when(F.col("o_totalprice") > 400000, F.lit("large")),
                          F.when(F.col("o_orderstatus") == "P", F.lit("open")))
    return early.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"), reasons.alias("reasons"))


@query("""
SELECT c_custkey AS k, c_name AS name, 'annual' AS kind FROM customer UNION ALL SELECT s_suppkey, s_name, 'quarterly' FROM supplier
""")
def union_by_name(t):
    a = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.lit("annual").alias("kind"))
    b = t.supplier.select(F.lit("quarterly").alias("kind"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("k"))
    return a.unionByName(b)


@query("""
SELECT c_custkey AS k, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier
""")
def union_missing(t):
    a = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("balance"))
    return a.unionByName(b, allowMissingColumns=True)


@query("""
SELECT c_nationkey AS k, 'customer' AS level, COUNT(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT s_nationkey, 'supplier', COUNT(*) FROM supplier GROUP BY 1
""")
def union_all(t):
    return t.spark.sql("""
        SELECT c_nationkey AS k, 'customer' AS level, COUNT(*) AS n FROM {c} GROUP BY c_nationkey
        UNION ALL SELECT s_nationkey, 'supplier', COUNT(*) FROM {s} GROUP BY s_nationkey""", c=t.customer, s=t.supplier)


@query("SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def distinct_rows(t):
    return t.orders.select("o_custkey", "o_orderpriority").distinct()


@query("SELECT l_orderkey, MIN(l_linenumber) AS l_linenumber FROM lineitem GROUP BY 1")
def drop_duplicates(t):
    """One row per key; which one is fixed by an order, so reruns agree."""
    return pick_per_key(t.lineitem.select("l_orderkey", "l_linenumber"), ["l_orderkey"], [F.asc("l_linenumber")])


@query("""
SELECT strftime(o_orderdate, '%Y-%m') AS p FROM orders WHERE o_totalprice > 470000 INTERSECT SELECT strftime(l_shipdate, '%Y-%m') FROM lineitem WHERE l_quantity = 50
INTERSECT SELECT strftime(o_orderdate, '%Y-%m') FROM orders WHERE o_orderstatus = 'P'
""")
def intersect_periods(t):
    m = dt.month_key
    a = t.orders.where("o_totalprice > 470000").select(m(F.col("o_orderdate")).alias("p"))
    b = t.lineitem.where("l_quantity = 50").select(m(F.col("l_shipdate")).alias("p"))
    c = t.orders.where("o_orderstatus = 'P'").select(m(F.col("o_orderdate")).alias("p"))
    return a.intersect(b).intersect(c)


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'")
def except_keys(t):
    gone = t.orders.where("o_orderdate >= TIMESTAMP_NTZ'1999-01-01'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").join(gone, "c_custkey", "left_anti")


@query(_DIMENSION_SQL + """
SELECT CASE WHEN t.c_custkey IS NULL THEN 'insert' WHEN s.c_custkey IS NULL THEN 'deactivate' WHEN s.c_mktsegment <> t.c_mktsegment THEN 'update' ELSE 'same' END AS action,
  COUNT(*) AS n FROM t FULL OUTER JOIN s ON t.c_custkey = s.c_custkey GROUP BY 1
""")
def dim_diff(t):
    target, source = _customer_dimension(t)
    return up.dimension_diff(target, source, ["c_custkey"], ["c_mktsegment"])
