"""Data quality gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.catalog.c01_sources import events_raw
from fathomline.catalog.registry import query
from fathomline.functions import text as tx
from fathomline.operators import gates


@query(r"""
WITH c AS (
SELECT 'order_key_unique' AS check_name, CAST(COUNT(*) - COUNT(DISTINCT o_orderkey) AS BIGINT) AS n_bad FROM orders
UNION ALL SELECT 'line_key_unique', COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL SELECT 'status_in_enum', COUNT(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F')
UNION ALL SELECT 'price_positive', COUNT(*) FROM orders WHERE o_totalprice <= 0
UNION ALL SELECT 'customer_resolves', COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'no_mail_left', COUNT(*) FROM documents WHERE regexp_matches(text, '[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+'))
SELECT check_name, n_bad, n_bad = 0 AS ok FROM c
""")
def quality_checks(t):
    """Keys unique, values in their lists, references resolve, no address left; each table is read once."""
    return gates.all_checks(
        gates.table_checks(t.orders, ["o_orderkey"], "order_key_unique", {"status_in_enum": ~F.col("o_orderstatus").isin("O", "F"), "price_positive": F.col("o_totalprice") <= 0},
                           {"customer_resolves": ("o_custkey", t.customer, "c_custkey")}),
        gates.unique_key(t.lineitem, ["l_orderkey", "l_linenumber"], "line_key_unique"),
        gates.check_rows(t.documents, {"no_mail_left": tx.has_email(F.col("text"))}))


@query("""
SELECT strftime(ts, '%Y%m%d') AS batch_id, COUNT(*) AS n_rows, COUNT(*) FILTER (length(props) = 0) AS n_empty, COUNT(*) - COUNT(DISTINCT event_id) AS n_repeated,
  COUNT(*) FILTER (event_type IS NULL) AS n_untyped, true AS ok FROM events GROUP BY 1
""")
def raw_checks(t):
    """Per batch: payloads present, paths unique, every record typed."""
    per_path = events_raw(t).groupBy("batch_id", "batch_path").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.length("payload") == 0).alias("e"), F.count_if(F.col("record_type").isNull()).alias("u"))
    out = per_path.groupBy("batch_id").agg(F.sum("n").alias("n_rows"), F.sum("e").alias("n_empty"), F.sum(F.col("n") - 1).alias("n_repeated"), F.sum("u").alias("n_untyped"))
    return out.withColumn("ok", (F.col("n_empty") == 0) & (F.col("n_repeated") == 0) & (F.col("n_untyped") == 0))


@query("""
WITH c AS (SELECT 'orders' AS table_name, 'key_null' AS check_name, COUNT(*) FILTER (o_orderkey IS NULL) AS n_bad FROM orders
UNION ALL SELECT 'orders', 'period_range', COUNT(*) FILTER (o_orderdate < TIMESTAMP '1996-01-01') FROM orders
UNION ALL SELECT 'lineitem', 'key_null', COUNT(*) FILTER (l_orderkey IS NULL OR l_linenumber IS NULL) FROM lineitem
UNION ALL SELECT 'lineitem', 'discount_range', COUNT(*) FILTER (l_discount > 0.09) FROM lineitem)
SELECT table_name, check_name, n_bad, n_bad = 0 AS ok FROM c
""")
def typed_checks(t):
    specs = {
        "orders": {"key_null": F.col("o_orderkey").isNull(), "period_range": F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")},
        "lineitem": {"key_null": F.col("l_orderkey").isNull() | F.col("l_linenumber").isNull(), "discount_range": F.col("l_discount") > 0.09},
    }
    return gates.all_checks(*[gates.check_rows(getattr(t, n), c).select(F.lit(n).alias("table_name"), "check_name", "n_bad", "ok") for n, c in specs.items()])


@query("""
SELECT 'regions' AS name, 5.0::DOUBLE AS expected, CAST(COUNT(*) AS DOUBLE) AS actual, COUNT(*) = 5 AS ok FROM region
UNION ALL SELECT 'nations', 24.0::DOUBLE, COUNT(*), COUNT(*) = 24 FROM nation
UNION ALL SELECT 'discount share', 0.05::DOUBLE, AVG(CAST(l_discount AS DECIMAL(18,2))), abs(AVG(CAST(l_discount AS DECIMAL(18,2))) - 0.05) <= 0.000001 FROM lineitem WHERE l_discount = 0.05
""")
def expected_values(t):
    """Listed queries against listed numbers with a tolerance."""
    listed = [("regions", 5.0, "SELECT COUNT(*) FROM {region}"), ("nations", 24.0, "SELECT COUNT(*) FROM {nation}"),
              ("discount share", 0.05, "SELECT AVG(CAST(l_discount AS DECIMAL(18,2))) FROM {lineitem} WHERE l_discount = 0.05")]
    tables = {"region": t.region, "nation": t.nation, "lineitem": t.lineitem}
    parts = []
    for name, expected, sql in listed:
        used = {k: v for k, v in tables.items() if "{" + k + "}" in sql}
        value = t.spark.sql(sql, **used).toDF("v")
        parts.append(value.select(F.lit(name).alias("name"), F.lit(expected).alias("expected"), F.col("v").cast("double").alias("actual"),
                                  gates.close_to(F.col("v"), F.lit(expected)).alias("ok")))
    return gates.all_checks(*parts)


@query("""
WITH c AS (SELECT COUNT(*) AS n FROM documents GROUP BY sha1(text)), d AS (SELECT SUM(n - 1) / SUM(n) AS dup FROM c),
r AS (SELECT AVG(CAST(n_chars < 150 AS INT)) AS short, AVG(CAST(lang <> 'en' AS INT)) AS foreign_share FROM documents)
SELECT 'duplicates' AS measure, dup AS value, CASE WHEN dup > 0.8 THEN 'stop' WHEN dup > 0.05 THEN 'warn' ELSE 'ok' END AS verdict FROM d
UNION ALL SELECT 'short', short, CASE WHEN short > 0.2 THEN 'warn' ELSE 'ok' END FROM r
UNION ALL SELECT 'foreign_share', foreign_share, CASE WHEN foreign_share > 0.1 THEN 'stop' ELSE 'ok' END FROM r
""")
def threshold_gates(t):
    """Rates against warn and stop limits, from one pre-aggregation per text hash."""
    per = t.documents.groupBy(F.sha1("text").alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_chars") < 150).alias("s"), F.count_if(F.col("lang") != "en").alias("f"))
    rates = per.agg((F.sum(F.col("n") - 1) / F.sum("n")).alias("duplicates"), (F.sum("s") / F.sum("n")).alias("short"), (F.sum("f") / F.sum("n")).alias("foreign_share"))
    return gates.graded(rates, {"duplicates": (0.05, 0.8), "short": (0.2, None), "foreign_share": (None, 0.1)})
