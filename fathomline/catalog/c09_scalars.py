"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.catalog.registry import query
from fathomline.functions import dates as dt
from fathomline.functions import jsons, rules
from fathomline.functions import numbers as nm
from fathomline.functions import text as tx


@query("""
SELECT p_partkey, trim('  ' || p_name || ' ') AS t, upper(p_name) AS u, length(p_name) AS n, substring(p_name, 2, 3) AS s,
  p_brand || '/' || p_type AS c, lpad(CAST(p_size AS VARCHAR), 3, '0') AS padded FROM part
""")
def string_basic(t):
    return t.part.select(
        "p_partkey", F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("t"), F.upper("p_name").alias("u"),
        F.length("p_name").cast("long").alias("n"), F.substring("p_name", 2, 3).alias("s"),
        F.concat_ws("/", "p_brand", "p_type").alias("c"), F.lpad(F.col("p_size").cast("string"), 3, "0").alias("padded"))


@query("SELECT doc_id, NULLIF(trim(CASE WHEN lang = 'en' THEN '   ' ELSE source END), '') AS v FROM documents")
def blank_null(t):
    return t.documents.select("doc_id", tx.blank_to_null(
        F.when(F.col("lang") == "en", F.lit("   ")).otherwise(F.col("source"))).alias("v"))


@query("""
SELECT doc_id, length(regexp_replace(text, '[aeiou]+', '#', 'g')) AS n_masked, regexp_extract(text, '([A-Z][a-z]+) ([a-z]+)', 2) AS second_word,
  len(regexp_extract_all(text, '[0-9]+')) AS n_numbers, regexp_matches(text, 'License') AS has_license FROM documents
""")
def regex_ops(t):
    return t.documents.select(
        "doc_id", F.length(F.regexp_replace("text", "[aeiou]+", "#")).cast("long").alias("n_masked"),
        F.regexp_extract("text", "([A-Z][a-z]+) ([a-z]+)", 2).alias("second_word"),
        tx.count_matches(F.col("text"), "[0-9]+").cast("long").alias("n_numbers"), F.col("text").rlike("License").alias("has_license"))


@query("SELECT page_id, string_split(regexp_extract(url, '^[^?#]*'), '/')[-1] AS tail FROM pages")
def path_tail(t):
    return t.pages.select("page_id", F.try_element_at(F.split(F.regexp_extract("url", "^[^?#]*", 0), "/"), F.lit(-1)).alias("tail"))


@query("SELECT doc_id, 'ABC 0-9! ' || source AS half, lower('abc 0-9! ' || source) AS norm FROM documents")
def fullwidth(t):
    wide = F.concat(F.lit("ＡＢＣ　０－９！ "), "source")
    return t.documents.select("doc_id", tx.halfwidth(wide).alias("half"), tx.alias_norm(wide).alias("norm"))


@query("SELECT c_custkey, regexp_replace(regexp_replace(c_name, '[0-9]', '9', 'g'), '[A-Za-z]', 'A', 'g') || '中' AS shape FROM customer")
def shape_mask(t):
    return t.customer.select("c_custkey", tx.shape(F.concat("c_name", F.lit("漢"))).alias("shape"))


@query(r"""
SELECT doc_id, md5(text) AS m, sha1(text) AS s1, sha256(text) AS s2,
  CASE WHEN length(text) >= 150 THEN sha1(lower(regexp_replace(text, '[\p{P}\p{Z}\p{C}]', '', 'g'))) END AS content_hash FROM documents
""")
def hash_keys(t):
    return t.documents.select("doc_id", F.md5("text").alias("m"), F.sha1("text").alias("s1"), F.sha2("text", 256).alias("s2"),
                              tx.content_hash(F.col("text")).alias("content_hash"))


@query("""
SELECT p_partkey, starts_with(p_name, 'red') AS a, ends_with(p_name, 'ring') AS b, contains(p_name, 'olt') AS c, p_type LIKE 'S%L' AS d FROM part
""")
def string_match(t):
    n = F.col("p_name")
    return t.part.select("p_partkey", n.startswith("red").alias("a"), n.endswith("ring").alias("b"), n.contains("olt").alias("c"),
                         F.col("p_type").like("S%L").alias("d"))


@query("""
SELECT event_id, CAST(ts AS DATE) AS d, CASE WHEN event_type <> 'error' THEN date_trunc('minute', ts) END AS m FROM events
""")
def parse_dates(t):
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.date_format("ts", "yyyy/MM/dd HH:mm"))
    return t.events.select("event_id", dt.date_or_null(F.date_format("ts", "yyyy-MM-dd")).alias("d"),
                           F.try_to_timestamp(text, F.lit("yyyy/MM/dd HH:mm")).cast("timestamp_ntz").alias("m"))


@query("""
SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 'view' THEN strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S')
  ELSE strftime(ts - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') END AS utc FROM events
""")
def iso_to_utc(t):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (F.when(F.col("event_type") == "error", F.lit("  ")).when(F.col("event_type") == "click", F.concat(iso, F.lit("Z")))
            .when(F.col("event_type") == "view", F.concat(iso, F.lit("+02:00"))).otherwise(iso))
    instant = F.convert_timezone(F.current_timezone(), F.lit("UTC"), dt.iso_to_utc(text).cast("timestamp_ntz"))
    return t.events.select("event_id", F.date_format(instant, "yyyy-MM-dd HH:mm:ss").alias("utc"))


@query("""
SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start, strftime(o_orderdate, '%G-W%V') AS iso_week, year(o_orderdate) AS y, quarter(o_orderdate) AS q FROM orders
""")
def iso_week(t):
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", dt.week_start(d).alias("week_start"), dt.iso_week(d).alias("iso_week"),
                           F.year(d).cast("long").alias("y"), F.quarter(d).cast("long").alias("q"))


@query("""
SELECT o_orderkey, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS age, CAST(CAST(o_orderdate AS DATE) + INTERVAL 10 DAY AS DATE) AS plus10,
  CAST(CAST(o_orderdate AS DATE) - INTERVAL 3 DAY AS DATE) AS minus3, len(range(date_trunc('week', o_orderdate), TIMESTAMP '2001-08-06', INTERVAL 7 DAY)) AS weeks FROM orders
""")
def date_math(t):
    d = F.to_date("o_orderdate")
    weeks = F.size(F.sequence(dt.week_start(F.col("o_orderdate")), F.lit("2001-07-30").cast("date"), F.expr("INTERVAL 7 DAYS")))
    return t.orders.select("o_orderkey", F.datediff(d, F.lit("1995-01-01").cast("date")).cast("long").alias("age"),
                           F.date_add(d, 10).alias("plus10"), F.date_sub(d, 3).alias("minus3"), weeks.cast("long").alias("weeks"))


@query("""
WITH a AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN year(o_orderdate) || '-Q' || quarter(o_orderdate) WHEN 'O' THEN strftime(o_orderdate, '%Y-%m') ELSE 'soon' END AS as_of, o_orderstatus,
  year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS q FROM orders)
SELECT o_orderkey, as_of, CASE WHEN o_orderstatus <> 'P' THEN 2001 * 4 + 2 - q END AS age, CASE WHEN o_orderstatus <> 'P' THEN 2001 * 4 + 2 - q > 2 END AS retire FROM a
""")
def quarter_age(t):
    d = F.col("o_orderdate")
    as_of = F.when(F.col("o_orderstatus") == "F", dt.quarter_key(d)).when(F.col("o_orderstatus") == "O", dt.month_key(d)).otherwise(F.lit("soon"))
    age = F.lit(2001 * 4 + 2) - dt.quarter_index_of_text(F.col("as_of"))
    return t.orders.select("o_orderkey", as_of.alias("as_of")).select(
        "o_orderkey", "as_of", age.cast("long").alias("age"), (age > 2).alias("retire"))


@query("""
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS first_day, last_day(o_orderdate) AS last_day, strftime(o_orderdate + INTERVAL 2 MONTH, '%Y-%m') AS plus2,
  least(last_day(o_orderdate), CAST(date_trunc('month', o_orderdate) + INTERVAL 29 DAY AS DATE)) AS day30 FROM orders
""")
def month_windows(t):
    d = F.to_date("o_orderdate")
    first = F.trunc(d, "month")
    return t.orders.select("o_orderkey", first.alias("first_day"), F.last_day(d).alias("last_day"),
                           dt.month_key(F.add_months(d, 2)).alias("plus2"), F.least(F.last_day(d), F.date_add(first, 29)).alias("day30"))


@query("""
WITH x AS (SELECT l_orderkey, l_linenumber, l_shipdate, CAST(o_orderdate AS DATE) AS anchor, month(l_shipdate) AS m, day(l_shipdate) AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
g AS (SELECT *, TRY_CAST(year(anchor) || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-' || lpad(CAST(d AS VARCHAR), 2, '0') AS DATE) AS guess FROM x)
SELECT l_orderkey, l_linenumber, l_shipdate, CASE WHEN guess - anchor > 7 THEN CAST(guess - INTERVAL 12 MONTH AS DATE) ELSE guess END AS inferred FROM g
""")
def infer_year(t):
    """Month and day without a year, dated by the order they belong to."""
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("anchor"))
    x = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate").join(o, "l_orderkey")
    return x.select("l_orderkey", "l_linenumber", "l_shipdate", dt.inferred_date(
        F.month("l_shipdate"), F.dayofmonth("l_shipdate"), F.col("anchor")).alias("inferred"))


@query("""
SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN date_trunc('day', ts) ELSE date_trunc('minute', ts) END AS parsed FROM events
""")
def datetime_forms(t):
    """English long form, the Chinese form with half days, a date without time, and other text."""
    en = F.date_format("ts", "EEEE, MMMM d, yyyy h:mm a")
    zh = F.concat(F.date_format("ts", "yyyy"), F.lit("年"), F.date_format("ts", "M"), F.lit("月"), F.date_format("ts", "d"), F.lit("日 "),
                  F.when(F.hour("ts") < 12, F.lit("上午 ")).otherwise(F.lit("下午 ")),
                  F.when(F.hour("ts") > 12, F.hour("ts") - 12).otherwise(F.hour("ts")).cast("string"), F.date_format("ts", ":mm"))
    text = (F.when(F.col("event_type") == "error", F.lit("tomorrow at noon")).when(F.col("event_type") == "view", zh)
            .when(F.col("event_type") == "signup", F.date_format("ts", "MMMM d, yyyy")).otherwise(en))
    return t.events.select("event_id", dt.mail_datetime(text).alias("parsed"))


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, greatest(l_quantity, 25) AS g, least(l_discount, l_tax) AS l, abs(l_discount - 0.05) AS a,
  l_extendedprice / NULLIF(l_discount, 0) AS r FROM lineitem
""")
def math_guard(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", F.greatest("l_quantity", F.lit(25.0)).alias("g"), F.least("l_discount", "l_tax").alias("l"),
                             F.abs(F.col("l_discount") - 0.05).alias("a"), F.try_divide("l_extendedprice", "l_discount").alias("r"))


@query("""
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 1e5 WHEN 'MACHINERY' THEN 1e6 WHEN 'FURNITURE' THEN 1e8 ELSE 1.0 END AS divisor,
  c_acctbal / CASE c_mktsegment WHEN 'BUILDING' THEN 1e5 WHEN 'MACHINERY' THEN 1e6 WHEN 'FURNITURE' THEN 1e8 ELSE 1.0 END AS scaled FROM customer
""")
def money_scale(t):
    seg = F.col("c_mktsegment")
    cur = rules.map_value(seg, {"BUILDING": "twd", "MACHINERY": "USD", "FURNITURE": "JPY", "HOUSEHOLD": "EUR", "AUTOMOBILE": "USD"})
    unit = rules.map_value(seg, {"BUILDING": "thousand", "HOUSEHOLD": "million", "AUTOMOBILE": "million"}, F.lit("one"))
    d = nm.money_scale(cur, unit)
    return t.customer.select("c_custkey", d.alias("divisor"), (F.col("c_acctbal") / d).alias("scaled"))


@query("""
WITH w AS (SELECT doc_id, list_distinct(regexp_extract_all(text, '[a-z]+')) AS a, list_distinct(regexp_extract_all(string_split(text, chr(10))[1], '[a-z]+')) AS b FROM documents)
SELECT doc_id, len(a) AS n_a, len(list_intersect(a, b)) AS n_both, list_has_any(a, ['the', 'der']) AS hit, list_contains(b, 'the') AS has_the,
  (SELECT MAX(x) FROM unnest(a) u(x)) AS top FROM w
""")
def array_ops(t):
    a = F.array_distinct(F.regexp_extract_all("text", F.lit("([a-z]+)"), 1))
    b = F.array_distinct(F.regexp_extract_all(F.substring_index("text", "\n", 1), F.lit("([a-z]+)"), 1))
    w = t.documents.select("doc_id", a.alias("a"), b.alias("b"))
    return w.select("doc_id", F.size("a").cast("long").alias("n_a"), F.size(F.array_intersect("a", "b")).cast("long").alias("n_both"),
                    F.arrays_overlap("a", F.array(F.lit("the"), F.lit("der"))).alias("hit"), F.array_contains("b", "the").alias("has_the"),
                    F.array_max("a").alias("top"))


@query("""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)
SELECT doc_id, len(list_filter(ls, lambda x: trim(x) <> '')) AS n_lines, CAST(list_sum(list_transform(ls, lambda x: length(x))) AS BIGINT) AS n_chars,
  list_max(list_transform(ls, lambda x: length(x))) AS longest FROM l
""")
def higher_order(t):
    ls = F.split("text", "\n")
    return t.documents.select(
        "doc_id", F.size(F.filter(ls, lambda x: F.trim(x) != "")).cast("long").alias("n_lines"),
        F.aggregate(ls, F.lit(0).cast("long"), lambda acc, x: acc + F.length(x)).alias("n_chars"),
        F.array_max(F.transform(ls, F.length)).cast("long").alias("longest"))


@query("""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, string_split(text, chr(10))[i] AS line FROM (SELECT *, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)
""")
def explode_pos(t):
    return t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' END AS state, CAST(NULL AS VARCHAR) AS none FROM orders")
def map_lookup(t):
    return t.orders.select("o_orderkey", rules.map_value(F.col("o_orderstatus"), {"F": "filled", "O": "open"}).alias("state"),
                           rules.map_value(F.col("o_orderstatus"), {}).alias("none"))


@query("""
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS missing, '{"k":' || (props->>'$.k') || ',"type":"' || event_type || '"}' AS packed FROM events
""")
def json_path(t):
    p = F.from_json("props", "k INT")
    return t.events.select("event_id", jsons.path_text(F.col("props"), "$.k").alias("k"), jsons.path_text(F.col("props"), "$.no.such").alias("missing"),
                           F.to_json(F.struct(p["k"].alias("k"), F.col("event_type").alias("type"))).alias("packed"))


@query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN 0 ELSE 2 END AS n, CASE WHEN event_type <> 'error' THEN 1000.0 + CAST(props->>'$.k' AS INT) + value END AS total,
  CASE WHEN event_type = 'error' THEN '' ELSE 'kpcs|usd' END AS units FROM events
""")
def json_numbers(t):
    """Numbers listed as JSON: separators removed, booleans and objects skipped, bad text is empty."""
    k = F.get_json_object("props", "$.k").cast("int")
    listed = F.concat(F.lit('[{"value":"'), F.format_number(k + 1000, 0), F.lit('","unit":" Kpcs"},{"value":'), F.col("value").cast("string"),
                      F.lit(',"unit":"USD"},{"value":true},{"value":{"x":1},"unit":"a"}]'))
    text = F.when(F.col("event_type") == "error", F.lit("{broken")).otherwise(listed)
    nums = t.events.select("event_id", jsons.number_values(text).alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x["value"])
    return nums.select("event_id", F.size("v").alias("n"), F.when(F.size("v") > 0, total).alias("total"),
                       F.array_join(F.transform("v", lambda x: x["unit"]), "|").alias("units"))


@query("SELECT doc_id, array_to_string(regexp_extract_all(text, '[A-Z][a-z]{9,}'), ', ') AS names FROM documents", name="array_join")
def array_join_query(t):
    return t.documents.select("doc_id", F.array_join(F.regexp_extract_all("text", F.lit("([A-Z][a-z]{9,})"), 1), ", ").alias("names"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN 'Q' || quarter(o_orderdate) END AS strict, CASE WHEN o_orderstatus <> 'P' THEN 'Q' || quarter(o_orderdate) ELSE 'FY' || year(o_orderdate) END AS kept FROM orders
""")
def fiscal_quarter(t):
    q = F.concat(F.lit("q"), F.quarter("o_orderdate").cast("string"))
    y = F.year("o_orderdate").cast("string")
    raw = F.when(F.col("o_orderstatus") == "F", F.concat(y, F.upper(q))).when(F.col("o_orderstatus") == "O", F.concat(F.lit("FY"), y, q)).otherwise(
        F.concat(F.lit("FY"), y))
    return t.orders.select("o_orderkey", dt.fiscal_quarter(raw).alias("strict"), dt.fiscal_quarter(raw, keep_unknown=True).alias("kept"))


@query("""
SELECT p_partkey, CASE WHEN p_size > CASE p_type WHEN 'LARGE' THEN 40 ELSE 30 END THEN 'red' WHEN p_size > 20 THEN 'yellow' WHEN p_size < 5 THEN 'low' ELSE 'green' END AS lamp FROM part
""")
def threshold_lamp(t):
    red = F.when(F.col("p_type") == "LARGE", F.lit(40)).otherwise(F.lit(30))
    return t.part.select("p_partkey", nm.lamp(F.col("p_size"), red, F.lit(20), F.lit(5)).alias("lamp"))


@query("SELECT p_partkey, CASE regexp_extract(p_brand, '#(.*)$', 1) WHEN '1' THEN 'First' ELSE regexp_extract(p_brand, '#(.*)$', 1) END AS brand FROM part")
def strip_prefix(t):
    """'APP_name' loses its prefix, then the display name is looked up."""
    code = F.replace("p_brand", F.lit("#"), F.lit("_"))
    bare = F.regexp_replace(code, "^[^_]*_", "")
    return t.part.select("p_partkey", rules.map_value(bare, {"1": "First"}, bare).alias("brand"))


@query("""
SELECT user_id, COUNT(*) FILTER (event_type <> 'error') AS n_kept, COUNT(*) FILTER (event_type IN ('click', 'view')) AS n_market, COUNT(*) FILTER (event_type = 'purchase') AS n_pairs
FROM events GROUP BY 1
""")
def nested_clean(t):
    """Nested summary of one event: blank strings dropped, views bucketed by topic, complete
    question/answer pairs kept; then counted per user."""
    typ = F.col("event_type")
    text = F.when(typ == "error", F.lit("  ")).otherwise(typ)
    views = F.array(F.struct(typ.alias("topic"), text.alias("view")), F.struct(F.lit("none").alias("topic"), F.lit(" ").alias("view")))
    pairs = F.array(F.struct(typ.alias("q"), F.when(typ == "purchase", F.lit("yes")).alias("a")))
    kept = F.filter(views, lambda v: F.trim(v["view"]) != "")
    market = F.filter(kept, lambda v: v["topic"].isin("click", "view"))
    full = F.filter(pairs, lambda p: p["q"].isNotNull() & p["a"].isNotNull())
    rows = t.events.select("user_id", F.size(kept).alias("k"), F.size(market).alias("m"), F.size(full).alias("p"))
    return rows.groupBy("user_id").agg(F.sum("k").alias("n_kept"), F.sum("m").alias("n_market"), F.sum("p").alias("n_pairs"))


@query("""
SELECT d.doc_id, COALESCE(CASE WHEN l.toxic = 1 THEN 'conflict' END, CASE WHEN lang = 'en' THEN 'support' ELSE 'sb_only' END) AS effective,
  l.doc_id IS NULL AND lang = 'en' AS pending FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def effective_value(t):
    """Review before rule; pending when not reviewed and not one-sided."""
    rule = F.when(F.col("lang") == "en", F.lit("support")).otherwise(F.lit("sb_only"))
    j = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return j.select("doc_id", F.coalesce(F.when(F.col("toxic") == 1, F.lit("conflict")), rule).alias("effective"),
                    (F.col("quality").isNull() & (rule != "sb_only")).alias("pending"))
