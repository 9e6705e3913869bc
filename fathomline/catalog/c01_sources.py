"""Scans, sources, sinks and table contracts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fathomline.catalog.registry import query
from fathomline.functions import text as tx
from fathomline.functions.dates import month_key
from fathomline.functions.numbers import money_sum
from fathomline.operators import upsert as up
from fathomline.operators.keyed import top_n_ranked
from fathomline.session import run_dir
from fathomline.sources import binary, contracts, delimited, records, sinks
from fathomline.sources.tables import scan, tagged_union


@query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
""")
def scan_filter_project(t):
    year = F.col("o_orderdate")
    return scan(
        t.orders, ["o_orderkey", "o_custkey", "o_totalprice"],
        (year >= F.lit("1997-01-01").cast("timestamp_ntz")) & (year < F.lit("1998-01-01").cast("timestamp_ntz")),
    )


@query("""
SELECT c_custkey AS party_key, c_name AS party_name, c_nationkey AS nation_key, c_acctbal AS balance,
       'customer' AS source FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'supplier' FROM supplier
""", name="tagged_union")
def tagged_union_query(t):
    shape = ["party_key", "party_name", "nation_key", "balance"]
    return tagged_union({
        "customer": t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal").toDF(*shape),
        "supplier": t.supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal").toDF(*shape),
    })


ORDER_MANIFEST = [("order_key", "INT"), ("cust_key", "INT"), ("status", "STRING"), ("total", "DOUBLE"),
                  ("order_day", "DATE")]


def _orders_csv(t):
    """The orders table as CSV files in the shared folder, read back strictly."""
    path = run_dir(t.spark, "orders_csv")
    schema = contracts.manifest_schema(ORDER_MANIFEST)
    t.orders.select(
        "o_orderkey", "o_custkey", F.nullif("o_orderstatus", F.lit("P")), "o_totalprice",
        F.to_date("o_orderdate"),
    ).toDF(*schema.fieldNames()).write.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    return delimited.read_strict_csv(t.spark, path, schema)


@query("""
SELECT o_orderkey AS order_key, o_custkey AS cust_key, NULLIF(o_orderstatus, 'P') AS status,
       o_totalprice AS total, CAST(o_orderdate AS DATE) AS order_day FROM orders
""")
def csv_strict_roundtrip(t):
    return _orders_csv(t)


@query("SELECT COUNT(*) AS loaded, COUNT(*) AS expected, true AS ok FROM orders")
def load_count_gate(t):
    manifest = t.orders.agg(F.count(F.lit(1)).alias("n_rows"))
    return delimited.require_count(_orders_csv(t), manifest, "n_rows")


@query()
def binary_scan(t):
    path = run_dir(t.spark, "page_files")
    t.pages.select("html").write.option("maxRecordsPerFile", 100).text(path)
    files = binary.read_binary(t.spark, path, "*.txt")
    return files.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), F.col("length").alias("n_bytes"),
        F.sha2("content", 256).alias("sha256"),
    )


def events_raw(t):
    """Events as raw records: a day is a batch."""
    return records.raw_records(
        t.events, batch_id=F.date_format("ts", "yyyyMMdd"), seq=F.col("event_id"), record_type=F.col("event_type"),
        payload=F.col("props"), key=F.col("user_id"),
        path=F.concat(F.lit("landing/"), F.date_format("ts", "yyyyMMdd"), F.lit("/"), F.col("event_id")),
        ingested_at=F.col("ts"),
    )


EVENTS_RAW_SQL = """
SELECT strftime(ts, '%Y%m%d') AS batch_id, event_id AS seq, event_type AS record_type,
       'landing/' || strftime(ts, '%Y%m%d') || '/' || event_id AS batch_path, user_id AS record_key,
       sha256(props) AS sha256, CAST(octet_length(encode(props)) AS BIGINT) AS bytes, props AS payload,
       ts AS ingested_at
FROM events
"""


@query(EVENTS_RAW_SQL)
def bronze_records(t):
    return events_raw(t)


@query("""
SELECT event_id AS seq, user_id AS record_key, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(NULL AS VARCHAR) AS unit
FROM events WHERE event_type = 'purchase'
""")
def json_parse(t):
    parsed = records.typed(events_raw(t), "purchase", "k INT, unit STRING")
    return parsed.select("seq", "record_key", F.col("p.k").alias("k"), F.col("p.unit").alias("unit"))


@query("""
WITH dup AS (
  SELECT upper(trim(c_name)) AS norm FROM customer GROUP BY 1 HAVING COUNT(*) > 1
), n AS (SELECT n_nationkey FROM nation WHERE n_regionkey <> 4)
SELECT c_custkey AS row_key, 'bad id' AS problem FROM customer
WHERE NOT regexp_matches(c_name, '^Customer#[0-9]{8}[0-8]$')
UNION ALL
SELECT c_custkey, 'unknown segment' FROM customer
WHERE c_mktsegment NOT IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE', 'HOUSEHOLD')
UNION ALL
SELECT c_custkey, 'duplicate name' FROM customer WHERE upper(trim(c_name)) IN (SELECT norm FROM dup)
UNION ALL
SELECT c_custkey, 'dangling nation' FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM n)
""")
def seed_violations(t):
    known = t.nation.where("n_regionkey <> 4").select(F.col("n_nationkey").alias("c_nationkey"))
    checks = [
        ("bad id", t.customer.where(~F.col("c_name").rlike("^Customer#[0-9]{8}[0-8]$"))),
        ("unknown segment", t.customer.where(
            ~F.col("c_mktsegment").isin("MACHINERY", "BUILDING", "AUTOMOBILE", "HOUSEHOLD"))),
        ("dangling nation", t.customer.join(known, "c_nationkey", "left_anti")),
    ]
    named = t.customer.withColumn("norm", F.upper(F.trim("c_name")))
    repeated = up.duplicate_keys(named, ["norm"]).select("norm")
    checks.append(("duplicate name", named.join(repeated, "norm", "left_semi")))
    parts = [df.select(F.col("c_custkey").alias("row_key"), F.lit(p).alias("problem")) for p, df in checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("""
SELECT l_returnflag, COUNT(*) AS n, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem GROUP BY 1
""")
def sink_append(t):
    path = run_dir(t.spark, "append")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    sinks.append_rows(lines.where("l_returnflag = 'R'"), path)
    sinks.append_rows(lines.where("l_returnflag <> 'R'"), path)
    return t.spark.read.parquet(path).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), money_sum("l_extendedprice").alias("total"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS batch_id,
       CASE WHEN o_orderdate >= TIMESTAMP '2001-01-01' THEN 'new' ELSE 'old' END AS origin
FROM orders
""")
def replace_batch(t):
    """The 2001 months are delivered again on top of a table that already holds them."""
    rows = t.orders.select("o_orderkey", month_key(F.col("o_orderdate")).alias("batch_id"))
    stored = rows.withColumn("origin", F.lit("old"))
    batch = rows.where("batch_id >= '2001-01'").withColumn("origin", F.lit("new"))
    once = up.replace_batch(stored, batch, ["batch_id"])
    return up.replace_batch(once, batch, ["batch_id"])


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS day, COUNT(*) AS n,
       CASE WHEN ts >= TIMESTAMP '2024-01-29' THEN 2 ELSE 1 END AS run
FROM events GROUP BY 1, 3
""")
def replace_day(t):
    """One row per day; the last two days are written a second time by a later run."""
    path = run_dir(t.spark, "days")
    daily = t.events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    sinks.replace_partitions(daily.withColumn("run", F.lit(1)), path, ["day"])
    sinks.replace_partitions(daily.where("day >= '2024-01-29'").withColumn("run", F.lit(2)), path, ["day"])
    return t.spark.read.schema("n BIGINT, run INT, day STRING").parquet(path)


def _typed_latest(raw):
    return (
        raw.select("record_key", "record_type", "seq", F.from_json("payload", "k INT").alias("p"))
        .groupBy("record_key", "record_type")
        .agg(F.max(F.struct("seq", "p.k")).alias("top"))
        .select("record_key", "record_type", F.col("top.seq").alias("seq"), F.col("top.k").alias("k"))
    )


@query("""
SELECT user_id AS record_key, event_type AS record_type, MAX(event_id) AS seq,
       CAST(json_extract_string(arg_max(props, event_id), '$.k') AS INTEGER) AS k, true AS same
FROM events GROUP BY 1, 2
""")
def rebuild_equals_incremental(t):
    """Rebuild from the whole raw layer beside the result of two increments."""
    raw = events_raw(t)
    early, late = raw.where("batch_id < '20240116'"), raw.where("batch_id >= '20240116'")
    stored = _typed_latest(early)
    step = up.merge(stored, _typed_latest(late), ["record_key", "record_type"],
                    update_when=F.col("s.seq") > F.col("t.seq"))
    rebuilt = _typed_latest(raw)
    other = step.select("record_key", "record_type", F.struct("seq", "k").alias("inc"))
    return rebuilt.join(other, ["record_key", "record_type"], "left").select(
        "record_key", "record_type", "seq", "k",
        F.struct("seq", "k").eqNullSafe(F.col("inc")).alias("same"))


@query("SELECT c_custkey AS customer_key, c_name AS customer_name, c_acctbal AS balance FROM customer")
def sink_insert_overwrite(t):
    """Declared table, filled by position twice; the second fill replaces the first."""
    path = run_dir(t.spark, "declared")
    name = "declared_" + path.rsplit("/", 1)[1][:12]
    declared = StructType.fromDDL("customer_key BIGINT, customer_name STRING, balance DOUBLE")
    t.spark.sql(contracts.create_table_sql(name, declared, ["customer_key"], {"balance": "account balance"})
                + f" LOCATION '{path}'")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    for df in (rows.where("c_acctbal < 0"), rows):
        df.write.insertInto(name, overwrite=True)
    return t.spark.read.schema(declared).parquet(path)


def customer_batch(t):
    """A delivery: BUILDING customers with a new balance, and suppliers as new rows."""
    changed = t.customer.where("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    fresh = t.supplier.select(
        (-F.col("s_suppkey") - 1).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"))
    return changed.unionByName(fresh)


@query("""
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer
UNION ALL
SELECT -s_suppkey - 1, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier
""")
def upsert_all(t):
    return up.merge(t.customer, customer_batch(t), ["c_custkey"])


@query("""
WITH t AS (SELECT c_mktsegment AS segment, NULLIF(c_nationkey, 0) AS nation_key, COUNT(*) AS n
           FROM customer GROUP BY ALL),
s AS (SELECT 'BUILDING' AS segment, NULLIF(s_nationkey, 0) AS nation_key, COUNT(*) AS n
      FROM supplier GROUP BY ALL)
SELECT COALESCE(t.segment, s.segment) AS segment, COALESCE(t.nation_key, s.nation_key) AS nation_key,
       COALESCE(s.n, t.n) AS n
FROM t FULL OUTER JOIN s ON t.segment = s.segment AND t.nation_key IS NOT DISTINCT FROM s.nation_key
""")
def upsert_nullsafe(t):
    def cells(df, segment, nation):
        return df.groupBy(segment.alias("segment"), F.nullif(nation, F.lit(0)).alias("nation_key")).agg(
            F.count(F.lit(1)).alias("n"))
    target = cells(t.customer, F.col("c_mktsegment"), F.col("c_nationkey"))
    source = cells(t.supplier, F.lit("BUILDING"), F.col("s_nationkey"))
    return up.merge(target, source, ["segment", "nation_key"], null_safe=True)


@query("""
WITH t AS (SELECT doc_id AS summary_key,
             CAST(length(text) - length(replace(text, chr(10), '')) AS BIGINT) + 1 AS n_items FROM documents),
s AS (SELECT conv_id AS summary_key,
        CAST(SUM(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS n_items
      FROM conversations GROUP BY 1)
SELECT COALESCE(t.summary_key, s.summary_key) AS summary_key,
       CASE WHEN s.n_items >= t.n_items OR t.n_items IS NULL THEN s.n_items ELSE t.n_items END AS n_items,
       CASE WHEN s.n_items >= t.n_items OR t.n_items IS NULL THEN 'batch' ELSE 'stored' END AS origin
FROM t FULL OUTER JOIN s USING (summary_key)
""")
def upsert_richer(t):
    """The batch row wins only when it holds at least as many list items."""
    lines = F.size(F.split("text", "\n")).cast("long")
    target = t.documents.select(F.col("doc_id").alias("summary_key"), lines.alias("n_items"),
                                F.lit("stored").alias("origin"))
    source = t.conversations.groupBy(F.col("conv_id").alias("summary_key")).agg(
        F.sum(lines).alias("n_items")).withColumn("origin", F.lit("batch"))
    return up.merge(target, source, ["summary_key"], update_when=F.col("s.n_items") >= F.col("t.n_items"))


@query("""
WITH h AS (SELECT sha1(text) AS text_hash, MIN(doc_id) AS doc_id, MIN(CASE WHEN lang = 'en' THEN doc_id END) AS en_id
           FROM documents GROUP BY 1)
SELECT text_hash, COALESCE(en_id, doc_id) AS doc_id, CASE WHEN en_id IS NULL THEN 'new' ELSE 'stored' END AS state
FROM h
""")
def insert_new_only(t):
    def hashed(df, state):
        return df.groupBy(F.sha1("text").alias("text_hash")).agg(F.min("doc_id").alias("doc_id")).withColumn(
            "state", F.lit(state))
    return up.insert_new(hashed(t.documents.where("lang = 'en'"), "stored"), hashed(t.documents, "new"), ["text_hash"])


@query("""
SELECT d.doc_id, CAST(d.n_chars > 1000 AS INTEGER) AS machine_quality, l.toxic AS reviewed,
       CASE WHEN l.doc_id IS NULL THEN 'batch' ELSE 'stored' END AS created
FROM documents d LEFT JOIN labels l USING (doc_id)
UNION ALL
SELECT l.doc_id, l.quality, l.toxic, 'stored' FROM labels l ANTI JOIN documents d USING (doc_id)
""")
def upsert_protect_cols(t):
    """Machine columns follow the batch; the human column keeps its value."""
    target = t.labels.select("doc_id", F.col("quality").alias("machine_quality"), F.col("toxic").alias("reviewed"),
                             F.lit("stored").alias("created"))
    batch = t.documents.select("doc_id", (F.col("n_chars") > 1000).cast("int").alias("machine_quality"),
                               F.lit("batch").alias("created"))
    return up.merge(target, batch, ["doc_id"], protect=["reviewed"], insert_only=["created"])


def _customer_dimension(t):
    target = t.customer.select("c_custkey", "c_mktsegment", (F.col("c_acctbal") >= 0).alias("is_active"),
                               F.lit("2024-01-01").cast("date").alias("updated_at"))
    source = customer_batch(t).unionByName(t.customer.where("c_mktsegment <> 'BUILDING'")).where(
        "c_nationkey <> 0").select(
        "c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", F.lit("CONSTRUCTION")).otherwise(
            F.col("c_mktsegment")).alias("c_mktsegment"))
    return target, source


_DIMENSION_SQL = """
WITH t AS (SELECT c_custkey, c_mktsegment, c_acctbal >= 0 AS is_active, DATE '2024-01-01' AS updated_at FROM customer),
s AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'CONSTRUCTION' ELSE c_mktsegment END AS c_mktsegment
      FROM customer WHERE c_nationkey <> 0
      UNION ALL SELECT -s_suppkey - 1, 'SUPPLIER' FROM supplier WHERE s_nationkey <> 0)
"""


@query(_DIMENSION_SQL + """
SELECT COALESCE(t.c_custkey, s.c_custkey) AS c_custkey, COALESCE(s.c_mktsegment, t.c_mktsegment) AS c_mktsegment,
       s.c_custkey IS NOT NULL AS is_active,
       CASE WHEN t.c_custkey IS NULL THEN DATE '2024-02-01'
            WHEN s.c_custkey IS NULL AND t.is_active THEN DATE '2024-02-01'
            WHEN s.c_custkey IS NULL THEN t.updated_at
            WHEN NOT t.is_active OR s.c_mktsegment <> t.c_mktsegment THEN DATE '2024-02-01'
            ELSE t.updated_at END AS updated_at
FROM t FULL OUTER JOIN s ON t.c_custkey = s.c_custkey
""")
def scd_soft_delete(t):
    target, source = _customer_dimension(t)
    return up.soft_delete_merge(target, source, ["c_custkey"], ["c_mktsegment"], F.lit("2024-02-01").cast("date"))


@query("""
SELECT d.doc_id, d.source AS path, CASE WHEN d.n_chars >= 150 THEN sha256(d.text) END AS sha FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM documents v WHERE v.lang = 'de' AND v.source = d.source
  AND (CASE WHEN v.n_chars >= 150 THEN sha256(v.text) END)
      IS NOT DISTINCT FROM (CASE WHEN d.n_chars >= 150 THEN sha256(d.text) END))
""")
def delete_by_keys(t):
    docs = t.documents.select("doc_id", "lang", F.col("source").alias("path"),
                              F.when(F.col("n_chars") >= 150, F.sha2("text", 256)).alias("sha"))
    return up.delete_keys(docs, docs.where("lang = 'de'"), ["path", "sha"]).drop("lang")


@query("""
WITH ledger AS (SELECT source, CASE WHEN MIN(doc_id) < 5 THEN 'active' ELSE 'unreviewed' END AS status
                FROM documents GROUP BY 1),
v AS (SELECT d.source, MAX(l.quality) AS has_y, MAX(1 - l.quality) AS has_n
      FROM labels l JOIN documents d USING (doc_id) GROUP BY 1)
SELECT source, CASE WHEN ledger.status <> 'unreviewed' OR v.has_y IS NULL THEN ledger.status
                    WHEN v.has_y = 1 THEN 'active' ELSE 'retired' END AS status,
       CASE WHEN ledger.status = 'unreviewed' AND v.has_y = 0 THEN 'all reviews say no' END AS note
FROM ledger LEFT JOIN v USING (source)
""")
def status_sync(t):
    """Reviews move a still unreviewed row: any yes makes it active, only no retires it."""
    ledger = t.documents.groupBy("source").agg(
        F.when(F.min("doc_id") < 5, F.lit("active")).otherwise(F.lit("unreviewed")).alias("status"))
    votes = t.labels.join(t.documents.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.max("quality").alias("has_y"))
    open_row = (F.col("status") == "unreviewed") & F.col("has_y").isNotNull()
    return ledger.join(votes, "source", "left").select(
        "source",
        F.when(open_row & (F.col("has_y") == 1), F.lit("active")).when(open_row, F.lit("retired"))
        .otherwise(F.col("status")).alias("status"),
        F.when(open_row & (F.col("has_y") == 0), F.lit("all reviews say no")).alias("note"))


@query("""
SELECT conv_id, turn, 1 AS version, bool_or(role = 'system') OVER (PARTITION BY conv_id) AS superseded FROM conversations
UNION ALL
SELECT conv_id, turn, 2, false FROM conversations c
WHERE EXISTS (SELECT 1 FROM conversations s WHERE s.conv_id = c.conv_id AND s.role = 'system')
""")
def supersede_append(t):
    """Conversations with a system turn are extracted again; their old rows stay, superseded."""
    rows = t.conversations.select("conv_id", "turn")
    stored = rows.select("*", F.lit(1).alias("version"), F.lit(False).alias("superseded"))
    again = rows.join(t.conversations.where("role = 'system'").select("conv_id"), "conv_id", "left_semi")
    batch = again.select("*", F.lit(2).alias("version"), F.lit(False).alias("superseded"))
    return up.supersede_append(stored, batch, ["conv_id"])


@query("""
SELECT c_custkey, n_name AS nation_name, COALESCE(n_regionkey, -1) AS region_key
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON c_nationkey = n_nationkey
""")
def backfill_dim(t):
    """Derived columns of every stored row are recomputed from the current dimension."""
    dim = t.nation.where("n_regionkey <> 2").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation_name"),
        F.col("n_regionkey").alias("region_key"))
    return t.customer.select("c_custkey", "c_nationkey").join(dim, "c_nationkey", "left").select(
        "c_custkey", "nation_name", F.coalesce("region_key", F.lit(-1)).alias("region_key"))


@query("""
SELECT o_orderkey, year(o_orderdate) AS order_year,
       o_orderstatus <> 'P' AND NOT (year(o_orderdate) = 1997 AND o_orderpriority <> '1-URGENT') AS active
FROM orders
""")
def deactivate_missing(t):
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").cast("long").alias("order_year"),
                           (F.col("o_orderstatus") != "P").alias("active"))
    batch = t.orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.year("o_orderdate") == 1997))
    return up.deactivate_missing(rows, batch.select("o_orderkey"), ["o_orderkey"], F.col("order_year") == 1997)


@query("""
SELECT c_custkey, c_mktsegment AS segment FROM customer WHERE c_acctbal < 0 AND c_mktsegment <> 'BUILDING'
""")
def sync_copied_cols(t):
    """Rows whose copied column no longer equals the source of truth, with the new value."""
    copy = t.customer.select("c_custkey", F.when(F.col("c_acctbal") < 0, F.lit("BUILDING")).otherwise(
        F.col("c_mktsegment")).alias("segment"))
    truth = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return up.paired(copy, truth, ["c_custkey"]).where(up.differs(["segment"])).select("s.*")


@query("""
WITH v AS (SELECT o_custkey, o_orderdate, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1)
SELECT COUNT(*) AS rows_before, COUNT(*) FILTER (v.o_custkey IS NULL) AS rows_after
FROM orders o LEFT JOIN v ON o.o_custkey = v.o_custkey AND o.o_orderdate = v.o_orderdate
  AND o.o_totalprice = v.o_totalprice
""")
def guarded_delete(t):
    """The exact three-column key may match one row only; otherwise nothing is deleted."""
    keys = ["o_custkey", "o_orderdate", "o_totalprice"]
    victim = t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(1).select(*keys)
    hits = t.orders.join(victim, keys, "left_semi").agg(F.count(F.lit(1)).alias("hits"))
    allowed = victim.where(hits.scalar() == 1)
    left = up.delete_keys(t.orders.select(*keys), allowed, keys)
    return t.orders.agg(F.count(F.lit(1)).alias("rows_before"),
                        F.any_value(left.agg(F.count(F.lit(1))).scalar()).alias("rows_after"))


@query("""
SELECT doc_id, CASE WHEN lang = 'en' THEN 'rule' WHEN n_chars >= 150 THEN 'model' END AS basis FROM documents
""")
def update_where(t):
    basis = F.when(F.col("lang") == "en", F.lit("rule"))
    value = F.when(F.col("n_chars") >= 150, F.col("text"))
    rows = t.documents.select("doc_id", basis.alias("basis"), value.isNotNull().alias("has_value"))
    return rows.select("doc_id", F.when(F.col("basis").isNull() & F.col("has_value"), F.lit("model")).otherwise(
        F.col("basis")).alias("basis"))


@query("""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS DATE) AS closed_on,
       CAST(NULL AS DOUBLE) AS weight FROM customer
""")
def schema_evolve_add(t):
    declared = StructType([*t.customer.schema.fields, *StructType.fromDDL("closed_on DATE, weight DOUBLE").fields])
    return contracts.require_contract(contracts.add_missing_columns(t.customer, declared), declared)


@query("""
SELECT 'orders' AS table_name, COUNT(*) AS n_rows, '' AS problems FROM orders
UNION ALL SELECT 'customer', COUNT(*), 'column 2: have (''c_nationkey'', ''int''), declared (''c_nationkey'', ''bigint''); column 4: have (''c_mktsegment'', ''string''), declared (''c_segment'', ''string'')' FROM customer
""")
def schema_contract(t):
    """Differences between each table and its declared form, with the row count it guards."""
    declared = {
        "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
                  " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
        "customer": "c_custkey BIGINT, c_name STRING, c_nationkey BIGINT, c_acctbal DOUBLE, c_segment STRING",
    }
    out = None
    for name, ddl in declared.items():
        df = getattr(t, name)
        problems = contracts.contract_violations(df, StructType.fromDDL(ddl))
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit("; ".join(problems)).alias("problems"))
        out = part if out is None else out.unionByName(part)
    return out


@query("""
SELECT conv_id, turn, role, to_json(list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z]{12,}')))) AS long_words,
       array_to_string(list_sort(regexp_extract_all(text, '[0-9]+')), '|') AS numbers
FROM conversations
""")
def export_projection(t):
    """Internal columns dropped, arrays turned into plain strings."""
    rows = t.conversations.withColumn("words", F.array_sort(F.array_distinct(
        F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{12,})"), 1)))).withColumn(
        "nums", F.array_sort(F.regexp_extract_all("text", F.lit("([0-9]+)"), 1)))
    return rows.select("conv_id", "turn", "role", F.to_json("words").alias("long_words"),
                       F.array_join("nums", "|").alias("numbers"))


@query("""
WITH y AS (SELECT o_custkey, year(o_orderdate) AS yr, COUNT(*) AS n FROM orders GROUP BY 1, 2),
f AS (SELECT o_custkey, string_agg(yr || ':' || n, ',' ORDER BY yr) AS facts FROM y GROUP BY 1),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
SELECT c_custkey, c_name, f.facts, r1.o_orderkey AS newest_order,
       (SELECT string_agg(r.o_orderkey, ',' ORDER BY r.rn) FROM r WHERE r.o_custkey = c_custkey AND r.rn <= 3) AS top_orders
FROM customer LEFT JOIN f ON f.o_custkey = c_custkey LEFT JOIN r r1 ON r1.o_custkey = c_custkey AND r1.rn = 1
""")
def entity_bundle(t):
    """Dimension row, facts per year, newest order and the ranked three newest per customer."""
    yearly = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("yr")).agg(F.count(F.lit(1)).alias("n"))
    facts = yearly.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("yr", "n"))).alias("f")).select(
        "o_custkey", F.array_join(F.transform("f", lambda x: F.concat_ws(":", x["yr"], x["n"])), ",").alias("facts"))
    newest = top_n_ranked(t.orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 3)
    top = newest.groupBy("o_custkey").agg(
        F.array_sort(F.collect_list(F.struct("rank_no", "o_orderkey"))).alias("r")).select(
        "o_custkey", F.col("r")[0]["o_orderkey"].alias("newest_order"),
        F.array_join(F.transform("r", lambda x: x["o_orderkey"].cast("string")), ",").alias("top_orders"))
    cust = t.customer.select("c_custkey", "c_name", F.col("c_custkey").alias("o_custkey"))
    return cust.join(facts, "o_custkey", "left").join(top, "o_custkey", "left").drop("o_custkey")


@query("""
SELECT c_custkey, lower(trim(c_name)) AS alias_norm,
       array_to_string(list_filter(string_split(c_mktsegment || '| |' || n_name, '|'), lambda x: trim(x) <> ''), ',') AS defaults,
       true AS is_active
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def seed_dims(t):
    """Pipe-separated list to array without blanks, normalised alias key, active flag."""
    dim = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = t.customer.join(dim, "c_nationkey").withColumn(
        "listed", F.concat("c_mktsegment", F.lit("| |"), "n_name"))
    return rows.select("c_custkey", tx.alias_norm(F.col("c_name")).alias("alias_norm"),
                       F.array_join(tx.split_list(F.col("listed")), ",").alias("defaults"),
                       F.lit(True).alias("is_active"))
