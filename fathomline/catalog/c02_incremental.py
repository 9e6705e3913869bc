"""Increments, work queues, batch logs and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.catalog.c01_sources import events_raw
from fathomline.catalog.registry import query
from fathomline.functions.dates import month_key
from fathomline.operators import incremental as inc
from fathomline.session import run_dir, written
from fathomline.sources.sinks import BucketTable, KeyLog
from fathomline.streaming import jobs


def pinned(t, name, due, key):
    """Rows of an increment by the keys that a key log holds for this run, which is closed once they are written."""
    log = KeyLog(t.spark, run_dir(t.spark, f"{name}_keys"))
    batch, keys = log.pin(due.select(key))
    rows = written(due.join(keys, key, "left_semi"), name)
    log.close(batch)
    return rows


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


@query("""
SELECT event_id, user_id, event_type, ts FROM events
WHERE ts > (SELECT MAX(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')
""")
def watermark_increment(t):
    ev = t.events.select("event_id", "user_id", "event_type", "ts")
    return pinned(t, "watermark_increment", inc.newer_than(ev, "ts", ev.where(F.col("ts") < ntz("2024-01-20"))), "event_id")


@query("""
SELECT event_id, user_id, n_run FROM events, (VALUES (1), (2)) AS r(n_run) WHERE CAST(ts AS DATE) >= DATE '2024-01-25' AND event_type <> 'error'
  AND (n_run = 1) = (event_type <> 'signup')
""")
def pinned_increment(t):
    """A run fails after its keys were pinned; the rerun takes the same keys though more have arrived, the next run takes those."""
    base = run_dir(t.spark, "pinned_increment")
    log, sink = KeyLog(t.spark, f"{base}/keys"), f"{base}/sink"
    source = t.events.where((F.to_date("ts") >= F.lit("2024-01-25").cast("date")) & (F.col("event_type") != "error")).select("event_id", "user_id", "event_type")
    landed = source.where("event_type <> 'signup'")
    log.pin(landed.select("event_id"))  # the first run ends here, before its sink
    for run in (1, 2):
        done = t.spark.read.parquet(sink).select("event_id") if run > 1 else source.select("event_id").where("false")
        batch, keys = log.pin(source.select("event_id").join(done, "event_id", "left_anti"))
        source.join(keys, "event_id", "left_semi").select("event_id", "user_id", F.lit(run).alias("n_run")).write.mode("append").parquet(sink)
        log.close(batch)
    return t.spark.read.parquet(sink)


@query("""
SELECT event_id, user_id, event_type, ts FROM events
WHERE ts > (SELECT MAX(ts) FROM events WHERE (ts < TIMESTAMP '2024-01-20' AND event_type <> 'error')
            OR (ts < TIMESTAMP '2024-01-25' AND event_type = 'error'))
""")
def watermark_union(t):
    """Quarantined errors were stored further than the kept rows and move the mark."""
    ev = t.events.select("event_id", "user_id", "event_type", "ts")
    kept = ev.where((F.col("ts") < ntz("2024-01-20")) & (F.col("event_type") != "error"))
    quarantined = ev.where((F.col("ts") < ntz("2024-01-25")) & (F.col("event_type") == "error"))
    return pinned(t, "watermark_union", inc.newer_than(ev, "ts", kept, quarantined), "event_id")


@query("""
SELECT doc_id, source FROM documents
WHERE doc_id > (SELECT MAX(doc_id) FROM documents WHERE lang <> 'en') OR (lang = 'de')
""")
def version_reprocess(t):
    docs = t.documents.select("doc_id", "source", "lang")
    stored = docs.where("lang <> 'en'").withColumn(
        "rule_version", F.when(F.col("lang") == "de", F.lit("0.1")).otherwise(F.lit("0.2")))
    due = inc.newer_than(docs, "doc_id", stored, first="-1")
    return pinned(t, "version_reprocess", inc.with_stale_versions(due, docs, stored, "doc_id", "rule_version", "0.2").select("doc_id", "source"), "doc_id")


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1999-03-01' AND DATE '1999-04-30' OR o_orderkey IN (1, 2, 3)
""")
def forced_backfill(t):
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    due = rows.where("day > DATE'2001-07-01'")
    return inc.forced_or_range(rows, due, "o_orderkey", "day", start="1999-03-01", end="1999-04-30", force=[1, 2, 3])


@query("""
WITH s AS (SELECT l_orderkey, MAX(l_shipdate) AS done_at, MAX(CAST(l_linenumber AS BIGINT)) AS version
           FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_orderdate FROM orders LEFT JOIN s ON l_orderkey = o_orderkey
WHERE done_at IS NULL OR o_orderdate > done_at OR version IS DISTINCT FROM 7
""")
def state_compare(t):
    state = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("done_at"), F.max(F.col("l_linenumber").cast("long")).alias("version"))
    return inc.state_due(t.orders.select("o_orderkey", "o_orderdate"), state, ["o_orderkey"], "o_orderdate",
                         "done_at", "version", F.lit(7).cast("long"))


def event_attempts(t):
    """Events read as parse attempts of the document with the user's number."""
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.select(
        F.col("user_id").alias("doc_id"), "event_id", "ts",
        F.when(k < 30, F.lit("success")).when(k < 60, F.lit("partial")).otherwise(F.lit("failed")).alias("status"),
        F.when(F.col("value") < 10, F.lit(1)).when(F.col("value") < 20, F.lit(2)).otherwise(F.lit(3)).alias("attempt"),
        F.when(F.col("event_type") == "signup", F.lit("old")).otherwise(F.lit("native")).alias("parser"))


_ATTEMPTS_SQL = """
a AS (SELECT user_id AS doc_id, event_id, ts,
        CASE WHEN CAST(props->>'$.k' AS INT) < 30 THEN 'success' WHEN CAST(props->>'$.k' AS INT) < 60 THEN 'partial'
             ELSE 'failed' END AS status,
        CASE WHEN value < 10 THEN 1 WHEN value < 20 THEN 2 ELSE 3 END AS attempt,
        CASE WHEN event_type = 'signup' THEN 'old' ELSE 'native' END AS parser FROM events),
last AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY ts DESC, event_id DESC) = 1)
"""


@query("WITH " + _ATTEMPTS_SQL + """
SELECT d.doc_id, d.lang, CASE WHEN parser = 'native' THEN attempt ELSE 0 END AS attempt
FROM documents d LEFT JOIN last USING (doc_id)
WHERE parser IS DISTINCT FROM 'native' OR (status <> 'success' AND attempt < 3) OR d.n_chars > 10000
""")
def work_queue(t):
    return inc.retry_queue(
        t.documents.select("doc_id", "lang", "n_chars"), event_attempts(t), "doc_id", parser="native", max_attempts=3,
        newest=[F.desc("ts"), F.desc("event_id")], force=F.col("n_chars") > 10000).drop("n_chars")


@query("""
WITH i AS (SELECT conv_id, turn, CASE WHEN turn < 4 THEN '0.3' ELSE '0.2' END AS version,
             CASE WHEN length(text) < 200 THEN 'failed_quote' ELSE 'ok' END AS status
           FROM conversations WHERE role = 'assistant')
SELECT c.conv_id, c.turn FROM conversations c
WHERE role <> 'system' AND length(text) >= 150
  AND (NOT EXISTS (SELECT 1 FROM i WHERE i.conv_id = c.conv_id AND i.turn = c.turn AND version = '0.3' AND status = 'ok')
       OR c.conv_id = 1)
""")
def pending_segments(t):
    seg = t.conversations.select(
        "conv_id", "turn", (F.length("text") >= 150).alias("extractable"),
        F.when(F.col("role") == "system", F.lit("x")).alias("dup_of"))
    items = t.conversations.where("role = 'assistant'").select(
        "conv_id", "turn", F.when(F.col("turn") < 4, F.lit("0.3")).otherwise(F.lit("0.2")).alias("version"),
        F.when(F.length("text") < 200, F.lit("failed_quote")).otherwise(F.lit("ok")).alias("status"),
        F.lit(False).alias("superseded"))
    return inc.pending_segments(seg, items, ["conv_id", "turn"], "0.3", forced=F.col("conv_id") == 1).select(
        "conv_id", "turn")


@query("""
WITH c AS (SELECT d.doc_id, sha1(text) AS item_key, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT item_key, MIN(doc_id) AS doc_id FROM c WHERE quality IS NULL OR toxic = 1 OR quality = 0 GROUP BY 1
""")
def pending_classify(t):
    """Unclassified, reactivated or stale candidates, one row per stable key."""
    cand = t.documents.select("doc_id", F.sha1("text").alias("item_key")).join(t.labels, "doc_id", "left")
    due = cand.where(F.col("quality").isNull() | (F.col("toxic") == 1) | (F.col("quality") == 0))
    return due.groupBy("item_key").agg(F.min("doc_id").alias("doc_id"))


@query("""
WITH p AS (SELECT doc_id, 0 AS p, 'reviewed' AS reason FROM labels WHERE quality = 1
  UNION ALL SELECT doc_id, 1, 'follows_primary' FROM documents WHERE source = 'src1'
  UNION ALL SELECT doc_id, 2, 'auto' FROM documents WHERE lang = 'en')
SELECT doc_id, arg_min(reason, p) AS reason FROM p GROUP BY 1
""")
def pending_ledger(t):
    return inc.by_priority({
        "reviewed": t.labels.where("quality = 1"),
        "follows_primary": t.documents.where("source = 'src1'"),
        "auto": t.documents.where("lang = 'en'"),
    }, ["doc_id"])


@query("""
WITH h AS (SELECT o_custkey, sha256(o_orderkey || ':' || o_orderstatus) AS m FROM orders),
s AS (SELECT o_custkey, COUNT(*) AS n_rows, """ + ", ".join(f"SUM(CAST('0x' || m[{16 * k + 1}:{16 * k + 16}] AS HUGEINT)) % 18446744073709551616 AS w{k}" for k in range(4)) + """ FROM h GROUP BY 1)
SELECT o_custkey, n_rows, sha256(concat_ws('|', n_rows, w0, w1, w2, w3, 'r2')) AS digest FROM s
""")
def digest_change(t):
    """Customers whose orders or rule version changed since the stored digest (none is stored for a new run)."""
    rows = t.orders.select("o_custkey", F.concat_ws(":", "o_orderkey", "o_orderstatus").alias("h"))
    now = inc.group_digest(rows, ["o_custkey"], F.col("h"), [F.lit("r2")])
    stored = inc.group_digest(rows, ["o_custkey"], F.col("h"), [F.lit("r1")])
    return now.join(stored.select("o_custkey", "digest"), ["o_custkey", "digest"], "left_anti")


@query("""
WITH b AS (SELECT user_id, CAST(ts AS DATE) AS day, MAX(event_id) AS seq,
             MAX(event_id) FILTER (event_type <> 'signup') AS landed, MAX(CAST(props->>'$.k' AS INT)) AS k
           FROM events GROUP BY 1, 2),
x AS (SELECT *, lag(seq) OVER w AS before, lag(landed) OVER w AS prev_seq FROM b WINDOW w AS (PARTITION BY user_id ORDER BY seq))
SELECT user_id, seq, CASE WHEN k < 20 THEN 'waiting' WHEN before IS NULL THEN 'first'
  WHEN prev_seq = before THEN 'ok' ELSE 'gap' END AS state FROM x
""")
def seq_gap(t):
    """A user's day is a batch; it names the last landed event of the day before as its predecessor."""
    from pyspark.sql import Window

    k = F.get_json_object("props", "$.k").cast("int")
    b = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.max("event_id").alias("seq"), F.max(F.when(F.col("event_type") != "signup", F.col("event_id"))).alias("landed"),
        F.max(k).alias("k"))
    b = b.withColumn("prev_seq", F.lag("landed").over(Window.partitionBy("user_id").orderBy("seq")))
    return inc.sequence_gaps(b, ["user_id"], "seq", "prev_seq", F.col("k") >= 20).select("user_id", "seq", "state")


def batch_log_rows(t):
    """One row per day: counters, a map of counts and an array of result structs."""
    per = t.events.groupBy(F.date_format("ts", "yyyyMMdd").alias("batch_id"), "event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("value") < 1).alias("n_failed"),
        F.min("ts").alias("first_at"), F.max("ts").alias("last_at"))
    return per.groupBy("batch_id").agg(
        F.sum("n_rows").alias("landed"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("event_type", "n_rows")))).alias("counts"),
        F.array_sort(F.collect_list(F.struct("event_type", "n_rows", "n_failed", "first_at", "last_at"))).alias("results"),
    ).withColumn("status", F.when(F.exists("results", lambda r: r["n_failed"] > 0), F.lit("partial")).otherwise(F.lit("ok")))


@query("""
WITH e AS (SELECT strftime(ts, '%Y%m%d') AS batch_id, event_type, COUNT(*) AS n_rows, COUNT(*) FILTER (value < 1) AS n_failed,
  strftime(MIN(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_at, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_at FROM events GROUP BY 1, 2)
SELECT batch_id, CAST(SUM(n_rows) AS BIGINT) AS landed, '{' || string_agg('"' || event_type || '":' || n_rows, ',' ORDER BY event_type) || '}' AS counts,
  string_agg(concat_ws('|', event_type, n_rows, n_failed, first_at, last_at), ';' ORDER BY event_type) AS results,
  CASE WHEN bool_or(n_failed > 0) THEN 'partial' ELSE 'ok' END AS status FROM e GROUP BY 1
""")
def batch_log(t):
    """The map and the array of a batch, written out."""
    shown = F.transform("results", lambda r: F.concat_ws("|", r["event_type"], r["n_rows"], r["n_failed"], *[F.date_format(r[c], "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("first_at", "last_at")]))
    return batch_log_rows(t).select("batch_id", "landed", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("counts")))).alias("counts"), F.array_join(shown, ";").alias("results"), "status")


@query("""
SELECT event_type AS endpoint, COUNT(*) AS sent, COUNT(*) FILTER (value < 1) AS failed, MIN(ts) AS first_at,
       MAX(ts) AS last_at, COUNT(DISTINCT CAST(ts AS DATE)) AS batches
FROM events GROUP BY 1
""")
def log_totals(t):
    flat = batch_log_rows(t).select("batch_id", F.explode("results").alias("a")).select("batch_id", "a.*")
    return flat.groupBy(F.col("event_type").alias("endpoint")).agg(
        F.sum("n_rows").alias("sent"), F.sum("n_failed").alias("failed"), F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"), F.count("batch_id").alias("batches"))


@query("""
WITH l AS (SELECT COUNT(DISTINCT (l_orderkey, l_linenumber)) AS local_keys, COUNT(*) AS n_rows FROM lineitem)
SELECT local_keys, n_rows, local_keys <= n_rows AS ok FROM l
""")
def expected_keys(t):
    """Distinct upsert keys may not exceed the rows the other side reports."""
    keys = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    return keys.agg(F.count(F.lit(1)).alias("local_keys"), F.sum("n").alias("n_rows")).withColumn(
        "ok", F.col("local_keys") <= F.col("n_rows"))


@query("""
SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS period, COUNT(DISTINCT o_orderstatus) AS n_values
FROM orders GROUP BY 1, 2 HAVING COUNT(DISTINCT o_orderstatus) > 1
""")
def key_collapse(t):
    rows = t.orders.select("o_custkey", month_key(F.col("o_orderdate")).alias("period"), "o_orderstatus")
    return inc.colliding_keys(rows, ["o_custkey", "period"], "o_orderstatus")


@query("""
WITH g AS (SELECT date_diff('day', o_orderdate, l_shipdate) AS lag FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT COUNT(*) AS n, COUNT(*) FILTER (lag > 7) AS late, COUNT(*) FILTER (lag < 0) AS negative,
       MIN(lag) AS min_lag, MAX(lag) AS max_lag FROM g
""")
def late_data(t):
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lag = F.datediff("l_shipdate", "o_orderdate").cast("long")
    g = t.lineitem.select("l_orderkey", "l_shipdate").join(o, "l_orderkey").select(lag.alias("lag"))
    return g.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("lag") > 7).alias("late"),
                 F.count_if(F.col("lag") < 0).alias("negative"), F.min("lag").alias("min_lag"),
                 F.max("lag").alias("max_lag"))


def _latest_event(df):
    return df.groupBy("user_id", "event_type").agg(
        F.max(F.struct("ts", "event_id", "value")).alias("m")).select(
        "user_id", "event_type", F.col("m.ts").alias("ts"), F.col("m.event_id").alias("event_id"),
        F.col("m.value").alias("value"))


@query("""
SELECT user_id, event_type, MAX(ts) AS ts, arg_max(event_id, ts) AS event_id, arg_max(value, ts) AS value
FROM events GROUP BY 1, 2
""")
def stream_upsert(t):
    """Events land in several files; each micro-batch is merged into the typed table."""
    base = run_dir(t.spark, "stream_upsert")
    t.events.repartitionByRange(4, "ts").write.parquet(f"{base}/landing")
    table = BucketTable(t.spark, f"{base}/typed", ["user_id", "event_type"])
    stream = jobs.landed(t.spark, f"{base}/landing", t.events.schema, files_per_batch=2)
    jobs.upsert_stream(stream, table, _latest_event, F.struct("s.ts", "s.event_id") >= F.struct("t.ts", "t.event_id"), f"{base}/checkpoint")
    return table.read()


@query("""
SELECT event_type, props AS payload, MIN(ts) AS first_ts, 0::BIGINT AS n_late FROM events GROUP BY 1, 2
""")
def stream_dedup(t):
    """First arrival of a payload hash wins, over two runs in the order of time; rows later than the delay are counted apart."""
    base = run_dir(t.spark, "stream_dedup")
    job = jobs.FirstArrivals(t.spark, f"{base}/job", ["news_hash"], "ts", "60 days")
    early = F.col("ts") < ntz("2024-01-16")
    for part in (early, ~early):
        t.events.where(part).write.mode("append").parquet(f"{base}/landing")
        stream = jobs.landed(t.spark, f"{base}/landing", t.events.schema)
        rows = stream.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", F.col("props").alias("payload"),
                             F.sha2(F.concat_ws("|", "event_type", "props"), 256).alias("news_hash"))
        job.run(rows)
    n_late = job.counts().agg(F.sum("n_late")).scalar()
    return job.arrivals(rows.schema).select("event_type", "payload", F.col("ts").cast("timestamp_ntz").alias("first_ts"), n_late.alias("n_late"))


@query("""
SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2
""")
def stream_weekly(t):
    """Two runs over landed files: the second goes on from the state of the first and replaces the weeks it changes."""
    base = run_dir(t.spark, "stream_weekly")
    ev = t.events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    table = BucketTable(t.spark, f"{base}/weeks", ["week_start", "event_type"], 8)
    for part in (early, ~early):
        ev.where(part).write.mode("append").parquet(f"{base}/landing")
        jobs.weekly_stream(jobs.landed(t.spark, f"{base}/landing", ev.schema), "ts", ["event_type"], "7 days", table, f"{base}/checkpoint")
    return table.read()


@query("WITH " + _ATTEMPTS_SQL + """
SELECT d.doc_id, 'failed' AS status, CASE WHEN parser = 'native' THEN attempt ELSE 0 END + 1 AS attempt,
       'file missing: ' || d.source AS error, CAST(NULL AS VARCHAR) AS payload, TIMESTAMP '2024-02-01' AS parsed_at
FROM documents d LEFT JOIN last USING (doc_id)
WHERE parser IS DISTINCT FROM 'native' OR (status <> 'success' AND attempt < 3)
""")
def failed_attempts(t):
    work = inc.retry_queue(t.documents.select("doc_id", "source"), event_attempts(t), "doc_id", parser="native",
                           max_attempts=3, newest=[F.desc("ts"), F.desc("event_id")])
    return inc.failed_attempts(work, F.concat(F.lit("file missing: "), "source"), ntz("2024-02-01")).drop("source")


@query("""
WITH g AS (SELECT user_id, MAX(ts) FILTER (event_type = 'purchase') AS generated_at FROM events GROUP BY 1)
SELECT user_id, generated_at, generated_at IS NULL
  OR floor(epoch(TIMESTAMP '2024-01-31' - generated_at) / 3600) >= 48 AS stale FROM g
""")
def freshness(t):
    g = t.events.groupBy("user_id").agg(
        F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("generated_at"))
    return g.withColumn("stale", inc.is_stale(F.col("generated_at"), ntz("2024-01-31"), 48))


@query("""
WITH r AS (SELECT event_id, event_type, CAST(props->>'$.k' AS INT) AS k FROM events)
SELECT event_id, event_type AS endpoint, k >= 10 AS success, CASE WHEN k >= 50 THEN k END AS created,
       CASE WHEN k < 50 THEN k END AS updated, CAST(NULL AS INT) AS failed FROM r
""")
def delivery_result(t):
    """Counts read from a nested response text, tolerant of missing and non-numeric parts."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    body = F.to_json(F.struct(F.struct(F.when(k >= 50, k).alias("created"), F.when(k < 50, k).alias("updated")).alias("data")))
    resp = t.events.select("event_id", F.col("event_type").alias("endpoint"), k.alias("k"), body.alias("body"))
    p = F.from_json("body", "data STRUCT<created: STRING, updated: STRING, failed: STRING>")
    return resp.withColumn("p", p).select(
        "event_id", "endpoint", (F.col("k") >= 10).alias("success"),
        *[F.col(f"p.data.{c}").try_cast("int").alias(c) for c in ("created", "updated", "failed")])
