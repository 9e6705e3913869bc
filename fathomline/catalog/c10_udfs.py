"""Struct results, row generators, key functions, payloads, parameterised queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomline.catalog.derive import mails
from fathomline.catalog.registry import query
from fathomline.functions import markup
from fathomline.functions import text as tx
from fathomline.plans import mail, reports


@query()
def clean_mail(t):
    """One typed row per mail: chosen body, parsed sender, subject, hash, lengths."""
    return mail.clean_rows(mails(t)).select("pk_seq", "subject_clean", "emp_id", "body_source_field", "display_len", "body_hash")


@query()
def segment_rows(t):
    """One mail, many segments."""
    return mail.segment_rows(mail.clean_rows(mails(t))).select("pk_seq", "segment_no", "display_start", "segment_date", "raw_len")


SOURCE_WEIGHTS = {"src1": 5, "src2": 4, "src3": 3}


@query("""
SELECT doc_id, lower(regexp_replace(string_split(text, chr(10))[1], '\\s+', '', 'g')) AS title_key, sha256(lower(regexp_replace(string_split(text, chr(10))[1], '\\s+', '', 'g')) || '|' || COALESCE(
   CASE WHEN ends_with(u, '?') THEN rtrim(u, '?') ELSE u END, '')) AS news_hash, CASE source WHEN 'src1' THEN 5 WHEN 'src2' THEN 4 WHEN 'src3' THEN 3 ELSE 2 END AS weight
FROM documents LEFT JOIN (SELECT page_id, regexp_replace(regexp_replace(url, 'utm_[a-z]+=[^&#]*&?', '', 'g'), '\\?(#|$)', '\\1') AS u FROM pages) ON page_id = doc_id
""")
def news_keys(t):
    """Title key, hash over title and canonical address, weight of the source."""
    urls = t.pages.select(F.col("page_id").alias("doc_id"), tx.canonical_url(F.col("url")).alias("u"))
    title = tx.title_key(F.substring_index("text", "\n", 1))
    return t.documents.join(urls, "doc_id", "left").select(
        "doc_id", title.alias("title_key"),
        F.sha2(F.concat(title, F.lit("|"), F.coalesce("u", F.lit(""))), 256).alias("news_hash"),
        reports.source_weight(F.col("source"), SOURCE_WEIGHTS).alias("weight"))


@query()
def html_payload(t):
    """Payload text per page, built on executors from element rows."""
    pay = markup.payloads(markup.element_rows(t.spread("pages", "page_id"), "page_id", "html"), "page_id")
    return pay.select("page_id", F.length("payload").alias("n_chars"), F.sha1("payload").alias("payload_hash"))


@query("""
SELECT l_suppkey, COUNT(*) AS n, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem
WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1
""")
def param_tvf(t):
    """A parameterised query; the parameters are bound, not pasted into the text."""
    return t.spark.sql("""
        SELECT l_suppkey, COUNT(*) AS n, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM {lines}
        WHERE l_returnflag = :flag AND l_shipdate >= CAST(:start AS TIMESTAMP_NTZ) AND l_shipdate < CAST(:stop AS TIMESTAMP_NTZ)
        GROUP BY l_suppkey""", args={"flag": "R", "start": "1997-01-01", "stop": "1998-01-01"}, lines=t.lineitem)
