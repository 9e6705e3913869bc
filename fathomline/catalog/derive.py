"""Mail-shaped rows that Spark derives from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

# Numbers kept free for the turns of a conversation. A turn or a conversation beyond that is
# an error, never another one's key.
TURNS = 2**32


def mails(t):
    """Every conversation turn as a mail that forwards the turn before it.

    The earlier turn is found by an equi-join on (conversation, turn), so a very
    long conversation stays spread over many tasks. Each fifth conversation has its bodies as
    HTML only, with residue in the text fields.
    """
    c = t.conversations
    prev = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("p_role"), F.col("text").alias("p_text"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("conv_id"), F.lit(28)).cast("int"))
    header = F.concat(
        F.lit("\n\n**From:** "), F.initcap("p_role"), F.lit(" Person <"), F.col("p_role"), F.lit("@mail.example.com> **Sent:** "),
        F.date_format(day, "EEEE, MMMM d, yyyy"), F.lit(" 3:0"), F.pmod(F.col("turn"), F.lit(10)).cast("string"),
        F.lit(" PM\n**To:** desk@other.example.org; Team Desk <team@other.example.org>\n**Subject:** RE: "),
        F.substring_index("p_text", " ", 3), F.lit("\n\n"), F.col("p_text"))
    joined = c.join(prev, ["conv_id", "turn"], "left")
    body = F.concat("text", F.coalesce(header, F.lit("")))
    sender = F.when(F.col("role") == "assistant", F.col("role")).otherwise(F.concat(
        F.lit("1000"), F.lpad(F.pmod("conv_id", F.lit(1000)).cast("string"), 3, "0"), F.lit("/"), F.initcap("role"),
        F.lit("/acct"), F.col("conv_id").cast("string"), F.lit("/ML"), F.pmod("conv_id", F.lit(7)).cast("string"), F.lit("A01")))
    key = F.when(F.col("turn") >= TURNS, F.raise_error(F.lit("turn number too large"))).otherwise(F.col("conv_id") * F.lit(TURNS) + F.col("turn"))
    as_html = F.pmod("conv_id", F.lit(5)) == 0
    escaped = F.replace(F.replace(F.replace(body, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page = F.concat(F.lit("<html><head><style>p {}</style></head><body><p>"), F.replace(escaped, F.lit("\n"), F.lit("<br>")), F.lit("</p></body></html>"))

    def told(text):
        return F.when(as_html, F.lit("Normal\nEN-US")).otherwise(text)

    return joined.select(
        key.cast("long").alias("pk_seq"), "conv_id", "turn", "role", day.alias("mail_date"),
        sender.alias("mail_from"), F.concat(F.lit("FW: Re: "), F.substring_index("text", " ", 4)).alias("mail_subject"),
        told(F.when(F.length("text") >= 400, body)).alias("mail_body_md"), told(body).alias("mail_without_fw"), told(F.col("text")).alias("mail_body"),
        F.when(as_html, page).alias("mail_body_html"),
        F.lit("desk@other.example.org; 'Lee, Ann'; Sales Team <SALES@Mail.Example.com>; IMCEAEX-x@bad.example.com").alias("mail_to"))
