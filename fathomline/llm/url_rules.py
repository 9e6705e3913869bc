"""Allow and block rules on urls by a sort-merge range join.

A rule (host, path) fits its host and all subdomains if the path starts with the rule's.
Canonical keys put the host first, labels reversed and closed by a dot, then the path:
``com.example./fr/1``. A url has one key per host suffix, and a rule is the interval of keys
that begin with its own. Starts of rules and keys of urls are sorted together over all
tasks; a sweep over equal blocks keeps the stack of the rules it is in, nested in each other.
Blocks cut the sorted order, not the keys, so a frequent suffix is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.functions.binding import let
from fathomline.llm.columns import small
from fathomline.operators.numbering import row_numbers
from fathomline.session import written

# Events that one sweep goes over, from the rules that are open at its first one.
BLOCK_ROWS = 512


def url_host(url: Column) -> Column:
    """Host of a url, A-Z lower-cased; empty for a null url or one without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """Path of a url up to ``?``, ``#`` or the end; empty for a null url or one without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def rule_intervals(rules: DataFrame) -> DataFrame:
    """Each rule with the reversed host it names, the key that its interval starts at, and what it says (``fit``).

    A rule without host names nothing, and one whose path does not begin with a slash fits no
    url, as a path is empty or begins with one. Of equal rules, block wins.
    """
    own = rules.select(F.lower("host").alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.lower("verdict").alias("verdict"))
    own = own.where(F.col("host").isNotNull() & ((F.col("path") == "") | F.startswith("path", F.lit("/")))).groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    keyed = own.withColumn("suffix", _reversed_host(F.col("host"))).withColumn("key", F.concat("suffix", F.lit("."), "path"))
    text = F.concat("host", "path")
    return keyed.select("suffix", "key", F.struct(F.length(text).alias("size"), (F.col("verdict") == "block").alias("blocks"), text.alias("rule"), F.col("key").alias("start"), "verdict").alias("fit"))


def url_keys(parts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """(key, host, path): each distinct url under every suffix of its host that a rule names."""
    distinct = parts.select("host", "path").where("host != ''").distinct()
    ends = let(F.split("host", r"\."), lambda p: F.transform(F.sequence(F.lit(1), F.size(p)), lambda i: F.array_join(F.reverse(F.slice(p, i, F.size(p))), ".")))
    keyed = distinct.select("host", "path", F.explode(ends).alias("suffix")).join(small(suffixes), "suffix")
    return keyed.select(F.concat("suffix", F.lit("."), "path").alias("key"), "host", "path")


def swept(events: DataFrame, intervals: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(host, path, fit) of the urls among ``events``: the deepest rule on the stack at each of them.

    ``events`` holds starts of rules (side 0, fit) and urls (side 1, host, path). They are
    sorted over all tasks and cut into blocks of equal size. The rules open at the start of a
    block are those whose key begins its first key; from there a sweep over the block pops
    the rules that an event has left, pushes a rule that starts, and reads the top for a url.
    """
    at = row_numbers(events, [], [F.col("key"), F.col("side"), F.col("host"), F.col("path")], "at")
    placed = written(at.withColumn("block", F.floor((F.col("at") - 1) / block_rows)).drop("at"), "url_blocks")
    firsts = placed.groupBy("block").agg(F.min("key").alias("first"))
    begun = firsts.select("block", F.explode(F.transform(F.sequence(F.lit(1), F.length("first")), lambda n: F.substring(F.col("first"), F.lit(1), n))).alias("key"))
    opened = begun.join(intervals.select("key", "fit"), "key").groupBy("block").agg(F.sort_array(F.collect_list("fit")).alias("opened"))
    blocks = placed.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("key", "side", "host", "path", "fit"))).alias("events")).join(opened, "block", "left")
    none = F.lit(None).cast(intervals.schema["fit"].dataType)
    no_rules, no_urls = F.array_compact(F.array(none)), F.filter(F.array(F.struct(F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"), none.alias("fit"))), lambda _: F.lit(False))

    def step(state: Column, event: Column) -> Column:
        def after(stack: Column) -> Column:
            return F.struct(
                F.when(event["side"] == 0, F.concat(stack, F.array(event["fit"]))).otherwise(stack).alias("stack"),
                F.when((event["side"] == 1) & (F.size(stack) > 0), F.concat(state["found"], F.array(F.struct(
                    event["host"].alias("host"), event["path"].alias("path"), F.try_element_at(stack, F.lit(-1)).alias("fit"))))).otherwise(state["found"]).alias("found"))

        return let(F.filter(state["stack"], lambda rule: F.startswith(event["key"], rule["start"])), after)

    begin = F.struct(F.coalesce("opened", no_rules).alias("stack"), no_urls.alias("found"))
    return blocks.select(F.explode(F.aggregate("events", begin, step, lambda state: state["found"])).alias("u")).select("u.*")


def matched_urls(parts: DataFrame, rules: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(host, path, rule, verdict) of every distinct host and path that a rule fits.

    Longest rule wins; of equally long ones block wins, then the larger rule text.
    """
    intervals = written(rule_intervals(rules), "url_rules")
    urls = url_keys(parts, intervals.select("suffix").distinct())
    fit = intervals.schema["fit"].dataType
    events = urls.select("key", F.lit(1).alias("side"), "host", "path", F.lit(None).cast(fit).alias("fit")).union(
        intervals.select("key", F.lit(0), F.lit(None).cast("string"), F.lit(None).cast("string"), "fit"))
    best = swept(events, intervals, block_rows).groupBy("host", "path").agg(F.max("fit").alias("fit"))
    return best.select("host", "path", "fit.rule", "fit.verdict")


def judged_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict; ``default`` is the verdict without a rule.

    A null url or one without ``://`` has an empty host and path and fits no rule. Repeated
    rows stay. A column named like one of the four new ones is replaced.
    """
    new = ("host", "path", "rule", "verdict")
    parts = pages.drop(*new).withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    found = matched_urls(parts, rules).withColumnsRenamed({"host": "_host", "path": "_path"})
    # urls without a host fit nothing and would all meet in one task
    same = (F.col("host") != "") & (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path"))
    return parts.join(found, same, "left").drop("_host", "_path").withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def rule_rows(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path)."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")
