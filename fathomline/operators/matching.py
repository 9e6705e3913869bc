"""Dictionary matching by hash joins: aliases, leaked numbers, domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions import text as tx
from fathomline.operators.skew import HOT_ROWS, attach_groups
from fathomline.session import written


def substrings_of_lengths(c: Column, lengths: Column) -> Column:
    """All distinct substrings whose length is in ``lengths``."""
    n = F.length(c)
    return F.array_distinct(F.flatten(F.transform(
        F.filter(lengths, lambda k: k <= n),
        lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(c, i, k)))))


def alias_match(rows: DataFrame, raw: str, row_key: str, aliases: DataFrame, alias: str, entity: str,
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Names → entity: equal after normalising, else the longest alias contained.

    Short ASCII aliases (under three characters) count as whole words only. Each
    distinct name is matched once: its substrings of the alias lengths are joined
    by hash, instead of comparing every name with every alias. The match goes back
    to the rows with hot names spread.
    """
    al = aliases.select(tx.loose_key(F.col(alias)).alias("_k"), F.col(entity)).where("_k <> ''").groupBy("_k").agg(
        F.min(entity).alias(entity))
    short = (F.length("_k") < 3) & F.col("_k").rlike(r"^\p{ASCII}+$")
    lengths = al.where(~short).agg(F.array_sort(F.collect_set(F.length("_k")))).scalar()
    names = rows.where(F.col(raw).isNotNull()).groupBy(raw).agg(F.count(F.lit(1)).alias("_n"))
    keyed = names.withColumns({"_name": tx.loose_key(F.col(raw)), "_lengths": lengths})
    parts = F.transform(substrings_of_lengths(F.col("_name"), F.col("_lengths")), lambda s: F.struct(s.alias("_k"), F.lit(False).alias("word")))
    words = F.transform(
        F.array_distinct(F.filter(F.split(F.lower(raw), "[^a-z0-9]+"), lambda w: (w != "") & (F.length(w) < 3))),
        lambda w: F.struct(w.alias("_k"), F.lit(True).alias("word")))
    cand = keyed.select(raw, "_name", "_n", F.explode(F.concat(parts, words)).alias("c")).select(raw, "_name", "_n", "c.*")
    hits = cand.join(al.withColumn("_short", short), "_k").where(F.col("word") == F.col("_short"))
    best = hits.groupBy(raw).agg(
        F.max_by(entity, F.struct(F.col("_k") == F.col("_name"), F.length("_k"), F.col("_k"))).alias(entity),
        F.any_value("_n").alias("_n"))
    return attach_groups(rows, best, [raw], "_n", [row_key], hot_rows).drop("_n")


def shown_items(outgoing: DataFrame, row_key: list[str], items: DataFrame, cell: list[str], text: str) -> DataFrame:
    """(row_key, cell, item columns) of every confidential item that an outgoing text of its cell shows.

    ``items`` has value (digits and points) and unit, one row per cell, value and unit, and
    any further columns. A value counts with numeric boundaries, that is as a whole run of
    digits and points; if it has a unit of any length, with the unit right before or after
    it; without one it needs two characters. Case, thousands commas and white space do not
    matter. A null cell has no items.

    Every run of a text is joined by hash on (cell, value, unit) with all items of the cell,
    the unit being each stretch before and after the run that is as long as some unit. A row
    counts an item once. The items side has one row per key, so a cell or value that fills a
    third of all rows only has many rows on the other side, which the skew join splits.
    """
    named = items.withColumns({"value": F.replace("value", F.lit(","), F.lit("")), "unit": F.lower(tx.squeeze(F.col("unit")))})
    extra = [c for c in items.columns if c not in {*cell, "value", "unit"}]
    secret = written(named.where((F.col("unit") != "") | (F.length("value") >= 2)), "confidential_items")
    # Distinct lengths only: as many numbers as the longest unit has characters, at most; and whether a value is points alone.
    shapes = secret.select(F.length("unit").alias("k"), F.col("value").rlike(r"^\.+$").alias("bare")).distinct().collect()
    lengths = sorted({r.k for r in shapes if r.k})
    # Most runs of a prose text are full stops. Where no value is points alone, only runs with a digit can show one.
    run = r"[\p{Nd}.]+" if any(r.bare for r in shapes) else r"(?<![\p{Nd}.])\.*+\p{Nd}[\p{Nd}.]*+"
    plain = outgoing.select(*row_key, *cell, F.lower(F.replace(tx.squeeze(F.col(text)), F.lit(","), F.lit(""))).alias("_t"))
    beside = run + r"(?= *(.{0,%d}))" % (lengths[-1] if lengths else 0)
    after = F.regexp_extract_all("_t", F.lit(beside), F.lit(1))
    before = F.transform(F.reverse(F.regexp_extract_all(F.reverse("_t"), F.lit(beside), F.lit(1))), F.reverse)
    runs = plain.select(*row_key, *cell, F.explode(F.arrays_zip(
        F.regexp_extract_all("_t", F.lit(run), F.lit(0)).alias("value"), after.alias("after"), before.alias("before"))).alias("_r"))
    cuts = [cut for k in lengths for cut in (F.when(F.length("_r.after") >= k, F.left("_r.after", F.lit(k))), F.when(F.length("_r.before") >= k, F.right("_r.before", F.lit(k))))]
    units = F.array_distinct(F.array_compact(F.array(F.lit(""), *cuts)))
    shown = runs.select(*row_key, *cell, F.col("_r.value").alias("value"), F.explode(units).alias("unit")).distinct()
    return shown.join(secret.select(*cell, "value", "unit", *extra), [*cell, "value", "unit"])


def leaked_cells(outgoing: DataFrame, items: DataFrame, cell: list[str], text: str) -> DataFrame:
    """Cells whose outgoing text shows a number of a confidential item (see ``shown_items``)."""
    distinct = items.select(*cell, "value", F.coalesce("unit", F.lit("")).alias("unit")).distinct()
    return shown_items(outgoing, [], distinct, cell, text).select(*cell).distinct()


def email_domains(df: DataFrame, key: str, text: str, internal: list[str]) -> DataFrame:
    """(key, domain) once per text, lower case, with the internal flag; the address is not kept."""
    doms = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(tx.EMAIL_DOMAIN), F.lit(1)), F.lower))
    return df.select(key, F.explode(doms).alias("domain")).withColumn("is_internal", F.col("domain").isin(internal))
