"""Predicates, ordered rule lists and small fixed maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contains_all(df: DataFrame, words: dict[str, str]) -> DataFrame:
    """Case-insensitive contains per column; an empty word filters nothing."""
    for c, word in words.items():
        if word.strip():
            df = df.where(F.lower(c).contains(word.strip().lower()))
    return df


def half_open_days(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """Whole days first … last of a time stamp column, as a half-open range on the column itself."""
    kind = df.schema[column].dataType
    return df.where(
        (F.col(column) >= F.lit(first).cast(kind))
        & (F.col(column) < F.date_add(F.lit(last).cast("date"), 1).cast(kind))
    )


def bad_format(column: str, pattern: str) -> Column:
    return F.col(column).isNull() | ~F.col(column).rlike(pattern)


def not_allowed(column: str, allowed: list[str]) -> Column:
    return F.col(column).isNull() | ~F.col(column).isin(allowed)


def decide(chain: list[tuple[str, Column]], default: str | None) -> Column:
    """First condition that holds names the row."""
    out = F.lit(default)
    for name, cond in reversed(chain):
        out = F.when(cond, F.lit(name)).otherwise(out)
    return out


def split_by_rules(df: DataFrame, rule_list: list[tuple[str, str]], reason: str = "skip_reason") -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined): the first SQL predicate that holds gives the reason."""
    tagged = df.withColumn(reason, decide([(n, F.expr(p)) for n, p in rule_list], None))
    return tagged.where(F.col(reason).isNull()).drop(reason), tagged.where(F.col(reason).isNotNull())


def split_routes(df: DataFrame, routes: dict[str, Column], rest: str) -> dict[str, DataFrame]:
    """Disjoint frames by the first route that applies."""
    tagged = df.withColumn("_route", decide(list(routes.items()), rest))
    return {r: tagged.where(F.col("_route") == r).drop("_route") for r in [*routes, rest]}


def literal_map(values: dict[str, str]) -> Column:
    """Dictionary as a map column; an empty one stays typed."""
    if not values:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def map_value(key: Column, values: dict[str, str], default: Column | None = None) -> Column:
    hit = F.try_element_at(literal_map(values), key)
    return hit if default is None else F.coalesce(hit, default)


def parse_options(file_name: Column, kind: Column, by_kind: dict[str, dict], default: dict) -> Column:
    """Option key of a document: web pages go to the native parser, others by kind."""
    import json

    def key(d):
        return json.dumps(d, sort_keys=True, separators=(",", ":"))

    chosen = map_value(kind, {k: key(v) for k, v in by_kind.items()}, F.lit(key(default)))
    return F.when(F.lower(file_name).rlike(r"\.html?$"), F.lit(key({"engine": "native"}))).otherwise(chosen)


def routed_views(category: Column, by_category: dict[str, list[str]], default: list[str], override: Column,
                 requested: list[str]) -> Column:
    """Views of an entity: by category, replaced by its override, limited to the requested ones."""
    views = F.array(*[F.lit(v) for v in default])
    for c, names in by_category.items():
        views = F.when(category == c, F.array(*[F.lit(n) for n in names])).otherwise(views)
    return F.array_intersect(F.coalesce(override, views), F.array(*[F.lit(r) for r in requested]))


def ordinal_rank(value: Column, order: list[str]) -> Column:
    """Position in an ordered list of levels, NULL for an unknown level."""
    return F.nullif(F.array_position(F.array(*[F.lit(o) for o in order]), value), F.lit(0))


def ordinal_value(rank: Column, order: list[str]) -> Column:
    return F.try_element_at(F.array(*[F.lit(o) for o in order]), rank.cast("int"))
