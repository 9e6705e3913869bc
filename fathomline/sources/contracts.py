"""Declared schemas: manifest to schema, contract checks, added columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DoubleType, LongType, StringType, StructField, StructType

# The column types a manifest may name.
MANIFEST_TYPES = {
    "STRING": StringType(),
    "INT": LongType(),
    "DOUBLE": DoubleType(),
    "BOOLEAN": BooleanType(),
    "DATE": DateType(),
}


def manifest_schema(columns: list[tuple[str, str]]) -> StructType:
    """(name, type name) pairs → schema; an unknown type name is an error."""
    unknown = sorted({t for _, t in columns if t.upper() not in MANIFEST_TYPES})
    if unknown:
        raise ValueError(f"unknown column types: {unknown}")
    return StructType([StructField(n, MANIFEST_TYPES[t.upper()], True) for n, t in columns])


def contract_violations(df: DataFrame, declared: StructType) -> list[str]:
    """Differences of names, order and types between a frame and its declared table."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in declared.fields]
    problems = []
    for i in range(max(len(have), len(want))):
        h = have[i] if i < len(have) else None
        w = want[i] if i < len(want) else None
        if h != w:
            problems.append(f"column {i}: have {h}, declared {w}")
    return problems


def require_contract(df: DataFrame, declared: StructType) -> DataFrame:
    problems = contract_violations(df, declared)
    if problems:
        raise ValueError("; ".join(problems))
    return df


def add_missing_columns(df: DataFrame, declared: StructType) -> DataFrame:
    """Append the declared columns that the stored table lacks, NULL for its rows."""
    missing = [f for f in declared.fields if f.name not in df.columns]
    return df.select(*df.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def create_table_sql(name: str, declared: StructType, keys: list[str], comments: dict[str, str] | None = None,
                     partitioned_by: list[str] | None = None) -> str:
    """CREATE TABLE text: NOT NULL keys, a comment per column, optional partitions."""
    comments = comments or {}
    cols = []
    for f in declared.fields:
        null = " NOT NULL" if f.name in keys else ""
        note = comments.get(f.name)
        comment = " COMMENT '" + note.replace("'", "\\'") + "'" if note else ""
        cols.append(f"{f.name} {f.dataType.simpleString()}{null}{comment}")
    tail = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(cols)}) USING parquet{tail}"


def view_from_spec(source: DataFrame, columns: list[tuple[str, str]], forbidden: tuple[str, ...] = ()) -> DataFrame:
    """(expression, alias) pairs → projection; repeated or forbidden aliases are errors."""
    aliases = [a for _, a in columns]
    repeated = sorted({a for a in aliases if aliases.count(a) > 1})
    banned = sorted(set(aliases) & set(forbidden))
    if repeated or banned:
        raise ValueError(f"bad view: repeated {repeated}, forbidden {banned}")
    return source.selectExpr(*[f"{e} AS {a}" for e, a in columns])
