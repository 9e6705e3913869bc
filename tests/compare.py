"""Order-free comparison of a Spark result with a check-SQL result."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb
import pyarrow as pa

from fathomline.sources.tables import NAMES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int,)):
        return str(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return repr(round(v, 9) + 0.0) if v != int(v) else str(int(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def normalised(table: pa.Table) -> list[tuple]:
    cols = [table.column(c).to_pylist() for c in sorted(table.column_names)]
    return sorted(zip(*[[_value(v) for v in c] for c in cols])) if cols else []


def arrow_types(a: pa.Table, b: pa.Table) -> dict[str, str]:
    """Columns whose types differ between the two results."""
    out = {}
    for c in sorted(a.column_names):
        ta, tb = str(a.schema.field(c).type), str(b.schema.field(c).type)
        if ta.replace("large_", "") != tb.replace("large_", ""):
            out[c] = f"{ta}|{tb}"
    return out
