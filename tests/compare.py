"""Compare a query's rows with DuckDB's on the same tables, types included."""

import math

import duckdb

from tradeloom.sources.trades import TABLES

SAME_TYPE = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value + 0.0))
    return (1, str(value))


def differences(df, con, sql: str) -> list[str]:
    """Empty if column names, types and the multiset of rows agree."""
    relation = con.sql(sql)
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    found = []
    actual_types = {name: SAME_TYPE.get(kind, kind) for name, kind in df.dtypes}
    if actual_types != expected_types:
        odd = {
            c: (actual_types.get(c), expected_types.get(c))
            for c in {*actual_types, *expected_types}
            if actual_types.get(c) != expected_types.get(c)
        }
        found.append(f"types: {odd}")
    columns = sorted(set(df.columns) & set(relation.columns))
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = sorted(tuple(map(_key, r)) for r in con.sql(f"SELECT {quoted} FROM ({sql})").fetchall())
    have = sorted(tuple(map(_key, r)) for r in df.select(*columns).collect())
    if len(want) != len(have):
        found.append(f"rows: {len(have)} instead of {len(want)}")
    if want != have:
        wrong = next(((h, w) for h, w in zip(have, want) if h != w), None)
        bad = sum(h != w for h, w in zip(have, want))
        found.append(f"values: {bad} differ, first {wrong}")
    return found
