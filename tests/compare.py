"""Compare a Spark result with its SQL counterpart, order-insensitively and with types."""

from __future__ import annotations

from pathlib import Path

import duckdb

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    spark_types = {n: TYPES.get(t, t) for n, t in df.dtypes}
    result = con.sql(sql)
    sql_types = {n: str(t) for n, t in zip(result.columns, result.types)}
    if spark_types != sql_types:
        return f"schema: {sorted(set(spark_types.items()) ^ set(sql_types.items()))}"
    ours, theirs = _rows(df.columns, df.collect()), _rows(result.columns, result.fetchall())
    if len(ours) != len(theirs):
        return f"rows: {len(ours)} against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        columns = sorted(df.columns)
        a, b = wrong[0]
        cells = [(c, x, y) for c, x, y in zip(columns, a, b) if x != y]
        return f"{len(wrong)} rows differ, first: {cells} in {a}"
    return None
