"""Runs a query and its SQL over the same tables and compares the rows."""

from __future__ import annotations

from pathlib import Path

import duckdb


def connection(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path if path.is_file() else path / '*.parquet'}'")
    return con


def canonical(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(x):
        if x is None or x != x:
            return None
        return round(x, 5) if isinstance(x, float) else str(x)

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=str)


def compare(spark, con, sf: str, query, sql: str) -> None:
    df = query(spark, sf)
    found = con.execute(sql)
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.collect(), df.columns) == canonical(found.fetchall(), columns)
