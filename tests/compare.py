"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return str(int(value)) if value.is_integer() else f"{value:.6f}"
    return "\0" if value is None else str(value)


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> None:
    df = query(spark, sf_dir)
    found = canonical(df.columns, [tuple(r) for r in df.collect()])
    relation = con.sql(sql)
    expected = canonical(relation.columns, relation.fetchall())
    assert sorted(df.columns) == sorted(relation.columns), name
    assert len(found) == len(expected), f"{name}: {len(found)} rows, expected {len(expected)}"
    different = [(f, e) for f, e in zip(found, expected) if f != e]
    assert not different, f"{name}: {len(different)} rows differ, e.g. {different[0]}"
