"""Order-insensitive comparison of a Spark result with DuckDB SQL on the same tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

# Types that stand for the same thing in the two engines.
_KINDS = {
    "string": "VARCHAR",
    "double": "DOUBLE",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _bag(rows: list[tuple]) -> Counter:
    def plain(value):
        return None if isinstance(value, float) and math.isnan(value) else value

    return Counter(tuple(plain(value) for value in row) for row in rows)


def assert_same(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Same column names, types and bag of rows; returns the number of rows."""
    names = sorted(result.columns)
    expected = connection.sql(sql)
    assert sorted(expected.columns) == names
    kinds = dict(zip(expected.columns, map(str, expected.types), strict=True))
    assert {name: _KINDS[kind] for name, kind in result.dtypes} == kinds
    quoted = ", ".join(f'"{name}"' for name in names)
    want = _bag(connection.sql(f"SELECT {quoted} FROM ({sql})").fetchall())
    got = _bag([tuple(row) for row in result.select(*names).collect()])
    if want != got:
        missing, extra = want - got, got - want
        raise AssertionError(
            f"{sum(missing.values())} rows missing, {sum(extra.values())} extra, "
            f"e.g. {list(missing)[:2]} / {list(extra)[:2]}"
        )
    return sum(want.values())
