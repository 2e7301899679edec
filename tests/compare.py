"""Compare a Spark result with its SQL twin in DuckDB, row by row."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda row: tuple((v is None, str(type(v)), v) for v in row))


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty if both sides hold the same rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(names)}"]
    right = _sorted_rows(names, result.fetchall())
    left = _sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(left) != len(right):
        return [f"{len(left)} rows against {len(right)}"]
    return [f"{a} against {b}" for a, b in zip(left, right) if not _same(a, b)][:5]


def _same(a: tuple, b: tuple) -> bool:
    for x, y in zip(a, b):
        if isinstance(x, float) and isinstance(y, float):
            if x != y and not (math.isnan(x) and math.isnan(y)):
                return False
        elif x != y:
            return False
    return True
