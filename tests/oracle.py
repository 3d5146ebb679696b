"""Runs a registered query and its SQL twin and compares them value by value."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def normalised(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences, empty if there are none."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    actual = [tuple(r) for r in spark_df.collect()]
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    a, e = normalised(spark_df.columns, actual), normalised(names, expected)
    if len(a) != len(e):
        return [f"{len(a)} rows != {len(e)}"]
    return [f"{x} != {y}" for x, y in zip(a, e) if x != y]
