"""Running a query and its SQL side by side."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def spark_rows(df):
    return _sorted_rows(df.columns, df.collect())


def sql_rows(sql: str, sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    result = connection.execute(sql)
    return _sorted_rows([column[0] for column in result.description], result.fetchall())


def mismatches(df, sql: str, sf_dir: str, most: int = 5) -> list[str]:
    """What differs, in words; empty when names, types of values and all rows agree."""
    names, rows = spark_rows(df)
    expected_names, expected = sql_rows(sql, sf_dir)
    if names != expected_names:
        return [f"columns {names} != {expected_names}"]
    if len(rows) != len(expected):
        return [f"{len(rows)} rows != {len(expected)}"]
    found = [f"{a} != {b}" for a, b in zip(rows, expected, strict=True) if a != b or list(map(type, a)) != list(map(type, b))]
    return [f"{len(found)} rows differ", *found[:most]] if found else []
