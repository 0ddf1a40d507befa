"""Compares a query with its DuckDB SQL over the same Parquet tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def oracle_rows(sql: str, folder: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        if Path(folder, f"{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return sorted(names), rows_of(names, found.fetchall())


def compare(spark, query, sql: str, folder: str) -> int:
    frame = query(spark, folder)
    names, wanted = oracle_rows(sql, folder)
    assert sorted(frame.columns) == names
    found = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    assert len(found) == len(wanted)
    for a, b in zip(found, wanted):
        assert a == b, f"{names}\nSpark  {a}\nDuckDB {b}"
    return len(found)
