"""Compare a Spark query with its SQL statement in DuckDB: columns by name, rows as a multiset."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{folder}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0) if value else "0.0"
    return repr(value)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in data)


def differences(df, con, sql) -> list[str]:
    got_names, got = rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_names, want = rows([d[0] for d in result.description], result.fetchall())
    problems = []
    if got_names != want_names:
        problems.append(f"columns {got_names} against {want_names}")
    if sum(got.values()) != sum(want.values()):
        problems.append(f"rows {sum(got.values())} against {sum(want.values())}")
    if got != want:
        extra, lost = got - want, want - got
        problems.append(f"values: {sum(extra.values())} differ, e.g. {sorted(extra)[:3]} against {sorted(lost)[:3]}")
    return problems
