"""Run a query and its SQL and compare all rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(repr(v))
    return v


def rows_of_spark(df) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns)
    return cols, sorted((tuple(_plain(r[c]) for c in cols) for r in df.collect()), key=repr)


def rows_of_duck(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    return cols, sorted((tuple(_plain(r[i]) for i in at) for r in cur.fetchall()), key=repr)


def duck_types(con, sql: str) -> dict[str, str]:
    return {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}


def diff(spark_rows, duck_rows) -> str:
    (sc, sr), (dc, dr) = spark_rows, duck_rows
    if sc != dc:
        return f"columns {sc} != {dc}"
    if len(sr) != len(dr):
        return f"{len(sr)} rows != {len(dr)} rows; first {next((p for p in zip(sr, dr) if p[0] != p[1]), None)}"
    for a, b in zip(sr, dr):
        if a != b:
            return f"spark {a}\n duck {b}"
    return ""
