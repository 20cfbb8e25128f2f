"""Compare a query with its SQL in DuckDB, without regard to the order of rows."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def connection(sf_dir: str, threads: int = 4) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    con.execute(f"SET threads={threads}")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        at = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE TABLE {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{at}')")
    return con


class Database:
    """The tables of a folder. After an internal error, which ends a database, a query is tried once more on a new one with other threads."""

    def __init__(self, sf_dir: str):
        self.sf_dir, self.con = sf_dir, connection(sf_dir)

    def execute(self, sql: str) -> duckdb.DuckDBPyConnection:
        try:
            return self.con.execute(sql)
        except (duckdb.InternalException, duckdb.FatalException):
            self.close()
            self.con = connection(self.sf_dir, threads=8)
            return self.con.execute(sql)

    def close(self) -> None:
        self.con.close()


def plain(v: object) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, float):
        if math.isnan(v) or math.isinf(v):
            return str(v)
        r = round(v, 6)
        return str(int(r)) if r == int(r) and abs(r) < 1e15 else f"{r:.6f}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{plain(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return plain(v.asDict())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return str(v)


def rows_of_spark(df) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns)
    return cols, sorted(tuple(plain(r[c]) for c in cols) for r in df.select(*[f"`{c}`" for c in cols]).collect())


def rows_of_sql(con: Database, sql: str) -> tuple[list[str], list[tuple]]:
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in res.fetchall())


def difference(df, con: Database, sql: str) -> str:
    """Empty if both give the same rows, else the first differences."""
    a, b = rows_of_spark(df), rows_of_sql(con, sql)
    if a[0] != b[0]:
        return f"columns {a[0]} and {b[0]}"
    if a[1] == b[1]:
        return ""
    left, right = set(a[1]) - set(b[1]), set(b[1]) - set(a[1])
    return f"{len(a[1])} and {len(b[1])} rows of {a[0]}; only left {sorted(left)[:3]}; only right {sorted(right)[:3]}"
