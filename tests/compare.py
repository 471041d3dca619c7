"""Compare a Spark result with a SQL result: same columns, same rows in any order."""

from __future__ import annotations

import datetime as dt
import decimal
import math

SMALL = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canon(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (float, decimal.Decimal)):
        return f"{float(value):.4f}"
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canon(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> str:
    """Empty text when equal."""
    cur = con.execute(sql)
    names, want_rows = [d[0] for d in cur.description], cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    got, want = rows_of(df.columns, df.collect()), rows_of(names, want_rows)
    if got == want:
        return ""
    only_got, only_want = set(got) - set(want), set(want) - set(got)
    return (f"{len(got)} rows, expected {len(want)}; {sorted(names)}\n"
            f"  only spark: {list(only_got)[:2]}\n  only sql: {list(only_want)[:2]}")
