"""Compare a Spark result with a DuckDB SQL oracle, order-insensitively.

Values are normalised (dates to ISO text, floats rounded, NULL-likes to
None) and rows compared as sorted multisets; column names are compared
sorted, as the driver does.
"""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

DRIVER_VIEWS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for v in DRIVER_VIEWS:
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{sf_dir}/{v}.parquet')")
    return con


def _norm(v, digits: int):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits)
    if isinstance(v, Decimal):
        return round(float(v), digits)
    if isinstance(v, bool):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def spark_rows(df, digits: int = 6):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c], digits) for c in cols) for r in df.collect()]


def duck_rows(con, sql: str, digits: int = 6):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = rel.fetchall()
    return [names[i] for i in order], [tuple(_norm(r[i], digits) for i in order) for r in rows]


def compare(df, con, sql: str, digits: int = 6) -> tuple[bool, str]:
    scols, srows = spark_rows(df, digits)
    ocols, orows = duck_rows(con, sql, digits)
    if scols != ocols:
        return False, f"columns differ: spark={scols} oracle={ocols}"
    if len(srows) != len(orows):
        return False, f"row counts differ: spark={len(srows)} oracle={len(orows)}"
    cs, co = Counter(srows), Counter(orows)
    if cs != co:
        only_s = list((cs - co).elements())[:3]
        only_o = list((co - cs).elements())[:3]
        return False, f"values differ; spark-only={only_s} oracle-only={only_o}"
    return True, f"{len(srows)} rows equal"
