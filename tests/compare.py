"""Run a query and its SQL on the same parquet tables and compare the rows, whatever their order."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> dict:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    kinds = {d[0]: str(d[1]) for d in cur.description}
    return {
        "columns": sorted(names) == sorted(df.columns),
        "rows": (sum(got.values()), sum(want.values())),
        "missing": list((want - got).elements())[:3],
        "extra": list((got - want).elements())[:3],
        "types": {c: (t, kinds.get(c)) for c, t in df.dtypes},
    }
