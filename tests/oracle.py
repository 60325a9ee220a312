"""Runs a registered query and its SQL side by side."""

import decimal
from pathlib import Path

import duckdb
import numpy as np

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, list | tuple | np.ndarray):
        return tuple(plain(x) for x in v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v


def of_sql(sql: str, folder: str) -> tuple[list[str], list[tuple]]:
    c = duckdb.connect()
    for t in TABLES:
        if Path(folder, f"{t}.parquet").exists():
            c.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    r = c.sql(sql)
    order = sorted(range(len(r.columns)), key=lambda i: r.columns[i])
    return sorted(r.columns), sorted((tuple(plain(row[i]) for i in order) for row in r.fetchall()), key=repr)


def of_df(df) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    return sorted(df.columns), sorted((tuple(plain(row[i]) for i in order) for row in df.collect()), key=repr)
