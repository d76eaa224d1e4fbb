"""Runs a registered query and its SQL side by side."""

from __future__ import annotations

import glob
import math
import os

import duckdb

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def connect(sf_dir: str = SF):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def normalized(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def spark_result(df):
    return normalized(df.columns, [tuple(x) for x in df.collect()])


def sql_result(sql: str, sf_dir: str = SF):
    cur = connect(sf_dir).execute(sql)
    return normalized([c[0] for c in cur.description], cur.fetchall())
