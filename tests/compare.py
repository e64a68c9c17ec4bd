"""Run a query on Spark and its SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def check(df, con, sql):
    relation = con.sql(sql)
    ours, theirs = list(df.columns), list(relation.columns)
    assert sorted(ours) == sorted(theirs), f"columns differ: {sorted(set(ours) ^ set(theirs))}"
    left = rows_of(ours, [tuple(r) for r in df.collect()])
    right = rows_of(theirs, relation.fetchall())
    assert len(left) == len(right), f"{len(left)} rows, expected {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    assert not wrong, f"{len(wrong)} rows differ, first: {wrong[0]}"
    return len(left)
