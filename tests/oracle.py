"""Runs queries beside their SQL and compares rows without regard to order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


SAME_TYPE = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT"}


def normal(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(normal(r[i]) for i in order) for r in rows], key=repr)


def compare(spark, con, query, oracle, sf):
    """None where both agree, otherwise what differs; and the row count."""
    df = query(spark, sf)
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    types = {name: kind for name, kind, *_ in con.execute(f"DESCRIBE {oracle}").fetchall()}
    cur = con.execute(oracle)
    names = [d[0] for d in cur.description]
    right = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(left)
    for field in df.schema.fields:
        if SAME_TYPE.get(field.dataType.simpleString()) != types[field.name]:
            return f"type of {field.name}: {field.dataType.simpleString()} != {types[field.name]}", len(left)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}", len(left)
    for a, b in zip(left, right):
        if a != b:
            return f"first difference\n  spark {str(a)[:600]}\n  sql   {str(b)[:600]}", len(left)
    return None, len(left)
