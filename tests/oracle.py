"""Run a registered query and its check, and tell how the results differ."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def _value(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, int):
        return value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def _family(kind: str) -> str:
    kind = kind.lower()
    for family, marks in (("int", ("int", "long")), ("float", ("double", "float", "decimal")), ("text", ("varchar", "string")), ("bool", ("bool",))):
        if any(m in kind for m in marks):
            return family
    return kind


def compare(spark, con, folder, build, sql) -> str:
    """Empty when both agree, else a short account of the difference."""
    df = build(spark, folder)
    got = _rows(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    kinds = {d[0]: _family(str(d[1])) for d in cursor.description}
    mine = {f.name: _family(f.dataType.simpleString()) for f in df.schema.fields}
    off = {c: (mine[c], kinds[c]) for c in names if mine[c] != kinds[c] and str(kinds[c]) != "number"}
    if got != want:
        have, need = set(got), set(want)
        only_got = [r for r in got if r not in need][:3]
        only_want = [r for r in want if r not in have][:3]
        return f"rows {len(got)} vs {len(want)}; columns {sorted(names)}\n  spark  {only_got}\n  check  {only_want}"
    return f"types {off}" if off else ""
