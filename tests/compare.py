"""Run a registered query and its SQL on the same tables and compare the values."""

from __future__ import annotations

import math
import os
from collections import Counter
from decimal import Decimal

import duckdb

#: The tables that the tests read.
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "boolean": "BOOLEAN"}


def database(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, Decimal):
        return str(v.normalize())
    return v


def differences(df, con, sql: str) -> list[str]:
    """Empty when schema and rows agree."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    kinds = {d[0]: str(d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    want_rows = con.execute(sql).fetchall()
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        want = TYPES.get(kind, kind.upper())
        if kinds[name].replace(" ", "") != want.replace(" ", ""):
            out.append(f"type of {name}: {kind} != {kinds[name]}")
    order = sorted(names)
    at = [names.index(n) for n in order]
    got = Counter(tuple(_cell(r[n]) for n in order) for r in df.collect())
    want = Counter(tuple(_cell(r[i]) for i in at) for r in want_rows)
    if got != want:
        a, b = list((got - want).items()), list((want - got).items())
        out.append(f"rows {sum(got.values())} vs {sum(want.values())}, only Spark {len(a)} {a[:3]}, only SQL {len(b)} {b[:3]}")
    return out
