"""Compare a Spark result with DuckDB: columns, types, and all values."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()

SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
               "date": "DATE", "float": "FLOAT"}


def duck(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        if Path(f"{root}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return con


def cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return value


def difference(df, con, sql) -> str | None:
    """None when equal, else what differs first."""
    rel = con.sql(sql)
    types = {f.name: SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    other = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    if sorted(types) != sorted(other):
        return f"columns {sorted(types)} against {sorted(other)}"
    wrong = {n: (types[n], other[n]) for n in types if types[n] != other[n]}
    if wrong:
        return f"types {wrong}"
    names = sorted(types)
    mine = Counter(tuple(cell(r[n]) for n in names) for r in df.collect())
    place = {n: i for i, n in enumerate(rel.columns)}
    theirs = Counter(tuple(cell(r[place[n]]) for n in names) for r in rel.fetchall())
    if mine != theirs:
        return (f"rows {sum(mine.values())} against {sum(theirs.values())}; {names}; "
                f"only here {list((mine - theirs).items())[:3]}; only there {list((theirs - mine).items())[:3]}")
    return None
