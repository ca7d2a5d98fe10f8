"""Run a registered query and its SQL counterpart, and tell how they differ."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def open_oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return "decimal " + str(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return repr(value)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_plain(r[i]) for i in order) for r in rows])


_SAME_TYPE = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when names, types, row counts and values are the same."""
    cursor = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in cursor.description}
    their_rows = cursor.fetchall()
    ours = dict(spark_df.dtypes)
    if sorted(ours) != sorted(theirs):
        return [f"columns: {sorted(set(ours) ^ set(theirs))}"]
    found = [
        f"type of {n}: {t} / {theirs[n]}" for n, t in ours.items() if _SAME_TYPE.get(t, t) != theirs[n]
    ]
    our_rows = spark_df.collect()
    if len(our_rows) != len(their_rows):
        found.append(f"rows: {len(our_rows)} / {len(their_rows)}")
    left = _sorted_rows(spark_df.columns, our_rows)
    right = _sorted_rows(list(theirs), their_rows)
    if left != right:
        names = sorted(ours)
        ls, rs = set(left), set(right)
        for a, b in list(zip(sorted(ls - rs), sorted(rs - ls)))[:2]:
            found.append(str({n: (x, y) for n, x, y in zip(names, a, b) if x != y}))
        found.append(f"only here {len(ls - rs)}, only there {len(rs - ls)}")
    return found
