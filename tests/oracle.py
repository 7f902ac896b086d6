"""Compare a Spark result with its SQL equivalent: same columns, same rows, order ignored."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

from riskframe.plans.views import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    """Comparable form of a cell; numbers keep their value, not their type."""
    if isinstance(value, (bool, str, bytes)) or value is None:
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return float(value) if isinstance(value, int) else value


def differences(df, con, sql: str) -> list[str]:
    """Empty when the results agree, otherwise a short description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected_rows = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(set(df.columns) ^ set(names))}"]
    order = sorted(names)
    mine = Counter(tuple(plain(row[c]) for c in order) for row in df.collect())
    picks = [names.index(c) for c in order]
    theirs = Counter(tuple(plain(row[i]) for i in picks) for row in expected_rows)
    found = []
    if sum(mine.values()) != sum(theirs.values()):
        found.append(f"rows {sum(mine.values())} against {sum(theirs.values())}")
    extra, missing = mine - theirs, theirs - mine
    if extra or missing:
        found.append(f"{sum(extra.values())} of {sum(mine.values())} rows differ; columns {order}")
        key = lambda r: tuple(str(x) for x in r)
        found += [f"  spark {str(r)[:400]}" for r in sorted(extra, key=key)[:3]]
        found += [f"  sql   {str(r)[:400]}" for r in sorted(missing, key=key)[:3]]
    return found
