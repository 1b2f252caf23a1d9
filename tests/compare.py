"""Compare a Spark result with the DuckDB result of its SQL, value by value."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    """The value in a form that shows its type: 1 and 1.0 differ, a date and its text differ."""
    if isinstance(value, (decimal.Decimal, datetime.datetime, datetime.date, bool)):
        return f"{type(value).__name__}:{value}"
    if isinstance(value, float):
        return f"float:{value + 0.0!r}"
    return f"{type(value).__name__}:{value}"


def difference(df, con, sql: str) -> str | None:
    """None when columns, row counts and all values agree; else what differs."""
    relation = con.sql(sql)
    ours, theirs = df.columns, relation.columns
    if sorted(ours) != sorted(theirs):
        return f"columns: only ours {sorted(set(ours) - set(theirs))}, only sql {sorted(set(theirs) - set(ours))}"
    order = sorted(ours)
    mine = df.select(*[df[f"`{c}`"] for c in order]).toArrow().to_pylist()
    want_cols = [theirs.index(c) for c in order]
    want = Counter(tuple(plain(r[i]) for i in want_cols) for r in relation.fetchall())
    got = Counter(tuple(plain(r[c]) for c in order) for r in mine)
    if got == want:
        return None
    extra, lack = got - want, want - got
    return (
        f"rows {sum(got.values())} vs {sum(want.values())}; {order}\n"
        f"  only ours ({sum(extra.values())}): {sorted(extra)[:3]}\n  only sql ({sum(lack.values())}): {sorted(lack)[:3]}"
    )
