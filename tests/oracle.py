"""Run a query in both engines and compare all rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 9)
    return value


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in data)


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None if both sides agree, otherwise what differs."""
    df = query(spark, sf_dir)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours = rows(df.columns, df.collect())
    expected = rows(names, theirs)
    if ours == expected:
        return None
    return (
        f"{sum(ours.values())} rows against {sum(expected.values())}; "
        f"only ours: {list((ours - expected).items())[:3]}; only theirs: {list((expected - ours).items())[:3]}"
    )
