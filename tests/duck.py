"""Compare a named query with its DuckDB twin, value by value."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(tuple(r[i] for i in order) for r in cursor.fetchall())


def typed(rows: Counter) -> dict:
    """The same rows with their Python types, so that 1 and 1.0 or True differ."""
    return {tuple((type(v).__name__, v) for v in row): n for row, n in rows.items()}


def difference(df, con, sql: str) -> str:
    names, ours = spark_rows(df)
    expected_names, expected = duck_rows(con, sql)
    if names != expected_names:
        return f"columns {names} vs {expected_names}"
    a, b = typed(ours), typed(expected)
    if a == b:
        return ""
    return (f"{sum(ours.values())} vs {sum(expected.values())} rows; "
            f"ours {list((ours - expected) or (a.keys() - b.keys()))[:2]}; "
            f"expected {list((expected - ours) or (b.keys() - a.keys()))[:2]}"[:900])
