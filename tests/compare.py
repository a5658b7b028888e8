"""Compare a Spark result with the rows of its SQL counterpart."""

from __future__ import annotations

import duckdb

SF_SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Nothing if names, types of values, and values are all the same."""
    mine = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    theirs = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(set(df.columns) ^ set(names))}"]
    if len(mine) != len(theirs):
        return [f"rows {len(mine)} != {len(theirs)}"]
    a, b = _sorted_rows(df.columns, mine), _sorted_rows(names, theirs)
    return [f"{x} != {y}" for x, y in zip(a, b) if x != y]
