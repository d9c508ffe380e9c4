"""Order-free comparison of a Spark result with SQL on the same tables."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _norm(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(repr(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return sorted(df.columns), _norm([tuple(r) for r in df.collect()], df.columns)


def sql_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted(names), _norm(cur.fetchall(), names)


def difference(df, con, sql) -> str | None:
    names, got = spark_rows(df)
    want_names, want = sql_rows(con, sql)
    if names != want_names:
        return f"columns {names} instead of {want_names}"
    if got != want:
        extra, missing = list((got - want).elements()), list((want - got).elements())
        return (
            f"{sum(got.values())} rows instead of {sum(want.values())}; "
            f"extra {extra[:2]}, missing {missing[:2]} of {names}"
        )
    return None
