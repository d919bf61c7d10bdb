"""Compare registered queries with their SQL on the given tables."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if value is not None and not isinstance(value, (str, int, bool)):
        return str(value)
    return value


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    found = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(names), sorted(found, key=repr)


def compare(spark, con, name, query, sql, sf_dir) -> str | None:
    """None when equal, otherwise the first difference."""
    df = query(spark, sf_dir)
    got_names, got = normal(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_names, want = normal([c[0] for c in result.description], result.fetchall())
    if got_names != want_names:
        return f"{name}: columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{name}: {len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{name}: {a!r} != {b!r}"[:600]
    return None if got else f"{name}: no rows"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from gleanwork.session import local_session

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session()
    con = connect(sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    for name, query in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, name, query, sqls[name], sf)
            else:
                problem = f"rows only: {query(spark, sf).count()}"
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{time.time() - start:6.1f}s {name}: {problem or 'equal'}", flush=True)
