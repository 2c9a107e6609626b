"""Compare every catalogue query with its SQL on one scale."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str):
    """None if equal, else a short text."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    expected = rows_of(names, result.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if not expected:
        return "the SQL returns no rows"
    if got == expected:
        types = {n: str(t) for n, t in zip(names, [d[1] for d in con.execute(f"DESCRIBE {sql}").fetchall()])}
        wanted = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
        off = [(c, k, types[c]) for c, k in df.dtypes if wanted.get(k) != types[c]]
        return f"TYPES {off}" if off else None
    extra, missing = got - expected, expected - got
    return f"{sum(extra.values())} extra {list(extra)[:3]} / {sum(missing.values())} missing {list(missing)[:3]} (of {sum(expected.values())})"


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from __spark_entry__ import oracle_sql, queries
    from tallyloom.runtime import local_session

    folder, only = sys.argv[1], sys.argv[2:]
    spark, con, oracles, bad = local_session(8), connect(folder), oracle_sql(), 0
    for name, function in queries().items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            df = function(spark, folder)
            verdict = compare(df, con, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as error:
            verdict = "ERROR " + str(error).split("JVM stacktrace")[0][:500]
        bad += bool(verdict) and not verdict.startswith("rows only")
        print(f"{name:28s} {time.time() - began:6.2f}s {verdict or 'ok'}", flush=True)
    print("bad:", bad)
