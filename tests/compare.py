"""Run queries next to their SQL counterparts: python -m tests.compare [folder] [name ...]"""

from __future__ import annotations

import datetime as dt
import sys
import time

import duckdb

from voltmesh.plans.bindings import TABLES
from voltmesh.plans.catalogue import all_queries, all_sql


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr), [names[i] for i in order]


_WORDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def difference(df, con, sql: str) -> str | None:
    """What differs between a Spark result and the SQL's, None when nothing does."""
    got, got_names = _sorted([tuple(r) for r in df.collect()], df.columns)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want, want_names = _sorted(cursor.fetchall(), names)
    if got_names != want_names:
        return f"columns {got_names} / {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    for a, b in zip(got, want):
        if repr(a) != repr(b):
            return f"{a} / {b}"[:600]
    types = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    odd = [
        f"{f.name}: {f.dataType.simpleString()} / {types[f.name]}"
        for f in df.schema.fields
        if _WORDS.get(f.dataType.simpleString()) != types[f.name]
    ]
    return f"types {odd}" if odd else None


def main(folder: str, wanted: list[str]) -> int:
    from voltmesh.session import get_session

    spark = get_session(cpus="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = all_sql()
    bad = 0
    for name, run in all_queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            df = run(spark, folder)
            result = difference(df, con, sql[name]) if name in sql else f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:700]}"
        bad += result is not None and not result.startswith("rows only")
        print(f"{name:26s} {time.time() - began:6.2f}s  {result or 'ok'}", flush=True)
    print("different:", bad)
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(min(1, main(args[0] if args else "/root/testdata/sf0.01", args[1:])))
