"""Compare registered queries with their SQL: ``python -m tests.check [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(round(value, 6) + 0.0)
    if value is None:
        return "~"
    return str(value)


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def differences(spark, con, name, build, sql, sf_dir) -> str:
    """Empty if both results have the same columns and rows."""
    df = build(spark, sf_dir)
    ours = as_rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    theirs = as_rows([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"{name}: columns {ours[0]} / {theirs[0]}"
    if ours[1] != theirs[1]:
        left, right = set(ours[1]), set(theirs[1])
        only_l, only_r = sorted(left - right), sorted(right - left)
        return f"{name}: rows {len(ours[1])} / {len(theirs[1])}; ours only {len(only_l)} {str(only_l[:2])[:600]}; SQL only {len(only_r)} {str(only_r[:2])[:600]}"
    return "" if ours[1] else f"{name}: no rows"


def main() -> None:
    import __spark_entry__ as entry
    from quotewell.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(entry.oracle_sql())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    bad = 0
    for name in wanted:
        began = time.time()
        try:
            found = differences(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], sf_dir)
        except Exception as e:  # report and go on
            found = f"{name}: {type(e).__name__} {str(e)[:1200]}"
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - began:.1f}s {found}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} equal")


if __name__ == "__main__":
    main()
