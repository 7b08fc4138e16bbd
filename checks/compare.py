"""Run queries side by side with their SQL: ``python -m checks.compare [sf_dir] [name …]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb

from checks import all_oracles, all_queries
from checks.mapping import TABLES
from ledgerlake.session import build_session


# Spark type names that DuckDB spells differently.
NAMES = {"string": "varchar", "int": "integer", "timestamp_ntz": "timestamp"}


def normal(value: object) -> str:
    return "<null>" if value is None else str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, name: str, sql: str | None, query) -> tuple[bool, str]:
    start = time.time()
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return True, f"rows={len(got)} {took:.2f}s (no SQL)"
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    rel = con.sql(sql)
    want, names = rel.fetchall(), rel.columns
    if sorted(names) != sorted(df.columns):
        return False, f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    kinds = {c: str(k).lower() for c, k in zip(names, rel.types, strict=True)}
    odd = {
        f.name: (f.dataType.simpleString(), kinds[f.name])
        for f in df.schema.fields
        if NAMES.get(f.dataType.simpleString(), f.dataType.simpleString()) != kinds[f.name]
    }
    a, b = rows_of(df.columns, got), rows_of(list(names), want)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b, strict=False) if x != y][:2]
        return False, f"rows {len(a)} vs {len(b)}\n   {sorted(names)}\n   " + "\n   ".join(f"{x}\n   {y}" for x, y in diff)
    return True, f"rows={len(a)} {took:.2f}s" + (f" types: {odd}" if odd else "")


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args and "/" in args[0] else "/root/testdata/sf0.01"
    names = [a for a in args if "/" not in a]
    spark = build_session(
        master=f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    oracles, failed = all_oracles(), 0
    for name, query in all_queries().items():
        if names and name not in names:
            continue
        try:
            ok, note = compare(spark, sf_dir, name, oracles.get(name), query)
        except Exception:
            ok, note = False, traceback.format_exc(limit=3)[-1500:]
        failed += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
