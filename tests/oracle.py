"""Compare registered queries with their SQL, as a module and from the command line.

    python -m tests.oracle [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import os
import sys
import time
import traceback

import duckdb
import pyarrow as pa

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(
        (tuple(_norm(v) for v in row) for row in zip(*columns, strict=True)),
        key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r),
    )


def compare(got: pa.Table, want: pa.Table) -> str | None:
    """None if equal, otherwise what differs."""
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"
    kinds = []
    for n in sorted(got.column_names):
        a, b = got.schema.field(n).type, want.schema.field(n).type
        same = a == b or (pa.types.is_large_string(b) and pa.types.is_string(a)) or (
            pa.types.is_string(b) and pa.types.is_large_string(a))
        if not same:
            kinds.append(f"{n}: {a} != {b}")
    if kinds:
        return "types " + "; ".join(kinds)
    a, b = rows_of(got), rows_of(want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}; only here {[r for r in a if r not in set(b)][:2]}, only there {[r for r in b if r not in set(a)][:2]}"
    for x, y in zip(a, b, strict=True):
        if x != y:
            return f"row {x} != {y}"
    return None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tidemark import build_session

    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    sf_dir = f"/root/testdata/sf{opts.sf}"
    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if opts.names and name not in opts.names:
            continue
        start = time.time()
        try:
            got = fn(spark, sf_dir).toArrow()
            took = time.time() - start
            if name not in sql:
                print(f"rows  {name}: {got.num_rows} ({took:.1f}s)", flush=True)
                continue
            start = time.time()
            want = con.sql(sql[name]).to_arrow_table()
            sql_took = time.time() - start
            problem = compare(got, want)
        except Exception as e:  # noqa: BLE001 - reported
            took = time.time() - start
            problem = f"{type(e).__name__}: {str(e)[:600]}"
            if opts.names:
                traceback.print_exc()
        if problem:
            failed.append(name)
            print(f"FAIL  {name}: {problem}", flush=True)
        else:
            print(f"ok    {name}: {got.num_rows} ({took:.1f}s, sql {sql_took:.1f}s)", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
