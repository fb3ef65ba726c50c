"""Compare registered queries with their SQL on DuckDB.

    python tests/check_queries.py [folder] [name part ...]
"""

from __future__ import annotations

import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def family(name: str) -> str:
    name = name.lower().split("(")[0]
    names = {
        "bigint": "bigint", "long": "bigint", "int": "integer", "integer": "integer",
        "double": "double", "varchar": "string", "string": "string", "date": "date",
        "boolean": "boolean", "timestamp": "timestamp", "timestamp_ntz": "timestamp",
    }
    return names.get(name, name)


def compare(spark, con, name, builder, sql, folder):
    df = builder(spark, folder)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return f"no SQL, {len(got)} rows"
    rel = con.execute(sql)
    columns = [d[0] for d in rel.description]
    want_columns, want = rows_of(columns, rel.fetchall())
    types = con.execute(f"describe {sql}").fetchall()
    want_types = {r[0]: family(r[1]) for r in types}
    got_types = {n: family(t) for n, t in df.dtypes}
    if got_columns != want_columns:
        return f"FAIL columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"FAIL rows {len(got)} != {len(want)}"
    differing = [(g, w) for g, w in zip(got, want) if g != w]
    if differing:
        return f"FAIL {len(differing)} of {len(got)} rows, first {differing[0]}"
    if got_types != want_types:
        odd = {k: (v, want_types[k]) for k, v in got_types.items() if want_types[k] != v}
        return f"FAIL types {odd}"
    return f"ok {len(got)} rows"


def main() -> int:
    import __spark_entry__ as entry
    from slipstream.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = build_session("check", "local[8]", 8, {"spark.driver.memory": "12g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(folder)
    failed = 0
    sqls = entry.oracle_sql()
    for name, builder in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            result = compare(spark, con, name, builder, sqls.get(name), folder)
        except Exception as error:  # report and go on with the next query
            result = f"FAIL {type(error).__name__} {str(error)[:600]}"
        failed += result.startswith("FAIL")
        print(f"{time.time() - start:6.2f}s {name}: {result}", flush=True)
    print("failed", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
