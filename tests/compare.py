"""Compare each named query with its reference SQL: python -m tests.compare [sf] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

DATA = "/root/testdata"


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return repr(value + 0.0)
    if hasattr(value, "isoformat"):
        return value.isoformat(sep=" ")
    return str(value)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def oracle_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    cursor = con.execute(sql)
    return bag([d[0] for d in cursor.description], cursor.fetchall())


def spark_rows(df):
    return bag(df.columns, [tuple(r) for r in df.collect()])


def differences(got, want) -> str:
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] == want[1]:
        return ""
    extra, missing = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
    return f"rows {len(got[1])} vs {len(want[1])}; extra {sorted(extra)[:3]}; missing {sorted(missing)[:3]}"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tests.session import make_session

    sf_dir = f"{DATA}/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    names = sys.argv[2:]
    spark = make_session()
    sqls = oracle_sql()
    bad = 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            got = spark_rows(query(spark, sf_dir))
            took = time.time() - begin
            why = differences(got, oracle_rows(sf_dir, sqls[name])) if name in sqls else "(no SQL)"
        except Exception as error:  # report and go on with the next query
            took, got, why = time.time() - begin, ([], []), f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(why)
        print(f"{name:28s} {took:6.2f}s {len(got[1]):8d} {'ok' if not why else 'DIFF ' + why}", flush=True)
    print(f"{bad} not equal")


if __name__ == "__main__":
    main()
