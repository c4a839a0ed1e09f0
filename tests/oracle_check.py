"""Compare registered queries with their SQL. `python tests/oracle_check.py [sf_dir] [name...]`"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        name, extension = os.path.splitext(file)
        if extension == ".parquet":
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{file}'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=_key)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if the query and the SQL give the same columns and rows."""
    expected = con.execute(sql)
    columns = [d[0] for d in expected.description]
    want = rows_of(columns, expected.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want, strict=True):
        same = all(
            type(a) is type(b) and (a == b or (isinstance(a, float) and math.isclose(a, b)))
            for a, b in zip(g, w, strict=True)
        )
        if not same:
            return f"{g} != {w}"
    return None


def main() -> int:
    from tests.conftest import make_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, con = make_session(), duck_connection(sf_dir)
    sql, failed = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if name not in sql or (only and name not in only):
            continue
        start = time.time()
        try:
            problem = difference(query(spark, sf_dir), con, sql[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name}: {problem or 'ok'} ({time.time() - start:.1f} s)", flush=True)
    print(f"{failed} failed")
    return min(failed, 1)


if __name__ == "__main__":
    raise SystemExit(main())
