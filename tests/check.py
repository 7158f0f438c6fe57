"""Run catalog queries beside their SQL oracles: ``python tests/check.py [sf] [name ...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from ratingloom.session import build_session, ensure_shared_dir  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{sf_dir}/{name}'")
    return con


DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def rows_of(columns: list[str], rows: list) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str:
    """'' when the query equals its oracle (or has none and yields rows), else what differs."""
    df = contract.queries()[name](spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    oracle = contract.oracle_sql().get(name)
    if oracle is None:
        return "" if mine else "no rows"
    cursor = con.execute(oracle)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    other = rows_of(columns, cursor.fetchall())
    if mine == other:
        types = {name: DUCK_TYPES[kind] for name, kind in df.dtypes}
        differ = {d[0]: (types[d[0]], str(d[1])) for d in cursor.description if types[d[0]] != str(d[1])}
        if differ:
            return f"types {differ}"
        return "" if mine else "both empty"
    extra = sorted(set(mine) - set(other))[:3]
    missing = sorted(set(other) - set(mine))[:3]
    return f"{len(mine)} rows against {len(other)}; only here {extra}; only in SQL {missing}"


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(contract.queries())
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = build_session(), connect(sf_dir)
    ensure_shared_dir(spark, tempfile.mkdtemp(prefix="ratingloom-check-"))
    failed = 0
    for name in names:
        began = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception:
            problem = traceback.format_exc()[-1500:]
        failed += bool(problem)
        kind = "sql" if name in contract.oracle_sql() else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {kind:4} {name:28} {time.time() - began:6.2f}s {problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} fine")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
