"""Run registered queries and their SQL side by side: ``python tests/oracle.py [folder] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from keyloom.sources.readers import STAR_TABLES  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in STAR_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def plain(value):
    """A value as text that two engines agree on; types must agree up to integer width."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return f"b:{value}"
    if isinstance(value, int):
        return f"i:{value}"
    if isinstance(value, decimal.Decimal):
        return f"d:{value.normalize():f}"
    if isinstance(value, float):
        return f"f:{value:.9g}"
    if isinstance(value, datetime.datetime):
        return f"t:{value.isoformat()}"
    return f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(con, df, sql):
    """(ok, message) for one query's result."""
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return False, f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        extra, lacking = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
        return False, f"{len(got)} rows != {len(want)}; extra {extra}; lacking {lacking}"
    bad = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    return not bad, f"{len(got)} rows" if not bad else f"{len(bad)} rows differ: {bad[:2]}"


def main() -> int:
    from keyloom.plans.star import ORACLE, QUERIES
    from keyloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con, failed = local_session("8"), connect(folder), 0
    for name in names:
        start = time.time()
        try:
            ok, message = compare(con, QUERIES[name](spark, folder), ORACLE[name])
        except Exception as error:  # report every query, then fail
            ok, message = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {message}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
