"""Run jobs and their check SQL side by side.

    python tests/compare.py [--sf sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations").split()
DATA = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    if isinstance(value, bool) or value is None:
        return repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> str | None:
    """None when equal, otherwise what differs."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    want = rows_of(names, found.fetchall())
    have = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(have) != len(want):
        return f"{len(have)} rows != {len(want)}; only ours {list(set(have) - set(want))[:2]}, only theirs {list(set(want) - set(have))[:2]}"
    diff = [(a, b) for a, b in zip(have, want) if a != b]
    return f"{len(diff)} rows differ, first {diff[0]}" if diff else None


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="sf0.01")
    args = parser.parse_args()
    import __spark_entry__ as entry
    from protolith.session import local_session

    spark = local_session("8")
    sf_dir = f"{DATA}/{args.sf}"
    con = connect(sf_dir)
    jobs, checks = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args.names or jobs:
        began = time.time()
        try:
            df = jobs[name](spark, sf_dir)
            verdict = compare(df, con, checks[name]) if name in checks else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        ok = verdict is None or verdict.startswith("rows only")
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name:28s} {time.time() - began:6.1f}s {verdict or ''}"[:1500], flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
