"""Run registered queries beside their SQL: python -m checks.compare [--sf DIR] [name ...]."""

from __future__ import annotations

import argparse
import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(_cell(r[i]) for i in order) for r in rows])


def compare(spark, con, name, fn, sql, sf_dir):
    """None if equal, else a short text saying how the results differ."""
    df = fn(spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        extra = set(mine[1]) - set(theirs[1]), set(theirs[1]) - set(mine[1])
        return f"rows {len(mine[1])} != {len(theirs[1])}; e.g. {[sorted(e)[:2] for e in extra]}"
    bad = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine[1])} rows differ; spark {bad[0][0]} sql {bad[0][1]}"
    if not mine[1]:
        return "both empty"
    return None


def main(argv=None) -> int:
    from checks import ORACLES, QUERIES
    from plotwise.session import build_session

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args(argv)
    spark = build_session("local[8]", 8, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(args.sf), 0
    for name, fn in QUERIES.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, con, name, fn, ORACLES[name], args.sf)
            else:
                problem = None if fn(spark, args.sf).count() else "no rows"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        kind = "oracle" if name in ORACLES else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {kind:6} {name} {problem or ''}", flush=True)
        failed += problem is not None
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
