"""Spark-vs-DuckDB comparison used by the oracle tests and by ``python -m tests.oracle_compare``."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm_value(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm_value(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, name, query, sql, sf_dir):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count: spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        if diff:
            problems.append(f"{len(diff)} rows differ, first: spark={diff[0][0]} duck={diff[0][1]}")
    return problems, len(s_rows), t1 - t0, t2 - t1


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from drivestats.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = build_session("local[8]", **{"spark.ui.showConsoleProgress": "false"})
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, q in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            print(f"{name:32s} no oracle")
            continue
        problems, n, ts, td = compare(spark, con, name, q, sqls[name], sf_dir)
        status = "OK " if not problems else "BAD"
        bad += bool(problems)
        print(f"{status} {name:32s} rows={n:6d} spark={ts:6.2f}s duck={td:5.2f}s {'; '.join(problems)}")
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
