"""Run registered queries on Spark and their oracle on DuckDB; compare results.

Usage: python tests/compare.py [sf_dir] [name ...]
Rows are compared as sorted multisets after normalising values (decimals,
dates, timestamps) to text, with columns in name order.
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "\x00NULL"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def normalise(cols: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return [cols[i] for i in order], out


def compare(spark, con, name: str, sf_dir: str, fn, oracle: str | None) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s_cols = df.columns
    t1 = time.time()
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if oracle is None:
        res["match"] = None
        return res
    rel = con.sql(oracle)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    res["oracle_rows"] = len(d_rows)
    sc, sr = normalise(s_cols, s_rows)
    dc, dr = normalise(d_cols, d_rows)
    res["match"] = sc == dc and sr == dr
    if not res["match"]:
        res["cols"] = (sc, dc)
        ds, ss = set(dr), set(sr)
        diff_s = [r for r in sr if r not in ds][:3]
        diff_d = [r for r in dr if r not in ss][:3]
        res["only_spark"], res["only_oracle"] = diff_s, diff_d
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from strata.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, orc = queries(), oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, sf_dir, qs[name], orc.get(name))
        except Exception as e:  # report and continue with the next query
            r = {"query": name, "error": repr(e)[:400]}
        if r.get("match") is False or "error" in r:
            bad += 1
        print(r, flush=True)
    print(f"mismatches/errors: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
