"""Run registered Spark queries and their DuckDB oracle side by side.

Mirrors the correctness gate: row count, column names, and an
order-insensitive hash of the values, per query. Usage:
    python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from martlet.sources.tables import TABLES, table_path  # noqa: E402


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "nan"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(row[i]) for i in order) for row in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def compare(spark, sf_dir: str, names: list[str] | None = None) -> dict:
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        sdf = qs[name](spark, sf_dir)
        s_cols = sdf.columns
        s_rows = [tuple(r) for r in sdf.collect()]
        rec = {"spark_rows": len(s_rows), "spark_sec": round(time.time() - t0, 2)}
        if name in sqls:
            res = con.execute(sqls[name])
            o_cols = [d[0] for d in res.description]
            o_rows = res.fetchall()
            rec.update(
                oracle_rows=len(o_rows),
                cols_match=sorted(s_cols) == sorted(o_cols),
                hash_match=sorted(s_cols) == sorted(o_cols) and digest(s_cols, s_rows) == digest(o_cols, o_rows),
            )
            if not rec["hash_match"]:
                rec["spark_cols"], rec["oracle_cols"] = s_cols, o_cols
                order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
                order_o = sorted(range(len(o_cols)), key=lambda i: o_cols[i])
                ss = {"|".join(_norm(r[i]) for i in order_s) for r in s_rows}
                oo = {"|".join(_norm(r[i]) for i in order_o) for r in o_rows}
                rec["only_spark"] = sorted(ss - oo)[:3]
                rec["only_oracle"] = sorted(oo - ss)[:3]
        out[name] = rec
    return out


if __name__ == "__main__":
    from martlet.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session()
    res = compare(spark, sf, names)
    for k, v in res.items():
        print(k, json.dumps(v, default=str))
    bad = [k for k, v in res.items() if v.get("hash_match") is False]
    print("MISMATCH:", bad if bad else "none")
