"""Run registered queries in Spark and their oracle SQL in DuckDB on the same
parquet tables, and compare row count, column names and values (order
insensitive).  Usable from pytest and as a script:

    python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from shoplens.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat(sep=" ") if isinstance(v, datetime.datetime) else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


_DUCK_TYPE = {
    "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def compare(spark, con, sf_dir: str, key: str, query, sql: str) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {c: _DUCK_TYPE.get(t, t) for c, t in sdf.dtypes}
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    d_rows = rel.fetchall()
    t2 = time.time()
    res = {
        "key": key,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "spark_sec": round(t1 - t0, 2),
        "oracle_sec": round(t2 - t1, 2),
    }
    res["types_match"] = s_types == d_types
    res["values_match"] = res["columns_match"] and _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
    res["ok"] = res["values_match"] and res["types_match"] and len(s_rows) == len(d_rows)
    if not res["ok"]:
        res["spark_types"], res["oracle_types"] = s_types, d_types
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        res["spark_only"] = [r for r in a if r not in set(b)][:3]
        res["oracle_only"] = [r for r in b if r not in set(a)][:3]
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    from shoplens.session import get_session

    spark = get_session(master="local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or list(qs):
        if k not in sqls:
            print(f"{k}: no oracle")
            continue
        try:
            r = compare(spark, con, sf_dir, k, qs[k], sqls[k])
        except Exception as ex:  # report and go on
            r = {"key": k, "ok": False, "error": f"{type(ex).__name__}: {str(ex)[:400]}"}
        bad += not r["ok"]
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
