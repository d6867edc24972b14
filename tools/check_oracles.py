"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

Usage: python tools/check_oracles.py [sf_dir] [name ...]

Compares row count, column names, column types (Spark simple type vs
DuckDB type) and the multiset of rows after sorting columns by name.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TYPE_MAP = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
            "smallint": "SMALLINT", "tinyint": "TINYINT", "date": "DATE"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, "" if x is None else str(type(x).__name__), x if x is not None else 0)
                 for x in row)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    s_cols = list(sdf.columns)
    if sql is None:
        return {"name": name, "status": "rows-only", "rows": len(s_rows), "sec": round(t_spark, 2)}
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} duck={sorted(d_cols)}")
    else:
        for c in s_cols:
            want = TYPE_MAP.get(s_types[c], s_types[c])
            if want != d_types[c]:
                problems.append(f"type {c}: spark={s_types[c]} duck={d_types[c]}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        dorder = [d_cols.index(s_cols[i]) for i in order]
        a = sorted((tuple(_norm(r[i]) for i in order) for r in s_rows), key=_key)
        b = sorted((tuple(_norm(r[i]) for i in dorder) for r in d_rows), key=_key)
        diffs = [(x, y) for x, y in zip(a, b) if x != y]
        if diffs:
            problems.append(f"{len(diffs)} differing rows, e.g. spark={diffs[0][0]} duck={diffs[0][1]}")
    return {"name": name, "status": "ok" if not problems else "FAIL", "rows": len(s_rows),
            "sec": round(t_spark, 2), "problems": problems}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from scorewell.plans.queries import oracle_sql, queries
    from scorewell.session import TABLES, local_session
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, orc = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            res = compare(spark, con, name, fn, orc.get(name), sf_dir)
        except Exception as exc:  # report and go on
            res = {"name": name, "status": "ERROR", "problems": [repr(exc)[:600]]}
        bad += res["status"] in ("FAIL", "ERROR")
        print(res, flush=True)
    print(f"{len(qs)} queries, {len(orc)} oracles, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
